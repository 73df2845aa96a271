"""Questions from end to end: plans, retrieval or exact counts, gates, answers, citations to show."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import route
from .answer import LEAST_SCORE, answer, extractive
from .retrieve import coverage, retrieve

IDS = ["codigo", "chunk_ix"]


class Asked(NamedTuple):
    """plans (q, question, strategy, ...), hits (q, rank, codigo, chunk_ix, score, bm25, texto) and
    answers (q, strategy, refused_because, answer, citations, sufficient)."""

    plans: DataFrame
    hits: DataFrame
    answers: DataFrame


def no_answers(hits: DataFrame) -> DataFrame:
    """The provider of a run without generation: it declines every question."""
    return hits.select("q").distinct().select("q", F.lit(False).alias("sufficient"), F.lit("").alias("answer"), F.array().cast("array<bigint>").alias("citations"))


def ask(questions: DataFrame, notes: DataFrame, chunks: DataFrame, provider: Callable[[DataFrame], DataFrame] = extractive, k: int = 8, least_score: float = LEAST_SCORE, folded: bool = True, lists_count: bool = False, **options) -> Asked:
    """Answers a table of questions (q, question, today) over notes and their chunks, in one plan.

    Each is routed by the corpus's own agencies, refused where the corpus doesn't cover it, then
    counted or listed exactly, or answered by the provider from the passages that are found; what
    it cites must have been shown. Passages are scored where they lie. options are those of retrieve.
    """
    covered = coverage(notes)
    known = [o for o in (covered.head()["organismos"] or []) if o is not None]
    plans = route.plan(questions, known, lists_count)
    found = retrieve(None, None, plans.where("strategy != 'sql'"), notes, k, chunks=chunks, folded=folded, **options)
    hits = found.join(chunks.select(*IDS, "texto"), IDS)
    return Asked(plans, hits, answer(plans, covered, notes, hits, provider, least_score))


def sources(asked: Asked, notes: DataFrame, title_chars: int = 80) -> DataFrame:
    """(q, pos, codigo, fecha, organismo, titulo, url): what each answer cites, in its order, with
    the facts to show beside it; nulls for a code that names no note."""
    cited = asked.answers.where("sufficient and refused_because is null").select("q", F.posexplode("citations").alias("pos", "codigo"))
    facts = notes.select("codigo", "fecha", "organismo", F.substring("titulo", 1, title_chars).alias("titulo"), F.col("url_detalle").alias("url"))
    return cited.join(facts, "codigo", "left").select("q", "pos", "codigo", "fecha", "organismo", "titulo", "url")
