"""Ranked retrieval for many questions at once: BM25, filters, fusion, caps; counting and listing."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _ACCENTED, _STRIPPED, fold, shortened
from . import inplace
from .index import PREFIX, WEIGHTS, lengths, postings

K1, B, DAMPING = 1.2, 0.75, 60


def phrases(questions: DataFrame, terms_col: str = "terms", use_prefix: bool = True) -> DataFrame:
    """(q, phrase, is_prefix) from arrays of terms: punctuation separates, words of up to two
    characters go, each word counts once, and long ones become prefixes. Words are data here, no
    query language, so nothing a user types can be an operator."""
    words = F.split(F.array_join(F.col(terms_col), " "), r"(?U)[^\w]+")
    one = questions.select("q", F.explode(F.array_distinct(F.filter(words, lambda w: F.length(w) > 2))).alias("w"))
    long = (F.length("w") > PREFIX) & F.lit(use_prefix)
    return one.select("q", F.when(long, F.substring("w", 1, PREFIX)).otherwise(F.col("w")).alias("phrase"), long.alias("is_prefix")).distinct()


def bm25(posts: DataFrame, sizes: DataFrame, asked: DataFrame, id_cols: list[str], allowed: DataFrame | None = None, within=None) -> DataFrame:
    """(q, id, score) of every passage that matches a phrase.

    Document frequencies, the number of passages and their mean length are those of the whole
    corpus, whatever the filters `allowed` (q, id or id alone) and `within` (a function of the
    scored hits), which are applied after them. The inverse frequency has a floor just above zero.
    What a phrase gives a passage is worked out once for all questions that have the phrase.
    """
    ways = ["phrase", "is_prefix"]
    sought = asked.select(*ways).distinct().withColumn("begin", F.substring("phrase", 1, PREFIX))
    tf = posts.join(sought, (F.col("prefix") == F.col("begin")) & (F.col("is_prefix") | (F.col("term") == F.col("phrase")))).groupBy(*ways, *id_cols, "n_tokens").agg(F.sum("wtf").alias("tf"))
    df = tf.groupBy(*ways).agg(F.count("*").alias("df"))
    total = sizes.agg(F.count("*").alias("n"), F.avg("n_tokens").alias("avgdl"))
    idf = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = df.join(F.broadcast(total)).select(*ways, F.when(idf <= 0, 1e-6).otherwise(idf).alias("idf"), "avgdl")
    part = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("n_tokens") / F.col("avgdl")))
    scored = tf.join(weight, ways).select(*ways, *id_cols, part.alias("part"))
    hits = scored.join(asked.select("q", *ways), ways).groupBy("q", *id_cols).agg(F.sum("part").alias("score"))
    if allowed is not None:
        hits = hits.join(allowed, [c for c in ("q", *id_cols) if c in allowed.columns], "left_semi")
    return hits if within is None else within(hits)


def best_hits(chunks: DataFrame, runs: list[DataFrame], id_cols: list[str], k: int, allowed: DataFrame | None = None, plans: DataFrame | None = None, notes: DataFrame | None = None, folded: bool = True, places: int = 9) -> DataFrame:
    """(run, q, id, score, rank): the k best passages by bm25 of each question (q, phrase, is_prefix)
    of each run, with frequencies of all chunks; filters are allowed (id) and plans over notes.

    The questions are measured, then sent to all tasks, which read the passages twice: for the
    frequencies, then for the scores, of which only each task's best are shuffled. A question set
    that is too large to be sent goes by postings.
    """
    asked = inplace.asked_of(runs)
    filters = None
    if asked is not None and plans is not None:
        filters = _filters(asked, plans, notes)
    if asked is None or (plans is not None and filters is None):
        within = None if plans is None else within_filters(plans, notes)
        every = [bm25(postings(chunks, id_cols, folded, only=r), lengths(chunks, id_cols, folded), r, id_cols, allowed, within).select(F.lit(i).alias("run"), "q", *id_cols, "score") for i, r in enumerate(runs)]
        scored = every[0]
        for e in every[1:]:
            scored = scored.union(e)
        return top_k(scored, k, id_cols, places=places, of=["run", "q"])
    df, n, avgdl = inplace.statistics(chunks, asked, WEIGHTS, folded)
    idf = np.log((n - df + 0.5) / (df + 0.5))
    if allowed is not None:
        chunks = chunks.join(allowed, id_cols, "left_semi")
    if filters is not None:
        facts = notes.select("codigo", F.col("organismo").alias("its agency"), F.col("fecha").cast("string").alias("its day"))
        chunks = chunks.join(facts, "codigo")
    found = inplace.best(chunks, id_cols, asked, k, np.where(idf <= 0, 1e-6, idf), avgdl, K1, B, WEIGHTS, folded, filters, places, runs[0].schema["q"].dataType)
    return top_k(found, k, id_cols, places=places, of=["run", "q"])


def _filters(asked: inplace.Asked, plans: DataFrame, notes: DataFrame) -> inplace.Filters | None:
    p = plans.select("q", "organismos", "since", "until")
    named = plan_agencies(p, notes).limit(inplace.MOST_NAMED + 1).collect()
    if len(named) > inplace.MOST_NAMED:
        return None
    return inplace.Filters(asked.questions, p.select("q", F.size("organismos") > 0, "since", "until").collect(), named)


def top_k(scored: DataFrame, k: int, id_cols: list[str], score: str = "score", places: int = 9, of: list[str] | None = None) -> DataFrame:
    """The k best of each question, ties by id, with their rank. Scores are held against each other
    to nine places, so that copies tie whatever the order of their sums."""
    w = Window.partitionBy(*(of or ["q"])).orderBy(F.desc(F.round(score, places)), *id_cols)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def cap_per_note(ranked: DataFrame, per_note: int = 2, note: str = "codigo") -> DataFrame:
    """At most per_note passages of a notice for each question, the best by rank."""
    w = Window.partitionBy("q", note).orderBy("rank")
    return ranked.withColumn("of_note", F.row_number().over(w)).where(F.col("of_note") <= per_note).drop("of_note")


def rrf(runs: list[DataFrame], id_cols: list[str], damping: int = DAMPING) -> DataFrame:
    """(q, id, score, bm25) by reciprocal rank fusion of runs (q, id, rank, score). bm25 is that of
    the first run that has the passage; ties go by first appearance."""
    tagged = [r.select("q", *id_cols, F.lit(i).alias("run"), "rank", F.col("score").alias("s")) for i, r in enumerate(runs)]
    every = tagged[0]
    for r in tagged[1:]:
        every = every.unionByName(r)
    return fused(every, id_cols, damping)


def fused(every: DataFrame, id_cols: list[str], damping: int = DAMPING, s: str = "s") -> DataFrame:
    """rrf of runs that are one table (run, q, id, rank, s)."""
    return every.groupBy("q", *id_cols).agg(F.sum(1.0 / (damping + F.col("rank"))).alias("score"), F.min(F.struct("run", "rank", F.col(s).alias("s"))).alias("first")).select("q", *id_cols, "score", F.col("first.s").alias("bm25"), F.col("first.run").alias("run"), F.col("first.rank").alias("run_rank"))


def note_filter(organismos: Iterable[str] = (), since: str | None = None, until: str | None = None, organismo: str = "organismo", fecha: str = "fecha") -> Column:
    """A notice passes if any agency's folded name is in its own, and its date is in the range."""
    out = F.lit(True)
    names = list(organismos)
    if names:
        some = F.lit(False)
        for n in names:
            some = some | F.contains(fold(F.col(organismo)), fold(F.lit(n)))
        out = out & some
    if since:
        out = out & (F.col(fecha) >= F.lit(since))
    if until:
        out = out & (F.col(fecha) <= F.lit(until))
    return out


#: Distinct names of agencies that may be held against those of plans, pair by pair.
MOST_AGENCIES = 100_000


def fold_sql(c: Column) -> Column:
    """fold for Latin names, where a Python function can't stand (inside lambdas)."""
    return F.translate(F.lower(c), _ACCENTED, _STRIPPED)


_DATED = "since is not null or until is not null"
_FILTERED = f"size(organismos) > 0 or {_DATED}"


def _in_range(fecha: Column) -> Column:
    day = fecha.cast("string")
    return (F.col("since").isNull() | (day >= F.col("since"))) & (F.col("until").isNull() | (day <= F.col("until")))


def plan_agencies(plans: DataFrame, notes: DataFrame) -> DataFrame:
    """(q, organismo): the corpus's own names of agencies that hold the folded name of one that a
    plan asks for. Only distinct names meet, and only if they are a vocabulary."""
    asked = plans.select("q", F.explode("organismos").alias("a")).select("q", fold(F.col("a")).alias("asked")).distinct()
    own = notes.select("organismo").where("organismo is not null").distinct().withColumn("own", fold(F.col("organismo")))
    if (n := own.limit(MOST_AGENCIES + 1).count()) > MOST_AGENCIES:
        raise ValueError(f"over {n - 1} agencies are no vocabulary")
    alike = asked.select("asked").distinct().join(F.broadcast(own), F.contains("own", "asked")).select("asked", "organismo")
    return asked.join(alike, "asked").select("q", "organismo").distinct()


def allowed_notes(plans: DataFrame, notes: DataFrame) -> DataFrame:
    """(q, codigo) for plans (q, organismos, since, until) that have a filter: by equal names of
    agencies where they name any, else by the days of their range that the corpus has."""
    p = plans.select("q", "organismos", "since", "until")
    named = plan_agencies(p, notes).join(p.select("q", "since", "until"), "q")
    by_name = notes.select("codigo", "fecha", "organismo").join(named, "organismo").where(_in_range(F.col("fecha"))).select("q", "codigo")
    days = notes.select(F.col("fecha").cast("string").alias("day")).where("day is not null").distinct()
    ranges = p.where(f"size(organismos) = 0 and ({_DATED})").select("q", "since", "until")
    held = days.join(ranges, _in_range(F.col("day"))).select("q", "day")
    by_day = notes.select("codigo", F.col("fecha").cast("string").alias("day")).join(held, "day").select("q", "codigo")
    return by_name.union(by_day).distinct()


def within_filters(plans: DataFrame, notes: DataFrame):
    """Keeps hits (q, codigo, ...) whose notice passes the filters of its question's plan. Notices
    are joined to hits by code and plans by question; nothing else meets."""
    p = plans.select("q", "organismos", "since", "until")
    named = plan_agencies(p, notes).withColumnRenamed("organismo", "is in")
    facts = notes.select("codigo", "fecha", "organismo")

    def keep(hits: DataFrame) -> DataFrame:
        known = hits.join(facts, "codigo").join(p.withColumn("names", F.size("organismos") > 0).drop("organismos"), "q").where(_in_range(F.col("fecha")) | F.expr(f"not ({_DATED})"))
        own = known.join(named.withColumn("ok", F.lit(True)), (known.q == named.q) & (F.col("organismo") == F.col("is in")), "left").where("not names or ok")
        return own.select(*[known[c] for c in hits.columns])

    return keep


def retrieve(posts: DataFrame | None, sizes: DataFrame | None, plans: DataFrame, notes: DataFrame, k: int = 8, use_expansion: bool = True, use_prefilter: bool = True, use_prefix: bool = True, per_note: int = 2, chunks: DataFrame | None = None, folded: bool = True) -> DataFrame:
    """(q, rank, codigo, chunk_ix, score, bm25) for plans (q, terms, expansions, organismos, since,
    until): a literal run and, where expansions add words, an expanded one, each 3k deep; fused by
    reciprocal rank where there are two; then the cap by notice; then k. Passages are sought by
    their postings, or in chunks themselves."""
    ids = ["codigo", "chunk_ix"]
    literal = phrases(plans, "terms", use_prefix)
    runs, wider = [literal], None
    if use_expansion:
        more = phrases(plans.withColumn("all", F.concat("terms", F.flatten(F.map_values("expansions")))), "all", use_prefix)
        wider = more.groupBy("q").count().join(literal.groupBy("q").count().withColumnRenamed("count", "n"), "q", "left").where("n is null or count > n").select("q")
        runs.append(more.join(wider, "q", "left_semi"))
    if chunks is not None:
        every = best_hits(chunks, runs, ids, 3 * k, plans=plans if use_prefilter else None, notes=notes, folded=folded)
    else:
        within = within_filters(plans, notes) if use_prefilter else None
        tops = [top_k(bm25(posts, sizes, r, ids, within=within), 3 * k, ids).select(F.lit(i).alias("run"), "q", *ids, "score", "rank") for i, r in enumerate(runs)]
        every = tops[0]
        for t in tops[1:]:
            every = every.union(t)
    scored = fused(every, ids, s="score")
    if wider is None:
        scored = scored.withColumn("score", F.col("bm25"))
    else:
        scored = scored.join(F.broadcast(wider.withColumn("wider", F.lit(True))), "q", "left").withColumn("score", F.when(F.col("wider"), F.col("score")).otherwise(F.col("bm25"))).drop("wider")
    w = Window.partitionBy("q").orderBy(F.desc(F.round("score", 9)), "run", "run_rank", *ids)
    ranked = cap_per_note(scored.withColumn("rank", F.row_number().over(w)), per_note)
    again = Window.partitionBy("q").orderBy("rank")
    return ranked.withColumn("rank", F.row_number().over(again)).where(F.col("rank") <= k).select("q", "rank", *ids, "score", "bm25")


def count_by_agency(notes: DataFrame, where: Column) -> DataFrame:
    return notes.where(where).groupBy("organismo").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "organismo")


def enumerate_notes(notes: DataFrame, where: Column, limit: int = 200) -> DataFrame:
    return notes.where(where).orderBy(F.desc("fecha"), "codigo").limit(limit)


def coverage(notes: DataFrame) -> DataFrame:
    """One row: what the corpus holds, the ground for refusals. Its agencies are a set, which is as
    large as the vocabulary of agencies and no larger."""
    return notes.agg(F.count("*").alias("n_notas"), F.count_if(F.col("body_status") == "ok").alias("n_con_texto"), F.min("fecha").alias("fecha_min"), F.max("fecha").alias("fecha_max"), F.array_sort(F.collect_set("organismo")).alias("organismos"))


def context(hits: DataFrame, most: int = 1400) -> DataFrame:
    """(q, context): the passages of each question in order of rank, with their codes."""
    part = F.concat(F.lit("["), F.col("codigo").cast("string"), F.lit("] "), F.coalesce("titulo", F.lit("")), F.lit("\n"), shortened(F.col("texto"), most))
    return hits.groupBy("q").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", part.alias("p")))), lambda x: x["p"]), "\n---\n").alias("context"))


def split_context(c: Column) -> Column:
    """(codigo, passage) of each part of a context."""
    return F.transform(F.split(c, "\n---\n"), lambda p: F.struct(F.regexp_extract(p, r"^\[(\d+)\]", 1).try_cast("bigint").alias("codigo"), F.regexp_replace(p, r"^\[\d+\][^\n]*\n", "").alias("texto")))
