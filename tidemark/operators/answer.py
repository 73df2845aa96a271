"""Answers with gates: refuse what the corpus can't support, keep only citations that were shown."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold, shortened
from .retrieve import allowed_notes, fold_sql

LEAST_SCORE = 0.5
REASONS = ("out_of_coverage", "no_rows", "no_hits", "low_score", "fabricated_citations")
ANSWER = "sufficient boolean, answer string, citations array<bigint>"


def covers_range(since: Column, until: Column, low: Column, high: Column) -> Column:
    """Whether a range touches what is covered; an open end touches, an empty corpus covers nothing."""
    return F.coalesce((since.isNull() | (since <= high)) & (until.isNull() | (until >= low)), F.lit(False))


def covers_agency(agency: Column, known: Column) -> Column:
    """Whether some known agency's folded name holds the other's or is held by it."""
    a = fold_sql(agency)
    return F.exists(known, lambda k: F.contains(fold_sql(k), a) | F.contains(a, fold_sql(k)))


def coverage_gate(plans: DataFrame, covered: DataFrame) -> DataFrame:
    """plans with out_of_coverage (dates first, then any agency that isn't covered) and detail."""
    c = F.broadcast(covered.select("fecha_min", "fecha_max", F.col("organismos").alias("known")))
    joined = plans.join(c)
    dated = F.col("since").isNotNull() | F.col("until").isNotNull()
    bad_dates = dated & ~covers_range(F.col("since"), F.col("until"), F.col("fecha_min").cast("string"), F.col("fecha_max").cast("string"))
    missing = F.filter("organismos", lambda a: ~covers_agency(a, F.col("known")))
    detail = F.when(bad_dates, F.concat_ws("..", F.coalesce("since", F.lit("")), F.coalesce("until", F.lit("")))).when(F.size(missing) > 0, F.array_join(missing, "; "))
    return joined.select(*plans.columns, (bad_dates | (F.size(missing) > 0)).alias("out_of_coverage"), detail.alias("detail"))


def sql_answers(plans: DataFrame, notes: DataFrame, limit: int = 200) -> tuple[DataFrame, DataFrame]:
    """((q, total, detail) of counting plans, (q, rank, codigo) of listing plans)."""
    sql = plans.where("strategy = 'sql'")
    facts = notes.select("codigo", "organismo", "fecha")
    fits = allowed_notes(sql, notes).join(facts, "codigo")
    free = sql.where("size(organismos) = 0 and since is null and until is null").select("q", "wants_count")

    counting, listing = sql.where("wants_count").select("q"), sql.where("not wants_count").select("q")
    counts = fits.join(counting, "q", "left_semi").groupBy("q", "organismo").agg(F.count("*").alias("n"))
    newest = Window.partitionBy("q").orderBy(F.desc("fecha"), "codigo")
    listed = fits.join(listing, "q", "left_semi").withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= limit).select("q", "rank", "codigo")
    # plans without a filter ask for the same of all notices, which is worked out once: one row, and a list
    of_all = _totals(facts.groupBy("organismo").agg(F.count("*").alias("n")).withColumn("q", F.lit(0))).drop("q")
    top = facts.orderBy(F.desc("fecha"), "codigo").limit(limit).agg(F.sort_array(F.collect_list(F.struct("fecha", -F.col("codigo"), "codigo")), False).alias("top"))
    all_listed = free.where("not wants_count").select("q").join(F.broadcast(top)).select("q", F.posexplode("top").alias("i", "x")).select("q", (F.col("i") + 1).alias("rank"), "x.codigo")
    totals = _totals(counts).unionByName(free.where("wants_count").select("q").join(F.broadcast(of_all)).where("total is not null"))
    return totals, listed.unionByName(all_listed)


def _totals(counts: DataFrame) -> DataFrame:
    """(q, total, detail) of counts (q, organismo, n)."""
    top = Window.partitionBy("q").orderBy(F.desc("n"), "organismo")
    named = counts.withColumn("i", F.row_number().over(top))
    detail = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("i") <= 10, F.struct("i", F.concat_ws(": ", F.col("organismo"), F.col("n").cast("string")).alias("s"))))), lambda x: x["s"]), "; ")
    return named.groupBy("q").agg(F.sum("n").alias("total"), detail.alias("detail"))


def extractive(hits: DataFrame, passages: int = 3, chars: int = 400) -> DataFrame:
    """(q, sufficient, answer, citations): the heads of the best passages and their codes."""
    best = hits.where(F.col("rank") <= passages).groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", "codigo", shortened(F.col("texto"), chars).alias("t")))).alias("x"))
    return best.select("q", F.lit(True).alias("sufficient"), F.array_join(F.transform("x", lambda r: F.concat(F.lit("["), r["codigo"].cast("string"), F.lit("] "), r["t"])), "\n").alias("answer"), F.array_distinct(F.transform("x", lambda r: r["codigo"])).alias("citations"))


def parse_answers(raw: DataFrame) -> DataFrame:
    """(q, sufficient, answer, citations) from a provider's (q, json). What isn't such an object
    is no answer."""
    a = raw.select("q", F.from_json("json", ANSWER).alias("a"))
    bad = F.col("a").isNull() | F.col("a.sufficient").isNull() | F.col("a.answer").isNull()
    return a.select("q", F.when(bad, False).otherwise(F.col("a.sufficient")).alias("sufficient"), F.when(bad, "").otherwise(F.col("a.answer")).alias("answer"), F.when(bad, F.array().cast("array<bigint>")).otherwise(F.coalesce("a.citations", F.array().cast("array<bigint>"))).alias("citations"))


def answer(plans: DataFrame, covered: DataFrame, notes: DataFrame, hits: DataFrame, provider: Callable[[DataFrame], DataFrame] = extractive, least_score: float = LEAST_SCORE) -> DataFrame:
    """(q, strategy, refused_because, answer, citations) for all plans in one go.

    hits are (q, rank, codigo, bm25, texto). Gates in order: coverage, then for sql no rows, for
    the rest no hits and a best raw score below least_score (never a fused one); last, citations
    that were shown are kept, and an answer all of whose citations weren't is refused. provider
    maps hits to (q, sufficient, answer, citations).
    """
    gated = coverage_gate(plans, covered).select("q", "strategy", "wants_count", "out_of_coverage")
    counts, listed = sql_answers(plans, notes)
    listing = listed.groupBy("q").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "codigo"))), lambda r: r["codigo"]).alias("codes"))
    shown = hits.groupBy("q").agg(F.min_by("bm25", "rank").alias("best"), F.collect_set("codigo").alias("shown"))
    given = provider(hits)
    every = gated.join(counts, "q", "left").join(listing, "q", "left").join(shown, "q", "left").join(given, "q", "left")
    sql = F.col("strategy") == "sql"
    cited, real = F.coalesce("citations", F.array().cast("array<bigint>")), F.array_intersect("citations", "shown")
    why = F.when(F.col("out_of_coverage"), "out_of_coverage").when(sql & F.coalesce("total", F.lit(0)).eqNullSafe(0) & F.col("codes").isNull(), "no_rows").when(~sql & F.col("best").isNull(), "no_hits").when(~sql & (F.col("best") < least_score), "low_score").when(~sql & (F.size(cited) > 0) & (F.size(real) == 0), "fabricated_citations")
    said = F.when(sql & F.col("wants_count"), F.concat_ws(" — ", F.col("total").cast("string"), "detail")).when(sql, F.array_join(F.col("codes").cast("array<string>"), ", ")).otherwise(F.col("answer"))
    out = every.select("q", "strategy", why.alias("refused_because"), F.when(why.isNull(), said).alias("answer"), F.when(why.isNull(), F.when(sql, F.coalesce("codes", F.array().cast("array<bigint>"))).otherwise(F.coalesce(real, F.array().cast("array<bigint>")))).otherwise(F.array().cast("array<bigint>")).alias("citations"), F.coalesce("sufficient", sql).alias("sufficient"))
    return out


__all__ = ["answer", "coverage_gate", "covers_agency", "covers_range", "extractive", "fold", "parse_answers", "sql_answers"]
