"""Change detection: notes, bodies and editions against what is stored; the run ledger; work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TRACKED

COUNTERS = ("inserted", "updated", "unchanged", "skipped_robots", "no_edition", "errors")


def upsert_outcomes(stored: DataFrame, incoming: DataFrame, key: str = "codigo", hash_col: str = "content_hash") -> DataFrame:
    """(key, outcome): inserted, updated or unchanged for each incoming row, by its hash."""
    s = stored.select(F.col(key), F.col(hash_col).alias("old"), F.lit(True).alias("known"))
    outcome = F.when(F.col("known").isNull(), "inserted").when(F.col(hash_col).eqNullSafe(F.col("old")), "unchanged").otherwise("updated")
    return incoming.join(s, key, "left").select(key, outcome.alias("outcome"))


def field_diffs(stored: DataFrame, incoming: DataFrame, fields: tuple[str, ...] = TRACKED, key: str = "codigo", hash_col: str = "content_hash") -> DataFrame:
    """(key, revision, field, old_value, new_value) of the fields whose raw values differ in
    updated rows; revision is the one that the change makes."""
    s = stored.select(F.col(key), F.col(hash_col).alias("h"), F.col("revision").alias("r"), *[F.col(f).cast("string").alias(f"old {f}") for f in fields])
    both = incoming.join(s, key).where(~F.col(hash_col).eqNullSafe(F.col("h")))
    parts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`old {f}`").alias("old_value"), F.col(f).cast("string").alias("new_value")) for f in fields])
    return both.select(key, (F.col("r") + 1).alias("revision"), F.explode(parts).alias("d")).select(key, "revision", "d.*").where("not (old_value <=> new_value)")


def upsert_notes(stored: DataFrame, incoming: DataFrame, now: Column | str) -> DataFrame:
    """The stored notes after the incoming ones: new ones start at revision 1, changed ones take
    the incoming business fields and addresses and the next revision, equal ones are only seen.
    Body columns stay. One full join on codigo."""
    now = F.lit(now) if isinstance(now, str) else now
    fields = [c for c in incoming.columns if c != "codigo"]
    i = incoming.select("codigo", *[F.col(c).alias(f"new {c}") for c in fields], F.lit(True).alias("came"))
    both = stored.join(i, "codigo", "full")
    come, new = F.col("came").isNotNull(), F.col("revision").isNull()
    changed = come & ~new & ~F.col("content_hash").eqNullSafe(F.col("`new content_hash`"))
    out = []
    for c in stored.columns:
        old = F.col(c)
        if c in fields:
            v = F.when(come & (new | changed), F.col(f"`new {c}`")).otherwise(old)
        elif c == "revision":
            v = F.when(new, F.lit(1)).when(changed, old + 1).otherwise(old)
        elif c == "first_seen_at":
            v = F.when(new, now).otherwise(old)
        elif c == "last_seen_at":
            v = F.when(come, now).otherwise(old)
        elif c == "last_changed_at":
            v = F.when(new | changed, now).otherwise(old)
        elif c == "body_status":
            v = F.when(new, F.lit("pending")).otherwise(old)
        else:
            v = old
        out.append(v.cast(stored.schema[c].dataType).alias(c))
    return both.select(*out)


def set_bodies(stored: DataFrame, bodies: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """(stored notes with the bodies, (codigo, outcome)) for bodies (codigo, body_status, body_text).

    unchanged if hash and status are the same, inserted if there was no hash and now is one, else
    updated; unknown if there is no such note. A failure after a success clears the text.
    """
    b = bodies.select("codigo", F.col("body_status").alias("status2"), F.col("body_text").alias("text2"), F.when(F.col("body_text").isNotNull(), F.sha2("body_text", 256)).alias("hash2"))
    same = F.col("body_hash").eqNullSafe(F.col("hash2")) & F.col("body_status").eqNullSafe(F.col("status2"))
    known = stored.select("codigo", "body_hash", "body_status", F.lit(True).alias("known"))
    outcome = F.when(F.col("known").isNull(), "unknown").when(same, "unchanged").when(F.col("body_hash").isNull() & F.col("hash2").isNotNull(), "inserted").otherwise("updated")
    outcomes = b.join(known, "codigo", "left").select("codigo", outcome.alias("outcome"))
    both = stored.join(b, "codigo", "left")
    got, moved = F.col("status2").isNotNull(), F.col("status2").isNotNull() & ~same
    put = {"body_text": F.when(moved, F.col("text2")).otherwise(F.col("body_text")), "body_hash": F.when(moved, F.col("hash2")).otherwise(F.col("body_hash")), "body_status": F.when(moved, F.col("status2")).otherwise(F.col("body_status")), "body_fetched_at": F.when(got, F.lit(now)).otherwise(F.col("body_fetched_at")), "last_changed_at": F.when(moved, F.lit(now)).otherwise(F.col("last_changed_at"))}
    return both.select(*[put.get(c, F.col(c)).alias(c) for c in stored.columns]), outcomes


def pending_bodies(notes: DataFrame, limit: int, retry_errors: bool = False) -> DataFrame:
    """The newest notes whose bodies are to be fetched."""
    wanted = ["pending", "error"] if retry_errors else ["pending"]
    return notes.where(F.col("body_status").isin(wanted)).orderBy(F.desc("fecha"), "codigo").limit(limit)


def page_hash(notes: DataFrame, by: list[str], hash_col: str = "content_hash") -> DataFrame:
    """One hash for the set of a page's notes, whatever their order."""
    return notes.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_set(hash_col)), "|"), 256).alias("page_hash"))


def record_editions(stored: DataFrame, seen: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """(editions after seen, (fecha, edicion, changed)) for seen (fecha, edicion, status, n_notas,
    n_rejected, page_hash, url). A first sighting is a change, as is another hash or status."""
    keys = ["fecha", "edicion"]
    rest = [c for c in seen.columns if c not in keys]
    s = seen.select(*keys, *[F.col(c).alias(f"new {c}") for c in rest], F.lit(True).alias("came"))
    both = stored.withColumn("known", F.lit(True)).join(s, keys, "full")
    come = F.col("came").isNotNull()
    moved = come & (F.col("known").isNull() | ~F.col("page_hash").eqNullSafe(F.col("`new page_hash`")) | ~F.col("status").eqNullSafe(F.col("`new status`")))
    put = {c: F.when(come, F.col(f"`new {c}`")).otherwise(F.col(c)) for c in rest}
    put |= {"first_seen_at": F.coalesce("first_seen_at", F.lit(now)), "last_seen_at": F.when(come, F.lit(now)).otherwise(F.col("last_seen_at")), "last_changed_at": F.coalesce(F.when(moved, F.lit(now)), F.col("last_changed_at"))}
    return both.select(*[put.get(c, F.col(c)).alias(c) for c in stored.columns]), both.where(come).select(*keys, moved.alias("changed"))


def editions_to_visit(days: DataFrame, editions: DataFrame, today: str, recheck_days: int) -> DataFrame:
    """(fecha, edicion) of days that aren't recorded, or are younger than the recheck window."""
    old = editions.where(F.to_date("fecha") < F.date_sub(F.lit(today).cast("date"), recheck_days)).select("fecha", "edicion")
    return days.join(old, ["fecha", "edicion"], "left_anti")


def known_editions(editions: DataFrame, days: DataFrame) -> DataFrame:
    return editions.join(days.select("fecha").distinct(), "fecha", "left_semi")


def store_stats(notes: DataFrame, editions: DataFrame, revisions: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: counts of everything stored, each table read once."""
    n = notes.agg(F.count("*").alias("notas"), *[F.count_if(F.col("body_status") == s).alias(f"body_{s}") for s in ("ok", "pending", "robots_denied", "error")], F.count_if(F.col("revision") > 1).alias("amended"), F.count_distinct("organismo").alias("organismos"), F.coalesce(F.concat(F.min("fecha").cast("string"), F.lit(".."), F.max("fecha").cast("string")), F.lit("")).alias("fechas"))
    e = editions.agg(F.count("*").alias("editions"), F.count_if(F.col("status") == "no_edition").alias("no_edition"))
    return n.join(e).join(revisions.agg(F.count("*").alias("diffs"))).join(runs.agg(F.count("*").alias("runs")))


def run_counters(outcomes: DataFrame) -> dict[str, int]:
    found = {r["outcome"]: r["count"] for r in outcomes.groupBy("outcome").count().collect()}
    return {c: found.get(c, 0) for c in COUNTERS}


def merged(a: dict, b: dict) -> dict:
    """Counters added, details joined up to 50."""
    out = {c: a.get(c, 0) + b.get(c, 0) for c in {*a, *b} - {"detail"}}
    return out | {"detail": [*a.get("detail", []), *b.get("detail", [])][:50]}


def ledger_row(spark, run_id: int, command: str, started: str, finished: str | None, status: str, counters: dict) -> DataFrame:
    import json

    from ..schemas import RUN

    whole = lambda c: int(counters.get(c, 0))
    row = (run_id, command, started, finished, status, *[whole(c) for c in (*COUNTERS, "requests", "retries", "bytes_down")], float(counters.get("slept_s", 0.0)), json.dumps(counters.get("detail", [])[:50], ensure_ascii=False))
    return spark.createDataFrame([row], RUN)
