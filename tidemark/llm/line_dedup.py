"""Line dedup: drop lines that many documents share, keep them in one document, join the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, ascii_lower, hash128


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The rows of docs with text_col rewritten, plus n_lines and n_dropped.

    A text is split at newlines. A line's key is the line without ASCII white space at its ends
    and with A-Z lower-cased. A key of at least min_chars code points that occurs in at least
    min_docs documents loses all its lines, except those in the largest id that holds it.

    Null text counts as empty, which is one empty line. Rows with equal ids are one document
    when documents are counted, and each keeps its own text; rows with a null id count as no
    document, and lose the lines that are lost elsewhere. Other columns pass unchanged, whatever
    their names; an empty table gives an empty one.

    Keys travel as 128-bit hashes. Distinct (key, document) pairs are counted in two steps, both
    combined before the shuffle, so a line in a third of all documents is no hot group; the join
    of lines to lost keys is left to the skew handling of adaptive execution. Of the texts
    themselves one shuffle is made, on the row key.
    """
    r1, r2 = hash128(F.col(id_col), F.col(text_col))
    base = docs.select(F.col(id_col).alias("d"), r1.alias("r1"), r2.alias("r2"), F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
    key = base.where(F.length("line") >= min_chars).select("d", "r1", "r2", "pos", F.trim(F.col("line"), F.lit(ASCII_SPACE)).alias("t"))
    k1, k2 = hash128(ascii_lower(F.col("t")))
    keyed = key.where(F.length("t") >= min_chars).select("d", "r1", "r2", "pos", k1.alias("k1"), k2.alias("k2"))
    lost = keyed.where("d is not null").select("k1", "k2", "d").distinct().groupBy("k1", "k2").agg(F.count("d").alias("n"), F.max("d").alias("last")).where(F.col("n") >= min_docs).select("k1", "k2", "last")
    gone = keyed.join(lost, ["k1", "k2"]).where(~F.col("d").eqNullSafe(F.col("last"))).groupBy("r1", "r2").agg(F.sort_array(F.collect_set("pos")).alias("gone"))

    names = docs.columns
    row = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], r1.alias("r1"), r2.alias("r2"))
    t = F.col(f"c{names.index(text_col)}")
    out = row.join(gone.hint("shuffle_hash"), ["r1", "r2"], "left").withColumn("lines", _lines(t))
    ends = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size("lines")))
    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(1), F.size("ends") - 1), lambda i: F.slice("lines", F.get("ends", i - 1) + 2, F.get("ends", i) - F.get("ends", i - 1) - 1))), "\n")
    new = F.when(F.col("gone").isNull(), F.coalesce(t, F.lit(""))).otherwise(kept)
    out = out.withColumn("ends", ends)
    return out.select(*[(new if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)], F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
