"""SimHash near-dedup: fingerprints of word shingles, linked through shared blocks of bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, written

#: Blocks of the first and of the second level; pairs share all but MOST_BITS of them.
BLOCKS, SUB_BLOCKS = 5, 8
MOST_BITS = 2
#: A key that more fingerprints share than this is split by the bits it leaves free.
LARGE_GROUP = 256
#: Shingles hashed at once, which bounds the memory that a very long text takes.
AT_ONCE = 200_000


def fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit SimHash of a text: a bit is 1 if it is set in over half the XXH64 hashes
    (seed 42) of its shingles of `width` words, repeats included. Words are runs of anything but
    ASCII white space, with A-Z lower-cased; fewer words make one shingle, none make zero."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxh64_intdigest(b" ".join(words), 42)
    ones, n = np.zeros(64, np.int64), len(words) - width + 1
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    for at in range(0, n, AT_ONCE):
        part = words[at : at + AT_ONCE + width - 1]
        joined = b" ".join(part)
        ends = np.cumsum([len(w) + 1 for w in part])
        starts = (ends - [len(w) + 1 for w in part])[: len(part) - width + 1].tolist()
        hashes = [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist())]
        lanes = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[8 * k : 8 * k + 8] += np.bincount(lanes[:, k], minlength=256) @ bits
    return int(sum(1 << i for i in range(64) if 2 * ones[i] > n))


def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([(x := fingerprint(t)) - ((x >> 63) << 64) for t in batch], dtype="int64")


def _spans(bits: int, blocks: int) -> list[tuple[int, int]]:
    cuts = [bits * i // blocks for i in range(blocks + 1)]
    return list(zip(cuts, cuts[1:]))


def _mask(spans: list[tuple[int, int]]) -> int:
    m = sum(((1 << (b - a)) - 1) << a for a, b in spans)
    return m - ((m >> 63) << 64)


def block_masks(spans: list[tuple[int, int]]) -> list[int]:
    """A mask for every choice of all but MOST_BITS blocks: fingerprints that differ in at most
    MOST_BITS bits agree under one of them."""
    return [_mask([s for i, s in enumerate(spans) if i not in out]) for out in combinations(range(len(spans)), MOST_BITS)]


def _free_masks(mask: int) -> list[int]:
    """For a first-level mask, the second-level masks: all of it, and all but MOST_BITS of the
    SUB_BLOCKS parts of the bits that it leaves free."""
    free = [i for i in range(64) if not (mask >> i) & 1]
    parts = [free[a:b] for a, b in _spans(len(free), SUB_BLOCKS)]
    whole = mask & ((1 << 64) - 1)
    found = []
    for out in combinations(range(SUB_BLOCKS), MOST_BITS):
        m = whole | sum(1 << i for k, p in enumerate(parts) if k not in out for i in p)
        found.append(m - ((m >> 63) << 64))
    return found


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(masks)]))
    return fps.select("fp", keys.alias("x")).select("fp", "x.m", "x.v")


def _near(a: Column, b: Column) -> Column:
    return (a < b) & (F.bit_count(a.bitwiseXOR(b)) <= MOST_BITS)


def _pairs(keyed: DataFrame) -> DataFrame:
    a, b = keyed.select("m", "v", F.col("fp").alias("a")), keyed.select("m", "v", F.col("fp").alias("b"))
    return a.join(b, ["m", "v"]).where(_near(F.col("a"), F.col("b"))).select("a", "b")


def linked_fingerprints(fps: DataFrame) -> DataFrame:
    """(a, b), a < b: every pair of the distinct fingerprints fp that differ in at most MOST_BITS bits.

    First-level keys leave out MOST_BITS of BLOCKS blocks, so about 38 bits agree. A key that
    over LARGE_GROUP fingerprints share is keyed again, with all but MOST_BITS of the SUB_BLOCKS
    parts of its free bits; at most 2^8 fingerprints can share one of those. So no group is large,
    whatever the data, and no pair is lost.
    """
    masks = block_masks(_spans(64, BLOCKS))
    keyed = _keyed(fps, masks)
    large = written(keyed.groupBy("m", "v").count().where(F.col("count") > LARGE_GROUP).select("m", "v"), "large")
    small = keyed.join(large, ["m", "v"], "left_anti")
    free = F.element_at(F.array(*[F.array(*[F.lit(x) for x in _free_masks(m)]) for m in masks]), F.col("m") + 1)
    again = keyed.join(large, ["m", "v"], "left_semi").select("fp", "m", F.posexplode(free).alias("p", "mask"))
    again = again.select("fp", (F.col("m") * 100 + F.col("p")).alias("m"), F.col("fp").bitwiseAND(F.col("mask")).alias("v"))
    return _pairs(small).union(_pairs(again)).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id, fingerprint (16 hex digits), n_near, component_id.

    Two rows link when their fingerprints differ in at most MOST_BITS bits; n_near counts the
    other rows linked directly, component_id is the smallest id reachable through links, the
    row's own included. Null and empty texts have fingerprint zero, which links like any other.
    Equal ids are not merged: each row counts. A row with a null id counts and links like any
    other, but is never the smallest; if a component has only null ids, component_id is null.

    Equal fingerprints are collapsed first, so a group of copies is one vertex with a count,
    however large; only distinct fingerprints meet in the join on blocks.
    """
    rows = written(docs.select(F.col(id_col).alias("id"), F.pandas_udf(fingerprints, "long")(F.col(text_col)).alias("fp")), "fingerprints")
    groups = _groups(rows, "id")
    low = groups.groupBy("c").agg(F.min("least").alias("component_id"))
    found = groups.join(low, "c").select("fp", "n_near", "component_id")
    return rows.join(found.hint("shuffle_hash"), "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "n_near", "component_id")


def _groups(rows: DataFrame, order: str) -> DataFrame:
    """For each fingerprint fp of rows its component c, n_near, and the least value of order."""
    classes = rows.groupBy("fp").agg(F.count("*").alias("n"), F.min(order).alias("least"))
    classes = written(classes, "classes")
    links = written(linked_fingerprints(classes.select("fp")), "links")
    both = links.union(links.select("b", "a"))
    around = both.join(classes.select(F.col("fp").alias("b"), "n"), "b").groupBy(F.col("a").alias("fp")).agg(F.sum("n").alias("others"))
    parts = connected_components(links)
    groups = classes.join(around, "fp", "left").join(parts.select(F.col("node").alias("fp"), "component"), "fp", "left")
    return written(groups.select("fp", "least", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_near"), F.coalesce("component", "fp").alias("c")), "groups")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component: the one with the smallest id and, of rows with equal
    ids, the one whose text hashes lowest. Rows are judged one by one: an id that repeats with
    texts of several components may stay with each of them. Rows with a null id name no document
    that others could be copies of: they pass unchanged."""
    known, text = docs.where(F.col(f"`{id_col}`").isNotNull()), F.col(f"`{text_col}`")
    t1, t2 = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    row = F.struct(F.col(f"`{id_col}`").alias("id"), t1.alias("t1"), t2.alias("t2")).alias("row")
    rows = written(known.select(row, F.pandas_udf(fingerprints, "long")(text).alias("fp")), "fingerprints")
    first = _groups(rows, "row").groupBy("c").agg(F.min("least").alias("row"))
    first = first.select(F.col("row.id").alias("first id"), F.col("row.t1").alias("first t1"), F.col("row.t2").alias("first t2"))
    w = Window.partitionBy(f"`{id_col}`", t1, t2).orderBy(t1)
    same = (known[id_col] == F.col("`first id`")) & (t1 == F.col("`first t1`")) & (t2 == F.col("`first t2`"))
    stays = known.join(first, same, "left_semi").withColumn("rank among equals", F.row_number().over(w)).where("`rank among equals` = 1")
    return stays.select(*[f"`{c}`" for c in docs.columns]).union(docs.where(F.col(f"`{id_col}`").isNull()))
