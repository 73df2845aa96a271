"""Benchmark decontamination: greedy string tiling of documents with test passages."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import hash128, written
from .tokens import Tokenizer, folded, gram_hashes, running_hashes

#: The shortest match, in words; the share of a passage that makes a document contaminated.
LEAST, COVERAGE = 5, 0.5
#: Seeds of the benchmark that may travel to every task (about 12 bytes each); more are joined by shuffle.
MOST_SEEDS = 2_000_000
#: Parts of a seed's documents that are joined apart.
SALTS = 16


def tiles(doc: np.ndarray, item: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences: (start in doc, start in item, length) of matches
    that overlap in neither sequence, in any order, of at least `least` tokens.

    Running Karp-Rabin: windows of unmarked tokens of the sought length meet by running hashes,
    and matches are extended as far as they go. If one is over twice that length, the search
    starts over there. Matches are marked from the longest on; what is left of one that others
    cut into competes again if it is long enough. Then the sought length halves.
    """
    free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)
    least = min(least, len(item))
    found, sought = [], max(least, len(item))
    while least and free_i.any():
        matches = _matches(doc, item, free_d, free_i, sought)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * sought:
            sought = longest
            continue
        heap = [(-k, t, s) for s, t, k in matches]
        heapify(heap)
        while heap:
            k, t, s = heappop(heap)
            open_ = free_d[s : s - k] & free_i[t : t - k]
            if open_.all():
                free_d[s : s - k] = free_i[t : t - k] = False
                found.append((s, t, -k))
            else:
                edge = np.diff(np.concatenate([[0], open_.view(np.int8), [0]]))
                for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
                    if b - a >= sought:
                        heappush(heap, (int(a - b), int(t + a), int(s + a)))
        if sought == least:
            break
        sought = max(least, sought // 2)
    return sorted(found, key=lambda m: m[1])


def _matches(doc: np.ndarray, item: np.ndarray, free_d: np.ndarray, free_i: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Matches of at least n unmarked tokens that can't be extended to the left."""

    def windows(x: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        taken = np.concatenate([[0], np.cumsum(~free)])
        at = np.flatnonzero(taken[n:] == taken[:-n]) if len(x) >= n else np.empty(0, np.int64)
        return at, running_hashes(x, n)[at]

    at_i, h_i = windows(item, free_i)
    at_d, h_d = windows(doc, free_d)
    by = defaultdict(list)
    for t, h in zip(at_i.tolist(), h_i.tolist()):
        by[h].append(t)
    hit = np.isin(h_d, h_i)
    found = []
    for s, h in zip(at_d[hit].tolist(), h_d[hit].tolist()):
        for t in by[h]:
            if s and t and doc[s - 1] == item[t - 1] and free_d[s - 1] and free_i[t - 1]:
                continue
            m = min(len(doc) - s, len(item) - t)
            same = (doc[s : s + m] == item[t : t + m]) & free_d[s : s + m] & free_i[t : t + m]
            k = m if same.all() else int(same.argmin())
            if k >= n:
                found.append((s, t, k))
                if k == len(item):
                    return [(s, t, k)]
    return found


class Items:
    """The benchmark's token sequences, with a table from seed hash to items."""

    def __init__(self, texts: list[str | None], least: int = LEAST) -> None:
        tokens, self.least, self.items = Tokenizer(), least, []
        for t in texts:
            self.items.append(tokens.words(folded(t).encode("utf-8", "replace"))[0])
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by: dict[int, list] = defaultdict(list)
        for i, h in enumerate(self.items):
            if n := min(least, len(h)):
                by[n] += [(g, i) for g in set(gram_hashes(h, n).tolist())]
        for n, found in by.items():
            found.sort()
            g, i = np.array([x[0] for x in found], np.uint64), np.array([x[1] for x in found])
            sieve = np.zeros(1 << max(12, int(np.ceil(np.log2(len(g) * 16)))), bool)
            sieve[g & np.uint64(len(sieve) - 1)] = True
            self.seeds[n] = (g, i, sieve)

    def pairs(self, h: np.ndarray, cut: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) wherever a text has a seed of the item."""
        out: set[tuple[int, int]] = set()
        for n, (g, items, sieve) in self.seeds.items():
            x = gram_hashes(h, n)
            at = np.flatnonzero(sieve[x & np.uint64(len(sieve) - 1)])
            a, b = np.searchsorted(g, x[at]), np.searchsorted(g, x[at], "right")
            at, a, b = at[b > a], a[b > a], b[b > a]
            text = np.searchsorted(cut, at, "right") - 1
            inside = at + n <= cut[text + 1]
            for t, lo, hi in set(zip(text[inside].tolist(), a[inside].tolist(), b[inside].tolist())):
                out.update((t, i) for i in items[lo:hi].tolist())
        return out


_SPANS = "array<struct<doc_word: int, item_word: int, n_words: int>>"


def _found(items: Items, texts: list[str | None], least: int, coverage: float) -> Iterator[tuple[int, int, int, int, list]]:
    """(text, item, words marked, words of the item, tiles) for each covered pair."""
    tokens = Tokenizer()
    for first, _, cut, h, _, _ in tokens.groups([folded(t) for t in texts]):
        for t, i in sorted(items.pairs(h, cut)):
            item = items.items[i]
            parts = tiles(h[cut[t] : cut[t + 1]], item, least)
            marked = sum(p[2] for p in parts)
            if marked >= coverage * len(item):
                yield first + t, i, marked, len(item), parts


def _batch(rows: list[tuple], doc_type: pa.DataType, item_type: pa.DataType) -> pa.RecordBatch:
    span = pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()), ("n_words", pa.int32())])
    spans = [[{"doc_word": int(s), "item_word": int(u), "n_words": int(k)} for s, u, k in r[4]] for r in rows]
    cols = [pa.array([r[0] for r in rows], doc_type), pa.array([r[1] for r in rows], item_type), pa.array([r[2] / r[3] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.int32()), pa.array(spans, pa.list_(span))]
    return pa.RecordBatch.from_arrays(cols, names=["doc", "item", "coverage", "n_words", "tiles"])


def _small(bench: DataFrame, id_col: str, text_col: str, least: int):
    """The benchmark's ids and Items if its seeds are at most MOST_SEEDS, else None. A text has
    fewer words than bytes, so the bytes are measured before anything is collected."""
    size = bench.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{text_col}`")) + 16), F.lit(0))).head()[0]
    if size > 4 * MOST_SEEDS:
        return None
    rows = bench.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t")).orderBy("i", "t").collect()
    return [r["i"] for r in rows], [r["t"] for r in rows]


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """A row for each document and test passage of which the document has at least `coverage`:
    the ids, coverage (words in tiles by words of the passage), n_words (in tiles) and tiles.

    Words are runs of ASCII letters, digits and non-ASCII characters, after Unicode case folding
    and composition of both sides, so case in any script, punctuation and line breaks between
    words don't matter; nor does the order of the parts, each of which has at least `least` words
    (a shorter passage must occur whole). Null and empty texts match nothing. Repeated rows give a row each; null ids pass through. An empty table on
    either side gives no rows.

    A benchmark of proven small size goes to every task, and documents are neither shuffled nor
    reread. A larger one is joined by its seeds. Tiles that cover enough of a passage hold a number
    of its seeds, so each passage leaves out its most frequent seeds, one fewer than that number,
    and pairs are dropped that share fewer than it; texts follow only for the pairs that are left.
    A seed that very many documents have is split.
    """
    found = _contaminated(docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text")), bench, item_col, item_text_col, least, coverage)
    return found.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "coverage", "n_words", "tiles")


def _contaminated(docs: DataFrame, bench: DataFrame, item_col: str, item_text_col: str, least: int, coverage: float) -> DataFrame:
    spark, item_kind = docs.sparkSession, bench.schema[item_col].dataType
    schema = f"doc {docs.schema['doc'].dataType.simpleString()}, item {item_kind.simpleString()}, coverage double, n_words int, tiles {_SPANS}"
    small = _small(bench, item_col, item_text_col, least)
    if small is None:
        return _by_shuffle(docs, bench.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").alias("item_text")), least, coverage, schema)
    item_type = to_arrow_type(item_kind)
    shared = spark.sparkContext.broadcast((small[0], Items(small[1], least)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, items = shared.value
        for part in parts:
            docs, texts = part.column(0), part.column(1).to_pylist()
            yield _batch([(docs[t].as_py(), ids[i], *rest) for t, i, *rest in _found(items, texts, least, coverage)], docs.type, item_type)

    return docs.select("doc", "text").mapInArrow(run, schema)


def needed(n_words: int, least: int = LEAST, coverage: float = COVERAGE) -> int:
    """How many of a passage's seeds (n_words - least + 1 places) lie in tiles that cover enough of
    it, at least: each place covers `least` words."""
    least = min(least, n_words)
    return max(1, int(np.ceil(coverage * n_words / least))) if least else 0


def _by_shuffle(docs: DataFrame, bench: DataFrame, least: int, coverage: float, schema: str) -> DataFrame:
    lengths = [r[0] for r in written(bench.select(_n_words("item_text", least).alias("n")).distinct(), "lengths").where("n > 0").collect()]

    def grams(kind: str):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens = Tokenizer()
            for part in parts:
                keys = [part.column(i).to_numpy() for i in (0, 1)]
                for first, texts, cut, h, _, _ in tokens.groups([folded(t) for t in part.column(2).to_pylist()]):
                    for t in range(len(texts)):
                        own = h[cut[t] : cut[t + 1]]
                        for n in lengths if kind == "doc" else [min(least, len(own))]:
                            g, times = np.unique(gram_hashes(own, n), return_counts=True) if n else (np.empty(0, np.uint64), np.empty(0, np.int64))
                            same = lambda x, kind: pa.array(np.full(len(g), x), kind)  # noqa: B023, E731
                            need = needed(len(own), least, coverage) if kind == "item" else 0
                            yield pa.RecordBatch.from_arrays([same(keys[0][first + t], pa.int64()), same(keys[1][first + t], pa.int64()), same(n, pa.int32()), pa.array(g.view(np.int64)), pa.array(times, pa.int64()), same(need, pa.int64())], names=["k1", "k2", "n", "g", "times", "need"])

        return run

    def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
        k1, k2 = hash128(F.col(key), F.col(text))
        return df.select(k1.alias("k1"), k2.alias("k2"), F.col(key), F.col(text))

    d, b = keyed(docs, "doc", "text"), keyed(bench, "item", "item_text")
    of_doc, of_item = [x.select("k1", "k2", t).mapInArrow(grams(k), "k1 long, k2 long, n int, g long, times long, need long").withColumnsRenamed({"k1": f"{k}1", "k2": f"{k}2"}) for x, k, t in ((d, "doc", "text"), (b, "item", "item_text"))]
    of_item = written(of_item, "seeds")
    # documents' seeds that some passage has, each once, and how many documents have each
    held = written(of_doc.select("doc1", "doc2", "n", "g").join(of_item.select("n", "g").distinct(), ["n", "g"], "left_semi"), "held")
    often = of_item.join(held.groupBy("n", "g").agg(F.count("*").alias("often")), ["n", "g"])
    along = Window.partitionBy("item1", "item2").orderBy(F.desc("often"), "g")
    rare = often.withColumn("so_far", F.sum("times").over(along)).where("so_far >= need").select("item1", "item2", "n", "g", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    meet = written(held.withColumn("salt", F.pmod("doc1", F.lit(SALTS)).cast("int")).join(rare, ["n", "g", "salt"]).select("doc1", "doc2", "item1", "item2").distinct(), "pairs")
    # of these pairs, those that share enough seeds
    have = meet.join(of_item, ["item1", "item2"]).join(held, ["doc1", "doc2", "n", "g"])
    enough = written(have.groupBy("doc1", "doc2", "item1", "item2").agg(F.sum("times").alias("shared"), F.min("need").alias("need")).where("shared >= need"), "enough")
    pairs = enough.join(d, (F.col("doc1") == d.k1) & (F.col("doc2") == d.k2)).select("doc", "text", "item1", "item2").join(b, (F.col("item1") == b.k1) & (F.col("item2") == b.k2))
    item_type = to_arrow_type(bench.schema["item"].dataType)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokenizer()
        words = lambda t: tokens.words(folded(t).encode("utf-8", "replace"))[0]
        for part in parts:
            rows = []
            for doc, text, item, item_text in zip(*(part.column(i).to_pylist() for i in range(4))):
                own = words(item_text)
                found = tiles(words(text), own, least)
                marked = sum(p[2] for p in found)
                if marked >= coverage * len(own):
                    rows.append((doc, item, marked, len(own), found))
            yield _batch(rows, part.column(0).type, item_type)

    return pairs.select("doc", "text", "item", "item_text").mapInArrow(run, schema)


def _n_words(text: str, most: int):
    def count(texts: pd.Series) -> pd.Series:
        tokens = Tokenizer()
        return pd.Series([min(most, len(tokens.words(folded(t).encode("utf-8", "replace"))[0])) for t in texts], dtype="int32")

    return F.pandas_udf(count, "int")(F.col(text))


def drop_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: int = LEAST, coverage: float = COVERAGE) -> DataFrame:
    """The rows of docs that have less than `coverage` of every test passage."""
    small = _small(bench, item_col, item_text_col, least)
    names = [F.col(f"`{c}`") for c in docs.columns]
    text = F.col(f"`{text_col}`")
    if small is None:
        key = F.concat_ws(" ", *[F.hex(h) for h in hash128(text)])
        bad = _contaminated(docs.select(key.alias("doc"), text.alias("text")), bench, item_col, item_text_col, least, coverage).select(F.col("doc").alias("contaminated text")).distinct()
        return docs.join(bad, key == F.col("`contaminated text`"), "left_anti").select(*names)
    shared = docs.sparkSession.sparkContext.broadcast(Items(small[1], least))

    def clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            good = np.ones(len(part), bool)
            good[[t for t, *_ in _found(shared.value, part.tolist(), least, coverage)]] = False
            yield pd.Series(good)

    return docs.where(F.pandas_udf(clean, "boolean")(text))
