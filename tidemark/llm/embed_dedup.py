"""Embedding near-dedup: exact cosine links within a label, by tiles of PCA-rotated vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, hash128, written

#: Vectors of a tile (fewer where they are long) and numbers in it, tiles of a block; rows of a tile
#: that are compared at once; vectors that the rotation is fitted on.
TILE, NUMBERS, BLOCK, ROWS, FIT = 4096, 1 << 21, 4, 512, 4096
#: Leading coordinates that place a vector, and bits of each in its place on the curve.
LEAD, BITS = 8, 7
#: Leading dimensions after which pairs are dropped. Sums this close to the threshold are computed again.
STEPS, NEAR = (8, 16, 32, 64, 128, 256, 512), 1e-9
SALTS = 16
#: Stands for the smallest of no ids where pandas would turn whole numbers into floats.
NO_ID = (1 << 63) - 1


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def rotation(sample: np.ndarray) -> np.ndarray:
    """An orthogonal matrix whose leading columns hold the most of the sample's second moment. Any
    orthogonal matrix gives the same links; a fitted one lets pairs be dropped sooner."""
    return np.linalg.eigh(sample.T @ sample)[1][:, ::-1]


def links(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of the rows of x and y with cosine >= threshold, block by block; i < j if
    x and y are the same. Rows are unit vectors, rotated. After each step of leading dimensions
    the rest of a product is bounded by the norms of what is left of both vectors."""
    d = x.shape[1]
    steps = [*[s for s in STEPS if s < d], d]
    left = [(np.sqrt((x[:, s:] ** 2).sum(1)), np.sqrt((y[:, s:] ** 2).sum(1))) for s in steps]
    for a in range(0, len(x), ROWS):
        part = x[a : a + ROWS]
        b = a if same else 0
        total, at, i = np.zeros((len(part), len(y) - b)), 0, None
        for s, (lx, ly) in zip(steps, left):
            if i is None:
                total += part[:, at:s] @ y[b:, at:s].T
                alive = total + np.multiply.outer(lx[a : a + ROWS], ly[b:]) >= threshold - NEAR
                if same:
                    alive &= np.arange(len(part))[:, None] < np.arange(len(y) - b)
                n = np.count_nonzero(alive)
                if n < 0.02 * alive.size or s == d:
                    i, j = np.nonzero(alive)
                    total = total[i, j]
            else:
                total = total + np.einsum("ij,ij->i", part[i, at:s], y[b + j, at:s])
                ok = total + lx[a + i] * ly[b + j] >= threshold - NEAR
                i, j, total = i[ok], j[ok], total[ok]
            at = s
            if i is not None and not len(i):
                break
        if len(i):
            close = np.abs(total - threshold) <= NEAR
            yield i + a, j + b, close


def _compare(threshold: float, turn: np.ndarray):
    def compare(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("tile")
        tiles, at = {}, 0
        for tile, dim, start, vectors, weights in zip(*(block[c] for c in ("tile", "dim", "start", "vectors", "weights"))):
            raw = np.frombuffer(vectors, np.float64).reshape(-1, int(dim))
            spun = unit(raw)
            tiles[tile] = (raw, spun @ turn if len(turn) == dim else spun, np.asarray(weights, np.int64), at, int(start))
            at += len(raw)
        count, root = np.zeros(at, np.int64), np.arange(at)
        node = np.concatenate([start + np.arange(len(raw)) for raw, _, _, _, start in tiles.values()])
        for a, partners in zip(block["tile"], block["partners"]):
            for b in [] if partners is None else partners:
                (raw, x, wx, mx, _), (other, y, wy, my, _) = tiles[a], tiles[b]
                for i, j, close in links(x, y, threshold, a == b):
                    if close.any():
                        k = np.flatnonzero(close)
                        p, q = raw[i[k]], other[j[k]]
                        exact = np.einsum("ij,ij->i", p, q) / np.sqrt(np.einsum("ij,ij->i", p, p) * np.einsum("ij,ij->i", q, q))
                        sure = np.ones(len(i), bool)
                        sure[k[~(exact >= threshold)]] = False
                        i, j = i[sure], j[sure]
                    np.add.at(count, i + mx, wy[j])
                    np.add.at(count, j + my, wx[i])
                    i, j = i + mx, j + my
                    while True:
                        before = root.copy()
                        low = np.minimum(root[i], root[j])
                        np.minimum.at(root, root[i], low)
                        np.minimum.at(root, root[j], low)
                        root = root[root]
                        if (before == root).all():
                            break
        hit = count > 0
        return pd.DataFrame({"node": node[hit], "links": count[hit], "root": node[root][hit]})

    return compare


def _placer(turn: np.ndarray, edges: np.ndarray):
    """Adds to each row its leading coordinates and the norm of the rest, and its place on a curve
    through the cells of the leading coordinates, which keeps near vectors together."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            box, z = np.zeros((len(part), LEAD + 1)), np.zeros(len(part), np.int64)
            own = np.flatnonzero((part["dim"] == len(turn)).to_numpy())
            if len(own):
                spun = unit(np.stack(part["v"].to_numpy()[own])) @ turn[:, :LEAD]
                box[own[:, None], np.arange(spun.shape[1])] = spun
                box[own, LEAD] = np.sqrt(np.maximum(0, 1 - (spun * spun).sum(1)))
                cells = [np.searchsorted(e, c) for e, c in zip(edges, spun.T)]
                for bit in reversed(range(BITS)):
                    for cell in cells:
                        z[own] = z[own] << 1 | (cell >> bit & 1)
            yield part.assign(z=z, box=list(box))

    return place


def _tiler(size: int):
    """Rows sorted by label, dim and place, into tiles; node ids run on within a task, whose number
    is that of its tiles' block."""

    def tile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 40
        held: list[tuple] = []

        def out() -> pd.DataFrame:
            nonlocal at
            k1, k2, label, dim, v, n, least, box = zip(*held)
            box = np.stack(box)
            made = pd.DataFrame({"tile": [at], "label": [label[0]], "dim": [dim[0]], "lo": [box.min(0)], "hi": [box.max(0)], "start": [at], "vectors": [np.stack(v).astype(np.float64).tobytes()], "weights": [list(n)], "k1": [list(k1)], "k2": [list(k2)], "least": [list(least)]})
            at += len(held)
            held.clear()
            return made

        for part in batches:
            for row in zip(*(part[c] for c in ("k1", "k2", "label", "dim", "v", "n", "least", "box"))):
                if held and (len(held) >= min(size, max(64, NUMBERS // row[3])) or row[2:4] != held[-1][2:4]):
                    yield out()
                held.append(row)
        if held:
            yield out()

    return tile


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", tile: int = TILE) -> DataFrame:
    """One row per row of vectors: the id, n_links, component_id, kept.

    Rows with equal labels link when their cosine, in double precision, is at least threshold.
    Null labels, and vectors that are null, empty, zero, or hold a null or non-finite component,
    link with nothing; nor do vectors of different lengths. Rows with equal ids each count. A
    null id links like any other but is never the smallest. Other columns are left out.

    Equal vectors of a label are collapsed into one with a count. The others are range-partitioned
    by label and by a curve through their leading principal coordinates into tiles, so a label with
    most of the rows is many tiles. Tiles meet in a range join on the leading coordinate, and only
    if the boxes of their leading coordinates and of the norms of the rest are near enough for the
    threshold. A task gets the tiles of two blocks, each once, compares those that meet, and gives
    counts and the roots of a spanning forest, at most a row per vector, however dense the links.
    """
    row = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    sound = F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    k1, k2 = hash128(F.col("label"), F.col("v"))
    text_ids = dict(row.dtypes)["id"] == "string"
    good = row.where(sound).select("id", "label", "v", k1.alias("k1"), k2.alias("k2"), F.size("v").alias("dim"))
    sizes = good.groupBy("dim").agg(F.count("*").alias("n"))
    total, dim = (sizes.agg(F.sum("n"), F.max_by("dim", F.struct("n", -F.col("dim")))).head()) or (None, None)
    turn, edges = np.eye(0), np.empty((0, 0))
    if dim:
        sample = good.where((F.col("dim") == dim) & (F.pmod("k2", F.lit(max(1, total // FIT))) == 0)).select("v").limit(2 * FIT).collect()
        sample = unit(np.array([r[0] for r in sample], np.float64)) if sample else np.eye(dim)
        turn = rotation(sample)
        edges = np.quantile(sample @ turn[:, :LEAD], np.arange(1, 1 << BITS) / (1 << BITS), axis=0).T
    classes = good.groupBy("k1", "k2").agg(F.any_value("label").alias("label"), F.any_value("v").alias("v"), F.count("*").alias("n"), F.min(F.col("id").cast("string")).alias("least") if text_ids else F.coalesce(F.min("id"), F.lit(NO_ID)).cast("long").alias("least")).withColumn("dim", F.size("v"))
    kinds = {c: t for c, t in classes.dtypes}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ("k1", "k2", "label", "v", "n", "least", "dim"))
    placed = written(classes.select("k1", "k2", "label", "v", "n", "least", "dim").mapInPandas(_placer(turn, edges), schema + ", z long, box array<double>"), "vectors")
    spread = placed.repartitionByRange(max(1, -(-(total or 0) // (BLOCK * tile))), "label", "dim", "z", "k1").sortWithinPartitions("label", "dim", "z", "k1", "k2")
    tiles = spread.select("k1", "k2", "label", "dim", "v", "n", "least", "box").mapInPandas(_tiler(tile), f"tile long, label {kinds['label']}, dim int, lo array<double>, hi array<double>, start long, vectors binary, weights array<long>, k1 array<long>, k2 array<long>, least array<{kinds['least']}>")
    tiles = written(tiles, "tiles")

    gap = float(np.sqrt(max(0, 2 - 2 * threshold)) + 1e-6)
    reach = lambda less: F.sequence(F.floor(F.element_at("lo", 1) / gap) - less, F.floor(F.element_at("hi", 1) / gap) + less)
    side = tiles.select("tile", "label", "dim", "lo", "hi")
    a = side.select(F.col("tile").alias("a"), "label", "dim", F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"), reach(0).alias("cells"), F.pmod("tile", F.lit(SALTS)).cast("int").alias("salt"))
    a = a.withColumn("a_first", F.element_at("cells", 1)).withColumn("cell", F.explode("cells")).drop("cells")
    b = side.select(F.col("tile").alias("b"), "label", "dim", "lo", "hi", reach(1).alias("cells")).withColumn("b_first", F.element_at("cells", 1)).withColumn("cell", F.explode("cells")).drop("cells")
    b = b.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    apart = F.zip_with(F.zip_with("a_lo", "hi", lambda x, y: x - y), F.zip_with("lo", "a_hi", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    near = F.aggregate(apart, F.lit(0.0), lambda s, x: s + x * x) <= gap * gap
    meet = a.join(b, ["label", "dim", "salt", "cell"]).where((F.col("a") <= F.col("b")) & (F.col("cell") == F.greatest("a_first", "b_first")) & near).select("a", "b")
    blocks = [F.shiftright("a", 40).alias("block_a"), F.shiftright("b", 40).alias("block_b")]
    pairs = meet.select("a", "b", *blocks)
    sides = pairs.select("block_a", "block_b", F.col("a").alias("tile"), "b").union(pairs.where("a != b").select("block_a", "block_b", F.col("b").alias("tile"), F.lit(None).cast("long")))
    sides = sides.groupBy("block_a", "block_b", "tile").agg(F.collect_list("b").alias("partners"))
    packed = sides.join(tiles.select("tile", "dim", "start", "vectors", "weights"), "tile")
    found = written(packed.groupBy("block_a", "block_b").applyInPandas(_compare(threshold, turn), "node long, links long, root long"), "links")

    parts = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("others"))
    member = tiles.select("start", F.explode(F.arrays_zip("k1", "k2", "weights", "least", F.sequence(F.lit(0), F.size("k1") - 1).alias("i"))).alias("m"))
    member = member.select("m.k1", "m.k2", F.col("m.weights").alias("n"), "m.least", (F.col("start") + F.col("m.i")).alias("node"))
    joined = member.join(counts, "node", "left").join(parts, "node", "left")
    joined = written(joined.select("k1", "k2", "least", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("c")), "members")
    low = joined.groupBy("c").agg(F.min("least").alias("component"))
    if not text_ids:
        low = low.withColumn("component", F.nullif("component", F.lit(NO_ID)))
    classed = joined.join(low, "c").select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), "n_links", "component")
    keyed = row.select("id", F.when(sound, k1).alias("k1"), F.when(sound, k2).alias("k2"))
    out = keyed.join(classed, (F.col("k1") == F.col("j1")) & (F.col("k2") == F.col("j2")), "left")
    component = F.when(F.col("j1").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
