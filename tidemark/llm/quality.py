"""Quality classifier: document evidence combined with shrunk host and path posteriors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .tokens import Tokenizer

#: Labelled rows that the classifier is fitted on; buckets of words; buckets that a head may use.
SAMPLE, BUCKETS, CHOSEN = 8000, 1 << 20, 400
#: The least log-likelihood ratio of a bucket that a head uses.
TELLING = 13.0
HEADS = ("quality", "toxic")
SHAPES = 9


def features(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the buckets of its words (once each) and its shape."""
    tokens = Tokenizer()
    kinds = np.zeros((256, 5))
    for i in range(128):
        c = chr(i)
        kinds[i] = c.isdigit(), c == "|", c == "\n", c.isupper(), i > 32 and not c.isalnum() and c not in ".,;:'\"!?-()"
    for _, part, cut, h, a, b in tokens.groups(texts):
        bucket = (h & np.uint64(BUCKETS - 1)).astype(np.int32)
        for t, data in enumerate(part):
            own, n = h[cut[t] : cut[t + 1]], cut[t + 1] - cut[t]
            size = max(1, len(data))
            counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ kinds
            length = (b[cut[t] : cut[t + 1]] - a[cut[t] : cut[t + 1]]).sum() / max(1, n)
            seen = np.unique(bucket[cut[t] : cut[t + 1]])
            yield seen, np.array([np.log1p(n), len(np.unique(own)) / max(1, n), length, *np.sqrt(counts / size), 1.0])


def telling(pos: np.ndarray, neg: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """The log-likelihood ratio of presence in pos of n1 and neg of n0 texts against equal rates."""
    total = np.zeros(len(pos))
    for seen, out, n in ((pos, n1 - pos, n1), (neg, n0 - neg, n0)):
        rate = (pos + neg) / (n1 + n0)
        for k, p in ((seen, rate), (out, 1 - rate)):
            with np.errstate(divide="ignore", invalid="ignore"):
                total += np.where(k > 0, 2 * k * np.log(k / np.where(p > 0, n * p, 1)), 0.0)
    return total


class Classifier:
    """A logistic regression for each head over the presence of telling words and the shape."""

    def __init__(self, seen: list[np.ndarray], shapes: np.ndarray, labels: dict[str, np.ndarray]) -> None:
        self.mean, self.scale = (shapes[:, :-1].mean(0), shapes[:, :-1].std(0) + 1e-6) if len(shapes) else (np.zeros(SHAPES - 1), np.ones(SHAPES - 1))
        rows = np.repeat(np.arange(len(seen)), [len(s) for s in seen])
        cols = np.concatenate(seen) if len(seen) else np.empty(0, np.int32)
        self.heads = {}
        for head, y in labels.items():
            known = ~np.isnan(y)
            if known.sum() < 2 or len(np.unique(y[known])) < 2:
                rate = float(np.clip(y[known].mean(), 0.02, 0.98)) if known.any() else 0.5
                self.heads[head] = (np.empty(0, np.int64), np.append(np.zeros(SHAPES - 1), np.log(rate / (1 - rate))), np.empty(0))
                continue
            ok, yes = known[rows], np.nan_to_num(y)[rows] == 1
            z = telling(np.bincount(cols[ok & yes], minlength=BUCKETS), np.bincount(cols[ok & ~yes], minlength=BUCKETS), (y[known] == 1).sum(), (y[known] == 0).sum())
            chosen = np.sort(np.argsort(-z, kind="stable")[:CHOSEN])
            chosen = chosen[z[chosen] > TELLING]
            x = np.zeros((len(seen), len(chosen) + SHAPES))
            at = np.searchsorted(chosen, cols) if len(chosen) else np.zeros(len(cols), np.int64)
            hit = (at < len(chosen)) & (chosen[np.minimum(at, len(chosen) - 1)] == cols) if len(chosen) else np.zeros(len(cols), bool)
            x[rows[hit], at[hit]] = 1
            x[:, len(chosen) :] = self.shape(shapes)
            w = self.fit(x[known], y[known])
            self.heads[head] = (chosen, w[len(chosen) :], w[: len(chosen)])

    def shape(self, shapes: np.ndarray) -> np.ndarray:
        return np.concatenate([np.clip((shapes[:, :-1] - self.mean) / self.scale, -6, 6), np.ones((len(shapes), 1))], 1)

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 12) -> np.ndarray:
        w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
        keep[-1] = 1e-3
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            g = x.T @ (p - y) + keep * w
            w -= np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(keep), g)
        return w

    def logits(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty((len(texts), len(self.heads)))
        every = np.unique(np.concatenate([np.asarray(c, np.int64) for c, _, _ in self.heads.values()]))
        weights, used = np.zeros((len(self.heads), len(every) + 1)), np.full(BUCKETS, len(every), np.int32)
        used[every] = np.arange(len(every))
        for k, (chosen, _, w) in enumerate(self.heads.values()):
            weights[k, np.searchsorted(every, chosen)] = w
        shape_weights = np.array([ws for _, ws, _ in self.heads.values()])
        for i, (seen, shape) in enumerate(features(texts)):
            out[i] = np.clip(shape_weights @ self.shape(shape[None, :])[0] + weights[:, used[seen]].sum(1), -20, 20)
        return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE) -> Classifier:
    """Fits on about `rows` labelled rows (never over twice that), chosen by a hash of the id at a
    rate from the count of all. Rows without an id or without any label, and labels that are
    neither 0 nor 1, say nothing; of a text only its buckets (a bounded number) are collected."""
    known = labels.select(F.col(f"`{id_col}`").alias("k"), *[F.when(F.col(f"`{h}`").isin(0, 1), F.col(f"`{h}`").cast("double")).alias(h) for h in HEADS]).where("k is not null")
    n = known.count()
    chosen = known.where(F.pmod(F.xxhash64("k"), F.lit(1_000_003)) < F.lit(rows / max(1, n) * 1_000_003)).orderBy(F.xxhash64("k")).limit(2 * rows)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            seen, shapes = zip(*features(part.column(2).to_pylist())) if part.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([s.tobytes() for s in seen], pa.binary()), pa.array([s.tobytes() for s in shapes], pa.binary())], names=["quality", "toxic", "seen", "shape"])

    text = docs.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").alias("text"))
    found = text.join(F.broadcast(chosen), "k").select("quality", "toxic", "text").mapInArrow(run, "quality double, toxic double, seen binary, shape binary").orderBy(F.xxhash64("seen", "shape"), "quality", "toxic").limit(4 * rows).collect()
    found.sort(key=lambda r: (r["seen"], r["shape"], str(r["quality"]), str(r["toxic"])))
    as_float = lambda h: np.array([np.nan if r[h] is None else r[h] for r in found], float)
    shapes = np.array([np.frombuffer(r["shape"]) for r in found]).reshape(-1, SHAPES)
    return Classifier([np.frombuffer(r["seen"], np.int32) for r in found], shapes, {h: as_float(h) for h in HEADS})


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(mean: str) -> Column:
    """How many observations a prior is worth, by moments: the spread of the groups' means around
    `mean` beyond what their sizes explain. Between 1 and 10,000."""
    spread = F.sum(F.col("n") * (F.col("s") / F.col("n") - F.col(mean)) ** 2) / F.greatest(F.sum("n"), F.lit(1))
    noise = F.sum(F.col(mean) * (1 - F.col(mean))) / F.greatest(F.sum("n"), F.lit(1))
    inner = F.avg(F.col(mean) * (1 - F.col(mean)))
    return F.least(F.greatest(inner / F.greatest(spread - noise, F.lit(1e-9)) - 1, F.lit(1.0)), F.lit(1e4))


def shrunk(s: Column, n: Column, k: float, prior: Column) -> Column:
    """The posterior mean of n observations with sum s under a prior that is worth k of them."""
    return (s + k * prior) / (n + k)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """One row per row of docs: the id, keep, and for quality and toxic (p_, host_, path_,
    evidence_) the document's posterior, those of its host and path, and what the classifier says
    of its text alone.

    A logistic classifier, fitted on a bounded sample of the labels, reads the whole text. Over
    all documents, its probabilities are counted by host and by path within the host; a host's
    posterior mean shrinks towards the global mean, a path's towards its host's, with strengths
    found by moments. A document's logit moves by what its path's posterior differs from the
    global mean, where path and host are those without the document itself, so its own evidence
    counts once, and a document alone on its host doesn't move. keep: quality at least and toxic
    below one half.

    Null hosts and paths are groups of their own; null and empty texts are judged by their shape;
    equal ids get a row each; other columns are left out. Without any label of a head, its
    probabilities are one half, and keep follows. Groups are counted with sums combined before
    the shuffle, and their posteriors joined by broadcast only below Spark's size threshold.
    """
    model = train(docs, labels, id_col, text_col)

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame(model.logits(part.tolist()), columns=list(HEADS))

    judged = F.pandas_udf(score, "quality double, toxic double")(F.col(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{host_col}`").cast("string").alias("host"), F.col(f"`{path_col}`").cast("string").alias("path"), judged.alias("x"))
    rows = written(rows.select("id", "host", "path", "x.*"), "scores")
    p = {h: 1 / (1 + F.exp(-F.col(h))) for h in HEADS}
    paths = written(rows.groupBy("host", "path").agg(F.count("*").alias("n"), *[F.sum(p[h]).alias(h) for h in HEADS]), "paths")
    hosts = paths.groupBy(F.col("host").alias("host2")).agg(F.sum("n").alias("host_n"), *[F.sum(h).alias(f"host_s_{h}") for h in HEADS])
    joined = written(paths.join(hosts, F.col("host").eqNullSafe(F.col("host2"))).drop("host2"), "hosts")
    totals = paths.agg(F.sum("n").alias("n"), *[F.sum(h).alias(h) for h in HEADS]).head()
    known: dict[str, tuple[float, float, float]] = {}
    for h in HEADS:
        total = float(totals[h] / totals["n"]) if totals["n"] else 0.5
        host_k = joined.select("host", "host_n", f"host_s_{h}").distinct().select(F.col("host_n").alias("n"), F.col(f"host_s_{h}").alias("s"), F.lit(total).alias("m")).agg(_strength("m")).head()[0] or 1.0
        mean = shrunk(F.col(f"host_s_{h}"), F.col("host_n"), host_k, F.lit(total))
        path_k = joined.select("n", F.col(h).alias("s"), mean.alias("m")).agg(_strength("m")).head()[0] or 1.0
        known[h] = total, host_k, path_k
    posterior = joined.withColumnsRenamed({"host": "host2", "path": "path2"} | {h: f"path_s_{h}" for h in HEADS})
    out = rows.join(posterior, F.col("host").eqNullSafe(F.col("host2")) & F.col("path").eqNullSafe(F.col("path2")))
    final, shown = {}, []
    for h in HEADS:
        total, host_k, path_k = known[h]
        s_host, s_path = F.col(f"host_s_{h}"), F.col(f"path_s_{h}")
        whole = shrunk(s_host, F.col("host_n"), host_k, F.lit(total))
        others = shrunk(s_path - p[h], F.col("n") - 1, path_k, shrunk(s_host - p[h], F.col("host_n") - 1, host_k, F.lit(total)))
        final[h] = 1 / (1 + F.exp(-(F.col(h) + _logit(others) - _logit(F.lit(total)))))
        shown += [final[h].alias(f"p_{h}"), whole.alias(f"host_{h}"), shrunk(s_path, F.col("n"), path_k, whole).alias(f"path_{h}"), p[h].alias(f"evidence_{h}")]
    keep = (final["quality"] >= 0.5) & (final["toxic"] < 0.5)
    return out.select(F.col("id").alias(id_col), keep.alias("keep"), *shown)
