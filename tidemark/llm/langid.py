"""Language ID: a bidirectional gated recurrent network over bytes, trained here in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units of each direction.
UNITS = 8
#: A direction runs over a text in windows of STEP bytes side by side, each from WARM bytes before.
#: Where the states of two windows differ by more than SEAM where they meet, the later one is run
#: again from the state that the earlier one ends with, as far as its states change, until all meet.
STEP, WARM, SEAM = 512, 64, 0.01
#: Bytes from one place to the next where a window that is run again may stop.
MARK = 32
#: Windows that run side by side, and bytes that are taken at once (a longer text is taken whole).
LANES, BYTES_AT_ONCE = 2048, 2_000_000
#: Bytes of a training window.
TRAIN_BYTES = 96


def raw(text: str) -> bytes:
    """What the network sees: all bytes of the text, with A-Z lower-cased."""
    return text.encode("utf-8", "replace").lower()


def _cell(a: np.ndarray, h: np.ndarray, w: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    """One step of the network: inputs (3 * units, rows) and states (units, rows)."""
    u = len(h)
    b = w["u"] @ h
    zr = np.tanh((a[: 2 * u] + b[: 2 * u]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
    z, r, inner = zr[:u], zr[u:], b[2 * u :] + w["b"][:, None]
    n = np.tanh(a[2 * u :] + r * inner)
    return n + z * (h - n), z, r, n, inner


def run_gru(x: np.ndarray, w: dict[str, np.ndarray], keep: list | None = None) -> np.ndarray:
    """States (position, unit, row) of one direction over bytes x (position, row), from zero."""
    h, out = np.zeros((w["u"].shape[1], x.shape[1]), np.float32), []
    for t in x:
        before, (h, *inside) = h, _cell(w["x"][:, t], h, w)
        if keep is not None:
            keep.append((before, *inside))
        out.append(h)
    return np.array(out)


def back_through(x: np.ndarray, w: dict[str, np.ndarray], kept: list, d_out: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of run_gru by backpropagation through time."""
    g, dh = {k: np.zeros_like(v) for k, v in w.items()}, np.zeros_like(d_out[0])
    for t in reversed(range(len(x))):
        h, z, r, n, inner = kept[t]
        dh = dh + d_out[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz, dr, di = dh * (h - n) * z * (1 - z), dn * inner * r * (1 - r), dn * r
        one = np.zeros((x.shape[1], 256), dh.dtype)
        one[np.arange(x.shape[1]), x[t]] = 1
        g["x"] += np.concatenate([dz, dr, dn]) @ one
        d = np.concatenate([dz, dr, di])
        g["u"] += d @ h.T
        g["b"] += di.sum(1)
        dh = dh * z + w["u"].T @ d
    return g


def along(data: np.ndarray, cut: np.ndarray, w: dict[str, np.ndarray], top: np.ndarray, step: int = STEP, warm: int = WARM, seam: float = SEAM) -> np.ndarray:
    """What one direction says of each byte: (languages, bytes) of top @ state. data holds texts
    one after another, from cut[i] to cut[i + 1]; each starts from a state of zero."""
    u, out = w["u"].shape[1], np.empty((len(top), len(data)), np.float32)
    sizes = np.diff(cut)
    many = -(-sizes // step)
    text = np.repeat(np.arange(len(sizes)), many)
    start = cut[text] + step * (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many))
    size = np.minimum(step, cut[text + 1] - start)
    head = start == cut[text]
    begin, end = np.zeros((u, len(start)), np.float32), np.empty((u, len(start)), np.float32)
    marks = np.empty((-(-step // MARK), u, len(start)), np.float32)

    def run(which: np.ndarray, given: bool, again: bool = False) -> np.ndarray:
        """Runs windows, from their given states or from `warm` bytes before. A window that is run
        again stops where it meets its former run. Returns those that ran to their ends."""
        whole = []
        for a in range(0, len(which), LANES):
            own = which[a : a + LANES]
            own = own[np.argsort(-size[own], kind="stable")]
            h = begin[:, own] if given else np.zeros((u, len(own)), np.float32)
            t = 0 if given else -warm
            while len(own):
                if t == 0 and not given:
                    begin[:, own] = h
                if t >= 0 and t % MARK == 0:
                    if again and t:
                        apart = np.abs(h - marks[t // MARK][:, own]).max(0) > seam / 2
                        own, h = own[apart], h[:, apart]
                        if not len(own):
                            break
                    marks[t // MARK][:, own] = h
                at = start[own] + t
                h = _cell(w["x"].take(data[at], 1), h, w)[0]
                t += 1
                if t > 0:
                    out[:, at] = top @ h
                    m = len(own) if size[own[-1]] > t else int(np.searchsorted(-size[own], -t))
                    if m < len(own):
                        end[:, own[m:]] = h[:, m:]
                        whole.append(own[m:])
                        own, h = own[:m], h[:, :m]
        return np.concatenate(whole) if whole else which[:0]

    run(np.flatnonzero(head), True)
    later = np.flatnonzero(~head)
    run(later, False)
    while len(later):
        later = later[np.abs(begin[:, later] - end[:, later - 1]).max(0) > seam]
        begin[:, later] = end[:, later - 1]
        later = np.sort(run(later, True, True))
        later = later[later + 1 < len(start)] + 1
        later = later[~head[later]]
    return out


class Model:
    """Weights of both directions, and of what both states say of each language."""

    def __init__(self, langs: list[str], units: int = UNITS, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.langs = langs
        make = lambda: {"x": rng.normal(0, 0.3, (3 * units, 256)).astype(np.float32), "u": rng.normal(0, units**-0.5, (3 * units, units)).astype(np.float32), "b": np.zeros(units, np.float32)}
        self.ways = [make(), make()]
        self.top = {"w": rng.normal(0, units**-0.5, (len(langs), 2 * units)).astype(np.float32), "c": np.zeros(len(langs), np.float32)}

    def positions(self, data: np.ndarray, cut: np.ndarray, **options) -> np.ndarray:
        """Probability of each language at each byte of texts that follow one another: (languages, bytes)."""
        u = self.top["w"].shape[1] // 2
        p = along(data, cut, self.ways[0], self.top["w"][:, :u], **options)
        p += along(data[::-1], cut[-1] - cut[::-1], self.ways[1], self.top["w"][:, u:], **options)[:, ::-1]
        p += self.top["c"][:, None]
        p -= p.max(0)
        np.exp(p, out=p)
        p /= p.sum(0)
        return p

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over the positions of each text (none is empty): (texts, languages)."""
        cut = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        p = self.positions(np.frombuffer(b"".join(texts), np.uint8), cut)
        return (np.add.reduceat(p, cut[:-1], axis=1, dtype=np.float64) / np.diff(cut)).T

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> tuple[float, list[dict[str, np.ndarray]]]:
        n = np.array([len(t) for t in texts])
        there = np.arange(n.max())[:, None] < n
        x = np.frombuffer(b"".join(t.ljust(n.max(), b" ") for t in texts), np.uint8).reshape(len(texts), -1).T
        back = np.where(there, n - 1 - np.arange(n.max())[:, None], np.arange(n.max())[:, None])
        y, kept = np.take_along_axis(x, back, 0), ([], [])
        f, b = run_gru(x, self.ways[0], kept[0]), run_gru(y, self.ways[1], kept[1])
        states = np.concatenate([f, np.take_along_axis(b, back[:, None, :], 0)], 1)
        p = self.top["w"] @ states + self.top["c"][:, None]
        p = np.exp(p - p.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        at = np.broadcast_to(labels, there.shape)[:, None, :]
        loss = -float(np.log(np.take_along_axis(p, at, 1)[:, 0] + 1e-9)[there].sum() / there.sum())
        np.put_along_axis(p, at, np.take_along_axis(p, at, 1) - 1, 1)
        p *= (there / there.sum()).astype(p.dtype)[:, None, :]
        ds, u = self.top["w"].T @ p, f.shape[1]
        db = np.take_along_axis(ds[:, u:], back[:, None, :], 0)
        top = {"w": np.einsum("tkn,tun->ku", p, states), "c": p.sum((0, 2))}
        return loss, [back_through(x, self.ways[0], kept[0], ds[:, :u]), back_through(y, self.ways[1], kept[1], db), top]

    def train(self, texts: list[bytes], labels: np.ndarray, steps: int, rows: int = 256, size: int = TRAIN_BYTES, rate: float = 0.02, seed: int = 11) -> list[float]:
        """Adam over windows of `size` bytes of each language's texts: half are drawn evenly from all
        positions, half evenly from the texts and then from a text's positions, so that short and
        odd texts are learned too."""
        rng, weights = np.random.default_rng(seed), [*self.ways, self.top]
        m, v, losses = [{k: np.zeros_like(x) for k, x in w.items()} for w in weights], [{k: np.zeros_like(x) for k, x in w.items()} for w in weights], []
        own = [np.flatnonzero(labels == i) for i in range(len(self.langs))]
        ends = [np.cumsum([len(texts[j]) for j in ix]) for ix in own]
        each = rows // len(own) + 1
        for step in range(1, steps + 1):
            pick = []
            for ix, end in zip(own, ends):
                places = rng.integers(0, end[-1], each - each // 2)
                k = np.concatenate([np.searchsorted(end, places, "right"), rng.integers(0, len(ix), each // 2)])
                at = np.concatenate([places - np.append(0, end)[k[: len(places)]], rng.random(each // 2) * np.diff(end, prepend=0)[k[len(places) :]]]).astype(np.int64)
                for text, start in zip((texts[ix[i]] for i in k), at.tolist()):
                    start = max(0, min(start, len(text) - size))
                    pick.append(text[start : start + size])
            loss, grads = self.gradients(pick, np.repeat(np.arange(len(own)), each))
            losses.append(loss)
            now = rate * min(1, step / 20) * (1 - step / (steps + 1))
            for w, g, a, b in zip(weights, grads, m, v):
                for k in w:
                    a[k] = 0.9 * a[k] + 0.1 * g[k]
                    b[k] = 0.99 * b[k] + 0.01 * g[k] ** 2
                    w[k] -= (now * (a[k] / (1 - 0.9**step)) / (np.sqrt(b[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return losses


def held_out(id_col: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text has remainder 2 by 4. False for null."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def train_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = 1200, steps: int = 500) -> Model:
    """Learns from rows outside the held-out fold with a language and a text. Of each language
    about rows / (number of languages) rows are used, chosen by a hash of id and text at a rate
    that counts over all rows set, and their whole texts; that bound is all that the driver gets.
    More languages than rows raise ValueError. Empty texts are never learned from."""
    known = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    known = known.where(~held_out(F.col("id")) & F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    langs = sorted(r["lang"] for r in counts.select("lang").limit(rows + 1).collect())
    if len(langs) > rows:
        raise ValueError(f"more than {rows} languages")
    if not langs:
        return Model([])
    u = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_003)) / 1_000_003.0
    sample = known.join(F.broadcast(counts), "lang").where(u * F.col("n") < max(1, rows // len(langs))).select("text", "lang").toPandas()
    sample = sample.sort_values(["lang", "text"], kind="stable")
    model = Model(sorted(set(sample["lang"])))
    if model.langs:
        model.train([raw(t) for t in sample["text"]], sample["lang"].map({x: i for i, x in enumerate(model.langs)}).to_numpy(), steps)
    return model


def lettered(text: str | None) -> bool:
    """Whether a text has a letter, a character of category L."""
    return text is not None and any(map(str.isalpha, text))


def predictor(model: Model):
    """Texts to (lang, score) as a function over batches."""

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts = texts.tolist()
            langs, scores, at = np.full(len(texts), "und", object), np.zeros(len(texts)), 0
            while at < len(texts):
                own, held = [], 0
                while at < len(texts) and held < BYTES_AT_ONCE:
                    if model.langs and lettered(texts[at]):
                        own.append((at, raw(texts[at])))
                        held += len(own[-1][1])
                    at += 1
                if own:
                    p, which = model.pooled([t for _, t in own]), [i for i, _ in own]
                    langs[which], scores[which] = np.array(model.langs, object)[p.argmax(1)], np.minimum(1.0, p.max(1))
            yield pd.DataFrame({"lang": pd.Series(langs, dtype=object), "score": pd.Series(scores, dtype="float64")})

    return F.pandas_udf(predict, "lang string, score double")


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of docs plus held_out, lang_pred and score.

    The network runs over all bytes of the whole text, spaces and punctuation too, and labels every
    position; the document's probability of a language is the mean over all positions, score is
    that of lang_pred. Texts that are null or have no letter (Unicode category L) get `und` and 0,
    as do all texts where nothing could be learned. Columns of those three names in docs are
    replaced. Nothing is shuffled.

    A long text is run in windows side by side that begin early, to take up the state; where two
    don't meet within SEAM, the later is run again from the state of the earlier, so state is
    carried over the whole text however long the network remembers.
    """
    names = [c for c in docs.columns if c not in ("held_out", "lang_pred", "score")]
    row = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], held_out(F.col(f"`{id_col}`")).alias("held"), predictor(model)(F.col(f"`{text_col}`")).alias("found"))
    return row.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("held").alias("held_out"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def _lettered(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield pd.Series([lettered(t) for t in part], dtype=bool)


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs in which a language was found; those with `und` go, which are texts that
    are null or have no letter. Where nothing could be learned, the same ones go and no others."""
    model = train_on(docs, id_col, text_col, lang_col)
    if not model.langs:
        return docs.where(F.pandas_udf(_lettered, "boolean")(F.col(f"`{text_col}`")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    found = row.select("row", predictor(model)(F.col("text")).alias("found")).where("found.lang != 'und'")
    return found.select("row.*")
