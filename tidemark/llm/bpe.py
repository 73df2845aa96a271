"""BPE encoding and decoding of whole texts, reusing the encodings of chunks that texts share."""

from __future__ import annotations

from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunks have 2^CUT_BITS bytes on average; a cut depends on the WINDOW bytes before it.
CUT_BITS, WINDOW = 10, 32
#: The first look past a join, in characters; it doubles until both sides agree.
LOOK = 32
#: The pre-tokenizer looks at most this many characters past the end of a piece.
AHEAD = 3
#: The pattern of byte-level pre-tokenization. On characters of COMMON the regex module and the
#: pre-tokenizer, whose Unicode tables differ in age, agree; texts with others go the slow way.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
COMMON = "\\x00-\u0557\u05d0-\u05ea\u0620-\u064a\u0900-\u0970\u0e01-\u0e3a\u2000-\u2070\u20a0-\u20bf\u2100-\u218b\u2190-\u23ff\u2500-\u27bf\u3000-\u3096\u30a1-\u30ff\u3400-\u4db5\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e\U0001f300-\U0001f64f"
#: What a worker remembers: pieces, and characters of the chunks of each of two generations. A
#: chunk takes about four bytes a character.
PIECES, CHUNK_CHARS = 150_000, 6_000_000


class Encoded(NamedTuple):
    """A chunk by itself: where its pieces start (and its end), tokens before each, the ids."""

    text: str
    starts: array
    before: array
    ids: array


def gear() -> np.ndarray:
    return np.random.default_rng(0x6EA2).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(data: bytes, table: np.ndarray, bits: int = CUT_BITS) -> list[int]:
    """Content-defined cuts: after each byte where the rolling hash of the last WINDOW bytes has
    `bits` zero bits on top, moved forward to the start of a character."""
    if len(data) < 2 * WINDOW:
        return []
    b = np.frombuffer(data, np.uint8)
    h, width = table[b], 1
    while width < WINDOW:
        h[width:] += h[:-width].copy() << np.uint32(width)
        width *= 2
    at = np.flatnonzero(h[WINDOW:-1] >> np.uint32(32 - bits) == 0) + WINDOW + 1
    while len(at) and len(move := np.flatnonzero(b[at] & 0xC0 == 0x80)):
        at[move] += 1
        at = at[at < len(b)]
    return np.unique(at).tolist()


class Encoder:
    """Encodes as Tokenizer.encode(text, add_special_tokens=False).ids does, for byte-level BPE."""

    def __init__(self, definition: str) -> None:
        import json
        import re

        import regex
        from tokenizers import Tokenizer

        kind = json.loads(definition)
        pre = kind["pre_tokenizer"]
        if kind["normalizer"] or kind["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or not pre.get("use_regex", True) or pre["add_prefix_space"]:
            raise ValueError("chunks can be joined exactly only for byte-level BPE with its own pattern, without normalizer and prefix space")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in kind["added_tokens"]):
            raise ValueError("added tokens that take their surroundings along are not supported")
        tok = Tokenizer.from_str(definition)
        self.split, self.model, self.table = tok.pre_tokenizer.pre_tokenize_str, tok.model, gear()
        self.added = {t["content"]: t["id"] for t in kind["added_tokens"]}
        self.stops = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.old_pieces: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, Encoded] = {}
        self.old_chunks: dict[str, Encoded] = {}
        self.held, self.seen, self.served = 0, 0, 0
        self.pattern, self.other = regex.compile(PATTERN).findall, re.compile(f"[^{COMMON}]").search
        self.ints = list(range(tok.get_vocab_size(with_added_tokens=True)))
        self.chars = dict(enumerate(_byte_chars()))
        back = {c: i for i, c in self.chars.items()}
        self.raw = [b""] * tok.get_vocab_size(with_added_tokens=True)
        for token, i in tok.get_vocab(with_added_tokens=True).items():
            self.raw[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()

    def look_up(self, pieces: list[str]) -> list[tuple[int, ...]]:
        found = list(map(self.pieces.get, pieces))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None and (ids := self.pieces.get(p := pieces[i])) is None:
                    ids = self.old_pieces.get(p)
                    if ids is None:
                        ids = tuple(self.ints[t.id] for t in self.model.tokenize(p.encode().decode("latin-1").translate(self.chars)))
                    if len(self.pieces) >= PIECES:
                        self.old_pieces, self.pieces = self.pieces, {}
                    self.pieces[p] = ids
                found[i] = ids
        return found

    def alone(self, text: str) -> Encoded:
        if self.other(text):
            pieces = [text[a:b] for _, (a, b) in self.split(text)]
        else:
            pieces = self.pattern(text)
        found = self.look_up(pieces)
        starts, before = accumulate(map(len, pieces), initial=0), accumulate(map(len, found), initial=0)
        return Encoded(text, array("i", starts), array("i", before), array("i", chain.from_iterable(found)))

    def chunk(self, text: str) -> Encoded:
        """A chunk's encoding, kept until as many characters of others have been used twice over."""
        self.seen += len(text)
        found = self.chunks.get(text)
        if found is not None:
            self.served += len(text)
            return found
        found = self.old_chunks.get(text)
        if found is None:
            found = self.alone(text)
        else:
            self.served += len(text)
        if self.held > CHUNK_CHARS:
            self.old_chunks, self.chunks, self.held = self.chunks, {}, 0
        self.chunks[text] = found
        self.held += len(text)
        return found

    def joined(self, texts: list[str]) -> array:
        """The ids of the joined texts. From the last piece of one side that nothing behind it
        can change, the join is encoded again, with ever more of the other side, until a piece
        starts where one of the other side's own pieces starts: from there its ids hold."""
        out = array("i")
        now, since = self.chunk(texts[0]), 0
        for n, text in enumerate(texts[1:], 2):
            at = max(since, bisect_right(now.starts, len(now.text) - AHEAD) - 1)
            out += now.ids[now.before[since] : now.before[at]]
            tail, other, look = now.text[now.starts[at] :], self.chunk(text), LOOK
            while True:
                again = self.alone(tail + text[:look])
                whole = look >= len(text)
                sure = len(again.text) - (0 if whole and n == len(texts) else AHEAD)
                meet = None
                for i in range(bisect_left(again.starts, len(tail)), bisect_right(again.starts, sure)):
                    k = bisect_left(other.starts, again.starts[i] - len(tail))
                    if k < len(other.starts) and other.starts[k] == again.starts[i] - len(tail):
                        meet = k
                        break
                if meet is not None:
                    out += again.ids[: again.before[i]]
                    now, since = other, meet
                elif whole:
                    now, since = again, 0
                else:
                    look *= 2
                    continue
                break
        return out + now.ids[now.before[since] :]

    def plain(self, text: str, bits: int = CUT_BITS) -> array:
        data = text.encode()
        ends = cuts(data, self.table, bits)
        if not ends:
            return self.chunk(text).ids if text else array("i")
        return self.joined([data[a:b].decode() for a, b in zip([0, *ends], [*ends, len(data)])])

    def compact(self, text: str, bits: int = CUT_BITS) -> array:
        if self.stops is None or not self.stops.search(text):
            return self.plain(text, bits)
        out = array("i")
        for i, part in enumerate(self.stops.split(text)):
            out += array("i", [self.added[part]]) if i % 2 else self.plain(part, bits)
        return out

    def encode(self, text: str, bits: int = CUT_BITS) -> list[int]:
        return self.compact(text, bits).tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")


def _byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def worker_encoder(definition: str) -> Encoder:
    """One encoder for each tokenizer in a worker process, kept from task to task."""
    import hashlib
    import sys
    import types

    kept = sys.modules.setdefault("_tidemark_kept", types.ModuleType("_tidemark_kept")).__dict__
    name = "bpe " + hashlib.sha256(definition.encode()).hexdigest()
    if name not in kept:
        kept[name] = Encoder(definition)
    return kept[name]


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", batch_chars: int = 4_000_000) -> DataFrame:
    """id_col, n_tokens, ids (array of int) and decoded (the text of the ids) for each row of docs.

    tokenizer is the path of a byte-level BPE definition of the tokenizers library; the ids are
    those of encode(text, add_special_tokens=False), strings of added tokens in a text included,
    and decoded is decode(ids, skip_special_tokens=False). Null texts count as empty: no ids and
    an empty text. Ids of any type, null and repeated ones too, pass through row by row; other
    columns are left out.

    A text is cut where a rolling hash of its bytes says so, hence equal passages get equal
    chunks. A worker process encodes a chunk once for all its documents and tasks, within bounded
    memory, and repairs each join by encoding across it until both sides agree. There is no
    shuffle: texts stay in the partition that read them.
    """
    with open(tokenizer, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(shared.value)
        for batch in batches:
            keys, texts, at = batch.column(0), batch.column(1), 0
            while at < batch.num_rows:
                first, ids, decoded, held = at, [], [], 0
                while at < batch.num_rows and held < batch_chars:
                    text = texts[at].as_py() or ""
                    ids.append(encoder.compact(text))
                    decoded.append(encoder.decode(ids[-1]))
                    held += len(text)
                    at += 1
                sizes = np.array([len(x) for x in ids], np.int64)
                flat = pa.array(np.concatenate([np.frombuffer(x, np.int32) for x in ids]))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([keys.slice(first, at - first), pa.array(sizes), lists, pa.array(decoded, pa.string())], names=["id", "n_tokens", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, f"id {kind}, n_tokens long, ids array<int>, decoded string")
    return out.select(F.col("id").alias(id_col), "n_tokens", "ids", "decoded")
