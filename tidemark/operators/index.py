"""Chunks, postings and corpus statistics for full-text search."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scan
from ..functions.text import tokens

PREFIX = 6
WEIGHTS = {"titulo": 8.0, "organismo": 4.0, "texto": 1.0}


@dataclass(frozen=True)
class ChunkRule:
    """Most characters of a chunk, characters that hard slices share, fewest of a passage."""

    chunk_chars: int = 1200
    overlap: int = 150
    fewest: int = 40

    def signature(self, folded: bool = True) -> str:
        return f"{self.chunk_chars}/{self.overlap}/{self.fewest}/{'folded' if folded else 'plain'}"


_ORDINALS = "PRIMERO|SEGUNDO|TERCERO|CUARTO|QUINTO|SEXTO|S[EÉ]PTIMO|OCTAVO|NOVENO|D[EÉ]CIMO"
_HEADS = rf"(?:ART[IÍ]CULO\s+(?:\d+|{_ORDINALS})|T[IÍ]TULO|SECCI[OÓ]N|CAP[IÍ]TULO|ANEXO|TRANSITORIOS?|CONSIDERANDO)\b"
#: What a text without structure has none of: pieces of the words that begin heads, and blank lines.
_MAYBE = ("CULO", "TULO", "SECCI", "ANEXO", "TRANSITORIO", "CONSIDERANDO")
_BLANK_LINE = r"\n(?U)[\s\x1c-\x1f]*\n"
#: Characters of a long text's parts.
_BLOCK = 1 << 14
#: White space as Python's strip has it.
_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _edges(text: str) -> list[int]:
    """Where a stripped text is cut: at legal section heads if there are two or more, else at blank lines."""
    import re

    cuts = [m.start() for m in re.finditer(rf"^(?=\s*{_HEADS})", text, re.M)]
    if len(cuts) < 2:
        cuts = [m.end() for m in re.finditer(r"\n\s*\n", text)]
    return sorted({0, len(text), *cuts})


def split_passages(text: str | None, rule: ChunkRule) -> list[tuple[int, int, str]]:
    """(start, end, passage): cut at edges; what is too long is sliced with overlap. Offsets are
    those of the stripped text."""
    text = (text or "").strip()
    if not text:
        return []
    edges = _edges(text)
    found = []
    for a, b in zip(edges, edges[1:]):
        step = max(1, rule.chunk_chars - rule.overlap)
        while b - a > rule.chunk_chars:
            found.append((a, a + rule.chunk_chars))
            a += step
        found.append((a, b))
    kept = [(a, b, p) for a, b in found if len(p := text[a:b].strip()) >= rule.fewest]
    return kept or [(0, len(text), text)]


def _cut_at(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in parts:
        yield pd.Series([None if t is None else _edges(t) for t in part], dtype=object)


def edges(stripped: Column) -> Column:
    """_edges for a column; texts without structure stay in the JVM, and of others only numbers come back."""
    plain = ~stripped.rlike(_BLANK_LINE)
    for word in _MAYBE:
        plain = plain & ~stripped.contains(word)
    return F.when(plain, F.array(F.lit(0), F.length(stripped))).otherwise(F.pandas_udf(_cut_at, "array<int>")(F.when(~plain, stripped)))


def blocks(stripped: Column, rule: ChunkRule) -> Column:
    """A text in parts of equal length, as a place far inside a text costs the way there."""
    n = max(_BLOCK, rule.chunk_chars)
    return F.when(F.length(stripped) <= n, F.array(stripped)).otherwise(F.regexp_extract_all(stripped, F.lit(f"(?s).{{1,{n}}}"), F.lit(0)))


def passages(stripped: Column, edges: Column, blocks: Column, rule: ChunkRule = ChunkRule()) -> Column:
    """split_passages for columns of stripped texts, not empty, their edges and blocks."""
    most, step, size = rule.chunk_chars, max(1, rule.chunk_chars - rule.overlap), max(_BLOCK, rule.chunk_chars)

    def piece(a: Column, b: Column) -> Column:
        i, r = F.floor(a / size).cast("int"), a % size
        text = F.concat(F.substring(F.get(blocks, i), r + 1, b - a), F.when(r + b - a > size, F.substring(F.get(blocks, i + 1), F.lit(1), r + b - a - size)).otherwise(""))
        return F.struct(a.cast("int").alias("char_start"), b.cast("int").alias("char_end"), F.btrim(text, F.lit(_SPACE)).alias("texto"))

    def of_span(b: Column, i: Column) -> Column:
        a = F.get(edges, i)
        last = F.greatest(F.lit(0), F.ceil((b - a - most) / step)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda n: piece(a + n * step, F.when(n < last, a + n * step + most).otherwise(b)))

    spans = F.flatten(F.transform(F.slice(edges, 2, F.greatest(F.lit(0), F.size(edges) - 1)), of_span))
    kept = F.filter(spans, lambda p: F.length(p["texto"]) >= rule.fewest)
    whole = F.struct(F.lit(0).alias("char_start"), F.length(stripped).alias("char_end"), stripped.alias("texto"))
    some = F.get(F.transform(F.array(kept), lambda k: F.when(F.size(k) > 0, k).otherwise(F.array(whole))), F.lit(0))
    return F.transform(some, lambda p, i: F.struct(i.cast("int").alias("chunk_ix"), p["char_start"].alias("char_start"), p["char_end"].alias("char_end"), p["texto"].alias("texto")))


def hard_slices(text: Column, rule: ChunkRule = ChunkRule()) -> Column:
    """The last tier alone, without leaving the JVM: slices of a text without structure."""
    step = max(1, rule.chunk_chars - rule.overlap)
    n = F.length(text)
    starts = F.when(n <= rule.chunk_chars, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), n - rule.overlap - 1, F.lit(step)))
    return F.transform(starts, lambda s: F.substring(text, s + 1, F.lit(rule.chunk_chars)))


def chunk(notes: DataFrame, rule: ChunkRule = ChunkRule(), folded: bool = True) -> DataFrame:
    """A row per passage of notes (codigo, titulo, organismo, content_hash, body_hash, body_text)."""
    sign = F.concat_ws("/", F.coalesce("content_hash", F.lit("")), F.coalesce("body_hash", F.lit("")), F.lit(rule.signature(folded)))
    n = notes.select("codigo", "titulo", "organismo", sign.alias("signature"), F.btrim("body_text", F.lit(_SPACE)).alias("stripped")).where("stripped != ''")
    n = n.withColumn("edges", edges(F.col("stripped"))).withColumn("blocks", blocks(F.col("stripped"), rule))
    c = n.select("codigo", "titulo", "organismo", "signature", F.explode(passages(F.col("stripped"), F.col("edges"), F.col("blocks"), rule)).alias("p"))
    return c.select("codigo", F.col("p.chunk_ix").cast("long").alias("chunk_ix"), F.col("p.texto").alias("texto"), F.length("p.texto").cast("long").alias("n_chars"), F.col("p.char_start").cast("long").alias("char_start"), F.col("p.char_end").cast("long").alias("char_end"), "titulo", "organismo", "signature")


def build_index(table, notes: DataFrame, rule: ChunkRule = ChunkRule(), folded: bool = True, force: bool = False) -> dict[str, int]:
    """Brings a table of chunks up to the notes: those whose text, metadata, sizes or tokenizer
    changed are cut again, those that are gone lose all their chunks. Returns notes indexed,
    skipped and removed; if nothing changed nothing is written."""
    have = table.ensure().read()
    usable = notes.where((F.col("body_status") == "ok") & (F.length(F.trim("body_text")) > 0))
    sign = F.concat_ws("/", F.coalesce("content_hash", F.lit("")), F.coalesce("body_hash", F.lit("")), F.lit(rule.signature(folded)))
    known = have.groupBy("codigo").agg(F.max("signature").alias("had"))
    state = usable.withColumn("sign", sign).join(known, "codigo", "left")
    stale = state if force else state.where(~F.col("sign").eqNullSafe(F.col("had")))
    gone = known.join(usable.select("codigo"), "codigo", "left_anti")
    total, n, removed = usable.count(), stale.count(), gone.count()
    if n or removed:
        left = have.join(stale.select("codigo").union(gone.select("codigo")), "codigo", "left_anti")
        table.replace(left.unionByName(chunk(stale, rule, folded).select(*left.columns)))
    return {"indexed": n, "skipped": total - n, "removed": removed}


def postings(chunks: DataFrame, id_cols: list[str], folded: bool = True, weights: dict[str, float] | None = None, only: DataFrame | None = None) -> DataFrame:
    """(id, term, prefix, tf_<field>..., wtf, n_tokens): occurrences of each term in each field of a
    passage, their weighted sum, and the passage's tokens. The prefix is stored, so that prefix
    search is an equi-join. A passage is a row, counted where it lies: nothing is shuffled. only
    (phrase) leaves out terms that begin unlike all phrases."""
    weights = weights or WEIGHTS
    fields = list(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in scan.pieces(batch, fields):
                at, term, terms, tf, sizes = scan.term_counts([piece.column(f) for f in fields], folded)
                rows, row = pa.array(at), np.asarray(sizes)[at]
                total = sum((n * float(w) for n, w in zip(tf, weights.values())), np.zeros(len(at)))
                yield pa.RecordBatch.from_arrays([*[piece.column(c).take(rows) for c in id_cols], terms.take(term), pc.utf8_slice_codeunits(terms, 0, PREFIX).take(term), pa.array(row), *map(pa.array, tf), pa.array(total)], names)

    names = [*id_cols, "term", "prefix", "n_tokens", *[f"tf_{f}" for f in fields], "wtf"]
    kinds = {f.name: f.dataType for f in chunks.schema.fields}
    schema = T.StructType([*[T.StructField(c, kinds[c]) for c in id_cols], *[T.StructField(c, T.StringType()) for c in ("term", "prefix")], *[T.StructField(c, T.LongType()) for c in names[len(id_cols) + 2 : -1]], T.StructField("wtf", T.DoubleType())])
    out = chunks.select(*id_cols, *fields).mapInArrow(run, schema)
    if only is not None:
        out = out.join(only.select(F.substring("phrase", 1, PREFIX).alias("prefix")).distinct(), "prefix", "left_semi").select(*names)
    return out


def lengths(chunks: DataFrame, id_cols: list[str], folded: bool = True, fields: list[str] | None = None) -> DataFrame:
    """(id, n_tokens): tokens of all indexed fields, unweighted."""
    sizes = [F.coalesce(F.size(tokens(F.col(f), folded)), F.lit(0)) for f in (fields or list(WEIGHTS))]
    return chunks.select(*id_cols, sum(sizes[1:], sizes[0]).cast("long").alias("n_tokens"))


def corpus_stats(sizes: DataFrame) -> DataFrame:
    """One row: number of passages and their mean length."""
    return sizes.agg(F.count("*").alias("n_chunks"), F.avg("n_tokens").alias("avgdl"))
