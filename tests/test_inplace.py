from __future__ import annotations

import os
import random

import pyarrow as pa
import pytest
from conftest import TINY
from pyspark.sql import functions as F

from tidemark.functions import scan, text
from tidemark.operators import evaluate, index, inplace, retrieve
from tidemark.plans.queries import QUERIES

IDS = ["codigo", "chunk_ix"]
TEXTS = [
    "Azúcar, azúcar y AZÚCAR; maíz maiz-maíz",
    "ΣΟΦΟΣ σοφός İstanbul ISTANBUL ﬁn ½ x² 한국어 한글 한국어",
    "exportaciones exportar export export_ado exp‍ortar",
    None,
    "",
    "...",
    "azucar " * 3000,
    "privado\U000f0000 𝔘nicode 中文 表 Ålesund Å",
    "maiz",
    "maiz",
]


@pytest.fixture(scope="module")
def chunks(spark):
    rows = [(i // 2, i % 2, "Título sobre azúcar" if i == 2 else None, f"agencia {i % 3}", t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "codigo long, chunk_ix long, titulo string, organismo string, texto string").repartition(3).cache()


@pytest.fixture(scope="module")
def asked(spark):
    rows = [("a", "azucar", False), ("a", "export", True), ("a", "maiz", False), ("b", "σοφος", False), ("b", "σοφοσ", False), ("b", "istanb", True), ("b", "한국어", False), ("c", "agencia", False), ("c", "nada", False), ("d", "nada", False), ("e", "NEAR", False), ("f", "unicode", False), ("f", "alesun", True)]
    return spark.createDataFrame(rows, "q string, phrase string, is_prefix boolean")


def rows(df, *cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in cols)) for r in df.collect())


@pytest.mark.parametrize("folded", [True, False])
def test_tokens_are_those_of_the_columns(spark, folded):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    want = [r[0] or [] for r in df.orderBy("i").select(text.tokens(F.col("t"), folded)).collect()]
    terms, codes, counts = scan.occurrences(pa.array(TEXTS, pa.string()), folded)
    got, said = iter(codes), terms.to_pylist()
    assert [[said[next(got)] for _ in range(n)] for n in counts] == want


@pytest.mark.parametrize("folded", [True, False])
@pytest.mark.parametrize("k", [1, 2, 50])
def test_best_hits_are_those_of_postings(chunks, asked, folded, k):
    want = retrieve.top_k(retrieve.bm25(index.postings(chunks, IDS, folded), index.lengths(chunks, IDS, folded), asked, IDS), k, IDS)
    got = retrieve.best_hits(chunks, [asked, asked.where("not is_prefix")], IDS, k, folded=folded)
    assert rows(got.where("run = 0"), "q", *IDS, "rank", "score") == rows(want, "q", *IDS, "rank", "score")
    alone = retrieve.best_hits(chunks, [asked.where("not is_prefix")], IDS, k, folded=folded)
    assert rows(got.where("run = 1"), "q", *IDS, "rank", "score") == rows(alone, "q", *IDS, "rank", "score")


def test_small_pieces_and_large_question_sets(chunks, asked, monkeypatch):
    want = rows(retrieve.best_hits(chunks, [asked], IDS, 3), "run", "q", *IDS, "rank", "score")
    assert len(want) > 5
    monkeypatch.setattr(inplace, "MOST_ASKED", 1)
    assert inplace.asked_of([asked]) is None
    assert rows(retrieve.best_hits(chunks, [asked], IDS, 3), "run", "q", *IDS, "rank", "score") == want


def test_filters(spark, chunks, asked, monkeypatch):
    days = [(i, f"agencia {i % 3}", None if i == 2 else f"2026-07-{i + 1:02d}") for i in range(5)]
    notes = spark.createDataFrame(days, "codigo long, organismo string, fecha string")
    plans = spark.createDataFrame([("a", ["Agencia 1"], None, None), ("b", [], "2026-07-01", "2026-07-02"), ("c", ["AGENCIA"], None, "2026-07-04"), ("d", [], None, None), ("f", ["otra"], None, None)], "q string, organismos array<string>, since string, until string")
    allowed = chunks.where("codigo != 1").select(*IDS)
    one = lambda: rows(retrieve.best_hits(chunks, [asked], IDS, 2, allowed, plans, notes), "q", *IDS, "rank", "score")
    got = one()
    assert {r[0] for r in got} == {"a", "b", "c"}
    monkeypatch.setattr(inplace, "MOST_NAMED", 0)
    assert one() == got


def test_chunks_are_those_of_the_rule(spark):
    rng = random.Random(3)
    parts = ["ARTÍCULO PRIMERO. ", "ARTICULO 5 ", "TITULO ", "ANEXO", "TRANSITORIOS ", "\n", "\n\n", "\n \x1c\n", " ", "\xa0", "\x1c", "\x85", "\r\n", "palabra ", "ñandú " * 9, "𝔘x" * 30, "b" * 700, "z q" * 7000, " " * 1300]
    texts = [None, "", " \n", "corto", *["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(150)]]
    notes = spark.createDataFrame(list(enumerate(texts)), "codigo long, body_text string").selectExpr("*", "'t' titulo", "'o' organismo", "'h' content_hash", "'b' body_hash")
    for rule in (index.ChunkRule(), index.ChunkRule(400, 50, 10)):
        want = [(i, j, *p) for i, t in enumerate(texts) for j, p in enumerate(index.split_passages(t, rule))]
        assert rows(index.chunk(notes, rule), "codigo", "chunk_ix", "char_start", "char_end", "texto") == want


def test_texts_without_structure_stay_in_the_jvm(spark):
    """What a task's Python holds doesn't grow with the texts: it gets none of those without heads or blank lines."""
    d = spark.createDataFrame([("linea\n" * 900,), ("ARTÍCULO 1 a\nARTÍCULO 2 b",), ("a\n \nb",)], "t string").select(index.edges(F.col("t")).alias("e"))
    assert [r["e"] for r in d.collect()] == [[0, 5400], [0, 13, 25], [0, 4, 5]]
    plan = index.chunk(spark.createDataFrame([(1, "t", "o", "h", "b", "x")], "codigo long, titulo string, organismo string, content_hash string, body_hash string, body_text string"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "CONSIDERANDO" in plan


def test_postings_shuffle_nothing(spark, chunks):
    df = index.postings(chunks, IDS)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    got = {(r["codigo"], r["chunk_ix"], r["term"]): r for r in df.collect()}
    r = got[1, 0, "azucar"]
    assert (r["tf_titulo"], r["tf_organismo"], r["tf_texto"], r["wtf"], r["n_tokens"], r["prefix"]) == (1, 0, 0, 8.0, 12, "azucar")
    assert got[0, 0, "azucar"]["wtf"] == 3.0
    only = spark.createDataFrame([("azucar",)], "phrase string")
    assert {r["term"] for r in index.postings(chunks, IDS, only=only).collect()} == {"azucar"}


def test_passages():
    texts = ["x" * 30 + "ñandú corre" + "y" * 9, "ñandú corr", None, "", "ñandú corre", "aaaaaaaaaaaaaaaaaaaa", "corto"]
    passages = ["ñandú corre", "a" * 9, "a" * 21, "cort", "", "ú corre" + "y" * 9, "corto" + "x"]
    got = {(int(a), int(b)) for a, b in zip(*scan.Passages(passages).found(pa.array(texts, pa.string())))}
    assert got == {(i, j) for i, t in enumerate(texts) for j, p in enumerate(passages) if t is not None and p in t}
    assert [len(x) for x in scan.Passages([]).found(pa.array(texts, pa.string()))] == [0, 0]


def test_containing(spark):
    notes = spark.createDataFrame([(1, "uno dos tres cuatro"), (2, "dos tres cuatro cinco"), (3, None)], "codigo long, text string")
    sought = spark.createDataFrame([("p", "dos tres cuatro"), ("r", "uno dos"), ("s", None)], "q string, passage string")
    assert rows(evaluate.containing(notes, sought), "q", "codigo") == [("p", 1), ("p", 2), ("r", 1)]


@pytest.mark.skipif(not os.path.isdir(TINY), reason="no test data")
@pytest.mark.parametrize("name", ["bm25_topk", "bm25_prefix", "per_doc_cap", "rrf_fusion", "retrieve_filtered", "eval_questions", "eval_metrics"])
def test_texts_are_scored_where_they_lie(spark, name):
    plan = QUERIES[name](spark, TINY)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "regexp_extract_all" not in plan and "contains(text" not in plan
