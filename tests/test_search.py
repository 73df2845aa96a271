from __future__ import annotations

import sqlite3
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import answer, evaluate, index, retrieve, route
from tidemark.schemas import CHUNK
from tidemark.sources.versioned import Table

FILL = "El presente acuerdo entra en vigor al dia siguiente de su publicacion. "
NOTES = [
    (1, "COMISION FEDERAL PARA LA PROTECCION CONTRA RIESGOS SANITARIOS", "ACUERDO de registro sanitario de medicamentos", "Los fabricantes podrán exportar medicamentos. " + FILL * 8),
    (2, "SECRETARIA DE ECONOMIA", "AVISO sobre exportaciones", "Tarifas para exportar maíz y azúcar. " + FILL * 30),
    (3, "SECRETARIA DE SALUD", "NORMA oficial de higiene", "Higiene en hospitales públicos. " + FILL * 30),
    (4, "BANCO DE MEXICO", "TIPO de cambio", "Obligaciones en moneda extranjera. " + FILL * 8),
]


@pytest.fixture(scope="module")
def notes(spark):
    rows = [(c, o, t, b, f"2026-07-{c:02d}", "h", "b", "ok") for c, o, t, b in NOTES]
    return spark.createDataFrame(rows, "codigo long, organismo string, titulo string, body_text string, fecha string, content_hash string, body_hash string, body_status string").cache()


@pytest.fixture(scope="module")
def chunks(notes):
    return index.chunk(notes, index.ChunkRule(400, 50)).cache()


def plans(spark, notes, *asked):
    known = [r[0] for r in notes.select("organismo").distinct().collect()]
    return route.plan(spark.createDataFrame([(i, q, "2026-08-05") for i, q in enumerate(asked)], "q int, question string, today string"), known)


def search(spark, notes, chunks, *asked, **options):
    ids = ["codigo", "chunk_ix"]
    return retrieve.retrieve(index.postings(chunks, ids), index.lengths(chunks, ids), plans(spark, notes, *asked), notes, **options)


def test_passages():
    text = "Considerando algo que se dice aquí con bastante detalle.\nARTÍCULO PRIMERO. " + "a" * 60 + "\nARTÍCULO SEGUNDO. " + "b" * 60 + "\nTRANSITORIOS " + "c" * 60
    got = index.split_passages(text, index.ChunkRule())
    assert [p[2].split()[0] for p in got] == ["Considerando", "ARTÍCULO", "ARTÍCULO", "TRANSITORIOS"]
    long = index.split_passages("palabra " * 4000, index.ChunkRule())
    assert len(long) > 10 and max(len(p[2]) for p in long) <= 1200 and long[1][0] == 1050
    assert index.split_passages("corto", index.ChunkRule()) == [(0, 5, "corto")] and index.split_passages(" \n", index.ChunkRule()) == []
    a, b = "x" * 50, "y" * 50
    assert [p[2] for p in index.split_passages(f"{a}\n \n{b}", index.ChunkRule())] == [a, b]


def test_hard_slices(spark):
    df = spark.createDataFrame([("z" * n,) for n in (0, 1, 1200, 1201, 2250, 2251, 5000)], "t string").select("t", index.hard_slices(F.col("t")).alias("s"))
    for t, s in df.collect():
        whole = [(t[i : i + 1200]) for i in ([0] if len(t) <= 1200 else range(0, len(t) - 150, 1050))]
        assert s == whole


def test_index_is_incremental(spark, tmp_path, notes):
    t = Table(spark, str(tmp_path / "chunks"), CHUNK)
    assert index.build_index(t, notes) == {"indexed": 4, "skipped": 0, "removed": 0}
    v = t.version()
    assert index.build_index(t, notes) == {"indexed": 0, "skipped": 4, "removed": 0} and t.version() == v
    retitled = notes.withColumn("content_hash", F.when(F.col("codigo") == 1, "new").otherwise(F.col("content_hash"))).where("codigo < 4")
    assert index.build_index(t, retitled) == {"indexed": 1, "skipped": 2, "removed": 1}
    assert {r[0] for r in t.read().select("codigo").distinct().collect()} == {1, 2, 3}
    assert index.build_index(t, retitled, index.ChunkRule(600, 80))["indexed"] == 3


def test_bm25_is_that_of_sqlite(spark, chunks):
    ids, rows = ["codigo", "chunk_ix"], chunks.collect()
    con = sqlite3.connect(":memory:")
    con.execute("create virtual table f using fts5(titulo, organismo, texto, tokenize = \"unicode61 remove_diacritics 2\")")
    con.executemany("insert into f(rowid, titulo, organismo, texto) values (?, ?, ?, ?)", [(r["codigo"] * 1000 + r["chunk_ix"], r["titulo"], r["organismo"], r["texto"]) for r in rows])
    want = {k: -s for k, s in con.execute("select rowid, bm25(f, 8.0, 4.0, 1.0) from f where f match '\"export\"* OR \"salud\" OR \"maiz\" OR \"medica\"*'")}
    asked = spark.createDataFrame([(1, "export", True), (1, "salud", False), (1, "maiz", False), (1, "medica", True)], "q int, phrase string, is_prefix boolean")
    got = {r["codigo"] * 1000 + r["chunk_ix"]: r["score"] for r in retrieve.bm25(index.postings(chunks, ids), index.lengths(chunks, ids), asked, ids).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_phrases_are_literal(spark):
    q = spark.createDataFrame([(1, ['"x" OR NEAR(a b)', "salud* -drop", "exportaciones exportar", "ab"])], "q int, terms array<string>")
    assert {(r["phrase"], r["is_prefix"]) for r in retrieve.phrases(q).collect()} == {("NEAR", False), ("salud", False), ("drop", False), ("export", True)}


def test_retrieval(spark, notes, chunks):
    asked = "¿Qué se dijo sobre exportaciones?", "medicamentos en COFEPRIS", "higiene publicada en julio de 2026"
    got = search(spark, notes, chunks, *asked).collect()
    by = lambda q: [r for r in sorted(got, key=lambda r: r["rank"]) if r["q"] == q]
    assert by(0)[0]["codigo"] == 2 and {1, 2} == {r["codigo"] for r in by(0)}
    assert {r["codigo"] for r in by(1)} == {1} and by(1)[0]["bm25"] > 1 > by(1)[0]["score"]
    assert by(2)[0]["codigo"] == 3
    for q in range(3):
        codes = [r["codigo"] for r in by(q)]
        assert max(codes.count(c) for c in codes) <= 2 and [r["rank"] for r in by(q)] == list(range(1, len(codes) + 1))
    plain = search(spark, notes, chunks, asked[0], use_prefix=False).collect()
    assert {r["codigo"] for r in plain} == {2}


def test_context(spark):
    hits = spark.createDataFrame([(1, 2, 9, "b", "zwei"), (1, 1, 8, "a", "eins")], "q int, rank int, codigo long, titulo string, texto string")
    c = retrieve.context(hits)
    assert c.head()["context"] == "[8] a\neins\n---\n[9] b\nzwei"
    assert [(x["codigo"], x["texto"]) for x in c.select(retrieve.split_context(F.col("context")).alias("p")).head()["p"]] == [(8, "eins"), (9, "zwei")]


@pytest.mark.parametrize(
    "asked, want",
    [
        ("entre 2020 y 2023", ("2020-01-01", "2023-12-31")),
        ("el 31 de julio de 2026", ("2026-07-31", "2026-07-31")),
        ("en febrero de 2024", ("2024-02-01", "2024-02-29")),
        ("durante marzo", ("2026-03-01", "2026-03-31")),
        ("últimos 2 meses", ("2026-06-06", "2026-08-05")),
        ("este trimestre", ("2026-07-01", "2026-09-30")),
        ("primer trimestre de 2025", ("2025-01-01", "2025-03-31")),
        ("este año", ("2026-01-01", "2026-12-31")),
        ("el año pasado", ("2025-01-01", "2025-12-31")),
        ("en 2021", ("2021-01-01", "2021-12-31")),
        ("hoy", (None, None)),
    ],
)
def test_dates(asked, want):
    assert route.dates_in(asked, date(2026, 8, 5)) == want


def test_routes():
    known = ["SECRETARÍA DE HACIENDA Y CRÉDITO PÚBLICO", "Comisión Federal de Electricidad"]
    p = lambda q: route.plan_of(q, known, date(2026, 8, 5))
    a = p("¿Cuántas notas publicó la SHCP en julio de 2026?")
    assert (a["strategy"], a["terms"], a["organismos"], a["since"], a["wants_count"]) == ("sql", [], known[:1], "2026-07-01", True)
    assert p("estímulos fiscales a gasolinas")["strategy"] == "retrieval"
    b = p("tarifas de la CFE este trimestre")
    assert (b["strategy"], b["until"], b["expansions"]["tarifa"]) == ("hybrid", "2026-09-30", ["tarifas"])
    assert p("acuerdos del IMSS")["organismos"] == ["instituto mexicano del seguro social"]
    assert p("qué dijo la SHCP y el IMSS")["organismos"] == [known[0], "instituto mexicano del seguro social"]
    assert p("¿Qué hay del PIB?")["organismos"] == []
    assert p("expediente 79/2025")["terms"] == ["expediente"]
    assert "2025" in route.terms_in("expediente 79/2025", [], keep_numbers=True)


def test_gates_and_citations(spark, notes, chunks):
    asked = ["acuerdos del IMSS sobre vacunas", "salud en 2019", "higiene", "zzzzz qqqqq", "¿Cuántas notas publicó COFEPRIS este año?", "medicamentos"]
    p = plans(spark, notes, *asked)
    hits = search(spark, notes, chunks, *asked).join(chunks.select("codigo", "chunk_ix", "texto"), ["codigo", "chunk_ix"])

    def provider(h):
        return h.sparkSession.createDataFrame([(2, True, "x", [3, 99]), (5, True, "y", [77])], "q int, sufficient boolean, answer string, citations array<long>")

    got = {r["q"]: r for r in answer.answer(p, retrieve.coverage(notes), notes, hits, provider).collect()}
    assert [got[q]["refused_because"] for q in range(6)] == ["out_of_coverage", "out_of_coverage", None, "no_hits", None, "fabricated_citations"]
    assert got[2]["citations"] == [3] and got[4]["answer"].startswith("1 — COMISION FEDERAL")
    low = {r["q"]: r["refused_because"] for r in answer.answer(p, retrieve.coverage(notes), notes, hits, provider, least_score=1e9).collect()}
    assert low[2] == "low_score"
    ext = {r["q"]: r for r in answer.answer(p, retrieve.coverage(notes), notes, hits).collect()}
    assert ext[5]["refused_because"] is None and 1 in ext[5]["citations"]


def test_malformed_answers(spark):
    raw = spark.createDataFrame([(1, "nope"), (2, '{"sufficient": true, "answer": "a", "citations": [1]}'), (3, '{"answer": 1}')], "q int, json string")
    assert [(r["q"], r["sufficient"], r["citations"]) for r in answer.parse_answers(raw).orderBy("q").collect()] == [(1, False, []), (2, True, [1]), (3, False, [])]


def test_metrics(spark):
    gold = spark.createDataFrame([("a", "answerable", "retrieval", [1, 2]), ("b", "answerable", "sql", []), ("c", "answerable", "hybrid", [99]), ("u", "unanswerable", "retrieval", []), ("v", "unanswerable", "retrieval", [])], "id string, kind string, strategy string, gold_codigos array<long>")
    corpus = spark.createDataFrame([(1,), (2,), (3,)], "codigo long")
    p = spark.createDataFrame([("a", "retrieval", None), ("b", "retrieval", "no_rows"), ("c", "hybrid", None), ("u", "retrieval", "no_hits"), ("v", "retrieval", None)], "q string, strategy string, refused_because string")
    found = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("a", 3, 3)], "q string, rank int, codigo long")
    answers = spark.createDataFrame([("a", True, [1, 3])], "q string, sufficient boolean, citations array<long>")
    m = evaluate.summarise(evaluate.question_results(gold, corpus, p, found, answers)).head().asDict()
    assert m["n_questions"] == 4
    assert (m["recall@8"], m["hit_rate@8"], m["routing_accuracy"], m["refusal_rate_unanswerable"], m["over_refusal_rate_answerable"]) == (0.5, 1.0, 0.75, 1.0, 0.5)
    assert (m["citation_precision"], m["citation_recall"], m["citation_f1"]) == (0.5, 0.5, 0.5)
    assert len(evaluate.failures(m)) == 3 and evaluate.failures({}) and not evaluate.failures({"x": 1.0}, {"x": 0.5})
    assert "recall@8" in evaluate.render(m)


def test_fusion(spark):
    run = lambda rows: spark.createDataFrame(rows, "q int, codigo long, rank int, score double")
    got = {r["codigo"]: r for r in retrieve.rrf([run([(1, 5, 1, 9.0), (1, 6, 2, 8.0)]), run([(1, 6, 1, 3.0), (1, 7, 2, 2.0)])], ["codigo"]).collect()}
    assert abs(got[6]["score"] - (1 / 62 + 1 / 61)) < 1e-12 and got[6]["bm25"] == 8.0 and got[7]["bm25"] == 2.0
