"""From a site to answers: discovery, bodies, index, questions, evaluation, ablation."""

from __future__ import annotations

from datetime import date
from urllib.parse import parse_qs, urlsplit

import pytest

from tidemark.operators import ask, crawl, evaluate
from tidemark.sources.fetch import CircuitOpen, PoliteClient, Response

BASE, BODIES = "https://x.test/index.php", "https://x.test/body"
FILL = " El presente acuerdo entra en vigor al día siguiente de su publicación." * 6


class Site:
    def __init__(self):
        self.index = {("2026-07-01", "MAT"): [(1, "SECRETARIA DE SALUD", "NORMA de higiene"), (2, "BANCO DE MEXICO", "TIPO de cambio")], ("2026-07-02", "MAT"): [(3, "SECRETARIA DE ECONOMIA", "AVISO sobre exportaciones"), (4, "SECRETARIA DE SALUD", "ACUERDO de medicamentos")]}
        self.bodies = {1: "Higiene en hospitales públicos." + FILL, 2: "Obligaciones en moneda extranjera." + FILL, 3: "Tarifas para exportar maíz y azúcar." + FILL}
        self.robots, self.asked, self.down, self.odd = "User-agent: *\nDisallow: /nota/4\n", [], set(), set()

    def __call__(self, url, headers):
        self.asked.append(url)
        parts = urlsplit(url)
        if parts.path == "/robots.txt":
            return Response(200, self.robots.encode())
        if url in self.down:
            return Response(503)
        if parts.path == "/index.php":
            q = {k: v[0] for k, v in parse_qs(parts.query).items()}
            day = f"{q['year']}-{q['month']}-{q['day']}"
            rows = "".join(f'<tr><td class="subtitle_azul">{o}</td></tr><tr><td><a href="/nota/{c}?f=nota_detalle.php&codigo={c}">{t}</a></td></tr>' for c, o, t in self.index.get((day, q["edicion"]), []))
            if day in self.odd:
                rows = '<a href="nota_detalle.php?code=x">?</a>'
            return Response(200, f"<body><table>{rows}</table></body>".encode(), {"content-type": "text/html; charset=utf-8"})
        code = int(parts.path.rpartition("/")[2])
        return Response(200, f"<html><nav>menu</nav><p>{self.bodies[code]}</p></html>".encode("cp1252")) if code in self.bodies else Response(404)


def client(site, **options):
    return PoliteClient(site, "agent", gap=0, attempts=1, sleep=lambda s: None, **options)


@pytest.fixture(scope="module")
def crawled(spark, tmp_path_factory):
    site, store = Site(), crawl.Store(spark, str(tmp_path_factory.mktemp("store")))
    run = store.start_run("discover", "t0")
    c = client(site)
    found = crawl.discover(store, c, date(2026, 7, 1), date(2026, 7, 3), ("MAT", "VES"), BASE, today=date(2026, 8, 1), now="t1")
    store.finish_run(run, found, c, now="t2")
    return site, store, found


def test_discover(crawled):
    site, store, found = crawled
    assert (found["inserted"], found["no_edition"], found["errors"]) == (4, 4, 0)
    notes = {r["codigo"]: r for r in store.notes.read().collect()}
    assert notes[2]["organismo"] == "BANCO DE MEXICO" and notes[2]["url_detalle"] == "https://x.test/nota/2?f=nota_detalle.php&codigo=2" and notes[2]["fecha"] == "2026-07-01" and notes[2]["body_status"] == "pending"
    assert store.editions.read().where("status = 'ok'").count() == 2
    last = store.recent_runs(1).head()
    assert (last["command"], last["status"], last["inserted"], last["finished_at"]) == ("discover", "ok", 4, "t2") and last["requests"] == 6
    asked = len(site.asked)
    again = crawl.discover(store, client(site), date(2026, 7, 1), date(2026, 7, 3), ("MAT", "VES"), BASE, today=date(2026, 8, 1))
    assert len(site.asked) == asked and again["inserted"] == again["unchanged"] == 0


def test_bodies_then_questions(spark, crawled):
    site, store, _ = crawled
    found = crawl.enrich(store, client(site), 10, BODIES, now="t3")
    assert (found["inserted"], found["skipped_robots"], found["errors"]) == (3, 1, 0)
    status = {r["codigo"]: (r["body_status"], r["body_text"]) for r in store.notes.read().collect()}
    assert status[4] == ("robots_denied", None) and status[3][1].startswith("Tarifas para exportar maíz") and "menu" not in status[3][1]
    assert crawl.enrich(store, client(site), 10, BODIES)["inserted"] == 0
    assert store.build_index() == {"indexed": 3, "skipped": 0, "removed": 0}
    notes, chunks = store.notes.read(), store.chunks.read()

    questions = [("a", "¿Qué se dijo sobre exportaciones de maíz?"), ("b", "¿Cuántas notas publicó la Secretaría de Salud?"), ("c", "higiene en enero de 1990"), ("d", "zzzz qqqq"), ("e", "listado de julio de 2026"), ("f", "¿Cuántas notas publicó la Secretaría de Salud en febrero de 2026?")]
    got = ask.ask(spark.createDataFrame([(q, t, "2026-08-05") for q, t in questions], "q string, question string, today string"), notes, chunks)
    by = {r["q"]: r for r in got.answers.collect()}
    assert by["a"]["refused_because"] is None and by["a"]["citations"][0] == 3 and "maíz" in by["a"]["answer"]
    assert by["b"]["answer"] == "2 — SECRETARIA DE SALUD: 2" and by["b"]["strategy"] == "sql"
    assert [by[q]["refused_because"] for q in "cd"] == ["out_of_coverage", "no_hits"]
    assert by["e"]["citations"] == [3, 4, 1, 2] and by["f"]["refused_because"] == "out_of_coverage"
    shown = {(r["q"], r["pos"]): r for r in ask.sources(got, notes).collect()}
    assert (shown["a", 0]["titulo"], shown["a", 0]["organismo"], shown["a", 0]["url"]) == ("AVISO sobre exportaciones", "SECRETARIA DE ECONOMIA", "https://x.test/nota/3?f=nota_detalle.php&codigo=3")

    gold = spark.createDataFrame([("a", questions[0][1], "answerable", "retrieval", [3], "2026-08-05"), ("b", questions[1][1], "answerable", "sql", [], "2026-08-05"), ("e", questions[4][1], "answerable", "sql", [1, 2, 3, 4], "2026-08-05"), ("x", "¿Qué se dijo de la luna?", "answerable", "retrieval", [999], "2026-08-05"), ("c", questions[2][1], "unanswerable", "hybrid", [], "2026-08-05")], "id string, question string, kind string, strategy string, gold_codigos array<long>, today string")
    report = evaluate.evaluate(gold, notes, chunks, None)
    assert report["counts"] == {"total": 5, "scored": 4, "skipped_not_in_corpus": 1, "answerable": 3, "answerable_with_gold": 2, "unanswerable": 1}
    assert (report["metrics"]["recall@8"], report["metrics"]["routing_accuracy"], report["metrics"]["refusal_rate_unanswerable"], report["metrics"]["over_refusal_rate_answerable"]) == (1.0, 1.0, 1.0, 0.0)
    assert evaluate.evaluate(gold, notes, chunks)["metrics"]["citation_recall"] > 0
    table = {r["variant"]: r for r in evaluate.ablate(gold, notes, variants={v: evaluate.ABLATIONS[v] for v in ("baseline", "chunks 600/80")}).collect()}
    assert len(table) == 2 and table["baseline"]["delta recall@8"] == 0 and table["chunks 600/80"]["recall@8"] == 1.0


def test_changes_errors_and_breaker(spark, tmp_path):
    site, store = Site(), crawl.Store(spark, str(tmp_path / "s"))
    go = lambda **o: crawl.discover(store, client(site, **o), date(2026, 7, 1), date(2026, 7, 2), ("MAT",), BASE, recheck_days=60, today=date(2026, 7, 20))
    site.odd.add("2026-07-02")
    first = go()
    assert (first["inserted"], first["errors"]) == (2, 1) and store.editions.read().count() == 1
    site.odd.clear()
    site.index["2026-07-01", "MAT"][0] = (1, "SECRETARIA DE SALUD", "NORMA corregida de higiene")
    second = go()
    assert (second["inserted"], second["updated"], second["unchanged"]) == (2, 1, 1)
    diff = store.revisions.read().collect()
    assert [(r["codigo"], r["revision"], r["field"], r["old_value"], r["new_value"]) for r in diff] == [(1, 2, "titulo", "NORMA de higiene", "NORMA corregida de higiene")]
    site.down = {f"{BODIES}/{i}" for i in (1, 2, 3)}
    site.robots = ""
    with pytest.raises(CircuitOpen):
        crawl.enrich(store, client(site, breaker=2), 10, BODIES)
    assert {r[0] for r in store.notes.read().where("codigo = 4").select("body_status").collect()} == {"not_found"}
    row = store.stats().head()
    assert (row["notas"], row["amended"], row["diffs"], row["editions"]) == (4, 1, 1, 2)


def test_seed(spark, tmp_path):
    import json

    path = tmp_path / "notes.jsonl"
    path.write_text("\n".join(json.dumps({"codigo": i, "fecha": "2026-07-01", "edicion": "MAT", "titulo": f"T{i}", "organismo": "O", "body_text": "cuerpo " * 30 if i else ""}) for i in range(3)) + "\n\n")
    store = crawl.Store(spark, str(tmp_path / "s"))
    assert crawl.seed(store, str(path)) == {"inserted": 3, "updated": 0, "unchanged": 0, "bodies": 2, "indexed": 2}
    assert crawl.seed(store, str(path))["unchanged"] == 3
