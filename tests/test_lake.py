from __future__ import annotations

import itertools
import json

import pytest

from tidemark.operators import lake as ops
from tidemark.schemas import NOTE, SNAPSHOT
from tidemark.session import Lake
from tidemark.sources.snapshots import export_notes, export_snapshot, read_questions, read_snapshots
from tidemark.sources.versioned import Table


def note(codigo, revision, body="text", **more):
    return {"codigo": codigo, "fecha": "2026-07-31", "edicion": "MAT", "seccion": "", "poder": "EJECUTIVO", "organismo": "SHCP" if codigo == 101 else "SEP", "titulo": f"t{codigo}", "url_detalle": "", "content_hash": f"h{codigo}{revision}", "body_hash": f"b{body}", "body_status": "ok", "revision": revision, "first_seen_at": "x", "last_seen_at": "x", "last_changed_at": "x", "body_text": body, **more}


def put(folder, day, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"notas-{day}.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def versions(spark, lake):
    return {(r["codigo"], r["revision"], r["body_hash"]): (str(r["valid_from"]), r["valid_to"] and str(r["valid_to"]), r["is_current"]) for r in ops.silver_table(spark, lake).read().collect()}


def test_two_days_and_again(spark, tmp_path):
    lake, land = Lake(str(tmp_path / "lake")), tmp_path / "land"
    put(land, "2026-08-01", [note(101, 1), note(102, 1)])
    assert ops.load_bronze(spark, lake, str(land)) == {"staged": 2, "inserted": 2, "rejected": 0}
    assert ops.load_bronze(spark, lake, str(land))["inserted"] == 0
    assert ops.update_silver(spark, lake) == 2
    before = ops.silver_table(spark, lake).version()
    assert ops.update_silver(spark, lake) == 0 and ops.silver_table(spark, lake).version() == before
    put(land, "2026-08-05", [note(101, 2), note(102, 1)])
    ops.load_bronze(spark, lake, str(land))
    assert ops.update_silver(spark, lake) == 1
    got = versions(spark, lake)
    assert got[101, 1, "btext"] == ("2026-08-01", "2026-08-05", False)
    assert got[101, 2, "btext"] == ("2026-08-05", None, True)
    assert got[102, 1, "btext"] == ("2026-08-01", None, True)
    ops.update_gold(spark, lake)
    mart = {r["organismo"]: r for r in Table(spark, lake.path("gold", "amendments_by_organismo")).read().collect()}
    assert len(mart) == 2
    assert (mart["SHCP"]["notas"], mart["SHCP"]["amended"], mart["SHCP"]["amendment_rate"], mart["SHCP"]["avg_days_to_correction"], mart["SHCP"]["days_since_seen"]) == (1, 1, 1.0, 5.0, 4.0)
    assert ops.broken_invariants(ops.silver_table(spark, lake).read()).count() == 0
    stats = ops.lake_stats(spark, lake)
    assert (stats["bronze_rows"], stats["snapshots"], stats["silver_rows"], stats["current"], stats["amendments_by_organismo"]) == (4, 2, 3, 2, 2)


def test_any_order_of_arrival(spark, tmp_path):
    days = [("2026-08-01", 1), ("2026-08-03", 2), ("2026-08-05", 3)]
    want = None
    for n, order in enumerate((days, days[::-1], [days[1], days[0], days[2]])):
        lake, land = Lake(str(tmp_path / f"lake{n}")), tmp_path / f"land{n}"
        for day, revision in order:
            put(land, day, [note(101, revision)])
            ops.load_bronze(spark, lake, str(land))
            ops.update_silver(spark, lake)
        got = versions(spark, lake)
        want = want or got
        assert got == want
    frames = [ops.bronze_table(spark, lake).read().where(f"_snapshot_date = '{d}'") for d, _ in days]
    rows = {tuple(map(str, ops.silver_from(a.union(b).union(c)).orderBy("revision").collect())) for a, b, c in itertools.permutations(frames)}
    assert len(rows) == 1
    assert [v[:2] for _, v in sorted(want.items())] == [("2026-08-01", "2026-08-03"), ("2026-08-03", "2026-08-05"), ("2026-08-05", None)]


def test_body_change_is_a_version(spark, tmp_path):
    lake, land = Lake(str(tmp_path / "lake")), tmp_path / "land"
    put(land, "2026-08-01", [note(101, 1, "a")])
    put(land, "2026-08-02", [note(101, 1, "b")])
    ops.load_bronze(spark, lake, str(land))
    b = ops.bronze_table(spark, lake).read()
    assert ops.silver_from(b).count() == 2
    assert ops.silver_from(b, metadata_only=True).count() == 1
    assert [r["body_text"] for r in ops.silver_from(b).where("is_current").collect()] == ["b"]


def test_inverted_sightings_are_clamped(spark):
    rows = spark.createDataFrame([(1, 1, "2026-08-06"), (1, 2, "2026-08-04")], "codigo long, revision long, d string").selectExpr("codigo", "revision", "cast(d as date) effective_date")
    got = ops.brackets(rows).orderBy("revision").collect()
    assert [str(r["valid_from"]) for r in got] == ["2026-08-06", "2026-08-06"] and got[1]["is_current"]
    assert ops.broken_invariants(ops.brackets(rows)).count() == 0


def test_bad_lines_and_names_are_rejected(spark, tmp_path):
    put(tmp_path, "2026-08-01", [note(1, 1)])
    (tmp_path / "notas-2026-08-02.jsonl").write_text("{not json\n")
    (tmp_path / "notas-undated.jsonl").write_text(json.dumps(note(2, 1)) + "\n")
    good, bad = read_snapshots(spark, str(tmp_path / "*.jsonl"))
    assert [(r["codigo"], str(r["_snapshot_date"])) for r in good.collect()] == [(1, "2026-08-01")]
    assert bad.count() == 2


def test_exports(spark, tmp_path):
    notes = spark.createDataFrame([{**{f.name: None for f in NOTE}, **note(7, 1)}], NOTE)
    path, n = export_snapshot(notes, str(tmp_path / "out"), "2026-08-01")
    assert n == 1 and path.endswith("notas-2026-08-01.jsonl")
    line = json.loads(open(path).read())
    assert list(line) == [f.name for f in SNAPSHOT] and line["revision"] == 1
    export_snapshot(notes, str(tmp_path / "out"), "2026-08-01")
    export_notes(notes, str(tmp_path / "csv"), "csv", include_body=False)
    back = spark.read.option("header", "true").csv(str(tmp_path / "csv"))
    assert "body_text" not in back.columns and back.count() == 1
    with pytest.raises(ValueError):
        export_notes(notes, str(tmp_path / "x"), "xml")


def test_questions(spark, tmp_path):
    p = tmp_path / "gold.jsonl"
    p.write_text('// a comment\n\n{"id": "a", "question": "?", "kind": "answerable", "gold_codigos": [1]}\n')
    assert [r["gold_codigos"] for r in read_questions(spark, str(p)).collect()] == [[1]]
    p.write_text('{"id": "a"}\n{"id": "a"}\n')
    with pytest.raises(ValueError):
        read_questions(spark, str(p))


def test_table_versions(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), spark.range(0).selectExpr("id", "cast(id as string) v").schema).ensure()
    assert t.read().count() == 0
    t.append(spark.range(2).selectExpr("id", "'a' v"))
    assert t.insert_new(spark.range(1, 4).selectExpr("id", "'b' v"), ["id"]) == 2
    t.upsert(spark.range(1).selectExpr("id", "'z' v"), ["id"])
    assert {(r["id"], r["v"]) for r in t.read().collect()} == {(0, "z"), (1, "a"), (2, "b"), (3, "b")}
    assert t.read(version=1).count() == 2 and t.read(as_of=10**12).count() == 4
    v = t.version()
    t.append(spark.range(0).selectExpr("id", "'a' v"))
    assert t.version() == v
    t.delete(spark.range(2), ["id"])
    assert t.read().count() == 2
    with pytest.raises(ValueError):
        t.read(version=99)
    t.drop()
    assert not t.exists()


def test_stream(spark, tmp_path):
    from tidemark.streaming.bronze import stream_bronze

    lake, land = Lake(str(tmp_path / "lake")), tmp_path / "land"
    put(land, "2026-08-01", [note(1, 1)])
    for more, n in (([], 1), ([note(2, 1)], 2)):
        if more:
            put(land, "2026-08-02", more)
        stream_bronze(spark, lake, str(land), str(tmp_path / "ck")).awaitTermination()
        assert ops.bronze_table(spark, lake).read().count() == n


def test_names():
    a, b = Lake("/x/a"), Lake("/x/b")
    assert a.name("gold", "t") != b.name("gold", "t") and Lake("/x", "main").name("gold", "t") == "main.gold.t"
