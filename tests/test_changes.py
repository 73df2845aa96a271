from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import canonical_text, content_hash, fold
from tidemark.operators import changes
from tidemark.schemas import EDITION, HASHED, NOTE, RUN


def incoming(spark, titulo, codigo=1, origen="u"):
    df = spark.createDataFrame([(codigo, "2026-07-31", "MAT", "", "P", "O", titulo, "d", origen)], "codigo long, fecha string, edicion string, seccion string, poder string, organismo string, titulo string, url_detalle string, url_origen string")
    return df.withColumn("content_hash", content_hash(HASHED, exact=["codigo"]))


def test_upserts(spark):
    none = spark.createDataFrame([], NOTE)
    one = changes.upsert_notes(none, incoming(spark, "a"), "t1")
    assert changes.upsert_outcomes(none, incoming(spark, "a")).head()["outcome"] == "inserted"
    same = changes.upsert_notes(one, incoming(spark, "a", origen="v"), "t2").head()
    assert (same["revision"], same["last_seen_at"], same["last_changed_at"], same["body_status"]) == (1, "t2", "t1", "pending")
    two = incoming(spark, "b")
    assert [(r["revision"], r["field"], r["old_value"], r["new_value"]) for r in changes.field_diffs(one, two).collect()] == [(2, "titulo", "a", "b")]
    after = changes.upsert_notes(one, two, "t3").head()
    assert (after["revision"], after["titulo"], after["first_seen_at"], after["last_changed_at"]) == (2, "b", "t1", "t3")
    assert changes.upsert_notes(one, incoming(spark, "c", codigo=2), "t4").count() == 2


def test_hash(spark):
    h = lambda s: incoming(spark, s).head()["content_hash"]
    assert h("Más  que nada ") == h("Más que\nnada") and h("a") != h("b")
    import hashlib
    import json

    want = {"codigo": 1, "edicion": "MAT", "fecha": "2026-07-31", "organismo": "O", "poder": "P", "seccion": "", "titulo": 'é "x" \\'}
    assert h('é "x" \\') == hashlib.sha256(json.dumps(want, sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def test_text(spark):
    df = spark.createDataFrame([("Ñandú ÁÉ",), ("á",), ("Ṩ",), (None,)], "s string")
    assert [r[0] for r in df.select(fold(F.col("s"))).collect()] == ["nandu ae", "a", "s", None]
    assert [r[0] for r in df.select(canonical_text(F.col("s"))).collect()] == ["Ñandú ÁÉ", "á", "Ṩ", ""]


def test_bodies(spark):
    notes = changes.upsert_notes(spark.createDataFrame([], NOTE), incoming(spark, "a"), "t1")
    body = lambda status, text: spark.createDataFrame([(1, status, text)], "codigo long, body_status string, body_text string")
    notes, out = changes.set_bodies(notes, body("ok", "x"), "t2")
    assert out.head()["outcome"] == "inserted"
    assert changes.set_bodies(notes, body("ok", "x"), "t3")[1].head()["outcome"] == "unchanged"
    assert changes.set_bodies(notes, body("ok", "x"), "t3")[0].head()["last_changed_at"] == "t2"
    later, out = changes.set_bodies(notes, body("error", None), "t4")
    assert out.head()["outcome"] == "updated" and later.head()["body_text"] is None
    assert changes.pending_bodies(later, 5).count() == 0 and changes.pending_bodies(later, 5, retry_errors=True).count() == 1
    unknown = spark.createDataFrame([(9, "ok", "x")], "codigo long, body_status string, body_text string")
    assert changes.set_bodies(notes, unknown, "t")[1].head()["outcome"] == "unknown"


def test_editions(spark):
    seen = lambda h: spark.createDataFrame([("2026-07-31", "MAT", "ok", 1, 0, h, "u")], "fecha string, edicion string, status string, n_notas long, n_rejected long, page_hash string, url string")
    stored, flags = spark.createDataFrame([], EDITION), []
    for h in ("a", "a", "b"):
        stored, changed = changes.record_editions(stored, seen(h), "t")
        flags.append(changed.head()["changed"])
    assert flags == [True, False, True] and stored.count() == 1


def test_ledger(spark):
    assert changes.merged({"inserted": 1, "detail": ["x"] * 40}, {"inserted": 2, "errors": 1, "detail": ["y"] * 40}) | {} == {"inserted": 3, "errors": 1, "detail": ["x"] * 40 + ["y"] * 10}
    row = changes.ledger_row(spark, 1, "run", "a", "b", "ok", {"inserted": 2, "slept_s": 1.5})
    assert row.schema == RUN and row.head()["slept_s"] == 1.5
    outcomes = spark.createDataFrame([("inserted",), ("inserted",), ("unchanged",)], "outcome string")
    assert changes.run_counters(outcomes)["inserted"] == 2
