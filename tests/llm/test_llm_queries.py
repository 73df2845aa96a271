from __future__ import annotations

import os

import pytest
from conftest import TINY, same_rows

from tidemark.llm.queries import ORACLE_SQL, QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(TINY), reason="no test data")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, oracle, name):
    same_rows(QUERIES[name](spark, TINY), oracle, ORACLE_SQL[name])


def test_encoding_query(spark):
    import hashlib

    from tokenizers import Tokenizer

    from tidemark.llm.queries import table, tokenizer_path

    lib, docs = Tokenizer.from_file(tokenizer_path()), {r["doc_id"]: r["text"] or "" for r in table(spark, TINY, "documents").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op9_bpe"](spark, TINY).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        ids = lib.encode(text, add_special_tokens=False).ids
        assert (got[i]["n_tokens"], got[i]["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[i]["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_fingerprint_query(spark):
    from tidemark.llm.queries import table
    from tidemark.llm.simhash import fingerprint

    fps = {r["doc_id"]: fingerprint(r["text"]) for r in table(spark, TINY, "documents").collect()}
    near = {a: sum(a != b and (x ^ y).bit_count() <= 2 for b, y in fps.items()) for a, x in fps.items()}
    got = {r["doc_id"]: r for r in QUERIES["op3_simhash"](spark, TINY).collect()}
    assert {i: (r["fingerprint"], r["n_near"]) for i, r in got.items()} == {i: (f"{fps[i]:016x}", near[i]) for i in fps}


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    out = corpus_pipeline.run(spark, TINY)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < out.count() < docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.withColumn("extra", docs.doc_id), TINY).columns == [*docs.columns, "extra"]


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    """Every stage on what the one before kept: nulls, empty and very long texts, ties, repeated
    rows, copies, shared lines, test passages."""
    import hashlib

    import numpy as np
    import test_llm_operators as ops
    from tokenizers import Tokenizer

    import corpus_pipeline
    from tidemark.llm import decontam, tokens
    from tidemark.llm.queries import tokenizer_path

    line, item = "a line that a good many of the documents share, word for word", ops.prose(5, 40)
    texts = [(i, f"{ops.prose(100 + i, 60)}\n{line}\n{ops.prose(200 + i, 30)}", "en" if i % 2 else "de") for i in range(12)]
    texts += [(20, None, "en"), (21, "", "en"), (22, "12 -- 34", "en"), (23, line, "en"), (24, line.upper(), "de"), (25, ops.prose(300, 40_000), "en"), (26, ops.prose(300, 40_000) + " end", None)]
    texts += [(30, ops.prose(400, 50) + " " + item, "en"), (31, texts[3][1], "en"), (3, texts[3][1], "en"), (3, texts[3][1], "en"), (32, ops.prose(401, 30) + " <|endoftext|> ß é", None), (None, ops.prose(402, 30), "de"), (None, None, None)]
    rows = [(i, t, lang, "s", len(t or ""), "x") for i, t, lang in texts]
    schema = "doc_id long, text string, lang string, source string, n_chars long, rank string"
    bench = [(1, item, "y"), (None, None, "y"), (2, "", "y")]
    for name, given, kind in (("documents", rows, schema), ("benchmark", bench, "item_id long, text string, coverage string")):
        spark.createDataFrame(given, kind).write.parquet(f"{tmp_path}/full/{name}.parquet")
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/none/{name}.parquet")
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, f"{tmp_path}/full").collect())

    kept = [(i, t) for i, t, _ in texts if t is not None and any(map(str.isalpha, t))]
    kept = [(None if i == "None" else int(i), t) for i, t, _, _ in ops.brute_lines(kept)]
    fps = [ops.slow_fingerprint(t) for _, t in kept]
    edges = [(a, b) for a in range(len(kept)) for b in range(a) if kept[a][0] is not None and kept[b][0] is not None and (fps[a] ^ fps[b]).bit_count() <= 2]
    first = {}
    for n, g in ops.groups(range(len(kept)), edges).items():
        if kept[n][0] is not None:
            first.setdefault(g, []).append((kept[n][0], n))
    stay = {min(v)[1] for v in first.values()} | {n for n, (i, _) in enumerate(kept) if i is None}
    words = lambda t: tokens.Tokenizer().words(t.casefold().encode())[0]
    clean = [kept[n] for n in sorted(stay) if sum(k for _, _, k in decontam.tiles(words(kept[n][1]), words(item))) < 0.5 * 40]
    lib, want = Tokenizer.from_file(tokenizer_path()), []
    for i, t in clean:
        ids = lib.encode(t, add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert 10 < len(want) < len(texts) - 8 and got == sorted(want) and np.array(fps).size
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
