"""Each operator against a brute-force version on small fixtures, with nulls, empty and long texts,
ties, repeated rows, empty tables and clashing extra columns."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, common, decontam, embed_dedup, langid, quality, simhash, substring, tokens, url_filter, warc
from tidemark.llm.line_dedup import dedup_lines

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def docs(spark, texts, extra=()):
    rows = [(i if not isinstance(t, tuple) else t[0], t if not isinstance(t, tuple) else t[1], "en", "s", 0, *[0] * len(extra)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + "".join(f", {e} long" for e in extra))


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


def groups(nodes, edges):
    """Smallest node reachable from each."""
    low = {n: n for n in nodes}

    def root(n):
        while low[n] != n:
            n = low[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        low[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3)]
    got = {x["node"]: x["component"] for x in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == groups({n for e in real for n in e}, real)
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_lines(rows, least=40, n_docs=5):
    strip, upper = " \t\n\x0b\x0c\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(strip).translate(upper)
    held = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least and d is not None:
                held[key(line)].add(d)
    lost = {k: max(v) for k, v in held.items() if len(v) >= n_docs}
    return sorted((str(d), "\n".join(kept := [x for x in (t or "").split("\n") if not (key(x) in lost and lost[key(x)] != d)]), (t or "").count("\n") + 1, (t or "").count("\n") + 1 - len(kept)) for d, t in rows)


def test_line_dedup(spark):
    hot, odd = "This line is shared by many of the documents here", "É una línea que comparten varios documentos, ÉSTA"
    rows = [(i, "\n".join([hot, f"own {i}", "  " + odd + "\t", ""])) for i in range(8)]
    rows += [(20, hot.upper() + "\n" + hot), (21, odd.lower()), (22, None), (23, ""), (24, "\n"), (None, hot), (7, hot), (7, "again " + hot), (7, hot), (30, "x" * 39), (31, "\n".join(f"{hot} {i % 50}" for i in range(20000)))]
    df = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], "doc_id long, text string, r1 int, pos int, gone int")
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "r1", "pos", "gone", "n_lines", "n_dropped"]
    assert sorted((str(r["doc_id"]), r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()) == brute_lines(rows)
    assert dedup_lines(df.limit(0)).count() == 0


def test_warc(spark, tmp_path):
    big = "<p>" + "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 40
    fake = "x" * 50 + warc.record(1, "http://trap", b"payload", 7, "0" * 64, None, False).decode() * 3
    rows = [(3, "http://a", big), (1, "http://b\r\nX: y", big), (2, None, fake), (9, "http://é", "small"), (8, "u", "small"), (7, "u", None), (6, "u", ""), (None, "u", big), (None, "n", "z" * 200), (5, "u", "ß" * 60), (4, "u", "ß" * 60), (4, "u", "ß" * 60)] + [(100 + i, f"u{i}", f"page {i} " * 30) for i in range(200)]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "page_id long, url string, html string, size int, digest int")
    manifest = warc.write_warc(df.repartition(2), str(tmp_path / "w"), file_bytes=20_000)
    assert manifest.agg(F.sum("records")).head()[0] == len(rows) and manifest.count() > 3
    got = warc.read_warc(manifest, split_bytes=3_000).collect()
    first = {}
    for p, _, h in rows:
        data = (h or "").encode()
        if len(data) >= 100 and p is not None:
            first[data] = min(p, first.get(data, p))
    want = []
    for p, _, h in rows:
        data = (h or "").encode()
        least = first.get(data)
        revisit = least is not None and least != p
        want.append((str(p), len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", least if revisit else None))
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == sorted(want, key=lambda x: x[:4])
    assert all(bytes(r["payload"]).decode() == next(h or "" for p, _, h in rows if p == r["page_id"] and len((h or "").encode()) == r["payload_bytes"]) for r in got if r["payload"] is not None and r["page_id"] is not None)
    assert warc.archive_and_read(df.limit(0)).count() == 0
    path = manifest.head()["path"]
    with open(path.removeprefix("file:"), "r+b") as f:
        f.truncate(5000)
    with pytest.raises(Exception):
        warc.read_warc(manifest, split_bytes=3_000).collect()


def test_warc_of_long_urls(spark):
    urls = ["http://long/" + "a" * 70_000, "http://long/" + "b" * 300_000, "http://c", "http://long/" + "d" * 65_536]
    html = ["x" * 200, "WARC/1.1\r\n" + "no header " * 20_000, "WARC/1.1\r\nName: " + "v" * 100_000, "WARC/1.1\r\nContent-Length: 3\r\n\r\n" + "y" * 90_000]
    df = spark.createDataFrame(list(zip(range(4), urls, html)), "page_id long, url string, html string")
    for split in (5_000, 1 << 20):
        got = {r["page_id"]: r for r in warc.archive_and_read(df.coalesce(1), split_bytes=split).collect()}
        assert [(got[i]["url"], bytes(got[i]["payload"]).decode()) for i in range(4)] == list(zip(urls, html))


def test_warc_paths():
    assert [warc.uri(x) for x in ("s3a://bucket/x", "s3n://b/x", "hdfs://h:1/x", "/tmp/a:b")] == ["s3://bucket/x", "s3://b/x", "hdfs://h:1/x", "/tmp/a:b"]
    assert warc._open("file:/tmp/x")[1] == warc._open("file:///tmp/x")[1] == warc._open("/tmp/x")[1] == "/tmp/x"


def slow_fingerprint(text):
    import xxhash

    words = [w for w in "".join(c.lower() if c.isascii() else c for c in (text or "")).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(monkeypatch):
    monkeypatch.setattr(simhash, "AT_ONCE", 50)
    for t in (None, "", " \n", "One", "one TWO", "a b c", prose(1, 400), "É é x É\ty Z\x0bq", "a b c d a b c a b c d"):
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_simhash(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE_GROUP", 3)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)] + [0]
    fps = set(base)
    for f in base:
        for _ in range(6):
            fps.add(f ^ sum({1 << r.randrange(64) for _ in range(r.randrange(4))}))
    fps |= {base[0] ^ (1 << i) for i in range(64)}
    signed = lambda f: f - ((f >> 63) << 64)
    want = {tuple(sorted((signed(a), signed(b)))) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 2}
    got = [(x["a"], x["b"]) for x in simhash.linked_fingerprints(spark.createDataFrame([(signed(f),) for f in fps], "fp long")).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    texts = [prose(1, 300), prose(1, 300) + " tail", prose(2, 50), None, "", "  ", prose(3, 5000), (40, prose(2, 50)), (40, prose(2, 50)), (None, prose(2, 50)), (None, "lonely words of no id")] + [prose(4, 120)] * 30
    df = docs(spark, texts, ["fingerprint", "component"])
    rows = [(r["doc_id"], slow_fingerprint(r["text"])) for r in df.collect()]
    got = sorted((str(x["doc_id"]), x["fingerprint"], x["n_near"], str(x["component_id"])) for x in simhash.near_duplicates(df).collect())
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= 2]
    near, comp = Counter(n for e in edges for n in e), groups(range(len(rows)), edges)
    least = {c: min((rows[i][0] for i in comp if comp[i] == c and rows[i][0] is not None), default=None) for c in set(comp.values())}
    assert got == sorted((str(rows[i][0]), f"{rows[i][1]:016x}", near[i], str(least[comp[i]])) for i in range(len(rows)))
    kept = [x["doc_id"] for x in simhash.keep_one_per_group(df).collect()]
    assert sorted(k for k in kept if k is not None) == sorted({v for v in least.values() if v is not None}) and kept.count(None) == 2
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    a, b = prose(1, 300), prose(2, 300)
    for near in (a.upper(), a):
        rows = [(3, a), (5, near), (5, b), (5, b), (7, b.upper()), (None, a)] + [(9, prose(20 + i, 100)) for i in range(6)]
        out = simhash.keep_one_per_group(docs(spark, rows)).select("doc_id", "text").collect()
        assert sorted(map(str, map(tuple, out))) == sorted(map(str, [rows[0], rows[2], *rows[5:]]))


def test_embeddings(spark):
    r = np.random.default_rng(1)
    rows, centres = [], r.normal(size=(12, 24))
    for i in range(260):
        v = centres[r.integers(12)] + r.normal(size=24) * r.choice([0.1, 0.25, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v], int(r.integers(3))))
    rows += [(300, rows[0][1], rows[0][2]), (301, rows[0][1], rows[0][2]), (300, rows[0][1], rows[0][2]), (302, None, 1), (303, [], 1), (304, [0.0] * 24, 1), (305, [None] + [1.0] * 23, 1), (306, [float("nan")] * 24, 1), (307, [float("inf")] + [1.0] * 23, 1), (308, rows[0][1], None), (None, rows[0][1], rows[0][2]), (309, rows[0][1][:5], rows[0][2]), (310, rows[0][1][:5], rows[0][2])]
    df = spark.createDataFrame([(*x, 0, 0) for x in rows], "vec_id long, embedding array<float>, label int, k1 int, n_links int")

    def sound(v):
        return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    edges = []
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if a[2] is not None and a[2] == b[2] and sound(a[1]) and sound(b[1]) and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    edges.append((i, j))
    n, comp = Counter(k for e in edges for k in e), groups(range(len(rows)), edges)
    least = {c: min((rows[i][0] for i in comp if comp[i] == c and rows[i][0] is not None), default=None) for c in set(comp.values())}
    want = sorted((str(rows[i][0]), n[i], str(least[comp[i]]), rows[i][0] is not None and rows[i][0] == least[comp[i]]) for i in range(len(rows)))
    assert len(edges) > 400
    for tile in (16, 4096):
        got = embed_dedup.near_vectors(df, tile=tile).collect()
        assert sorted((str(x["vec_id"]), x["n_links"], str(x["component_id"]), x["kept"]) for x in got) == want
    assert embed_dedup.near_vectors(df.limit(0)).count() == 0


def test_quality(spark):
    r = random.Random(2)
    good, junk, bad = (lambda i: prose(i, r.randrange(20, 90))), (lambda i: " | ".join(prose(i, 40).split()) + " $$$ ###"), (lambda i: prose(i, 60) + " idiot scum trash")
    texts = [(good, junk, bad)[0 if i % 5 < 3 else i % 5 - 2](i) for i in range(400)]
    df = spark.createDataFrame([(i, t, "en", f"host{i % 7}", 0) for i, t in enumerate(texts)] + [(900, None, None, None, 0), (901, "", "en", None, 0), (900, None, None, None, 0)], "doc_id long, text string, lang string, source string, host2 long")
    labels = spark.createDataFrame([(i, int(i % 5 != 3), int(i % 5 == 4)) for i in range(300)] + [(None, 1, 1), (5000, None, 1), (5, 7, None)], "doc_id long, quality int, toxic int")
    out = quality.classify(df, labels).collect()
    assert len(out) == 403
    keep = {x["doc_id"]: x["keep"] for x in out}
    assert np.mean([keep[i] == (i % 5 < 3) for i in range(300, 400)]) > 0.95
    assert all(0 <= x[c] <= 1 for x in out for c in ("p_quality", "p_toxic", "host_quality", "path_toxic"))
    assert quality.classify(df, labels.limit(0)).count() == 403 and quality.classify(df.limit(0), labels).count() == 0
    by = {x["host_quality"] for x in out}
    assert len(by) <= 8


def test_quality_posteriors(spark):
    """Against sums in Python: shrinkage by moments, without the document's own evidence."""
    import math

    r = random.Random(4)
    rows = [(i, prose(i, r.randrange(3, 60)) + (" trash" if i % 3 == 0 else ""), r.choice(["en", "de", None]), "solo" if i == 0 else f"h{r.randrange(6)}" if i % 11 else None) for i in range(300)]
    rows += [(5, "again " + rows[5][1], *rows[5][2:])] * 2
    rows.append((7000, "word " * 60_000, "en", "h2"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    out = quality.classify(df, labels).collect()
    place = {i: (h, l) for i, _, l, h in rows}
    for head in quality.HEADS:
        docs_ = [(place[x["doc_id"]], x[f"evidence_{head}"], x) for x in out]
        total = sum(p for _, p, _ in docs_) / len(docs_)

        def strength(groups):  # (n, s, prior mean)
            n = sum(g[0] for g in groups)
            spread = sum(g[0] * (g[1] / g[0] - g[2]) ** 2 for g in groups) / n
            noise = sum(g[2] * (1 - g[2]) for g in groups) / n
            inner = sum(g[2] * (1 - g[2]) for g in groups) / len(groups)
            return min(max(inner / max(spread - noise, 1e-9) - 1, 1.0), 1e4)

        hosts, paths = defaultdict(list), defaultdict(list)
        for (h, l), p, _ in docs_:
            hosts[h].append(p)
            paths[h, l].append(p)
        kh = strength([(len(v), sum(v), total) for v in hosts.values()])
        mean = {h: (sum(v) + kh * total) / (len(v) + kh) for h, v in hosts.items()}
        kp = strength([(len(v), sum(v), mean[h]) for (h, _), v in paths.items()])
        logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
        for (h, l), p, x in docs_:
            host = (sum(hosts[h]) - p + kh * total) / (len(hosts[h]) - 1 + kh)
            path = (sum(paths[h, l]) - p + kp * host) / (len(paths[h, l]) - 1 + kp)
            want = 1 / (1 + math.exp(-(math.log(p / (1 - p)) + logit(path) - logit(total))))
            assert abs(x[f"p_{head}"] - want) < 1e-6 and abs(x[f"host_{head}"] - mean[h]) < 1e-9
            assert abs(x[f"path_{head}"] - (sum(paths[h, l]) + kp * mean[h]) / (len(paths[h, l]) + kp)) < 1e-9
            low, high = sorted((total, sum(hosts[h]) / len(hosts[h])))
            assert low - 1e-9 <= x[f"host_{head}"] <= high + 1e-9
        solo = next(x for x in out if x["doc_id"] == 0)
        assert abs(solo[f"p_{head}"] - solo[f"evidence_{head}"]) < 1e-9


def slow_tiles(doc, item, least):
    free_d, free_i, found = [True] * len(doc), [True] * len(item), []
    least = min(least, len(item))
    while least:
        best = (0, 0, 0)
        for t in range(len(item)):
            for s in range(len(doc)):
                k = 0
                while s + k < len(doc) and t + k < len(item) and doc[s + k] == item[t + k] and free_d[s + k] and free_i[t + k]:
                    k += 1
                if k > best[0]:
                    best = (k, s, t)
        k, s, t = best
        if k < least:
            break
        for j in range(k):
            free_d[s + j] = free_i[t + j] = False
        found.append(k)
    return sum(found)


def test_tiles():
    r = random.Random(1)
    for n in range(150):
        item = [r.randrange(9 if n % 2 else 500) for _ in range(r.randrange(1, 40))]
        parts = [item[a : a + r.randrange(1, 15)] for a in (r.randrange(len(item)) for _ in range(4))]
        doc = [x for p in parts for x in [*p, *[r.randrange(900) for _ in range(r.randrange(4))]]]
        got = decontam.tiles(np.array(doc, np.uint64), np.array(item, np.uint64), 3)
        seen_d, seen_i = set(), set()
        for s, t, k in got:
            assert doc[s : s + k] == item[t : t + k] and k >= min(3, len(item))
            assert not seen_d & set(range(s, s + k)) and not seen_i & set(range(t, t + k))
            seen_d |= set(range(s, s + k))
            seen_i |= set(range(t, t + k))
        want = slow_tiles(doc, item, 3)
        assert len(seen_i) == want


def test_decontamination(spark, monkeypatch):
    item = prose(77, 40)
    w = item.split()
    moved = " ".join(w[25:] + ["other"] + w[:25])
    texts = [prose(1, 200) + " " + item + " " + prose(2, 20), prose(3, 50) + "\n" + moved.upper().replace(" ", ",  "), prose(4, 300), " ".join(w[:12]) + " " + prose(5, 60), None, "", "short one", (1, moved), (None, item), prose(6, 30_000) + " " + item]
    bench = spark.createDataFrame([(1, item, 0), (2, "tiny passage", 0), (3, None, 0), (4, "", 0), (None, "short one", 0)], "item_id long, text string, doc_id long")
    df = docs(spark, texts, ["item", "coverage"])
    want = sorted([("0", "1"), ("1", "1"), ("1", "1"), ("None", "1"), ("9", "1"), ("6", "None")])
    pairs = lambda: sorted((str(x["doc_id"]), str(x["item_id"])) for x in decontam.contaminated(df, bench).collect())
    left = lambda: sorted(str(x["doc_id"]) for x in decontam.drop_contaminated(df, bench).collect())
    assert pairs() == want and left() == ["2", "3", "4", "5"]
    assert decontam.contaminated(df.limit(0), bench).count() == 0 and decontam.contaminated(df, bench.limit(0)).count() == 0
    monkeypatch.setattr(decontam, "MOST_SEEDS", 0)
    assert pairs() == want and left() == ["2", "3", "4", "5"]


def test_needed_seeds_are_in_every_covered_passage():
    r = random.Random(8)
    for n in range(400):
        item = [r.randrange(40) for _ in range(r.randrange(1, 60))]
        doc = [x for _ in range(6) for a in [r.randrange(len(item))] for x in [*item[a : a + r.randrange(1, 25)], 99]]
        marked = sum(k for _, _, k in decontam.tiles(np.array(doc, np.uint64), np.array(item, np.uint64)))
        if marked >= 0.5 * len(item):
            k = min(5, len(item))
            own = {tuple(doc[i : i + k]) for i in range(len(doc) - k + 1)}
            assert sum(tuple(item[i : i + k]) in own for i in range(len(item) - k + 1)) >= decontam.needed(len(item))


def test_large_benchmark_with_frequent_seeds(spark, monkeypatch):
    """Passages that begin with the same words as all documents: both ways give the same pairs."""
    head = prose(40, 12)
    items = [f"{head} {prose(100 + i, 30)}" for i in range(8)] + [head, " ".join(head.split()[:3])]
    texts = [f"{head} {prose(500 + i, 80)}" for i in range(60)] + [f"{prose(700 + i, 30)} {x} tail" for i, x in enumerate(items)] + [" ".join(items[0].split()[20:] + ["and"] + items[0].split()[:9])]
    bench = spark.createDataFrame([(f"{i}", x) for i, x in enumerate(items)], "item_id string, text string").withColumn("item_id", F.struct(F.lit(1).alias("a"), "item_id"))
    pairs = lambda: sorted((x["doc_id"], x["item_id"]["item_id"], x["n_words"]) for x in decontam.contaminated(docs(spark, texts), bench).collect())
    want = pairs()
    assert len(want) > 60
    monkeypatch.setattr(decontam, "MOST_SEEDS", 0)
    assert pairs() == want


def test_decontamination_folds_case_of_all_letters(spark, monkeypatch):
    import unicodedata

    item = "El Niño comió después más piñas que Íñigo según la lección número dos de Óscar Núñez allí en la estación de Málaga über die Straße für Åsa"
    texts = [prose(1, 50) + " " + item.upper() + " " + prose(2, 20), unicodedata.normalize("NFD", item), prose(3, 60), item.lower()]
    bench = spark.createDataFrame([(1, item), (2, unicodedata.normalize("NFD", item.upper()))], "item_id long, text string")
    df = docs(spark, texts)
    for most in (decontam.MOST_SEEDS, 0):
        monkeypatch.setattr(decontam, "MOST_SEEDS", most)
        got = sorted((x["doc_id"], x["item_id"], x["coverage"]) for x in decontam.contaminated(df, bench).collect())
        assert got == [(d, i, 1.0) for d in (0, 1, 3) for i in (1, 2)]
        assert [x["doc_id"] for x in decontam.drop_contaminated(df, bench).collect()] == [2]


def test_urls(spark):
    link = lambda u: f"<html><head><link href='{u}' class=x rel=\"canonical\"></head>"
    jump = lambda u: f'<meta http-equiv="Refresh" content="0; URL={u}">'
    pages = [
        (1, "http://Example.COM/en/9?a#b", None), (2, "https://www.example.com/en/75", ""), (3, "http://x.example.net/de/81", "x"), (4, "http://example.net/de/1", "x"),
        (5, "http://alias.io/a", link("https://spam.org/es/1")), (6, "http://alias.io/b", jump("http://alias.io/a")), (7, "http://alias.io/a#frag", None), (8, "http://free.io/a", link("http://free.io/b")),
        (9, "http://mixed.io/a", link("http://bad.com/en/") + jump("http://example.com/en/71")), (10, None, link("http://bad.com/en/")), (11, "no scheme/en/", "x"), (12, "http://alias.io/c?q", "x"), (5, "http://alias.io/a", None), (None, "http://notcom/en/", None), (13, "http://alias.io", None),
    ]
    df = spark.createDataFrame([(*p, "mine", 0) for p in pages], "page_id long, url string, html string, rule string, node int")
    more = spark.createDataFrame([("http://alias.io/c?q", "http://alias.io/b"), (None, "http://a/b")], "src string, dst string")
    got = sorted((str(x["page_id"]), x["host"], x["path"], str(x["rule"]), x["verdict"]) for x in url_filter.judge_urls(df, redirects=more).collect())
    want = [("1", "example.com", "/en/9", "com/en/", "block"), ("2", "www.example.com", "/en/75", "example.com/en/7", "allow"), ("3", "x.example.net", "/de/81", "example.net/de/8", "block"), ("4", "example.net", "/de/1", "net/de/", "allow"), ("5", "alias.io", "/a", "None", "block"), ("5", "alias.io", "/a", "None", "block"), ("6", "alias.io", "/b", "None", "block"), ("7", "alias.io", "/a", "None", "block"), ("8", "free.io", "/a", "None", "allow"), ("9", "mixed.io", "/a", "None", "allow"), ("10", "", "", "None", "allow"), ("11", "", "", "None", "allow"), ("12", "alias.io", "/c", "None", "block"), ("None", "notcom", "/en/", "None", "allow"), ("13", "alias.io", "", "None", "allow")]
    assert got == sorted(want)
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_relative_links(spark):
    link = lambda u, more="": f"<html><head>{more}<link rel=canonical href='{u}'></head>"
    jump = lambda u: f'<meta http-equiv="refresh" content="0; url={u}">'
    pages = [(1, "http://spam.org/x", link("/es/1")), (2, "http://spam.org", link("es/2")), (3, "http://spam.org/a/b", jump("../es/3")), (4, "https://free.io/a", link("//spam.org/es/4")), (5, "http://free.io/b", jump("a")), (6, "http://free.io/c", link("4", '<base target=_top><base href="//spam.org/es/">')),
             (7, "http://free.io/d", link("mailto:x@spam.org/es/1")), (8, "http://free.io/e", link("/to?u=http://spam.org/es/1")), (9, "http://free.io/f", link("")), (10, "http://free.io/g", link("http://[bad")), (11, "http://free.io/h", None), (12, "http://spam.org/q", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    more = spark.createDataFrame([("http://spam.org/q", "/es/9")], "src string, dst string")
    got = {x["page_id"]: x["verdict"] for x in url_filter.judge_urls(df, redirects=more).collect()}
    assert got == {i: "block" if i in (1, 2, 3, 4, 5, 6, 12) else "allow" for i in range(1, 13)}


def test_network_gradients():
    model, words, labels = langid.Model(["a", "b", "c"], 4), [b"ab", b"c", b"hello"], np.array([0, 1, 2])
    weights = [*model.ways, model.top]
    for w in weights:
        for k in w:
            w[k] = w[k].astype(np.float64)
    for w, g in zip(weights, model.gradients(words, labels)[1]):
        for k in w:
            i, e = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape), 1e-3
            w[k][i] += e
            up = model.gradients(words, labels)[0]
            w[k][i] -= 2 * e
            down = model.gradients(words, labels)[0]
            w[k][i] += e
            assert abs(g[k][i] - (up - down) / (2 * e)) < 1e-4


def slow_probabilities(model, text):
    """Mean of the positions' probabilities, one text, one byte, one state after another."""
    sides = []
    for data, w in ((text, model.ways[0]), (text[::-1], model.ways[1])):
        h, states, u = np.zeros(w["u"].shape[1]), [], w["u"].shape[1]
        for byte in data:
            a, b = w["x"][:, byte].astype(float), w["u"].astype(float) @ h
            z, r = (1 / (1 + np.exp(-(a[k * u : (k + 1) * u] + b[k * u : (k + 1) * u]))) for k in (0, 1))
            h = (1 - z) * np.tanh(a[2 * u :] + r * (b[2 * u :] + w["b"])) + z * h
            states.append(h)
        sides.append(states)
    p = [np.exp(model.top["w"] @ np.concatenate([f, b]) + model.top["c"]) for f, b in zip(sides[0], reversed(sides[1]))]
    return np.array([x / x.sum() for x in p])


def test_network_over_whole_texts():
    """Windows side by side give what one run over the whole text gives, also where the network
    remembers for longer than a window."""
    model, r = langid.Model(["a", "b", "c"], 6, seed=3), np.random.default_rng(9)
    texts = [bytes(r.integers(0, 256, n).astype(np.uint8)) for n in (1, 7, 100, 101, 99, 1500, 3)]
    cut = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for slow in (0, 6):
        for w in model.ways:
            w["x"][:6] += slow
        want = np.concatenate([slow_probabilities(model, t) for t in texts]).T
        got = model.positions(np.frombuffer(b"".join(texts), np.uint8), cut, step=100, warm=20, seam=1e-6)
        assert np.abs(got - want).max() < 1e-4
    free = model.positions(np.frombuffer(b"".join(texts), np.uint8), cut, step=100, warm=20, seam=9.0)
    assert np.abs(free - want).max() > 1e-3
    assert np.abs(model.pooled(texts) - [want[:, a:b].mean(1) for a, b in zip(cut, cut[1:])]).max() < 0.02
    assert np.abs(model.pooled([b"ab cd"]) - model.pooled([b"cd ab"])).max() > 1e-6


def test_letters():
    assert [langid.lettered(t) for t in (None, "", "\u00bd \u00b2 \u2460 \u2167 _ 1", "1\u00aa", "\u65e5", "x")] == [False, False, False, True, True, True]


def test_language(spark):
    de, en = "der und nicht schön über straße gehen mädchen".split(), "the and with house street going through little".split()
    r = random.Random(1)
    texts = [(i, " ".join(r.choice(de if i % 2 else en) for _ in range(30)), "de" if i % 2 else "en") for i in range(300)]
    texts += [(1000, None, "en"), (1001, "", "en"), (1002, "123 $$ --", "en"), (1003, "the house", None), (None, "straße über", "de"), (1004, "x" * 5000 + " " + "日本語" * 300, "en"), (1, texts[1][1], "de")]
    df = spark.createDataFrame([(*t, 0, 0) for t in texts], "doc_id long, text string, lang string, found int, score int")
    model = langid.train_on(df, steps=80)
    out = langid.identify(df, model).collect()
    assert len(out) == len(texts) and model.langs == ["de", "en"]
    by = {x["doc_id"]: x for x in out}
    assert all(x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 4 == 2) for x in out)
    test = [x for x in out if x["held_out"] and x["doc_id"] < 300]
    assert np.mean([x["lang_pred"] == ("de" if x["doc_id"] % 2 else "en") for x in test]) > 0.95
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and all(0 <= x["score"] <= 1 for x in out)
    kept = langid.keep_identified(df)
    assert kept.columns == df.columns and kept.count() == len(texts) - 3
    nothing = langid.train_on(df.limit(0))
    assert {x["lang_pred"] for x in langid.identify(df, nothing).collect()} == {"und"} and langid.identify(df.limit(0), model).count() == 0


def test_language_stage_keeps_unlabelled_documents(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2][:3]
    texts = ["the house", "straße", "x", None, "", "12 --"]
    for ids, lang in ((range(6), None), ([*held, *held], "en")):
        df = spark.createDataFrame([(i, t, lang) for i, t in zip(ids, texts)], "doc_id long, text string, lang string")
        assert sorted(x["text"] for x in langid.keep_identified(df).collect()) == sorted(texts[:3])


def test_links_among_other_relations(spark):
    page = lambda rel, href: f"<link {rel} href='{href}'>"
    pages = [(1, page('rel="alternate canonical"', "http://spam.org/es/1")), (2, page("rel='canonical alternate'", "http://spam.org/es/1")), (3, page('rel="noncanonical"', "http://spam.org/es/1")), (4, page('rel="alternate"', "http://spam.org/es/canonical")), (5, page("rel=canonical", "http://x.io/q?a=1&amp;b=2")), (6, page("rel=canonical", "http&#58;//spam.org/es/1"))]
    df = spark.createDataFrame([(i, f"http://free.io/{i}", h) for i, h in pages], "page_id long, url string, html string")
    more = spark.createDataFrame([("http://x.io/q?a=1&b=2", "http://spam.org/es/2")], "src string, dst string")
    got = {x["page_id"]: x["verdict"] for x in url_filter.judge_urls(df, redirects=more).collect()}
    assert got == {i: "block" if i in (1, 2, 5, 6) else "allow" for i in range(1, 7)}
    assert url_filter.judge_urls(spark.createDataFrame([(1, "http://x/" + "p" * 200_000, "<link rel=canonical href='/" + "q" * 200_000 + "'>")], "page_id long, url string, html string")).count() == 1


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_bpe_is_that_of_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    lib, own, r = Tokenizer.from_file(path), bpe.Encoder(open(path, encoding="utf-8").read()), random.Random(1)
    bits = ["'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "a", "the", "É", "1", "23", "!", "?!", "<|endoftext|>", " ", "日本", "😀", "é", "\x1c", "\x85", " ", "֏"]
    for i in range(1500):
        text = "".join(r.choice(bits) for _ in range(r.randrange(300)))
        want = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text, 2 + i % 4) == want
        assert own.decode(want) == lib.decode(want, skip_special_tokens=False)
    for text in ("", " " * 5000, "a" * 20_000, "'" * 3000, prose(1, 20_000), "日本語" * 3000, "\n".join([prose(2, 60)] * 50)):
        assert own.encode(text) == lib.encode(text, add_special_tokens=False).ids
    assert len(bpe.cuts(prose(1, 20_000).encode(), own.table)) > 50


def test_encode_documents(spark):
    from tokenizers import Tokenizer

    path, texts = tokenizer_path(), [prose(1, 3000), None, "", (3, prose(1, 3000)), (3, "x <|endoftext|> y"), (None, "é"), prose(2, 10)]
    lib, df = Tokenizer.from_file(path), docs(spark, texts, ["ids", "id"])
    want = sorted((str(r["doc_id"]), lib.encode(r["text"] or "", add_special_tokens=False).ids, r["text"] or "") for r in df.collect())
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in bpe.encode_documents(df, path, batch_chars=100).collect()) == want
    assert bpe.encode_documents(df.limit(0), path).count() == 0


def slow_windows(h, short):
    found = []
    for c in range(len(h)):
        if h[c]:
            l, r = c, c
            while l and h[l - 1] and h[l - 1] > h[c]:
                l -= 1
            while r + 1 < len(h) and h[r + 1] and h[r + 1] >= h[c]:
                r += 1
            if r - l + 1 >= short:
                found.append((l, c, r))
    return found


def test_compact_windows():
    r = np.random.default_rng(1)
    for n in range(120):
        h = r.integers(0 if n % 2 else 1, 1 << 20, r.integers(0, 80)).astype(np.uint64) << np.uint64(substring.PLACE)
        h[r.random(len(h)) < 0.05] = 0
        short = int(r.integers(1, 9))
        assert list(zip(*(x.tolist() for x in substring.compact_windows(h, short)))) == slow_windows(h.tolist(), short)


def test_substring(spark):
    p, q = prose(50, 70), prose(51, 60)
    near = p.split()
    near[30] = "changed"
    texts = [prose(1, 40) + " " + p + " " + prose(2, 40), prose(3, 10) + "\n" + p.upper() + ", " + prose(4, 5), " ".join(near) + " " + prose(5, 80), prose(6, 500), None, "", "two words", prose(7, 20) + " " + q + " " + q, prose(8, 30) + " " + q, prose(9, 100) + " " + " ".join(p.split()[:30]), (20, prose(10, 200)), (20, prose(10, 200)), (None, q), prose(11, 30_000) + " " + p]
    df = docs(spark, texts, ["r", "pivot"])
    got = substring.repeated_passages(df).collect()
    words = {i: tokens.Tokenizer().words((t if not isinstance(t, tuple) else t[1] or "").encode() if t else b"")[0] for i, t in enumerate(texts)}
    ids = [i if not isinstance(t, tuple) else t[0] for i, t in enumerate(texts)]
    seen = defaultdict(set)
    for i, h in words.items():
        for g in tokens.gram_hashes(h, 50).tolist():
            seen[g].add((ids[i], texts[i] if not isinstance(texts[i], tuple) else texts[i][1]))
    need = {ids[i] for i, h in words.items() if any(len(seen[g]) > 1 for g in tokens.gram_hashes(h, 50).tolist())}
    assert need == {0, 1, 7, 8, None, 13} and {x["doc_id"] for x in got} == need | {2}
    for x in got:
        if x["doc_id"] in (0, 1, 8, None, 13):
            assert (x["n_words"] >= 60) and x["other_id"] != x["doc_id"]
    spans = {x["doc_id"]: (x["start_word"], x["end_word"]) for x in got}
    assert spans[0] == (40, 110) and spans[8] == (30, 90)
    assert substring.repeated_passages(df.limit(0)).count() == 0


def test_substring_alignment():
    r, at = np.random.default_rng(5), substring.SIDE
    for n, edits in ((50, 1), (55, 2), (60, 3), (80, 4), (96, 1)):
        for kind in ("in", "out", "both"):
            for _ in range(20):
                p = r.integers(1, 256, n).tolist()
                q, gram = list(p), n // 2
                places = sorted(r.choice([i for i in range(5, n - 5) if abs(i - gram) > 6], edits, replace=False).tolist(), reverse=True)
                shift = 0
                for k, i in enumerate(places):
                    put = kind == "in" or (kind == "both" and k % 2)
                    if put:
                        q.insert(i, int(r.integers(1, 256)))
                    else:
                        del q[i]
                    shift += (1 if put else -1) * (i < gram)
                rows = []
                for x, pivot in ((p, gram), (q, gram + shift)):
                    whole = r.integers(1, 256, at).tolist() + x + r.integers(1, 256, at + 4).tolist()
                    rows.append(np.array([whole[pivot : pivot + 2 * at + 4]], np.uint8))
                left, right, other_left, other_right = (int(v[0]) for v in substring.agree(*rows))
                assert max(left + right, other_left + other_right) >= 50
                assert abs(left + right - min(n, 104)) <= 12 and abs(other_left + other_right - min(len(q), 104)) <= 12
    a, b = r.integers(1, 256, (500, 104), dtype=np.uint8), r.integers(1, 256, (500, 104), dtype=np.uint8)
    b[:, at : at + 4] = a[:, at : at + 4]
    assert max(int(np.max(x + y)) for x, y in [substring.agree(a, b)[:2]]) < 30


def near_recall(n, exchanged, moved, passages=60):
    """Share of near-duplicate passages of n words that search and verification find: words
    exchanged, put in or left out at random places, in different surroundings."""
    r, found = np.random.default_rng(n * 100 + exchanged * 10 + moved), 0
    fresh = lambda k: r.integers(1, 1 << 63, k, dtype=np.uint64)
    step = np.arange(-substring.SIDE, substring.SIDE + substring.GRAM)
    for _ in range(passages):
        p = fresh(n)
        q = p.tolist()
        for k, i in enumerate(sorted(r.choice(np.arange(1, n - 1), exchanged + moved, replace=False).tolist(), reverse=True)):
            q[i : i + 1] = [int(fresh(1)[0])] if k < exchanged else [q[i], int(fresh(1)[0])] if k % 2 else []
        sides = []
        for x in (p, np.array(q, np.uint64)):
            h = np.concatenate([fresh(60), x, fresh(60)])
            key, at = substring.signatures(substring._grams(h, np.array([0, len(h)])))
            code = np.append((h % np.uint64(255)).astype(np.uint8) + np.uint8(1), np.uint8(0))
            place = at[:, None] + step
            sides.append(dict(zip(key.tolist(), code[np.where((place >= 0) & (place < len(h)), place, len(h))])))
        both = sorted(sides[0].keys() & sides[1].keys())
        if both:
            a, b, c, d = substring.agree(*(np.array([s[k] for k in both]) for s in sides))
            found += bool((np.maximum(a + b, c + d) >= substring.LEAST).any())
    return found / passages


def test_substring_recall():
    for case in ((55, 1, 0), (55, 2, 0), (55, 4, 0), (60, 4, 0), (80, 4, 0), (55, 0, 1), (60, 0, 1), (80, 0, 2), (96, 0, 1)):
        assert near_recall(*case) >= 0.9, case


def test_substring_names_every_partner(spark):
    header, body = prose(60, 60), prose(61, 70)
    texts = [prose(100 + i, 80) + " " + header + " " + prose(200 + i, 80) for i in range(8)] + [prose(300 + i, 30) + " " + header + " " + body + " " + prose(400 + i, 30) for i in range(2)]
    got = substring.repeated_passages(docs(spark, texts)).collect()
    links = {(x["doc_id"], x["other_id"]) for x in got}
    assert {(8, 9), (9, 8)} <= links and links == {(b, a) for a, b in links}
    for x in got:
        if x["doc_id"] >= 8 and x["other_id"] < 8:
            assert abs(x["start_word"] - 30) <= 6 and abs(x["end_word"] - 90) <= 6
        if x["doc_id"] >= 8 and x["other_id"] >= 8:
            assert x["end_word"] >= 154
    assert set(groups(range(10), links).values()) == {0}


def test_word_hashes(monkeypatch):
    text = ("Hello, WORLD é x1\n" * 30 + "é" * 50 + " end").encode()
    t = tokens.Tokenizer()
    h, a, b = t.words(text)
    assert [text[i:j] for i, j in zip(a[:4], b[:4])] == [b"Hello", b"WORLD", "é".encode(), b"x1"] and h[0] == h[4] == t.words(b"hello")[0][0]
    monkeypatch.setattr(tokens, "AT_ONCE", 20)
    assert all((x == y).all() for x, y in zip(t.words(text), (h, a, b)))
    cut = [g[2] for g in t.groups(["a b", None, "", "c"])]
    assert cut[0].tolist() == [0, 2, 2, 2, 3]


def test_substring_classes_of_copies(spark):
    whole, own = prose(60, 80), prose(61, 70)
    texts = [(3, own + " " + prose(62, 30)), (5, whole), (6, whole), (9, whole), (None, whole), (11, prose(63, 60) + " " + own), (12, "short copy"), (13, "short copy"), (14, prose(64, 90)), (14, prose(64, 90))]
    got = sorted((str(x["doc_id"]), x["start_word"], x["end_word"], x["other_id"], x["n_links"]) for x in substring.repeated_passages(docs(spark, texts)).collect())
    assert [g for g in got if g[0] not in ("3", "11")] == [("5", 0, 80, 9, 3), ("6", 0, 80, 5, 1), ("9", 0, 80, 5, 1), ("None", 0, 80, 5, 1)]
    assert [(g[0], g[1], g[2], g[3]) for g in got if g[0] in ("3", "11")] == [("11", 60, 130, 3), ("3", 0, 70, 11)]


def test_substring_variants_that_differ_from_the_first(spark):
    """Families of a template: the two last are near-duplicates of each other (4 of 80 words), and
    both differ from all others of the family in a third of their words."""
    r, texts, pairs = random.Random(70), [], []
    for f in range(30):
        base = prose(1000 + f, 80).split()
        for v in range(6):
            words = list(base)
            for i in r.sample(range(80), 27):
                words[i] = f"v{f}x{v}x{i}"
            texts.append(prose(5000 + 10 * f + v, 40) + " " + " ".join(words) + " " + prose(7000 + 10 * f + v, 40))
        for i in r.sample(range(80), 4):
            words[i] = f"w{f}x{i}"
        pairs.append((len(texts) - 1, len(texts)))
        texts.append(prose(9000 + f, 40) + " " + " ".join(words) + " " + prose(9500 + f, 40))
    got = {(x["doc_id"], x["other_id"]) for x in substring.repeated_passages(docs(spark, texts)).collect()}
    assert sum(p in got and p[::-1] in got for p in pairs) >= 0.9 * len(pairs)
    assert not {g for g in got if tuple(sorted(g)) not in pairs}


def test_substring_hot_passage(spark):
    """A passage in very many documents: a row of the first for each partner, one for each other."""
    p = prose(80, 70)
    texts = [prose(20_000 + i, 20) + " " + p + " " + prose(30_000 + i, 20) for i in range(2000)]
    got = substring.repeated_passages(docs(spark, texts)).collect()
    assert {x["doc_id"] for x in got if x["start_word"] <= 20 and x["end_word"] >= 90} == set(range(2000))
    assert all(15 <= x["start_word"] and x["end_word"] <= 95 for x in got)
    assert len(got) < 4 * 2000 and max(x["n_links"] for x in got) < 10


def test_substring_lowest_threshold(spark):
    """Near-duplicates at the threshold (50 words, 5 exchanged; 60 words, 6 exchanged) with runs of 7
    or 8 words, beside a third text that comes first for what they share: none is left out."""
    texts, pairs = [], []
    for f in range(40):
        n, edits = (50, range(7, 50, 8)) if f % 2 else (60, range(8, 60, 9))
        p = prose(40_000 + f, n).split()
        for i in [*edits][: n // 10]:
            p[i] = f"own{f}x{i}"
        q = [f"other{f}x{i}" if w.startswith("own") else w for i, w in enumerate(p)]
        pairs.append((len(texts), len(texts) + 1))
        texts += [prose(50_000 + 3 * f + k, 60) + " " + " ".join(w) + " " + prose(60_000 + 3 * f + k, 60) for k, w in enumerate((p, q, p[:20] + q[30:50]))]
    links = {(x["doc_id"], x["other_id"]) for x in substring.repeated_passages(docs(spark, texts)).collect()}
    assert [p for p in pairs if p not in links or p[::-1] not in links] == []


def test_substring_words_over_and_over(spark):
    """Texts of repeated words in which only one place of the repeats fits."""
    words = lambda *runs: " ".join(w for w, n in runs for _ in range(n))
    tail = prose(70_000, 35)
    texts = [words(("a", 30), ("b", 12)), words(("a", 24)) + " " + tail + " " + prose(70_001, 60), words(("c", 20), ("a", 70)) + " " + tail + " " + prose(70_002, 60)]
    assert {(x["doc_id"], x["other_id"]) for x in substring.repeated_passages(docs(spark, texts)).collect()} == {(1, 2), (2, 1)}


def runs_table(texts):
    """Contexts, as substring's last step gets them, of the key of five times the word 1: all places
    in runs of at least eight of it, all open."""
    import pyarrow as pa

    rows, side = [], substring.WIDE
    for r, runs in enumerate(texts):
        words = [w for w, n in runs for _ in range(n)]
        padded = [0] * side + words + [0] * (side + substring.GRAM)
        rows += [(r, p, bytes(padded[p : p + 2 * side + substring.GRAM])) for p in range(len(words) - 7) if set(words[p : p + 8]) == {1}]
    zeros = pa.array(np.zeros(len(rows), np.int32))
    return pa.RecordBatch.from_arrays([pa.array(np.ones(len(rows), np.int64)), zeros, zeros, zeros, pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int32()), pa.array([True] * len(rows)), pa.array([x[2] for x in rows], pa.binary())], names=["key", "i", "j", "part", "r", "pivot", "open", "codes"])


def test_substring_runs_cost(monkeypatch):
    """Runs of one word in texts of runs: those that match are linked, and few of the pairs of their
    places are aligned."""
    aligned, old = [0], substring.agree

    def counted(a, b, *how):
        aligned[0] += len(a)
        return old(a, b, *how)

    monkeypatch.setattr(substring, "agree", counted)
    n, r = 150, random.Random(90)
    texts = [[(2 + r.randrange(200), 20 + t % 25), (1, 20 + t % 25), (2 + r.randrange(200), 20 + t % 25)] for t in range(n)]
    texts += [[(201, 10), (1, 40), (202, 30)], [(203, 33), (1, 40), (202, 21)], [(204, 9), (1, 46), (205, 7)], [(206, 9), (1, 80)], [(207, 3), (1, 60), (208, 30)]]
    found = [x for b in substring._across(substring.LEAST, substring.SHORT)(iter([runs_table(texts)])) for x in b.to_pylist()]
    links = {frozenset((x["r"], x["first_r"])) for x in found if max(x["n"], x["first_n"]) >= substring.LEAST}
    assert {frozenset((n, n + 1)), frozenset((n + 2, n + 3)), frozenset((n + 3, n + 4))} <= links
    assert aligned[0] < 2000
