from __future__ import annotations

import random
from datetime import UTC, datetime

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from tidemark.functions import html
from tidemark.plans.queries import ORACLE_SQL, QUERIES
from tidemark.sources import fetch

PAGE = """<html><body><table>
<tr><td class="txt_blanco">PODER EJECUTIVO SECCION</td></tr><tr><td class="txt_blanco2">EJECUTIVO</td></tr>
<tr><td class="subtitle_azul">SECRETARIA  DE SALUD <a href="nota_to_doc.php?codnota=11">Imagen</a></td></tr>
<tr><td><a href="nota_detalle.php?codigo=21&fecha=x">Acuerdo &amp; m&aacute;s</a> <a href="nota_detalle.php?codigo=21">otra vez</a></td></tr>
<tr><td class="subtitle_azul">BANCO</td></tr><tr><td class="subtitle_azul"> </td></tr>
<tr><td><a href="/nota_detalle.php?codigo=22"><b>Tipo</b> de cambio</a><a href="nota_detalle.php?codigo=x">no</a><a href="nota_detalle.php?codigo=23"></a></td></tr>
</table></body></html>"""


def test_index_walk(spark):
    pages = spark.createDataFrame([("a", PAGE), ("b", "<body>nada</body>"), ("c", "<a href='nota_detalle.php?codigo=z'>roto</a>"), ("d", None)], "page string, html string")
    rows = html.index_notices(pages)
    got = [(r["kind"], r["codigo"], r["titulo"], r["seccion"], r["poder"], r["organismo"]) for r in rows.orderBy("pos").collect()]
    head = ("PODER EJECUTIVO SECCION", "EJECUTIVO")
    assert got == [("rejected", 11, "Imagen", *head, "SECRETARIA DE SALUD"), ("notice", 21, "Acuerdo & más", *head, "SECRETARIA DE SALUD"), ("notice", 22, "Tipo de cambio", *head, "BANCO")]
    status = {r["page"]: (r["status"], r["n_notas"], r["n_rejected"]) for r in html.index_status(pages, rows).collect()}
    assert status == {"a": ("ok", 2, 1), "b": ("no_edition", 0, 0), "c": ("error", 0, 0), "d": ("no_edition", 0, 0)}


def test_body(spark):
    doc = "<head><title>t</title></head><body><nav>menu</nav><script>x()</script><p>Uno   dos&nbsp;tres</p><footer>pie</footer> [citado el 01-08-2026] UDIS 8.84 fin</body>"
    df = spark.createDataFrame([(doc,), (None,)], "h string")
    assert [r[0] for r in df.select(html.body_text(F.col("h"))).collect()] == ["Uno dos tres fin", ""]


def test_body_of_a_cut_head(spark, oracle, tmp_path):
    cut = [f"<html><head><title>a &amp;&{x}</title></head><body><nav>n</nav><h1>a &amp;&{x}</h1><p>b &amp;lt; &#x27;&lt;</p></body></html>" for x in ("amp", "am", "a", "quot", "quo", "lt", "copy", "", "#x2", "amp;")]
    spark.createDataFrame(list(enumerate(cut)), "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    own = oracle.cursor()
    own.execute(f"create temp view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    same_rows(QUERIES["html_body_text"](spark, str(tmp_path)), own, ORACLE_SQL["html_body_text"])
    assert spark.createDataFrame([(cut[0],)], "h string").select(html.body_text(F.col("h"))).head()[0].startswith("a &&b")


def test_decode(spark):
    meta = b'<meta charset="iso-8859-1">'
    assert html.decode_bytes("ñ".encode(), None) == "ñ" and html.decode_bytes(meta + "ñ".encode()).endswith("ñ")
    assert html.decode_bytes(meta + b"\x93\xf1\x94").endswith("“ñ”")
    assert html.decode_bytes("ñ".encode("latin-1"), "latin-1") == "ñ" and html.decode_bytes("ñ".encode(), "nonsense") == "ñ"
    df = spark.createDataFrame([(bytearray("ñ".encode()), None), (bytearray(b"\xf1"), None), (bytearray(b"\xf1"), "latin-1"), (None, None)], "b binary, c string")
    assert [r[0] for r in df.select(html.decoded(F.col("b"), F.col("c"))).collect()] == ["ñ", "ñ", "ñ", None]


ROBOTS = "User-agent: *\n#\n\nDisallow: /private?\nDisallow: /a/b#gsc\nAllow: /a/b/c\n\nUser-agent: Ads\nUser-agent: Bot\nDisallow: /\nCrawl-delay: 2\n"


def test_robots(spark):
    assert fetch.robots_lines(ROBOTS).count("") == 1
    rules = fetch.robots_rules(ROBOTS)
    assert rules == [("/private?", False), ("/a/b", False), ("/a/b/c", True)] and fetch.robots_rules(ROBOTS, "bot") == [("/", False)] == fetch.robots_rules(ROBOTS, "ads")
    df = spark.createDataFrame([("https://x/private?a=1",), ("https://x/a/b/c",), ("https://x/a/bz",), ("https://x/ok",)], "u string")
    assert [r[0] for r in df.select(fetch.allowed_by(F.col("u"), rules)).collect()] == [False, True, False, True]
    gate = fetch.RobotsGate(lambda u: fetch.Response(200, ROBOTS.encode()), "me")
    assert gate.allows("https://x/ok") and not gate.allows("https://x/private?codigo=1")
    assert fetch.RobotsGate(lambda u: fetch.Response(200, ROBOTS.encode()), "Bot").delay("https://x/") == 2.0
    assert fetch.RobotsGate(lambda u: fetch.Response(404), "me").allows("https://x/") and not fetch.RobotsGate(lambda u: fetch.Response(503), "me").allows("https://x/")

    def broken(u):
        raise OSError

    assert not fetch.RobotsGate(broken, "me").allows("https://x/")


def test_waits():
    rng, now, slept = random.Random(1), [0.0], []
    lim = fetch.RateLimiter(1.0, rng, lambda: now[0], slept.append)
    assert lim.wait("a") == 0 and 0.75 <= lim.wait("a") <= 1.25 and lim.wait("b") == 0
    assert all(0 <= fetch.backoff(n, 1, 60, rng) <= min(60, 2**n) for n in range(10)) and fetch.backoff(0, 1, 60, rng, 99) == 60
    assert fetch.retry_after("3") == 3 and fetch.retry_after("soon") is None and fetch.retry_after(None) is None
    assert fetch.retry_after("Wed, 05 Aug 2026 00:01:00 GMT", datetime(2026, 8, 5, tzinfo=UTC)) == 60


def client(answers, **more):
    seen = []

    def send(url, headers):
        if url.endswith("robots.txt"):
            return fetch.Response(200, b"User-agent: *\nDisallow: /no\n")
        seen.append(url)
        return answers[min(len(seen), len(answers)) - 1]

    return fetch.PoliteClient(send, "me", rng=random.Random(1), sleep=lambda s: None, **more), seen


def test_client():
    c, seen = client([fetch.Response(503), fetch.Response(200, b"ok", {"content-type": "text/html; charset=UTF-8"})])
    r = c.get("https://x/a")
    assert (r.status, r.charset, c.retries, c.requests, c.bytes_down, c.failures) == (200, "utf-8", 1, 2, 2, 0)
    with pytest.raises(fetch.Refused):
        c.get("https://x/no")
    c, seen = client([fetch.Response(404)])
    assert c.get("https://x/a").status == 404 and len(seen) == 1
    c, seen = client([fetch.Response(500)], breaker=3)
    with pytest.raises(fetch.CircuitOpen):
        c.get("https://x/a")
    assert len(seen) == 3
