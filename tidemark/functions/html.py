"""HTML: bytes to text, a notice's body, and the walk over an index page."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dates import code_from_href
from .text import canonical_text

#: Elements whose text isn't a notice's, and passages that differ from one request to the next.
CHROME = ("script", "style", "noscript", "nav", "header", "footer", "form")
VOLATILE = [
    r"(?is)Tipo de cambio y tasas de inter.s.*?ver hist.rico",
    r"\[citado el [0-9]{2}-[0-9]{2}-[0-9]{4}\]",
    r"D.LAR\s+[0-9.,]+",
    r"UDIS\s+[0-9.,]+",
    r"TIIE[^%]{0,20}[0-9.,]+%",
    r"CCP(?:-(?:UDIS|D.LARES))?\s+[0-9.,]+%",
    r"CPP\s+[0-9.,]+%",
]
_WESTERN = {"iso-8859-1", "latin-1", "latin1", "windows-1252", "cp1252"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def decode_bytes(body: bytes, charset: str | None = None) -> str:
    """The transport's charset if it fits, else strict UTF-8, else what the page declares, western
    pages as cp1252; bytes that fit nowhere become replacement characters."""
    import re

    for name in (charset, "utf-8"):
        if name:
            try:
                return body.decode(name)
            except (LookupError, UnicodeDecodeError):
                continue
    said = re.search(rb"""(?i)<meta[^>]+charset=["']?\s*([\w-]+)""", body[:4096])
    name = said[1].decode("ascii", "ignore").lower() if said else ""
    try:
        return body.decode("cp1252" if not name or name in _WESTERN else name, "replace")
    except LookupError:
        return body.decode("cp1252", "replace")


def decoded(body: Column, charset: Column | None = None) -> Column:
    """decode_bytes for a column; valid UTF-8 without a declared charset stays in the JVM."""

    def run(bodies: pd.Series, charsets: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else decode_bytes(bytes(b), c) for b, c in zip(bodies, charsets)], dtype=object)

    charset = F.lit(None).cast("string") if charset is None else charset
    plain = charset.isNull() & F.is_valid_utf8(body.cast("string"))
    return F.when(plain, body.cast("string")).otherwise(F.pandas_udf(run, "string")(F.when(~plain, body), charset))


def _walker():
    from html.parser import HTMLParser

    class Walk(HTMLParser):
        """Text outside chrome; table cells and links in document order."""

        def __init__(self) -> None:
            super().__init__(convert_charrefs=True)
            self.skip: list[str] = []
            self.body, self.text, self.rows, self.cells, self.links = False, [], [], [], []

        def handle_starttag(self, tag, attrs):
            if tag in CHROME:
                self.skip.append(tag)
            if tag == "body" and not self.body:
                self.body, self.text = True, []
            given = dict(attrs)
            if tag == "td":
                self.rows.append(["td", given.get("class") or "", "", ""])
                self.cells.append(len(self.rows) - 1)
            elif tag == "a":
                self.rows.append(["a", self.rows[self.cells[-1]][1] if self.cells else "", given.get("href") or "", ""])
                self.links.append(len(self.rows) - 1)
            if tag in _VOID and tag in CHROME:
                self.skip.pop()

        def handle_endtag(self, tag):
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            if tag == "td" and self.cells:
                self.cells.pop()
            elif tag == "a" and self.links:
                self.links.pop()

        def handle_data(self, data):
            for i in {*self.cells[-1:], *self.links[-1:]}:
                self.rows[i][3] += data
            if not self.skip:
                self.text.append(data)

    return Walk()


def _visible(pages: pd.Series) -> pd.Series:
    def one(html: str | None) -> str | None:
        if html is None:
            return None
        walk = _walker()
        walk.feed(html)
        walk.close()
        return "".join(walk.text)

    return pages.map(one)


def whole_references(html: Column) -> Column:
    """Markup in which a character reference without its semicolon is text, as where a page was cut
    after it was escaped: a parser would read `&amp` as `&`."""
    return F.regexp_replace(html, r"&(?!(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);)", "&amp;")


def body_text(html: Column) -> Column:
    """The canonical text of a notice's page without chrome and volatile passages."""
    text = F.pandas_udf(_visible, "string")(html)
    for pattern in VOLATILE:
        text = F.regexp_replace(text, pattern, " ")
    return canonical_text(text)


def clean_agency(c: Column) -> Column:
    """A header cell without the labels of its download links."""
    return canonical_text(F.regexp_replace(c, r"(?i)\b(?:ver\s+(?:pdf|imagen)|imagen|descargar|word|pdf)\b", " "))


def _events(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for page, html in zip(part["page"], part["html"]):
            walk = _walker()
            walk.feed(html or "")
            walk.close()
            rows += [(page, i, *r) for i, r in enumerate(walk.rows)]
        yield pd.DataFrame(rows, columns=["page", "pos", "tag", "class", "href", "text"])


def page_events(pages: DataFrame, page_col: str, html_col: str) -> DataFrame:
    """(page, pos, tag, class, href, text): every cell and link, in document order. A link's class
    is that of its innermost cell."""
    kind = dict(pages.dtypes)[page_col]
    return pages.select(F.col(page_col).alias("page"), F.col(html_col).alias("html")).mapInPandas(_events, f"page {kind}, pos long, tag string, class string, href string, text string")


def index_notices(pages: DataFrame, page_col: str = "page", html_col: str = "html", detail: str = "nota_detalle.php", decoy: str = "nota_to_doc.php") -> DataFrame:
    """The notices of index pages: page, pos, kind, codigo, titulo, seccion, poder, organismo, href.

    Cells of class txt_blanco set the section, txt_blanco2 the branch, subtitle_azul the agency,
    for all links that follow: the state is carried along the page by windows. kind is `notice`
    for a numbered detail link with text (the first of each code on a page), `rejected` for the
    decoy links that sit in an agency's own cell.
    """
    text = canonical_text(F.col("text"))
    e = page_events(pages, page_col, html_col).withColumn("said", F.when(text != "", text))
    along = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_ = lambda c: (F.col("tag") == "td") & F.array_contains(F.split("class", r"\s+"), c)
    carry = lambda c, v: F.coalesce(F.last(F.when(is_(c), v), ignorenulls=True).over(along), F.lit(""))
    e = e.select("page", "pos", "tag", "class", "href", "said", carry("txt_blanco", F.col("said")).alias("seccion"), carry("txt_blanco2", F.col("said")).alias("poder"), carry("subtitle_azul", F.nullif(clean_agency("said"), F.lit(""))).alias("organismo"))
    links = e.where("tag = 'a'")
    code, bad = code_from_href(F.col("href"), "codigo"), code_from_href(F.col("href"), "codnota")
    kind = F.when(F.col("href").contains(detail) & code.isNotNull() & F.col("said").isNotNull(), "notice").when(F.col("href").contains(decoy) & bad.isNotNull() & F.array_contains(F.split("class", r"\s+"), "subtitle_azul"), "rejected")
    links = links.select("page", "pos", kind.alias("kind"), F.when(kind == "notice", code).otherwise(bad).alias("codigo"), F.col("said").alias("titulo"), "seccion", "poder", "organismo", "href").where("kind is not null")
    first = Window.partitionBy("page", "kind", "codigo").orderBy("pos")
    return links.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def index_status(pages: DataFrame, notices: DataFrame, page_col: str = "page", html_col: str = "html", detail: str = "nota_detalle.php") -> DataFrame:
    """(page, status, n_notas, n_rejected): ok, no_edition, or error for a page that has detail
    links of which none could be read, which is never an empty day."""
    counts = notices.groupBy("page").agg(F.count_if(F.col("kind") == "notice").alias("n_notas"), F.count_if(F.col("kind") == "rejected").alias("n_rejected"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = pages.select(F.col(page_col).alias("page"), F.contains(F.col(html_col), F.lit(detail)).alias("has")).join(counts, "page", "left")
    status = F.when(F.coalesce("n_notas", F.lit(0)) > 0, "ok").when(F.col("has"), "error").otherwise("no_edition")
    return out.select("page", status.alias("status"), zero("n_notas"), zero("n_rejected"))
