"""URL filters: rules on host and path, and block decisions carried over redirects and canonical links."""

from __future__ import annotations

from html import unescape
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, connected_components, hash128, written

#: (host, path, verdict)
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]

_ATTR = r"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_CANONICAL = r"""(?is)<link\s(?=[^>]*\brel\s*=\s*(?:"[^">]*(?<![\w-])|'[^'>]*(?<![\w-])|)canonical(?![\w-]))[^>]*>"""
_BASE = r"""(?is)<base\s(?=[^>]*\bhref\s*=)[^>]*>"""
_REFRESH = r"""(?is)<meta\s(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*>"""


_ABSOLUTE = r"dst rlike '^[A-Za-z][A-Za-z0-9+.-]*://'"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: from there up
    to ? or # or the end. Both empty for null and for urls without ://."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host followed by path) and its verdict, or nulls. A rule fits
    its host and all subdomains if the path starts with the rule's path. Of rules of equal length
    an allow goes first, then the smallest by name."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "allow", [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _attr(tag: Column, name: str) -> Column:
    pattern = _ATTR.replace("{name}", name)
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def _join(base: pd.Series, target: pd.Series) -> pd.Series:
    def one(b: str | None, t: str | None) -> str | None:
        try:
            return urljoin(b, t) if b is not None and t is not None else None
        except ValueError:
            return None

    return pd.Series([one(b, t) for b, t in zip(base, target)], dtype=object)


def _unescape(c: Column) -> Column:
    """An attribute's value with its character references resolved; most have none and stay in the JVM."""
    return F.when(c.contains("&"), F.pandas_udf(lambda x: x.map(unescape, na_action="ignore"), "string")(F.when(c.contains("&"), c))).otherwise(c)


def resolved(target: Column, base: Column) -> Column:
    """A target as a url: as it is if it names a scheme and a host, else relative to base. Other
    schemes (mailto:, javascript:) stay without :// and make no edges."""
    return F.when(target.rlike(r"\A[A-Za-z][A-Za-z0-9+.\-]*:"), target).otherwise(F.pandas_udf(_join, "string")(base, target))


def link_edges(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(src, dst): a page's url and the url that a canonical link or a meta refresh in its html
    names, among other relations too. Character references in them are resolved, and targets against
    the page's first <base href>, if it has one, and its url."""
    html, url = F.col(f"`{html_col}`"), F.col(f"`{url_col}`")
    canonical = F.transform(F.regexp_extract_all(html, F.lit(_CANONICAL), 0), lambda t: F.trim(_attr(t, "href")))
    refresh = F.transform(F.regexp_extract_all(html, F.lit(_REFRESH), 0), lambda t: F.trim(F.regexp_extract(_attr(t, "content"), r"""(?is);\s*url\s*=\s*["']?([^"']*)""", 1)))
    base = F.trim(_attr(F.regexp_extract(html, _BASE, 0), "href"))
    has = F.lower(html).rlike("canonical|refresh")
    found = pages.where(has).where(url.contains("://")).select(url.alias("src"), base.alias("base"), F.explode(F.concat(canonical, refresh)).alias("dst")).where("dst != ''")
    found = found.withColumns({"base": _unescape(F.col("base")), "dst": F.trim(_unescape(F.col("dst")))})
    found = found.withColumn("base", F.when(F.col("base") == "", F.col("src")).otherwise(resolved(F.col("base"), F.col("src"))))
    return found.select("src", resolved(F.col("dst"), F.col("base")).alias("dst")).where(_ABSOLUTE)


def _vertex(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, and all of it but its scheme and fragment."""
    host, path = host_path(url)
    query = F.regexp_extract(url, r"\A[^?#]*(\?[^#]*)", 1)
    return host, path, F.concat(host, path, query)


def judge_urls(pages: DataFrame, url_col: str = "url", html_col: str = "html", redirects: DataFrame | None = None, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """The rows of pages (all columns but the html) plus host, path, rule and verdict.

    A url's own rule decides first. A url without a rule takes the decision of its component
    under redirect edges (src, dst), canonical links and meta refreshes: allow if any url in it
    has an allow rule, else block if any has a block rule, else allow. Urls that differ only in
    scheme or fragment are one vertex; targets that are no page count too. Null urls and urls
    without :// have empty host and path, no rule and no links, and are allowed. Rows with equal
    urls get equal verdicts; an empty table gives an empty one.

    Only urls with an edge are joined; a component of any size is reduced to two flags before
    its shuffle.
    """
    edges = link_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.where("contains(src, '://') and dst != ''").select("src", resolved(F.col("dst"), F.col("src")).alias("dst")).where(_ABSOLUTE))
    ends = edges.where("contains(src, '://')").select(F.array("src", "dst").alias("u"))
    both = written(ends.select(*_hashed(F.col("u")[0], "a", rules), *_hashed(F.col("u")[1], "b", rules)), "links")
    parts = written(connected_components(both.select("a", "b")), "components")
    named = both.select(F.col("a").alias("node"), F.col("a_says").alias("says")).union(both.select("b", "b_says"))
    said = parts.join(named, "node", "left").groupBy("component").agg(F.max(F.col("says") == "allow").alias("allows"), F.max(F.col("says") == "block").alias("blocks"))
    blocked = said.where("blocks and not coalesce(allows, false)").select("component")
    bad = parts.join(blocked, "component", "left_semi").select(F.col("node").alias("bad node")).distinct()

    names = [c for c in pages.columns if c != html_col]
    host, path, full = _vertex(F.col(f"`{url_col}`"))
    rule, says = rule_for(host, path, rules)
    node = F.when(host == "", None).otherwise(_node(full))
    judged = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], host.alias("h"), path.alias("p"), rule.alias("r"), says.alias("v"), node.alias("node"))
    out = judged.join(bad, F.col("node") == F.col("`bad node`"), "left")
    verdict = F.coalesce("v", F.when(F.col("`bad node`").isNotNull(), "block").otherwise("allow"))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in ("host", "path", "rule", "verdict")], F.col("h").alias("host"), F.col("p").alias("path"), F.col("r").alias("rule"), verdict.alias("verdict"))


def _node(full: Column) -> Column:
    """128 bits that stand for a url."""
    return F.concat(*[F.lpad(F.hex(h), 16, "0") for h in hash128(full)])


def _hashed(url: Column, name: str, rules: list[tuple[str, str, str]]) -> list[Column]:
    host, path, full = _vertex(url)
    return [_node(full).alias(name), rule_for(host, path, rules)[1].alias(f"{name}_says")]
