"""Dates and page addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_end(year: Column, month: Column) -> Column:
    return F.last_day(F.make_date(year, month, F.lit(1)))


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "quarter").cast("date")


def quarter_end(d: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))


def date_range(since: Column, until: Column) -> Column:
    """All days from since to until; none if until is before since."""
    return F.when(since <= until, F.sequence(since, until)).otherwise(F.array().cast("array<date>"))


def index_url(base: Column | str, day: Column, edition: Column) -> Column:
    base = F.lit(base) if isinstance(base, str) else base
    return F.format_string("%s/index.php?year=%s&month=%s&day=%s&edicion=%s", base, F.date_format(day, "yyyy"), F.date_format(day, "MM"), F.date_format(day, "dd"), edition)


def code_from_href(href: Column, param: str) -> Column:
    """The whole number that a link's query gives for a parameter, else null."""
    return F.regexp_extract(href, rf"[?&]{param}=(\d+)(?:[&#]|$)", 1).try_cast("bigint")
