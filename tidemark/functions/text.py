"""Text normalisation, hashing and tokens."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it; Java's plain \\s knows ASCII only.
BLANK = r"(?U)[\s\x1c-\x1f]+"
_PLAIN = "[\\x00-\\x7F\\u00A0-\\u024F\\u2000-\\u206F]*"


def _composed(x: pd.Series) -> pd.Series:
    return x.str.normalize("NFC")


def _bare(x: pd.Series) -> pd.Series:
    import unicodedata

    strip = lambda s: "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")
    return x.map(strip, na_action="ignore")


def _latin() -> tuple[str, str, str]:
    """Latin letters that are an ASCII letter with marks, those letters, and the characters of the
    same blocks (and general punctuation) that have no mark to lose."""
    import unicodedata

    marked, plain, safe = "", "", ""
    for i in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), *range(0x20A0, 0x20C1)):
        c = chr(i)
        parts = unicodedata.normalize("NFD", c)
        if parts == c and unicodedata.category(c) != "Mn":
            safe += c
        elif parts[0].isascii() and all(unicodedata.category(x) == "Mn" for x in parts[1:]):
            marked, plain = marked + c, plain + parts[0]
    return marked, plain, safe


def _ranges(chars: str) -> str:
    """The characters (in order) as ranges of a regular expression's class."""
    out, codes = [], [ord(c) for c in chars]
    for c in codes:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in out)


_ACCENTED, _STRIPPED, _SAFE = _latin()
_EASY = f"\\A(?:[\\x00-\\x7F]++|[{_ranges(''.join(sorted(_ACCENTED + _SAFE)))}])*+\\z"


def nfc(c: Column) -> Column:
    """Composed form. Texts of Latin letters that are already composed stay in the JVM."""
    return F.when(c.rlike(f"\\A{_PLAIN}\\z"), c).otherwise(F.pandas_udf(_composed, "string")(F.when(~c.rlike(f"\\A{_PLAIN}\\z"), c)))


def canonical_text(c: Column) -> Column:
    """NFC, white space collapsed to single spaces, ends stripped; null is empty."""
    return F.coalesce(F.trim(F.regexp_replace(nfc(c), BLANK, " ")), F.lit(""))


def strip_accents(c: Column) -> Column:
    """Without combining marks. Texts of Latin letters stay in the JVM, others take an Arrow UDF."""
    easy = c.rlike(_EASY)
    return F.when(easy, F.translate(c, _ACCENTED, _STRIPPED)).otherwise(F.pandas_udf(_bare, "string")(F.when(~easy, c)))


def fold(c: Column) -> Column:
    """Lower case without accents."""
    return strip_accents(F.lower(c))


def content_hash(columns: Iterable[str], exact: Iterable[str] = ()) -> Column:
    """SHA-256 of compact JSON of the columns in order of name, texts in canonical form."""
    names, exact = sorted(columns), set(exact)
    parts = [F.col(f"`{n}`").alias(n) if n in exact else canonical_text(F.col(f"`{n}`").cast("string")).alias(n) for n in names]
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


def tokens(c: Column, folded: bool = True) -> Column:
    """Runs of letters, numbers and private-use characters, lower case, without accents if folded."""
    return F.regexp_extract_all(fold(c) if folded else F.lower(c), F.lit(r"[\p{L}\p{N}\p{Co}]+"), 0)


def words(c: Column, stop: Iterable[str] = (), least: int = 3) -> Column:
    stop = list(stop)
    found = F.array_distinct(F.filter(tokens(c), lambda w: F.length(w) >= least))
    return F.array_except(found, F.array(*[F.lit(s) for s in stop])) if stop else found


def overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of words; 0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def shortened(c: Column, most: int) -> Column:
    return F.substring(c, 1, most)
