"""Text parsing expressions that reproduce Python string semantics on the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.spec import NULL_SENTINELS

NUMERIC_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
DAY_FIRST_FORMATS = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy-MM-dd")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def title_case(c: str | Column) -> Column:
    """``str.title()``: every maximal run of letters starts upper, continues lower.

    ``initcap`` only splits on spaces (``O'neil``); tokenising into letter and
    non-letter runs first gives ``O'Neil`` and ``Y.S.R.`` like Python does.
    """
    tokens = F.regexp_extract_all(_c(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.when(_c(c).isNotNull(), F.array_join(F.transform(tokens, F.initcap), ""))


def split_list(c: str | Column, sep: str = ",") -> Column:
    """Split a delimited list and strip each part; null becomes the empty list."""
    parts = F.transform(F.split(_c(c), sep), strip)
    return F.when(_c(c).isNull(), F.array().cast("array<string>")).otherwise(parts)


def null_sentinels(c: str | Column, sentinels: Iterable[str] = NULL_SENTINELS) -> Column:
    """Map textual null markers to null; a marker with spaces around it is a text."""
    return F.when(_c(c).isin(list(sentinels)), F.lit(None)).otherwise(_c(c))


def coerce_numeric(c: str | Column) -> Column:
    """Text to double; anything that is not a plain number becomes null.

    ``try_cast`` alone accepts suffixed text such as ``'12d'``, so the value is
    validated by pattern first.
    """
    s = _c(c).cast("string")
    return F.when(s.rlike(NUMERIC_RE), strip(s).try_cast("double"))


def parse_day_first(c: str | Column, formats: Iterable[str] = DAY_FIRST_FORMATS) -> Column:
    """Day-first date parse over an explicit list of accepted formats; invalid -> null."""
    s = strip(c)
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])
