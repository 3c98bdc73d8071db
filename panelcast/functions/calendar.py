"""Calendar expressions: seasons, cyclic month encoding, month dates."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelcast.spec import MONSOON_MONTHS_EVENT, SEASON_OTHER, SEASONS_FOUR_WAY


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def season_two_way(month: str | Column) -> Column:
    """Event season: Monsoon for months 6-10, Non-Monsoon otherwise (null included)."""
    m = _c(month)
    return F.when(m.isin(list(MONSOON_MONTHS_EVENT)), "Monsoon").otherwise("Non-Monsoon")


def season_four_way(month: str | Column) -> Column:
    m = _c(month)
    expr = None
    for name, months in SEASONS_FOUR_WAY:
        expr = (F.when if expr is None else expr.when)(m.isin(list(months)), name)
    return expr.otherwise(SEASON_OTHER)


def month_sin(month: str | Column) -> Column:
    return F.sin(F.lit(2.0 * math.pi) * _c(month) / F.lit(12.0))


def month_cos(month: str | Column) -> Column:
    return F.cos(F.lit(2.0 * math.pi) * _c(month) / F.lit(12.0))


def first_of_month(year: str | Column, month: str | Column) -> Column:
    return F.make_date(_c(year), _c(month), F.lit(1))
