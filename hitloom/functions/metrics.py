"""Report building blocks: exact rounded ratios, session key, date cutoff."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: str, den: str, scale: int, factor: int = 1) -> Column:
    """``round(factor * num / den, scale)``, halves away from zero, exact.

    ``num`` and ``den`` are SQL expressions over integers of either sign
    (column names of an aggregate result).  The magnitude is rounded as
    ``(2*f*|n|*10^s + |d|) div (2*|d|)`` on DECIMAL(38,0) and gets its sign
    back, so no binary floating point enters before the final scaling; the
    result is a DOUBLE.  A zero or NULL denominator gives NULL instead of
    raising under ANSI mode.
    """
    return F.expr(ratio_sql(num, den, scale, factor))


def ratio_sql(num: str, den: str, scale: int, factor: int = 1) -> str:
    """``ratio`` as SQL text."""
    unit = 10 ** scale
    n = f"CAST(({num}) AS DECIMAL(38,0))"
    d = f"CAST(NULLIF(({den}), 0) AS DECIMAL(38,0))"
    size = f"(2 * abs({n}) * {factor * unit} + abs({d})) div (2 * abs({d}))"
    # "+ 0" turns a rounded -0.0 into 0.0.
    return f"(CAST({size} AS DOUBLE) * signum({n}) * signum({d}) / {unit} + 0D)"


def session_key(visitor: str = "fullVisitorId", visit: str = "visitId",
                exact: bool = False) -> Column:
    """Session identity used by distinct counts.

    The default concatenates visitor and visit id with no separator (so
    ("1","23") and ("12","3") collide, as the report definitions do).
    ``exact=True`` puts a separator between the two parts."""
    parts = [F.col(visitor), F.col(visit).cast("string")]
    if exact:
        return F.concat_ws("\u0001", *parts)
    return F.concat(*parts)


def as_of_date(as_of: str | _dt.date | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def date_cutoff(as_of: str | _dt.date | None = None, days: int = 30,
                col: str = "date") -> Column:
    """``date BETWEEN date AND as_of - days``: the lower bound is the column
    itself, so the rule is ``date <= as_of - days`` (NULL dates drop).  Written
    as a plain comparison against a literal so that it prunes date partitions.
    """
    if as_of is None:
        return F.col(col) <= F.date_sub(F.current_date(), days)
    cutoff = _dt.date.fromisoformat(str(as_of)) - _dt.timedelta(days=days)
    return F.col(col) <= F.lit(cutoff)
