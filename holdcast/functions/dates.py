"""As-of date helpers and period keys.

The as-of date is always an explicit parameter (the reference reads the driver
clock in one place and ``current_date()`` in another). Comparisons are against
typed DATE literals so the parquet reader can push them down.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = dt.date | str


def as_date(d: DateLike) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def lit_date(d: DateLike, minus_days: int = 0) -> Column:
    """A DATE literal ``d - minus_days`` (folded by the optimizer)."""
    return F.lit(as_date(d) - dt.timedelta(days=minus_days))


def on_day(c: str | Column, d: DateLike, minus_days: int = 0) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c == lit_date(d, minus_days)


def since(c: str | Column, d: DateLike, days: int) -> Column:
    """``c >= d - days``: inclusive trailing window, no upper bound."""
    c = F.col(c) if isinstance(c, str) else c
    return c >= lit_date(d, days)


def between_days(c: str | Column, d: DateLike, days: int) -> Column:
    """``d - days <= c <= d``."""
    c = F.col(c) if isinstance(c, str) else c
    return c.between(lit_date(d, days), lit_date(d))


def calendar_week(day: Column) -> tuple[Column, Column]:
    """(YEAR, WEEKOFYEAR): calendar year with ISO week, as the reference groups.

    Puts 2024-12-30 in (2024, 1); see ``iso_week`` for the consistent key.
    """
    return F.year(day), F.weekofyear(day)


def iso_week(day: Column) -> tuple[Column, Column]:
    """(ISO year-of-week, ISO week): 2024-12-30 is (2025, 1)."""
    return F.extract(F.lit("YEAROFWEEK"), day).cast("int"), F.weekofyear(day)


def day_text(d: DateLike, fmt: str = "%Y-%m-%d", minus_days: int = 0) -> str:
    return (as_date(d) - dt.timedelta(days=minus_days)).strftime(fmt)
