"""Ratios: percent change, share of total, bias. All divide with ``try_divide``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_change_or_zero(now: Column, prev: Column) -> Column:
    """(now - prev) / prev * 100, and 0 when prev is 0 or NULL."""
    return F.when(prev != 0, F.try_divide(now - prev, prev) * 100).otherwise(F.lit(0.0))


def share_pct(part: Column, total: Column) -> Column:
    """part / total * 100; NULL when the total is 0 or NULL."""
    return F.try_divide(part, total) * 100


def round_half_up(c: Column, places: int) -> Column:
    """Round half up, taking the value as a 12-decimal number first.

    A money or ratio value that is a decimal tie in exact arithmetic (400.96875)
    often arrives as float noise just below it (400.96874999999994) after a few
    multiplications, and would round down in one engine and up in another.
    Fixing 12 decimals first makes both the tie. Values outside DECIMAL(38,12)
    fall back to ``round`` on the double.
    """
    snapped = F.round(c.try_cast("decimal(38,12)"), places).cast("double")
    return F.coalesce(snapped, F.round(c, places))


def bias(demand: Column, actual: Column, absolute: bool = True) -> Column:
    """(demand - actual) / actual; NULL when actual is 0 or NULL."""
    b = F.try_divide(demand - actual, actual)
    return F.abs(b) if absolute else b
