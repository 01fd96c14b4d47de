"""Weekly and daily inventory sums, period totals and share of total.

Propagating NULL policy (the SQL script's): pallets are the ``InventoryStock*``
columns, restricted = quality inspection + restricted, and a NULL input gives a
NULL measure that ``SUM`` then skips.

Plan shape: batch rows are summed to the output grain *before* the material
master join. The measures are linear in pallets and every row of a group has
the same material, so ``sum(p) * upp / upc`` equals the per-row sum; this
shuffles one row per group instead of one per batch, and the partial sums
happen map-side, so a hot (material, location) is reduced before it moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdcast.functions import units as U
from holdcast.functions.dates import calendar_week, iso_week
from holdcast.functions.ratios import share_pct
from holdcast.plans.joins import with_calendar_totals, with_material_master
from holdcast.schemas import Tables

KEYS = ["MaterialID", "LocationID"]


def row_pallets() -> dict[str, Column]:
    """Pallet expression per status at batch-row grain (SQL-script form)."""
    return {
        "clear": F.col(U.UNIT_STOCK["clear"]),
        "blocked": F.col(U.UNIT_STOCK["blocked"]),
        "restricted": F.col(U.QUALITY_STOCK) + F.col(U.UNIT_STOCK["restricted"]),
    }


# Status order of the SQL script's output columns.
S_ORDER = ("clear", "blocked", "restricted")


def s_measure_names(suffix: str) -> list[str]:
    return [f"{s}_{u}{suffix}" for u in U.UNITS for s in S_ORDER]


def stock_with_material(tables: Tables) -> DataFrame:
    """Every batch row with its master attributes (stock drives, left join)."""
    return with_material_master(tables.batch_inventory, tables,
                                [U.UPP, U.UPC, U.LIST_PRICE, U.STD_COST])


def stock_units_sql(tables: Tables) -> DataFrame:
    """Per batch row: price and the nine measures, propagating policy."""
    j = stock_with_material(tables)
    m = U.propagating_measures(row_pallets())
    return j.select(
        F.col("MaterialID").alias("material_id"), F.col("LocationID").alias("location_id"),
        F.col("SnapshotDate").alias("snapshot_date"),
        F.col(U.UPP).alias("units_per_pallet"), F.col(U.UPC).alias("units_per_case"),
        U.price(default=None).alias("price"),
        *[m[n].alias(n) for n in s_measure_names("")],
    )


def _pallet_sums(rows: DataFrame, group: list[Column], source: str = "rows") -> DataFrame:
    """Sum the three pallet quantities to ``KEYS + group``.

    ``source="rows"`` reads batch rows; ``source="day_sums"`` re-aggregates the
    output of ``stock_day_sums`` (sums of sums: exact, NULL only when every
    batch row was NULL, as ``SUM`` over the rows).
    """
    if source == "rows":
        pallets = row_pallets()
        return rows.groupBy(*KEYS, *group).agg(*[F.sum(pallets[s]).alias(f"_p_{s}") for s in S_ORDER])
    return rows.groupBy(*KEYS, *group).agg(*[F.sum(f"_p_{s}").alias(f"_p_{s}") for s in S_ORDER])


def stock_day_sums(tables: Tables) -> DataFrame:
    """Batch rows summed to (MaterialID, LocationID, day of snapshot).

    The smallest table every SQL-form report can be derived from exactly; a
    job that writes several of them computes it once (``holdcast.plans.job``).
    """
    return _pallet_sums(tables.batch_inventory, [F.to_date("SnapshotDate").alias("day")])


def _measures(g: DataFrame, tables: Tables, suffix: str) -> DataFrame:
    """Join master to pallet sums ``g`` and compute the nine measures."""
    j = with_material_master(g, tables, [U.UPP, U.UPC, U.LIST_PRICE, U.STD_COST])
    m = U.propagating_measures({s: F.col(f"_p_{s}") for s in S_ORDER}, suffix=suffix)
    names = [c for c in g.columns if not c.startswith("_p_")]
    return j.select(*names, *[m[n].alias(n) for n in s_measure_names(suffix)]).withColumnsRenamed(
        {"MaterialID": "material_id", "LocationID": "location_id"})


def daily_inventory(tables: Tables, day_sums: DataFrame | None = None) -> DataFrame:
    """Nine measures per (material, location, day of snapshot)."""
    g = day_sums if day_sums is not None else stock_day_sums(tables)
    return _measures(g, tables, "_daily")


def weekly_inventory(tables: Tables, iso: bool = False, day_sums: DataFrame | None = None) -> DataFrame:
    """Nine measures per (material, location, year, week).

    ``iso=False`` groups by YEAR and WEEKOFYEAR as the reference does, which puts
    the last days of December into week 1 of the ending year; ``iso=True`` uses
    the ISO year of the week. Without ``day_sums`` batch rows are grouped by
    week directly (one shuffle); with it the day sums are re-aggregated.
    """
    week_of = iso_week if iso else calendar_week
    if day_sums is None:
        y, w = week_of(F.col("SnapshotDate"))
        g = _pallet_sums(tables.batch_inventory, [y.alias("year"), w.alias("week")])
    else:
        y, w = week_of(F.col("day"))
        g = _pallet_sums(day_sums, [y.alias("year"), w.alias("week")], source="day_sums")
    return _measures(g, tables, "_weekly")


def exact_sum(x: Column) -> Column:
    """Sum of a DOUBLE that hardly depends on the order of its rows, and cuts none.

    The part of each value that fits twelve decimals is summed exactly, what is
    left of it as DOUBLE. Values (or sums) beyond the decimal are summed as DOUBLE.
    """
    fixed = F.when(x.isNotNull(), F.coalesce(x.try_cast("decimal(38,12)"), F.lit(0).cast("decimal(38,12)")))
    return F.coalesce(F.try_sum(fixed).cast("double") + F.sum(x - fixed.cast("double")), F.sum(x))


def period_totals(df: DataFrame, period: list[str], suffix: str) -> DataFrame:
    """Sum of clear + blocked + restricted per period and unit; a row with a
    NULL status contributes nothing (as ``SUM(a + b + c)``). Rows are summed
    unrounded, however small."""
    def row_total(u: str) -> Column:
        return (F.col(f"clear_{u}{suffix}") + F.col(f"blocked_{u}{suffix}")
                + F.col(f"restricted_{u}{suffix}"))
    return df.groupBy(*period).agg(*[
        exact_sum(row_total(u)).alias(f"total_{u}{suffix}") for u in U.UNITS])


def weekly_totals(tables: Tables, iso: bool = False, day_sums: DataFrame | None = None) -> DataFrame:
    return period_totals(weekly_inventory(tables, iso, day_sums), ["year", "week"], "_weekly")


def daily_totals(tables: Tables, day_sums: DataFrame | None = None) -> DataFrame:
    return period_totals(daily_inventory(tables, day_sums), ["day"], "_daily")


def share_columns(df: DataFrame, suffix: str) -> dict[str, Column]:
    return {f"{s}_{u}{suffix}_pct": share_pct(F.col(f"{s}_{u}{suffix}"), F.col(f"total_{u}{suffix}"))
            for u in U.UNITS for s in S_ORDER}


def weekly_share(tables: Tables, iso: bool = False, day_sums: DataFrame | None = None) -> DataFrame:
    """Weekly rows with each measure as a percent of its week's total."""
    wk = weekly_inventory(tables, iso, day_sums)
    t = period_totals(wk, ["year", "week"], "_weekly")
    j = with_calendar_totals(wk, t, ["year", "week"])
    sh = share_columns(j, "_weekly")
    return j.select(*wk.columns, *[sh[n].alias(n) for n in sh])


def daily_share(tables: Tables, day_sums: DataFrame | None = None) -> DataFrame:
    """Daily rows with each measure as a percent of its day's total."""
    dy = daily_inventory(tables, day_sums)
    t = period_totals(dy, ["day"], "_daily")
    j = with_calendar_totals(dy, t, ["day"])
    sh = share_columns(j, "_daily")
    return j.select(*dy.columns, *[sh[n].alias(n) for n in sh])


def weekly_daily_aligned(tables: Tables, day_sums: DataFrame | None = None) -> DataFrame:
    """Each daily row next to the totals of its own (ISO) week.

    The weekly sums come from a window over (material, location, year, week)
    of the daily table: each window partition holds at most seven rows, so
    there is no hot partition and no second aggregation + join.
    """
    dy = daily_inventory(tables, day_sums)
    y, w = iso_week(F.col("day"))
    dy = dy.withColumns({"year": y, "week": w})
    win = Window.partitionBy("material_id", "location_id", "year", "week")
    weekly = {n.replace("_daily", "_weekly"): F.sum(n).over(win) for n in s_measure_names("_daily")}
    return dy.withColumns(weekly).select(
        "material_id", "location_id", "year", "week", *s_measure_names("_weekly"),
        "day", *s_measure_names("_daily"))
