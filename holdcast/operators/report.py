"""Hierarchy attributes, the business filter, the wide report and DOH ratio.

The SQL script's final select joins weekly rows to daily rows and to bias rows
on (material, location) only, which pairs every week of a key with every day
and every bias date of that key. ``wide_report_aligned`` keeps its 47 columns
but joins each day to its own ISO week and its own bias date, so the output
has one row per (material, location, day) and grows linearly with the input.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdcast.functions import units as U
from holdcast.functions.dates import DateLike, iso_week, lit_date
from holdcast.operators import demand, holding, totals
from holdcast.plans.joins import with_calendar_totals, with_hierarchy, with_material_master
from holdcast.schemas import Tables

HIERARCHY_COLUMNS = ["Division", "Network", "ProductLevel3CategoryID"]


def weekly_with_hierarchy(tables: Tables, iso: bool = False) -> DataFrame:
    """Weekly rows with Division, Network and ProductLevel3CategoryID."""
    wk = totals.weekly_inventory(tables, iso)
    return with_hierarchy(wk, tables, on="material_id")


def filter_holdings(df: DataFrame, material: str | None = None, location: int | None = None,
                    network: str | None = None, division: str | None = None,
                    pl3: str | None = None) -> DataFrame:
    """AND of the given equality filters; ``None`` leaves a column unfiltered."""
    conds = [(c, v) for c, v in (("material_id", material), ("location_id", location),
                                 ("Network", network), ("Division", division),
                                 ("ProductLevel3CategoryID", pl3)) if v is not None]
    for c, v in conds:
        df = df.filter(F.col(c) == F.lit(v))
    return df


def filtered_weekly(tables: Tables, material: str | None = None, location: int | None = None, network: str | None = None,
                    division: str | None = None, pl3: str | None = None, iso: bool = False) -> DataFrame:
    """``filter_holdings(weekly_with_hierarchy(t), ...)`` with the filters below the sums.

    Filters on stock's own keys go to the scan. Filters on the hierarchy become the set of
    materials that meet them, and stock is reduced to it by a semi join before it is summed, so
    what is filtered out is neither summed nor shuffled.
    """
    stock = tables.batch_inventory
    if material is not None:
        stock = stock.filter(F.col("MaterialID") == F.lit(material))
    if location is not None:
        stock = stock.filter(F.col("LocationID") == F.lit(location))
    hierarchy = filter_holdings(tables.material_hierarchy, network=network, division=division, pl3=pl3)
    if hierarchy is not tables.material_hierarchy:
        stock = stock.join(hierarchy.select("MaterialID"), "MaterialID", "left_semi")
    reduced = replace(tables, batch_inventory=stock, material_hierarchy=hierarchy)
    return weekly_with_hierarchy(reduced, iso)


def wide_report_aligned(tables: Tables, as_of: DateLike, bias_days: int = 28,
                        day_sums: DataFrame | None = None) -> DataFrame:
    """Daily rows with their ISO week's sums, week and day shares, hierarchy and
    the 28-day bias of that day.

    Shuffles: batch rows -> (material, location, day) sums, read three times
    through one reused exchange (detail, week totals, day totals); the bias join
    on the same keys keeps that partitioning; one window shuffle by
    (material, location, year, week) with at most seven rows per window; the two
    calendar-total tables are broadcast.
    """
    dy = totals.daily_inventory(tables, day_sums)
    b = demand.bias_28d(tables, as_of, bias_days).select(
        F.col("DATE").alias("day"), F.col("LocationID").alias("location_id"),
        F.col("MaterialID").alias("material_id"), "Total_Actual_Quantity_Cases",
        "Total_Demand_Quantity_Cases", "Bias_Perc")
    dy = dy.join(b, ["material_id", "location_id", "day"], "left")

    y, w = iso_week(F.col("day"))
    dy = dy.withColumns({"year": y, "week": w})
    win = Window.partitionBy("material_id", "location_id", "year", "week")
    weekly_names = totals.s_measure_names("_weekly")
    daily_names = totals.s_measure_names("_daily")
    dy = dy.withColumns({wn: F.sum(dn).over(win) for wn, dn in zip(weekly_names, daily_names)})

    # Totals from the daily aggregate alone (no bias join in these branches),
    # so both reuse the daily shuffle. Week totals sum weekly rows, as SQL does.
    daily = totals.daily_inventory(tables, day_sums)
    weekly_rows = daily.withColumns({"year": y, "week": w}).groupBy(
        "material_id", "location_id", "year", "week").agg(
        *[F.sum(dn).alias(wn) for wn, dn in zip(weekly_names, daily_names)])
    wk_tot = totals.period_totals(weekly_rows, ["year", "week"], "_weekly")
    day_tot = totals.period_totals(daily, ["day"], "_daily")
    j = with_calendar_totals(with_calendar_totals(dy, wk_tot, ["year", "week"]), day_tot, ["day"])
    j = with_hierarchy(j, tables, on="material_id")
    wsh = totals.share_columns(j, "_weekly")
    dsh = totals.share_columns(j, "_daily")
    return j.select(
        "material_id", "location_id", "year", "week", *weekly_names,
        *[wsh[n].alias(n) for n in wsh],
        "day", *daily_names, *[dsh[n].alias(n) for n in dsh],
        *HIERARCHY_COLUMNS, "Total_Actual_Quantity_Cases", "Total_Demand_Quantity_Cases",
        "Bias_Perc")


def doh_ratio(tables: Tables, as_of: DateLike) -> DataFrame:
    """Days on hand: clear cases on the day / the latest plan's demand for the
    as-of day, today and yesterday (same denominator). NULL when demand is 0
    or missing. Keys with stock on the as-of day."""
    g = holding.stock_by_key(tables, as_of, {"today": 0, "yesterday": 1})
    g = g.filter(F.col("today_rows") > 0)
    j = with_material_master(g, tables, [U.UPP, U.UPC])
    plan = demand.latest_plan(tables.demand_plan.filter(F.col("DATE") == lit_date(as_of)))
    j = j.join(plan.select("LocationID", "MaterialID", "ConsensusDemandPlan"),
               ["LocationID", "MaterialID"], "left")
    today_cases = U.cases_defaulted(F.col("today_clear"))
    yday_cases = U.cases_defaulted(F.col("yesterday_clear"))
    demand_cases = F.col("ConsensusDemandPlan")
    return j.select(
        lit_date(as_of).alias("date"),
        F.col("LocationID").alias("location_id"), F.col("MaterialID").alias("material_id"),
        today_cases.alias("clear_cases_today"), yday_cases.alias("clear_cases_yesterday"),
        demand_cases.alias("daily_demand_cases"),
        F.try_divide(today_cases, demand_cases).alias("doh_today"),
        F.try_divide(yday_cases, demand_cases).alias("doh_yesterday"))
