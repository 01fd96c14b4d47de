"""Reports of many as-of dates in one pass.

The single-date metrics filter their input by one literal date, so a backfill of D
dates is D scans. Here a range of dates is one scan: batch rows, plan rows and order lines are
first summed to days, and what a date needs of the days before it is a window
frame over those sums:

* ``RANGE BETWEEN n PRECEDING AND CURRENT ROW`` over days for the trailing windows (bias),
* ``RANGE BETWEEN 7 PRECEDING AND 7 PRECEDING`` for the value exactly a week
  earlier (``lag`` counts rows, and so misses wherever a day has none).

Frames run over day grain only: a key's window partition has at most a row per calendar day,
however many batches or snapshots the key has. Frames order by day number, so
a gap between days is a gap in the frame.

Every function takes ``first`` and ``last`` (both included) and has a column ``as_of``;
rows of one ``as_of`` equal those of the single-date function. Rows whose day
or date is NULL belong to no as-of date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdcast.functions import units as U
from holdcast.functions.dates import DateLike, as_date, lit_date
from holdcast.functions.ratios import bias, pct_change_or_zero, round_half_up
from holdcast.operators.demand import demand_quantity, latest_plan, order_lines
from holdcast.operators.holding import KEYS, status_quantities
from holdcast.plans.joins import with_material_master
from holdcast.schemas import Tables


def days_between(first: DateLike, last: DateLike) -> int:
    span = (as_date(last) - as_date(first)).days
    if span < 0:
        raise ValueError(f"{first} is after {last}")
    return span


def _frame(keys: list[str], day: str, start: int, end: int):
    """Rows of the same keys whose ``day`` lies from ``start`` to ``end`` days after the row's own."""
    return Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(start, end)


def trailing(daily: DataFrame, keys: list[str], day: str, sums: list[str], days: int,
             first: DateLike, last: DateLike) -> DataFrame:
    """Sums over [as_of - days, as_of] for each as-of date of the range.

    ``daily`` has one row per keys and ``day``. The result has ``keys``, ``as_of`` and the
    ``sums``, with a row wherever the window holds a row of ``daily``: the days that
    have none are filled in behind each row, up to the next row or the end of its window.
    Both window steps share one exchange on ``keys``.
    """
    inside = daily.filter(F.col(day).between(lit_date(first, days), lit_date(last)))
    following = F.lead(day).over(Window.partitionBy(*keys).orderBy(F.unix_date(day)))
    until = F.least(F.coalesce(F.date_sub(following, 1), lit_date(last)), F.date_add(day, days), lit_date(last))
    dense = inside.withColumn("_until", until).select(
        "*", F.explode(F.sequence(F.col(day), F.col("_until"))).alias("as_of"))
    frame = _frame(keys, "as_of", -days, 0)
    own = F.col("as_of") == F.col(day)
    summed = dense.select(*keys, "as_of", *[F.sum(F.when(own, F.col(c))).over(frame).alias(c) for c in sums])
    return summed.filter(F.col("as_of") >= lit_date(first))


def _plan_and_orders(tables: Tables, start: Column, end: Column, demand: Column, ordered: str) -> DataFrame:
    """(MaterialID, DATE): latest plan and order lines summed to days, one scan of each."""
    day = F.col("DATE").between(start, end)
    plan = demand_quantity(tables.demand_plan.filter(day)).select(
        "MaterialID", "DATE", demand.alias("demand"), F.lit(1).alias("plan_rows"), F.lit(None).cast("double").alias("actual"),
        F.lit(None).cast("int").alias("order_rows"))
    orders = order_lines(tables).filter(day).select(
        "MaterialID", "DATE", F.lit(None).cast("double").alias("demand"), F.lit(None).cast("int").alias("plan_rows"),
        F.col(ordered).alias("actual"), F.lit(1).alias("order_rows"))
    return plan.unionByName(orders).groupBy("MaterialID", "DATE").agg(
        *[F.sum(c).alias(c) for c in ("demand", "plan_rows", "actual", "order_rows")])


def bias_90d_aligned_range(tables: Tables, first: DateLike, last: DateLike, days: int = 90) -> DataFrame:
    """``demand.bias_90d_aligned`` of every as-of date from ``first`` to ``last``."""
    days_between(first, last)
    daily = _plan_and_orders(tables, lit_date(first, days), lit_date(last), F.col("ConsensusDemandPlan"), "ConfirmedQuantity")
    t = trailing(daily, ["MaterialID"], "DATE", ["demand", "plan_rows", "actual"], days, first, last).filter("plan_rows > 0")
    forecast = F.coalesce(F.col("demand"), F.lit(0.0))
    return t.select("as_of", "MaterialID", F.col("demand").alias("DemandForecast"), F.col("actual").alias("ActualDemand"),
                    round_half_up(bias(forecast, F.col("actual")), 3).alias("Bias"))


def bias_28d_trailing(tables: Tables, first: DateLike, last: DateLike, days: int = 28, absolute: bool = True) -> DataFrame:
    """Bias per (as_of, MaterialID) over the ``days`` days up to each as-of date.

    The sums of ``demand.bias_28d_aligned`` over [as_of - days, as_of]: delivered cases of the order
    lines against the demand quantity of the latest plan. A row wherever the window has an order line.
    """
    days_between(first, last)
    daily = _plan_and_orders(tables, lit_date(first, days), lit_date(last), F.col("Demand_Quantity_Cases"), "Actual_Quantity_Cases")
    t = trailing(daily, ["MaterialID"], "DATE", ["demand", "actual", "order_rows"], days, first, last).filter("order_rows > 0")
    return t.select("as_of", "MaterialID", F.col("actual").alias("Total_Actual_Quantity_Cases"),
                    F.col("demand").alias("Total_Demand_Quantity_Cases"),
                    bias(F.col("demand"), F.col("actual"), absolute=absolute).alias("Bias_Perc" if absolute else "Bias"))


def bias_90d_range(tables: Tables, first: DateLike, last: DateLike, days: int = 90) -> DataFrame:
    """``demand.bias_90d`` (the notebook's form) of every as-of date from ``first`` to ``last``.

    A plan key counts the snapshots from as_of - days on, without an upper bound. So a snapshot day
    ends the as-of dates that still see it, and the sums of all snapshots from a day on are a
    frame that is unbounded on its other side.
    """
    days_between(first, last)
    keys = ["DATE", "MaterialID", "LocationID"]
    by_snapshot = tables.demand_plan.filter(F.col("SnapshotDate") >= lit_date(first, days)).groupBy(*keys, "SnapshotDate").agg(
        F.sum("ConsensusDemandPlan").alias("plan"))
    order = Window.partitionBy(*keys).orderBy("SnapshotDate")
    later = order.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    # The as-of dates whose window begins after the snapshot before this one and reaches this one.
    seen_from = F.greatest(F.coalesce(F.date_add(F.lag("SnapshotDate").over(order), days + 1), lit_date(first)), lit_date(first))
    seen_until = F.least(F.date_add("SnapshotDate", days), lit_date(last))
    sums = by_snapshot.select(*keys, F.sum("plan").over(later).alias("DemandForecast"), seen_from.alias("_from"), seen_until.alias("_until"))
    forecast = sums.filter("_from <= _until").select(
        *keys, "DemandForecast", F.explode(F.sequence("_from", "_until")).alias("as_of"))
    actual = order_lines(tables).groupBy("MaterialID").agg(F.sum("ConfirmedQuantity").alias("ActualDemand"))
    j = forecast.join(actual, "MaterialID", "left")
    gap = F.coalesce(F.col("DemandForecast"), F.lit(0.0)) - F.coalesce(F.col("ActualDemand"), F.lit(0.0))
    b = F.round(F.abs(F.try_divide(gap, F.coalesce(F.col("ActualDemand"), F.lit(1.0)))), 3)
    return j.select("as_of", "DATE", "LocationID", "MaterialID", "DemandForecast", "ActualDemand", b.alias("Bias"))


def holding_history(tables: Tables, first: DateLike, last: DateLike) -> DataFrame:
    """``holding.holding_report`` of every as-of date from ``first`` to ``last``: one scan of stock.

    Batch rows are summed to (material, location, day); the values of last week and yesterday are
    frames of exactly seven days and one day back over those sums, so a day without stock
    counts as none and never as the nearest day that has some.
    """
    days_between(first, last)
    stock = tables.batch_inventory.filter(F.col("AvailableDate").between(lit_date(first, 7), lit_date(last)))
    quantity = status_quantities("pallet_stock", "restricted")
    daily = stock.groupBy(*KEYS, "AvailableDate").agg(
        *[F.sum(quantity[s]).alias(f"today_{s}") for s in U.STATUSES],
        F.max("Day").alias("today_day"), F.max("SnapshotDate").alias("today_snapshot"))
    week, day = _frame(KEYS, "AvailableDate", -7, -7), _frame(KEYS, "AvailableDate", -1, -1)
    shifted = daily.select(
        "*", *[F.first(f"today_{s}").over(week).alias(f"last_week_{s}") for s in U.STATUSES],
        F.first("today_snapshot").over(week).alias("last_week_snapshot"),
        F.first("today_day").over(day).alias("yesterday_day")).filter(F.col("AvailableDate") >= lit_date(first))
    j = with_material_master(shifted, tables, [U.UPP, U.UPC, U.LIST_PRICE, U.STD_COST])
    measures = U.defaulted_measures({s: F.col(f"today_{s}") for s in U.STATUSES})
    j = j.withColumns(measures)
    earlier = {s: F.coalesce(F.col(f"last_week_{s}"), F.lit(0.0)) for s in U.STATUSES}
    return j.select(
        F.col("AvailableDate").alias("as_of"), F.col("LocationID").alias("location_id"), F.col("MaterialID").alias("material_id"),
        *U.measure_names(),
        *[earlier[s].alias(f"last_week_{s}_pallets") for s in U.STATUSES],
        *[pct_change_or_zero(F.col(f"{s}_pallets"), earlier[s]).alias(f"wow_{s}_pct") for s in U.STATUSES],
        F.coalesce("today_snapshot", "last_week_snapshot").alias("snapshot_date"),
        F.coalesce("today_day", F.lit(0)).alias("doh_today"), F.coalesce("yesterday_day", F.lit(0)).alias("doh_yesterday"))


def week_over_week_history(tables: Tables, first: DateLike, last: DateLike) -> DataFrame:
    """``holding.week_over_week`` of every as-of date from ``first`` to ``last``."""
    h = holding_history(tables, first, last)
    return h.select("as_of", "location_id", "material_id", *[f"{s}_pallets" for s in U.STATUSES],
                    *[f"last_week_{s}_pallets" for s in U.STATUSES], *[f"wow_{s}_pct" for s in U.STATUSES])


def doh_ratio_history(tables: Tables, first: DateLike, last: DateLike) -> DataFrame:
    """``report.doh_ratio`` of every as-of date: clear cases of the day and of the day before,
    each over the planned demand of the as-of date (NULL where that is 0 or missing)."""
    days_between(first, last)
    stock = tables.batch_inventory.filter(F.col("AvailableDate").between(lit_date(first, 1), lit_date(last)))
    daily = stock.groupBy(*KEYS, "AvailableDate").agg(F.sum(U.PALLET_STOCK["clear"]).alias("today"))
    daily = daily.withColumn("yesterday", F.first("today").over(_frame(KEYS, "AvailableDate", -1, -1)))
    daily = daily.filter(F.col("AvailableDate") >= lit_date(first))
    j = with_material_master(daily, tables, [U.UPP, U.UPC])
    plan = latest_plan(tables.demand_plan.filter(F.col("DATE").between(lit_date(first), lit_date(last)))).select(
        *KEYS, F.col("DATE").alias("AvailableDate"), F.col("ConsensusDemandPlan").alias("daily_demand_cases"))
    j = j.join(plan, [*KEYS, "AvailableDate"], "left")
    cases = {c: U.cases_defaulted(c) for c in ("today", "yesterday")}
    return j.select(F.col("AvailableDate").alias("as_of"), F.col("MaterialID").alias("material_id"), F.col("LocationID").alias("location_id"),
                    cases["today"].alias("clear_cases_today"), cases["yesterday"].alias("clear_cases_yesterday"), "daily_demand_cases",
                    F.try_divide(cases["today"], F.col("daily_demand_cases")).alias("doh_today"),
                    F.try_divide(cases["yesterday"], F.col("daily_demand_cases")).alias("doh_yesterday"))


def span(last: DateLike, days: int) -> tuple[dt.date, dt.date]:
    """(first, last) of the ``days`` as-of dates that end at ``last``."""
    return as_date(last) - dt.timedelta(days=days - 1), as_date(last)
