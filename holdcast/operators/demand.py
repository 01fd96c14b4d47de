"""Latest demand plan, actuals and forecast bias.

Latest plan: the reference ranks plan rows with ``ROW_NUMBER`` per
(DATE, location, material) by snapshot and modification date and keeps rank 1.
Here it is ``max(struct(order..., payload...))`` in a ``groupBy``: an
aggregate, so it is partially computed map-side and a key with many archived
snapshots is reduced before the shuffle instead of being sorted in one task.
The struct order is total, so the pick is deterministic.

28-day bias as written joins order lines to the latest plan on (date,
material) without location, so each line meets every location's plan row and
the plan value is summed once per line. ``bias_28d`` computes the same numbers
without that fan-out: lines are summed and counted per (date, material) first,
then ``total_demand = demand * lines``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdcast.functions.dates import DateLike, between_days, since
from holdcast.functions.ratios import bias, round_half_up
from holdcast.schemas import Tables

PLAN_KEYS = ["DATE", "LocationID", "MaterialID"]
# Ranking order of plan rows, most recent first. SnapshotDate and Modified_date
# are the reference's; the rest break its ties so the result is deterministic.
PLAN_ORDER = ["SnapshotDate", "Modified_date", "ConsensusDemandPlan",
              "SalesActualCustomerOrders", "DependentDemand"]
PLAN_PAYLOAD = ["ConsensusDemandPlan", "SalesActualCustomerOrders", "DependentDemand"]


def latest_rows(plan: DataFrame) -> DataFrame:
    """The latest row per (DATE, LocationID, MaterialID) with the columns that rank it.

    A maximum: the latest rows of two parts of a plan give those of the whole.
    """
    top = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(PLAN_ORDER)]))
    g = plan.groupBy(*PLAN_KEYS).agg(top.alias("top"))
    return g.select(*PLAN_KEYS, *[F.col(f"top.o{i}").alias(c) for i, c in enumerate(PLAN_ORDER)])


def latest_plan(plan: DataFrame) -> DataFrame:
    """One plan row per (DATE, LocationID, MaterialID): the latest snapshot."""
    return latest_rows(plan).select(*PLAN_KEYS, *PLAN_PAYLOAD)


def demand_quantity(plan: DataFrame) -> DataFrame:
    """Latest plan with Demand_Quantity_Cases = plan + customer orders + dependent
    demand (NULL when any part is NULL)."""
    lp = latest_plan(plan)
    return lp.withColumn("Demand_Quantity_Cases", F.col("ConsensusDemandPlan")
                         + F.col("SalesActualCustomerOrders") + F.col("DependentDemand"))


def material_id_from_number(c: str = "MaterialNumber") -> F.Column:
    """Last eight characters of the order line's material number (whole text if shorter)."""
    return F.substring(F.col(c), -8, 8)


def order_lines(tables: Tables) -> DataFrame:
    """Order lines as (DATE = goods issue date, MaterialID, actual cases, confirmed)."""
    return tables.order_tracking.select(
        F.col("GoodsIssueDate").alias("DATE"),
        material_id_from_number().alias("MaterialID"),
        F.col("ActualQuantityDeliveredInSalesUnits").alias("Actual_Quantity_Cases"),
        F.col("ConfirmedQuantity"),
    )


def actuals_by_day(tables: Tables, as_of: DateLike, days: int = 28) -> DataFrame:
    """Order lines of the trailing window summed and counted per (DATE, MaterialID)."""
    lines = order_lines(tables).filter(since("DATE", as_of, days))
    return lines.groupBy("DATE", "MaterialID").agg(
        F.sum("Actual_Quantity_Cases").alias("Total_Actual_Quantity_Cases"),
        F.count(F.lit(1)).alias("order_lines"))


def actual_plan_join(tables: Tables, as_of: DateLike, days: int = 28) -> DataFrame:
    """Actuals per (DATE, material) left-joined to each location's latest plan."""
    a = actuals_by_day(tables, as_of, days)
    plan = tables.demand_plan.filter(since("DATE", as_of, days))
    p = demand_quantity(plan).select("DATE", "MaterialID", "LocationID", "Demand_Quantity_Cases")
    return a.join(p, ["DATE", "MaterialID"], "left")


def bias_28d(tables: Tables, as_of: DateLike, days: int = 28) -> DataFrame:
    """Bias per (DATE, LocationID, MaterialID) as the SQL script defines it."""
    j = actual_plan_join(tables, as_of, days)
    demand = F.col("Demand_Quantity_Cases") * F.col("order_lines")
    return j.select(
        "DATE", "LocationID", "MaterialID", "Total_Actual_Quantity_Cases",
        demand.alias("Total_Demand_Quantity_Cases"),
        bias(demand, F.col("Total_Actual_Quantity_Cases")).alias("Bias_Perc"))


def bias_28d_aligned(tables: Tables, as_of: DateLike, days: int = 28,
                     absolute: bool = True) -> DataFrame:
    """Bias per (DATE, MaterialID): actuals and plan each summed to that grain
    first, so no value is repeated. ``absolute=False`` keeps the sign."""
    a = actuals_by_day(tables, as_of, days)
    plan = tables.demand_plan.filter(since("DATE", as_of, days))
    p = demand_quantity(plan).groupBy("DATE", "MaterialID").agg(
        F.sum("Demand_Quantity_Cases").alias("Total_Demand_Quantity_Cases"))
    j = a.join(p, ["DATE", "MaterialID"], "left")
    name = "Bias_Perc" if absolute else "Bias"
    return j.select("DATE", "MaterialID", "Total_Actual_Quantity_Cases",
                    "Total_Demand_Quantity_Cases",
                    bias(F.col("Total_Demand_Quantity_Cases"), F.col("Total_Actual_Quantity_Cases"),
                         absolute=absolute).alias(name))


def bias_signed(tables: Tables, as_of: DateLike, days: int = 28) -> DataFrame:
    """(sum demand - sum actual) / sum actual per (DATE, MaterialID), signed."""
    return bias_28d_aligned(tables, as_of, days, absolute=False)


def demand_forecast_90d(tables: Tables, as_of: DateLike, days: int = 90) -> DataFrame:
    """Plan summed per (DATE, material, location) over all snapshots taken in
    the trailing window (the notebook's form)."""
    p = tables.demand_plan.filter(since("SnapshotDate", as_of, days))
    return p.groupBy("DATE", "MaterialID", "LocationID").agg(
        F.sum("ConsensusDemandPlan").alias("DemandForecast"))


def actual_demand(tables: Tables) -> DataFrame:
    """Confirmed quantity summed per material over all order lines."""
    return order_lines(tables).groupBy("MaterialID").agg(
        F.sum("ConfirmedQuantity").alias("ActualDemand"))


def bias_90d(tables: Tables, as_of: DateLike, days: int = 90) -> DataFrame:
    """round(|(forecast - actual) / actual|, 3), NULL forecast or actual read as 0
    and a NULL divisor as 1; a zero actual gives NULL."""
    f = demand_forecast_90d(tables, as_of, days)
    a = actual_demand(tables)
    j = f.join(a, "MaterialID", "left")
    fc = F.coalesce(F.col("DemandForecast"), F.lit(0.0))
    ac = F.coalesce(F.col("ActualDemand"), F.lit(0.0))
    b = F.round(F.abs(F.try_divide(fc - ac, F.coalesce(F.col("ActualDemand"), F.lit(1.0)))), 3)
    return j.select("DATE", "LocationID", "MaterialID", "DemandForecast", "ActualDemand",
                    b.alias("Bias"))


def bias_90d_aligned(tables: Tables, as_of: DateLike, days: int = 90) -> DataFrame:
    """Per material over planned/issue days in [as_of - days, as_of]: latest
    plan only (no snapshot double counting) against actuals of the same days."""
    plan = tables.demand_plan.filter(between_days("DATE", as_of, days))
    f = latest_plan(plan).groupBy("MaterialID").agg(
        F.sum("ConsensusDemandPlan").alias("DemandForecast"))
    lines = order_lines(tables).filter(between_days("DATE", as_of, days))
    a = lines.groupBy("MaterialID").agg(F.sum("ConfirmedQuantity").alias("ActualDemand"))
    j = f.join(a, "MaterialID", "left")
    fc = F.coalesce(F.col("DemandForecast"), F.lit(0.0))
    return j.select("MaterialID", "DemandForecast", "ActualDemand",
                    round_half_up(bias(fc, F.col("ActualDemand")), 3).alias("Bias"))
