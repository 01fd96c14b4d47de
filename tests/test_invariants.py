"""Invariants that must hold whatever the data (sf0.01 fixtures)."""

import pytest
from pyspark.sql import functions as F

from holdcast.operators import demand, holding, report, totals
from holdcast.schemas import Tables
from literal import AS_OF


def _unique(df, keys):
    return df.groupBy(*keys).count().filter("count > 1").count() == 0


def test_unique_keys(tables_oracle):
    t = tables_oracle
    assert _unique(demand.latest_plan(t.demand_plan), ["DATE", "LocationID", "MaterialID"])
    assert _unique(holding.holding_report(t, AS_OF), ["material_id", "location_id"])
    assert _unique(demand.bias_28d_aligned(t, AS_OF), ["DATE", "MaterialID"])
    assert _unique(demand.bias_90d_aligned(t, AS_OF), ["MaterialID"])
    assert _unique(report.wide_report_aligned(t, AS_OF), ["material_id", "location_id", "day"])


def test_weekly_shares_sum_to_100(tables_oracle):
    ws = totals.weekly_share(tables_oracle)
    for unit in ("pallets", "cases", "dollars"):
        parts = [F.col(f"{s}_{unit}_weekly_pct") for s in ("clear", "blocked", "restricted")]
        sums = (ws.filter(parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull())
                .groupBy("year", "week").agg(F.sum(parts[0] + parts[1] + parts[2]).alias("s"))
                .collect())
        assert sums and all(r["s"] == pytest.approx(100.0, abs=1e-6) for r in sums), unit


def test_daily_sums_reaggregate_to_weekly(tables_oracle):
    d = totals.daily_inventory(tables_oracle).withColumns(
        {"year": F.year("day"), "week": F.weekofyear("day")})
    re = d.groupBy("material_id", "location_id", "year", "week").agg(
        F.sum("clear_pallets_daily").alias("c"), F.sum("restricted_pallets_daily").alias("r"))
    w = totals.weekly_inventory(tables_oracle)
    j = re.join(w, ["material_id", "location_id", "year", "week"], "full")
    bad = j.filter((F.abs(F.col("c") - F.col("clear_pallets_weekly")) > 1e-9)
                   | (F.abs(F.col("r") - F.col("restricted_pallets_weekly")) > 1e-9)
                   | F.col("c").isNull() | F.col("clear_pallets_weekly").isNull())
    assert bad.count() == 0


def test_row_order_does_not_change_results(spark, tables_oracle):
    t = tables_oracle
    shuffled = Tables(t.material_master.orderBy(F.rand(7)), t.material_hierarchy,
                      t.batch_inventory.repartition(13).orderBy(F.rand(3)),
                      t.demand_plan.repartition(11).orderBy(F.rand(5)), t.order_tracking.orderBy(F.rand(9)))
    for fn in (lambda x: holding.holding_report(x, AS_OF), lambda x: demand.bias_28d(x, AS_OF),
               lambda x: demand.latest_plan(x.demand_plan)):
        a = fn(t).select([F.round(c, 6).alias(c) if dtype == "double" else F.col(c)
                          for c, dtype in fn(t).dtypes])
        b = fn(shuffled).select(a.columns)
        b = b.select([F.round(c, 6).alias(c) if dtype == "double" else F.col(c) for c, dtype in b.dtypes])
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bias_28d_rewrite_equals_line_level_join(tables_oracle):
    """The pre-aggregated bias equals joining every order line to every location's plan."""
    t = tables_oracle
    lines = demand.order_lines(t).filter(F.col("DATE") >= F.date_sub(F.lit(AS_OF), 28))
    plan = demand.demand_quantity(t.demand_plan)
    j = lines.join(plan.select("DATE", "MaterialID", "LocationID", "Demand_Quantity_Cases"),
                   ["DATE", "MaterialID"], "left")
    brute = j.groupBy("DATE", "LocationID", "MaterialID").agg(
        F.sum("Actual_Quantity_Cases").alias("a"), F.sum("Demand_Quantity_Cases").alias("d"))
    fast = demand.bias_28d(t, AS_OF)
    joined = brute.alias("b").join(
        fast.alias("f"),
        (F.col("b.DATE") == F.col("f.DATE")) & (F.col("b.MaterialID") == F.col("f.MaterialID"))
        & F.col("b.LocationID").eqNullSafe(F.col("f.LocationID")), "full")
    bad = joined.filter(
        F.col("b.DATE").isNull() | F.col("f.DATE").isNull()
        | ~F.col("b.a").eqNullSafe(F.col("f.Total_Actual_Quantity_Cases"))
        | ~F.coalesce(F.abs(F.col("b.d") - F.col("f.Total_Demand_Quantity_Cases")) < 1e-6,
                      F.col("b.d").isNull() & F.col("f.Total_Demand_Quantity_Cases").isNull()))
    assert bad.count() == 0
