"""Ranges of as-of dates equal the single-date functions, one scan each, gaps and year ends included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from holdcast.operators import demand, holding, report, rolling
from holdcast.schemas import BATCH_INVENTORY, Tables
from holdcast.sources.tables import read_mixed_folders
from literal import AS_OF, by_key, day, stock_row, tables


def _equal(got, want, keys):
    a, b = by_key(got, *keys), by_key(want, *keys)
    assert set(a) == set(b) and a
    for k in a:
        for c, v in a[k].items():
            if c in b[k]:
                w = b[k][c]
                assert v == w or isinstance(v, float) and v == pytest.approx(w, rel=1e-9, abs=1e-9), (k, c, v, w)


@pytest.mark.parametrize("back", [0, 3, 13])
def test_holding_history_equals_each_report(tables_small, back):
    d = day(back)
    got = rolling.holding_history(tables_small, day(13), AS_OF).filter(F.col("as_of") == F.lit(d))
    _equal(got, holding.holding_report(tables_small, d), ["material_id", "location_id"])
    ratio = rolling.doh_ratio_history(tables_small, day(13), AS_OF).filter(F.col("as_of") == F.lit(d))
    _equal(ratio, report.doh_ratio(tables_small, d), ["material_id", "location_id"])


@pytest.mark.parametrize("ahead", [-30, 0, 25, 80])
def test_bias_ranges_equal_each_date(tables_small, ahead):
    d, t = AS_OF + dt.timedelta(days=ahead), tables_small
    first, last = AS_OF - dt.timedelta(days=30), AS_OF + dt.timedelta(days=80)
    on = lambda df: df.filter(F.col("as_of") == F.lit(d)).drop("as_of")
    want = demand.bias_90d_aligned(t, d)
    if want.isEmpty():
        assert on(rolling.bias_90d_aligned_range(t, first, last)).isEmpty()
    else:
        _equal(on(rolling.bias_90d_aligned_range(t, first, last)), want, ["MaterialID"])
    want = demand.bias_90d(t, d)
    got = on(rolling.bias_90d_range(t, first, last))
    if want.isEmpty():
        assert got.isEmpty()
    else:
        _equal(got, want, ["DATE", "MaterialID", "LocationID"])


def test_a_gap_of_days_is_no_earlier_row(spark):
    """Stock eight days and one day before: neither is last week; seven days before the middle one is."""
    t = tables(spark, stock=[stock_row("m", 1, 8, 5.0, day_count=3), stock_row("m", 1, 1, 7.0, day_count=2), stock_row("m", 1, 1, 1.0, day_count=9),
                             stock_row("m", 1, 0, 4.0), stock_row("m", 2, 7, 2.0), stock_row("m", 2, 0, 3.0)])
    got = by_key(rolling.holding_history(t, day(9), AS_OF), "location_id", "as_of")
    assert set(got) == {(1, day(8)), (1, day(1)), (1, AS_OF), (2, day(7)), (2, AS_OF)}
    assert got[1, AS_OF]["last_week_clear_pallets"] == 0.0 and got[1, AS_OF]["wow_clear_pct"] == 0.0
    assert got[1, day(1)]["last_week_clear_pallets"] == 5.0 and got[1, day(1)]["wow_clear_pct"] == pytest.approx(60.0)
    assert got[1, AS_OF]["doh_yesterday"] == 9 and got[1, day(1)]["doh_yesterday"] == 0
    assert got[2, AS_OF]["last_week_clear_pallets"] == 2.0


def test_trailing_window_is_dense_and_ends(spark):
    """One order line counts on its day and the 28 days after it, whether they have rows or not."""
    t = tables(spark, orders=[{"MaterialNumber": "0011000001", "GoodsIssueDate": day(40), "ActualQuantityDeliveredInSalesUnits": 4.0},
                              {"MaterialNumber": "0011000001", "GoodsIssueDate": day(20), "ActualQuantityDeliveredInSalesUnits": None},
                              {"MaterialNumber": "0011000002", "GoodsIssueDate": None, "ActualQuantityDeliveredInSalesUnits": 1.0}],
               plan=[{"DATE": day(40), "LocationID": 1, "MaterialID": "11000001", "SnapshotDate": day(41), "ConsensusDemandPlan": 5.0,
                      "SalesActualCustomerOrders": 1.0, "DependentDemand": 0.0}])
    got = by_key(rolling.bias_28d_trailing(t, day(60), AS_OF + dt.timedelta(days=30)), "as_of")
    assert set(got) == {(day(i),) for i in range(-8, 41)}
    assert got[day(12),]["Total_Actual_Quantity_Cases"] == 4.0 and got[day(12),]["Bias_Perc"] == pytest.approx(0.5)
    assert got[day(11),]["Total_Actual_Quantity_Cases"] is None and got[day(11),]["Total_Demand_Quantity_Cases"] is None
    signed = by_key(rolling.bias_28d_trailing(t, day(40), day(40), absolute=False), "as_of")
    assert signed[day(40),]["Bias"] == pytest.approx(0.5)


def test_one_scan_of_each_input(spark, tables_oracle, tmp_path):
    t = tables_oracle
    stock = str(tmp_path / "stock")
    t.batch_inventory.write.parquet(stock)
    lake = Tables(t.material_master, t.material_hierarchy, spark.read.parquet(stock), t.demand_plan, t.order_tracking)
    plan = rolling.holding_history(lake, day(27), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/stock]") == 1 and "GreaterThanOrEqual(AvailableDate" in plan and "Python" not in plan
    plans = str(tmp_path / "plan")
    t.demand_plan.write.parquet(plans)
    lake = Tables(t.material_master, t.material_hierarchy, t.batch_inventory, spark.read.parquet(plans), t.order_tracking)
    for df in (rolling.bias_28d_trailing(lake, day(27), AS_OF), rolling.bias_90d_range(lake, day(27), AS_OF)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("/plan]") == 1 and "Python" not in plan


def test_a_range_must_not_end_before_it_begins(tables_small):
    with pytest.raises(ValueError):
        rolling.holding_history(tables_small, AS_OF, day(1))


# ---- folders whose types differ ----

def test_mixed_folders_push_filters_to_the_date_group(spark, tables_small, tmp_path):
    stock = tables_small.batch_inventory
    stock.write.parquet(str(tmp_path / "dates"))
    stock.withColumn("AvailableDate", F.col("AvailableDate").cast("string")).write.parquet(str(tmp_path / "text"))
    df = read_mixed_folders(spark, [str(tmp_path / "dates"), str(tmp_path / "text")], BATCH_INVENTORY)
    assert df.schema == BATCH_INVENTORY and df.count() == 2 * stock.count()
    one = df.filter(F.col("AvailableDate") == F.lit(AS_OF))
    assert one.count() == 2 * stock.filter(F.col("AvailableDate") == F.lit(AS_OF)).count() > 0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(AvailableDate," in plan and plan.count("FileScan parquet") == 2


def test_mixed_folders_refuse_what_would_lose_values(spark, tables_small, tmp_path):
    stock = tables_small.batch_inventory.limit(5)
    stock.withColumn("Day", F.col("Day") + F.lit(0.5)).write.parquet(str(tmp_path / "fractions"))
    with pytest.raises(ValueError, match="fractions: Day is double"):
        read_mixed_folders(spark, [str(tmp_path / "fractions")], BATCH_INVENTORY)
    stock.drop("Day").write.parquet(str(tmp_path / "without"))
    with pytest.raises(ValueError, match="without: column Day is missing"):
        read_mixed_folders(spark, [str(tmp_path / "without")], BATCH_INVENTORY)
    stock.withColumn("AvailableDate", F.lit("soon")).write.parquet(str(tmp_path / "words"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_mixed_folders(spark, [str(tmp_path / "words")], BATCH_INVENTORY).collect()
    assert read_mixed_folders(spark, [], BATCH_INVENTORY).schema == BATCH_INVENTORY
