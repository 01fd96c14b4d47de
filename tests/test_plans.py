"""Plan shape: no Python in the plans, one stock scan, pushdown and pruning."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from holdcast.plans import catalog
from conftest import SF_SMALL
from holdcast.operators import holding, totals
from holdcast.schemas import BATCH_INVENTORY, DEMAND_PLAN, MATERIAL_HIERARCHY, Tables
from holdcast.sources import tables as src
from literal import AS_OF

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "PythonUDF")


def _executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _final(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_evaluation(spark, name):
    plan = catalog.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PYTHON_NODES), name


def test_holding_report_scans_stock_once(spark, tables_small):
    plan = _final(holding.holding_report(tables_small, AS_OF))
    assert plan.count("lineitem.parquet") == 1   # stock, one scan for three dates
    assert "SortMergeJoin" not in plan


def test_share_reuses_the_stock_shuffle(spark, tables_small):
    plan = _final(totals.weekly_share(tables_small))
    assert plan.count("lineitem.parquet") == 1
    assert "ReusedExchange" in plan


@pytest.fixture(scope="module")
def lake(spark, tables_small, tmp_path_factory):
    """The fixtures written as lake tables: stock flat, hierarchy partitioned by
    Year/Month/Day with a current and an old partition, plan as three archived
    snapshot folders."""
    root = tmp_path_factory.mktemp("lake")
    t = tables_small
    t.batch_inventory.write.parquet(str(root / "stock"))
    t.batch_inventory.write.partitionBy("AvailableDate").parquet(str(root / "stock_by_day"))
    h = t.material_hierarchy
    (h.withColumns({"Year": F.lit(9999), "Month": F.lit(12), "Day": F.lit(31)})
     .unionByName(h.limit(5).withColumns({"Year": F.lit(2024), "Month": F.lit(1), "Day": F.lit(1)}))
     .write.partitionBy("Year", "Month", "Day").parquet(str(root / "hierarchy")))
    for i, part in enumerate(t.demand_plan.randomSplit([1.0, 1.0, 1.0], seed=1)):
        part.write.parquet(str(root / "plan" / "archive" / "2025" / "01" / f"{i:02d}" / "apo_snp_35d"))
    return root


def test_filters_reach_the_parquet_scan(spark, tables_small, lake):
    stock = src.read_table(spark, str(lake / "stock"), schema=BATCH_INVENTORY)
    t = Tables(tables_small.material_master, tables_small.material_hierarchy, stock,
               tables_small.demand_plan, tables_small.order_tracking)
    df = holding.holding_report(t, AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(AvailableDate" in plan
    scan = [line for line in plan.splitlines() if "stock" in line and "ReadSchema" in line][0]
    read = scan.split("ReadSchema: ")[1]
    assert "batch_row_id" not in read and "InventoryStockBlocked" not in read
    got = df.select("material_id", "location_id", "clear_dollars").exceptAll(
        holding.holding_report(tables_small, AS_OF).select("material_id", "location_id", "clear_dollars"))
    assert got.count() == 0


def test_date_partitioned_stock_prunes_to_three_days(spark, tables_small, lake):
    stock = src.read_table(spark, str(lake / "stock_by_day"), schema=BATCH_INVENTORY)
    t = Tables(tables_small.material_master, tables_small.material_hierarchy, stock,
               tables_small.demand_plan, tables_small.order_tracking)
    df = holding.holding_report(t, AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "AvailableDate" in plan.split("PartitionFilters: [")[1][:300]
    got = df.select("material_id", "location_id", "clear_dollars", "wow_clear_pct")
    want = holding.holding_report(tables_small, AS_OF).select(got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_current_partition_is_pruned(spark, tables_small, lake):
    h = src.read_current_partition(spark, str(lake / "hierarchy"), schema=MATERIAL_HIERARCHY)
    assert h.count() == tables_small.material_hierarchy.count()
    # Only the partition's own path is loaded, so there is no other to prune.
    assert "PartitionFilters: []" in h._jdf.queryExecution().executedPlan().toString()
    assert {os.path.dirname(f).split("hierarchy/")[1] for f in h.inputFiles()} == {"Year=9999/Month=12/Day=31"}


def test_snapshot_archive_reads_all_snapshots(spark, tables_small, lake):
    p = src.read_snapshot_archive(spark, str(lake / "plan" / "archive"), "apo_snp_35d",
                                  schema=DEMAND_PLAN)
    assert p.count() == tables_small.demand_plan.count()


def test_write_report_replaces_only_its_dates(spark, tables_small, tmp_path):
    out = str(tmp_path / "report")
    day1 = holding.daily_holding(tables_small, AS_OF)
    day0 = holding.daily_holding(tables_small, AS_OF - dt.timedelta(days=1))
    src.write_report(day0, out, partition_by=["date"])
    src.write_report(day1, out, partition_by=["date"])
    src.write_report(day1, out, partition_by=["date"])   # rerun of the same date
    back = spark.read.parquet(out)
    assert back.count() == day0.count() + day1.count()
    assert sorted(d for d in os.listdir(out) if d.startswith("date=")) == [
        "date=2025-01-11", "date=2025-01-12"]


def test_views_serve_spark_sql(spark, tables_small):
    src.register_views(tables_small, suffix="_v")
    got = spark.sql("""
        SELECT b.MaterialID, COUNT(*) AS n FROM batch_inventory_actual_v b
        LEFT JOIN material_master_v m ON m.MaterialID = b.MaterialID GROUP BY b.MaterialID""")
    assert got.count() == tables_small.batch_inventory.select("MaterialID").distinct().count()


def test_business_filter_ands_its_conditions(spark, tables_small):
    from holdcast.operators import report
    w = report.weekly_with_hierarchy(tables_small)
    one = w.select("material_id", "location_id", "Network").first()
    got = report.filter_holdings(w, material=one["material_id"], location=one["location_id"],
                                 network=one["Network"])
    rows = got.collect()
    assert rows and all(r["material_id"] == one["material_id"] and r["location_id"] == one["location_id"]
                        for r in rows)
    assert report.filter_holdings(w, network="NO SUCH NETWORK").count() == 0
    assert report.filter_holdings(w).count() == w.count()   # no condition: unfiltered


def test_read_table_passes_reader_options(spark, tables_small, tmp_path):
    path = str(tmp_path / "master_csv")
    tables_small.material_master.write.option("header", "true").csv(path)
    from holdcast.schemas import MATERIAL_MASTER
    df = src.read_table(spark, path, fmt="csv", schema=MATERIAL_MASTER,
                        options={"header": "true", "inferSchema": "true"})
    assert df.schema == MATERIAL_MASTER or [f.dataType for f in df.schema] == [
        f.dataType for f in MATERIAL_MASTER]
    assert df.count() == tables_small.material_master.count()


def test_snapshot_archive_of_some_days(spark, tables_small, tmp_path):
    days = [dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 3)]
    parts = tables_small.demand_plan.randomSplit([1.0, 1.0, 1.0], seed=1)
    for d, part in zip(days, parts):
        part.write.parquet(str(tmp_path / f"{d:%Y/%m/%d}" / "apo_snp_35d"))
    p = src.read_snapshot_archive(spark, str(tmp_path), "apo_snp_35d", schema=DEMAND_PLAN,
                                  days=[*days[1:], dt.date(2025, 1, 9)])
    assert p.count() == parts[1].count() + parts[2].count()
    assert {f.split("2025/01/")[1][:2] for f in p.inputFiles()} == {"02", "03"}


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_planned_keys_read_the_plan_once(spark, tables_small, broadcast):
    from holdcast.operators import onhand
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plan = _final(onhand.on_hand_join(tables_small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scans = [line for line in plan.splitlines() if "lineitem.parquet" in line and "ReadSchema" in line]
    assert len(scans) == 3 and "ReusedExchange" in plan   # plan, stock, and the stock's key columns alone
    assert min(s.split("ReadSchema: ")[1].count(":") for s in scans) == 2


def test_views_have_the_script_names(spark, tables_small):
    src.register_views(tables_small)
    for name in src.VIEW_NAMES.values():
        assert spark.table(name).columns


def test_hierarchy_filter_comes_before_the_sums(spark, tables_small):
    """Rows that reach the sums fall with the filter, and the result is that of filtering afterwards."""
    from holdcast.operators import report
    t = tables_small
    rows = t.batch_inventory.count()

    def summed(df):
        """Rows that the semi join lets through to the first aggregate, in the final plan."""
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        found, todo = [], [plan]
        while todo:
            node = todo.pop()
            todo += [getattr(node, name)() for name in ("finalPhysicalPlan", "plan") if node.nodeName() in {"AdaptiveSparkPlan"} and name == "finalPhysicalPlan"
                     or name == "plan" and "QueryStage" in node.nodeName()]
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
            if "Join" in node.nodeName() and "LeftSemi" in node.verboseStringWithOperatorId():
                found.append(node.metrics().apply("numOutputRows").value())
        return found

    for filters in ({"network": "AMBIENT"}, {"network": "AMBIENT", "division": "no such"}, {"location": 5001, "network": "CHILLED"}, {"material": "11000002"}, {}):
        want = report.filter_holdings(report.weekly_with_hierarchy(t), **filters)
        got = report.filtered_weekly(t, **filters)
        cut = lambda df: df.select([F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])
        assert got.columns == want.columns and got.count() == want.count()
        assert cut(got).exceptAll(cut(want)).count() == 0
    ambient = t.batch_inventory.join(t.material_hierarchy.filter("Network = 'AMBIENT'"), "MaterialID", "left_semi").count()
    assert summed(report.filtered_weekly(t, network="AMBIENT")) == [ambient] and 0 < ambient < rows
    assert summed(report.filtered_weekly(t, network="no such")) in ([0], [])


def test_wide_report_moves_no_day_sums(spark, tables_oracle):
    """Day sums in buckets of (material, location): the bias join and the week window need no exchange of them."""
    from holdcast.operators import report
    from holdcast.plans.stage import bucketed, co_partitioned
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")}
    plain = report.wide_report_aligned(tables_oracle, AS_OF)
    sums = bucketed(totals.stock_day_sums(tables_oracle), "test_day_sums", totals.KEYS, 8)
    try:
        co_partitioned(spark)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200k")     # the master is broadcast, the bias rows are not
        df = report.wide_report_aligned(tables_oracle, AS_OF, day_sums=sums)
        rows = df.count()
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    assert any("SortMergeJoin [material_id" in x for x in lines) and any("Window" in x for x in lines)
    scans = [i for i, x in enumerate(lines) if "test_day_sums" in x and "FileScan" in x]
    assert scans
    for i in scans:
        at, above = depth(lines[i]), []
        for x in reversed(lines[:i]):
            if depth(x) < at:
                at = depth(x)
                above.append(x)
                if "HashAggregate" in x:           # day or week totals from here on: partial sums, not day sums
                    break
        assert not [x for x in above if "Exchange hashpartitioning" in x or "Exchange Round" in x], above
    assert rows == plain.count()
