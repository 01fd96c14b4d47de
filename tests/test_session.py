"""The folder of intermediates: on a cluster, without a checkpoint folder, and where machines do not share it."""

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark import SparkConf
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter

from holdcast import session
from holdcast.plans import catalog
from holdcast.schemas import MATERIAL_HIERARCHY
from literal import AS_OF, day, stock_row, tables


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session as one of a standalone cluster with a ``file:`` checkpoint folder."""
    assert session.checkpoint_dir(spark).startswith("file:")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(session, "_SHARED", set())
    return spark


@pytest.mark.parametrize("name", ["lake_hierarchy_current", "lake_stock_mixed", "weekly_share_kept"])
def test_lake_queries_run_on_a_cluster_with_a_shared_mount(cluster, tables_small, name):
    assert catalog.run_on(name, tables_small).count() > 0


def test_a_folder_that_machines_do_not_share_is_refused(cluster, monkeypatch):
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: real(cluster.range(3).write, path))   # of the tasks, 3 wrote here
    for _ in range(2):
        with pytest.raises(RuntimeError, match="not shared"):
            session.checkpoint_dir(cluster)


def test_a_folder_is_tried_once(cluster, monkeypatch):
    session.checkpoint_dir(cluster)
    monkeypatch.setattr(DataFrameWriter, "parquet", None)
    session.checkpoint_dir(cluster)


def test_without_a_checkpoint_folder_the_warehouse_serves(spark, tables_small, monkeypatch, tmp_path):
    warehouse = f"file:{tmp_path}"
    real = type(spark.conf).get
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    monkeypatch.setattr(spark.sparkContext, "getConf", lambda: SparkConf(loadDefaults=False))
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a: warehouse if key == "spark.sql.warehouse.dir" else real(self, key, *a))
    rows = catalog.run_on("lake_hierarchy_current", tables_small)
    assert rows.count() == tables_small.material_hierarchy.count()
    assert all(f.startswith(f"file://{tmp_path}/_holdcast/") for f in rows.inputFiles())


@pytest.mark.parametrize("fault", ["not shared", "not writable"])
def test_a_named_folder_that_fails_gives_way_to_the_warehouse(cluster, tables_small, monkeypatch, tmp_path, fault):
    named, warehouse = cluster.sparkContext.getCheckpointDir(), f"file:{tmp_path}"
    real, conf = DataFrameWriter.parquet, type(cluster.conf).get

    def write(self, path, *a, **b):
        if path.startswith(f"{named}/holdcast-trial-"):
            if fault == "not writable":
                raise PySparkException("Mkdirs failed")
            self = cluster.range(3).write                    # of the tasks, 3 wrote here
        return real(self, path, *a, **b)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    monkeypatch.setattr(type(cluster.conf), "get", lambda self, key, *a: warehouse if key == "spark.sql.warehouse.dir" else conf(self, key, *a))
    try:
        with pytest.warns(UserWarning, match="used instead"):
            rows = catalog.run_on("lake_hierarchy_current", tables_small)
        assert rows.count() == tables_small.material_hierarchy.count()
        assert all(f.startswith(f"file://{tmp_path}/_holdcast/") for f in rows.inputFiles())
        monkeypatch.setattr(DataFrameWriter, "parquet", None)      # no further trial
        assert session.checkpoint_dir(cluster).startswith(f"{warehouse}/_holdcast/")
    finally:
        cluster.sparkContext.setCheckpointDir(named)


@pytest.mark.parametrize("name", ["lake_hierarchy_current", "lake_hierarchy_as_of", "lake_plan_archive_days", "lake_report_rewritten",
                                  "lake_stock_mixed", "latest_plan_kept"])
def test_the_folders_of_lake_queries_go_at_the_end(spark, tables_small, name):
    found = catalog.run_on(name, tables_small).inputFiles()[0]
    folder = spark._jvm.org.apache.hadoop.fs.Path(re.match(r".*/holdcast-lake-[a-z]+-[0-9a-f]{32}", found)[0])
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.cancelDeleteOnExit(folder)                      # true if it was noted
    fs.deleteOnExit(folder)


@pytest.fixture(params=["a shared mount", "each its own disk"])
def place(cluster, monkeypatch, tmp_path, request):
    """Where a cluster's queries must write: the named folder if it is a mount of all machines, else the warehouse."""
    named = cluster.sparkContext.getCheckpointDir()
    if request.param == "a shared mount":
        yield named
        return
    real, conf = DataFrameWriter.parquet, type(cluster.conf).get

    def write(self, path, *a, **b):
        if path.startswith(f"{named}/holdcast-trial-"):
            self = cluster.range(3).write                    # of the tasks, 3 wrote on the driver's machine
        return real(self, path, *a, **b)

    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    monkeypatch.setattr(type(cluster.conf), "get", lambda self, key, *a: f"file:{tmp_path}" if key == "spark.sql.warehouse.dir" else conf(self, key, *a))
    yield f"file:{tmp_path}/_holdcast"
    cluster.sparkContext.setCheckpointDir(named)


def _rows(df, at=None):
    """The rows of ``df`` as a multiset, all read from files below ``at``."""
    if at is not None:
        files = [re.sub("^file:/+", "file:/", f) for f in df.inputFiles()]
        assert files and all(f.startswith(f"{at}/") for f in files)
    return Counter(map(tuple, df.collect()))


def test_f3_the_current_hierarchy_is_whole_on_a_cluster(cluster, place):
    number = ["M1", "M2", "M2", None]                        # keys may repeat or be missing
    t = tables(cluster, hierarchy=[{"MaterialID": m, "Division": f"d{i}", "Network": "AMBIENT", "ProductLevel3CategoryID": None}
                                   for i, m in enumerate(number)])
    assert _rows(catalog.run_on("lake_hierarchy_current", t), place) == _rows(t.material_hierarchy)


def test_f3_a_hierarchy_without_rows_is_read_back(spark):
    got = catalog.run_on("lake_hierarchy_current", tables(spark))
    assert got.schema == MATERIAL_HIERARCHY and got.count() == 0


def test_f4_the_days_of_an_archive_are_whole_on_a_cluster(cluster, place):
    snapshots = [6, 7, 13, 20, 21, 26, 27, 28, 127]          # days before the as-of date, some in weeks that are not asked for
    t = tables(cluster, plan=[{"DATE": day(i), "LocationID": i, "MaterialID": m, "SnapshotDate": day(i), "Modified_date": day(i),
                               "ConsensusDemandPlan": float(i)} for i in snapshots for m in ("M1", "M2", "M2", None)])
    asked = {d + dt.timedelta(days=i) for d in (dt.date(2024, 12, 16), dt.date(2024, 12, 23), dt.date(2025, 1, 6)) for i in range(7)}
    got = catalog.run_on("lake_plan_archive_days", t)
    want = t.demand_plan.filter(t.demand_plan.SnapshotDate.isin(asked))
    assert 0 < want.count() < t.demand_plan.count()
    assert _rows(got, place) == _rows(want)


def test_f4_snapshots_without_a_date_are_delivered_too(spark):
    rows = [{"DATE": d, "LocationID": 1, "MaterialID": m, "SnapshotDate": snapshot, "Modified_date": snapshot, "ConsensusDemandPlan": 1.0,
             "SalesActualCustomerOrders": 1.0} for m in ("M1", None) for d, snapshot in [*((day(i), day(i)) for i in (3, 10, 17, 24)), (day(2), None), (None, None)]]
    t = tables(spark, plan=rows)
    assert catalog.run_on("lake_plan_archive_days", t).count() == 6        # of the weeks that are asked for
    assert _rows(catalog.run_on("latest_plan_kept", t)) == _rows(catalog.run_on("latest_plan", t))


def test_f5_a_rewritten_report_is_whole_on_a_cluster(cluster, place):
    stock = [stock_row(m, i % 2, i, clear=float(i), restricted=1.0) for i in (0, 1, 6, 7, 8, 20) for m in ("M1", "M1", "M2", None)]
    t = tables(cluster, master=[{"MaterialID": "M1", "ProductPlanningUnitsPerPallet": 10, "ProductPlanningUnitsPerCase": 3}],
               stock=[*stock, stock_row("M1", 1, 0, clear=2.0, SnapshotDate=None)])
    got = catalog.run_on("lake_report_rewritten", t)
    assert _rows(got, place) == _rows(catalog.run_on("daily_share", t))


@pytest.mark.parametrize("stock", [[], [stock_row("M1", 1, 0, clear=2.0, SnapshotDate=None)]], ids=["no rows", "no dates"])
def test_f5_a_report_without_days_is_read_back(spark, stock):
    t = tables(spark, stock=stock)
    got, want = catalog.run_on("lake_report_rewritten", t), catalog.run_on("daily_share", t)
    assert got.dtypes == want.dtypes and _rows(got) == _rows(want)


def test_f6_mixed_stock_is_whole_on_a_cluster(cluster, place):
    rows = [stock_row(f"M{i}", 1, offset, clear=1.0, blocked=float(i), day_count=i) for i in range(9) for offset in (0, 0, 1)]
    t = tables(cluster, stock=[*rows, stock_row(None, 1, 0, clear=1.0)])
    got = catalog.run_on("lake_stock_mixed", t)
    assert _rows(got, place) == _rows(t.batch_inventory.filter(t.batch_inventory.AvailableDate == AS_OF))


def test_f6_numbers_that_no_narrower_type_holds_stay_whole(spark):
    odd = [2.5, 3e9, float("inf"), -1e300, 7.0]
    stock = [stock_row(f"M{i}", 1, 0, blocked=b, day_count=n) for i in range(9) for b in odd for n in (3, 32_768, -40_000, None)]
    t = tables(spark, stock=stock)
    assert _rows(catalog.run_on("lake_stock_mixed", t)) == _rows(t.batch_inventory)
