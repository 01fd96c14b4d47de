"""The daily job end to end on lake-shaped folders (sf0.001 fixtures)."""

import datetime as dt
import time

from pyspark.sql import functions as F

from holdcast.operators import holding
from holdcast.plans import job
from literal import AS_OF


def _lake(spark, t, root):
    t.material_master.write.parquet(str(root / "master"))
    (t.material_hierarchy.withColumns({"Year": F.lit(9999), "Month": F.lit(12), "Day": F.lit(31)})
     .write.partitionBy("Year", "Month", "Day").parquet(str(root / "hierarchy")))
    t.batch_inventory.write.parquet(str(root / "stock"))
    snaps = t.demand_plan.withColumn("d", F.date_format("SnapshotDate", "yyyy/MM/dd"))
    for d in [r["d"] for r in snaps.select("d").distinct().collect()]:
        (snaps.filter(F.col("d") == d).drop("d")
         .write.parquet(str(root / "plan" / "archive" / d / "apo_snp_35d")))
    t.order_tracking.write.parquet(str(root / "orders"))
    return job.LakePaths(str(root / "master"), str(root / "hierarchy"), str(root / "stock"),
                         str(root / "plan" / "archive"), str(root / "orders"))


def test_job_writes_each_report_once_per_date(spark, tables_small, tmp_path):
    paths = _lake(spark, tables_small, tmp_path / "lake")
    lake = job.load_lake(spark, paths)
    out = str(tmp_path / "reports")
    names = job.run_reports(spark, lake, AS_OF, out)
    job.run_reports(spark, lake, AS_OF, out, ["holding_report"])            # rerun: replaced
    job.run_reports(spark, lake, AS_OF - dt.timedelta(days=1), out, ["holding_report"])
    assert names == list(job.REPORTS)
    hr = spark.read.parquet(f"{out}/holding_report")
    today = hr.filter(F.col("as_of") == F.lit(AS_OF))
    assert today.count() == holding.holding_report(tables_small, AS_OF).count()
    assert hr.select("as_of").distinct().count() == 2
    for name in names:
        assert spark.read.parquet(f"{out}/{name}").count() > 0, name


def test_reports_from_day_sums_equal_reports_from_rows(spark, tables_oracle):
    from holdcast.operators import report, totals
    from holdcast.plans.stage import materialize
    t = tables_oracle
    sums = materialize(totals.stock_day_sums(t), "test_day_sums")
    pairs = [
        (totals.daily_share(t), totals.daily_share(t, day_sums=sums)),
        (totals.weekly_share(t), totals.weekly_share(t, day_sums=sums)),
        (totals.weekly_share(t, iso=True), totals.weekly_share(t, iso=True, day_sums=sums)),
        (report.wide_report_aligned(t, AS_OF), report.wide_report_aligned(t, AS_OF, day_sums=sums)),
    ]
    for a, b in pairs:
        ra = a.select([F.round(c, 6).alias(c) if d == "double" else F.col(c) for c, d in a.dtypes])
        rb = b.select([F.round(c, 6).alias(c) if d == "double" else F.col(c) for c, d in b.dtypes])
        assert ra.count() == rb.count() and ra.exceptAll(rb).count() == 0


def test_day_sums_refresh_replaces_only_recent_days(spark, tables_small, tmp_path):
    from holdcast.operators import totals
    from holdcast.schemas import Tables
    path = str(tmp_path / "day_sums")
    t = tables_small
    first = job.refresh_day_sums(spark, t, path, AS_OF, refresh_days=1)  # nothing yet: full
    full = totals.stock_day_sums(t)
    assert first.count() == full.count()

    doubled = t.batch_inventory.withColumns({c: F.col(c) * 2 for c in (
        "InventoryStockUnRestricted", "InventoryStockBlocked", "InventoryStockRestricted",
        "InventoryStockInQualityInspection")})
    t2 = Tables(t.material_master, t.material_hierarchy, doubled, t.demand_plan, t.order_tracking)
    after = job.refresh_day_sums(spark, t2, path, AS_OF, refresh_days=1)
    recent = [AS_OF, AS_OF - dt.timedelta(days=1)]
    a = after.select("MaterialID", "LocationID", "day", "_p_clear")
    f = full.select("MaterialID", "LocationID", "day", F.col("_p_clear").alias("orig"))
    j = a.join(f, ["MaterialID", "LocationID", "day"])
    assert j.count() == full.count()
    changed = j.filter(F.col("day").isin(recent))
    kept = j.filter(~F.col("day").isin(recent))
    assert changed.count() > 0 and kept.count() > 0
    assert changed.filter(~F.col("_p_clear").eqNullSafe(F.col("orig") * 2)).count() == 0
    assert kept.filter(~F.col("_p_clear").eqNullSafe(F.col("orig"))).count() == 0


def test_job_with_persistent_day_sums_equals_fresh_reports(spark, tables_small, tmp_path):
    out_a, out_b = str(tmp_path / "a"), str(tmp_path / "b")
    names = ["daily_share", "weekly_share", "wide_report"]
    job.run_reports(spark, tables_small, AS_OF, out_a, names)
    path = str(tmp_path / "sums")
    job.run_reports(spark, tables_small, AS_OF, out_b, names, day_sums_path=path)
    job.run_reports(spark, tables_small, AS_OF, out_b, names, day_sums_path=path, refresh_days=3)
    for n in names:
        a, b = spark.read.parquet(f"{out_a}/{n}"), spark.read.parquet(f"{out_b}/{n}")
        ra = a.select([F.round(c, 6).alias(c) if d == "double" else F.col(c) for c, d in a.dtypes])
        rb = b.select([F.round(c, 6).alias(c) if d == "double" else F.col(c) for c, d in b.dtypes])
        assert ra.count() == rb.count() and ra.exceptAll(rb.select(ra.columns)).count() == 0, n


def test_materialize_writes_under_the_checkpoint_folder(spark, tables_small):
    from holdcast.operators import totals
    from holdcast.plans.stage import materialize
    from holdcast.session import checkpoint_dir
    df = totals.stock_day_sums(tables_small)
    m = materialize(df, "unit_test")
    from urllib.parse import urlparse
    root = urlparse(checkpoint_dir(spark)).path
    assert m.inputFiles() and all(urlparse(f).path.startswith(root) for f in m.inputFiles())
    assert m.exceptAll(df).count() == 0 and df.exceptAll(m).count() == 0


def test_a_late_row_of_an_old_day_is_refreshed(spark, tables_small, tmp_path):
    from holdcast.operators import totals
    from holdcast.schemas import Tables
    t, stock, path = tables_small, str(tmp_path / "stock"), str(tmp_path / "sums")
    t.batch_inventory.write.parquet(stock)

    def tables():
        return Tables(t.material_master, t.material_hierarchy, spark.read.parquet(stock), t.demand_plan, t.order_tracking)

    job.refresh_day_sums(spark, tables(), path, AS_OF)
    old = t.batch_inventory.filter(F.col("AvailableDate") == F.lit(AS_OF - dt.timedelta(days=20)))
    time.sleep(1.1)
    seen = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    old.write.mode("append").parquet(stock)
    got = job.refresh_day_sums(spark, tables(), path, AS_OF, refresh_days=1, changed_since=seen)
    want = totals.stock_day_sums(tables()).select(got.columns)
    assert old.count() and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_late_row_reaches_the_reports_of_the_next_daily_run(spark, tables_small, tmp_path):
    from dataclasses import replace
    t, stock, path = tables_small, str(tmp_path / "stock"), str(tmp_path / "sums")
    names, late = ["daily_share", "weekly_share", "wide_report"], F.to_date("SnapshotDate") == F.lit(AS_OF - dt.timedelta(days=20))
    t.batch_inventory.filter(~late).write.parquet(stock)

    def run(out, **how):
        job.run_reports(spark, replace(t, batch_inventory=spark.read.parquet(stock)), AS_OF, str(tmp_path / out), names, **how)

    run("daily", day_sums_path=path, refresh_days=3)
    time.sleep(1.1)
    assert t.batch_inventory.filter(late).count()
    t.batch_inventory.filter(late).write.mode("append").parquet(stock)
    run("daily", day_sums_path=path, refresh_days=3)
    run("fresh")
    for n in names:
        a, b = (spark.read.parquet(str(tmp_path / out / n)) for out in ("daily", "fresh"))
        ra, rb = (x.select([F.round(c, 6).alias(c) if d == "double" else F.col(c) for c, d in a.dtypes]) for x in (a, b))
        assert ra.exceptAll(rb).count() == 0 and rb.exceptAll(ra).count() == 0, n


def test_a_day_that_lost_its_rows_loses_its_partition(spark, tables_small, tmp_path):
    from holdcast.operators import totals
    from holdcast.schemas import Tables
    t = tables_small
    for name, back, refresh_days in (("partial", 1, 2), ("full", 10, None)):
        path, gone = str(tmp_path / name), AS_OF - dt.timedelta(days=back)
        job.refresh_day_sums(spark, t, path, AS_OF)
        less = Tables(t.material_master, t.material_hierarchy, t.batch_inventory.filter(
            F.to_date("SnapshotDate") != F.lit(gone)), t.demand_plan, t.order_tracking)
        got = job.refresh_day_sums(spark, less, path, AS_OF, refresh_days)
        want = totals.stock_day_sums(less).select(got.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_reports_of_an_old_date_see_nothing_later(spark, tables_small, tmp_path):
    out, day = str(tmp_path / "out"), AS_OF - dt.timedelta(days=20)
    job.run_reports(spark, tables_small, day, out, ["daily_share", "weekly_share", "wide_report", "on_hand_metrics"])
    for name, column in (("daily_share", "day"), ("wide_report", "day"), ("on_hand_metrics", "snapshot_date")):
        latest = spark.read.parquet(f"{out}/{name}").agg(F.max(F.to_date(column))).first()[0]
        assert latest == day, name


def test_job_with_kept_tables(spark, tables_small, tmp_path):
    """A second day costs the changed days; reports equal those of a job that keeps nothing."""
    from holdcast.plans import periods
    from holdcast.plans.versions import Versions
    lake_root, out, plain = tmp_path / "lake", str(tmp_path / "kept_out"), str(tmp_path / "plain_out")
    yesterday = AS_OF - dt.timedelta(days=1)
    early = lambda df, c: df.filter(F.col(c) <= F.lit(yesterday))
    t = tables_small
    from dataclasses import replace
    first = replace(t, batch_inventory=early(t.batch_inventory, "AvailableDate"), demand_plan=early(t.demand_plan, "SnapshotDate"))
    paths = _lake(spark, first, lake_root)
    kept = job.Kept(str(tmp_path / "state"), paths.stock, paths.plan_archive)
    names = ["weekly_share", "daily_share", "wide_report", "bias_28d", "bias_90d", "doh_ratio", "holding_report"]
    assert job.run_reports(spark, job.load_lake(spark, paths), yesterday, out, names, kept=kept) == names

    t.batch_inventory.filter(F.col("AvailableDate") > F.lit(yesterday)).coalesce(1).write.mode("append").parquet(paths.stock)
    t.demand_plan.filter(F.col("SnapshotDate") > F.lit(yesterday)).write.parquet(f"{paths.plan_archive}/{AS_OF:%Y/%m/%d}/apo_snp_35d")
    lake = job.load_lake(spark, paths)
    job.run_reports(spark, lake, AS_OF, out, names, kept=kept)
    job.run_reports(spark, lake, AS_OF, plain, names)

    changes = [r for r in Versions(spark, kept.periods).changes() if r["n"] == 2]
    assert {r["part"] for r in changes if r["name"] == "day_sums"} == {AS_OF}
    assert {r["part"] for r in Versions(spark, kept.latest_plan).changes() if r["n"] == 2 and r["name"] == "latest_plan"} == {AS_OF}
    for name in names:
        want = spark.read.parquet(f"{plain}/{name}").drop("as_of")
        if name in periods.REPORTS:
            got = periods.read_period(spark, kept.periods, name, as_of=AS_OF)
        else:
            got = spark.read.parquet(f"{out}/{name}").filter(F.col("as_of") == F.lit(AS_OF)).drop("as_of")
        cut = lambda df: df.select([F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in sorted(df.dtypes)])
        assert cut(got).count() == cut(want).count() > 0 and cut(got).exceptAll(cut(want)).count() == 0, name
    assert not (tmp_path / "kept_out" / "weekly_share").exists()


def test_rows_without_a_snapshot_time_are_kept_and_refreshed(spark, tables_small, tmp_path):
    """They are a day of their own in every report over history, and a partial refresh sees new ones."""
    from dataclasses import replace
    stock, sums, t = str(tmp_path / "stock"), str(tmp_path / "sums"), tables_small
    undated = t.batch_inventory.limit(20).withColumn("SnapshotDate", F.lit(None).cast("timestamp"))
    t.batch_inventory.write.parquet(stock)
    lake = lambda: replace(t, batch_inventory=spark.read.parquet(stock))
    job.run_reports(spark, lake(), AS_OF, str(tmp_path / "a"), ["daily_share", "weekly_share"], day_sums_path=sums)
    undated.write.mode("append").parquet(stock)
    job.run_reports(spark, lake(), AS_OF, str(tmp_path / "a"), ["daily_share", "weekly_share"], day_sums_path=sums, refresh_days=1)
    job.run_reports(spark, lake(), AS_OF, str(tmp_path / "b"), ["daily_share", "weekly_share"])
    for name in ("daily_share", "weekly_share"):
        a, b = (spark.read.parquet(str(tmp_path / x / name)) for x in "ab")
        assert a.count() == b.count() and a.filter("day is null" if name == "daily_share" else "year is null").count() > 0
