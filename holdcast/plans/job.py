"""The daily job: read the five lake tables, write the reports for one as-of date.

This is what the reference's scheduled notebook and ``main()`` do, with the
display calls replaced by writes. Each report is one Spark job writing its
own folder, partitioned by as-of date with dynamic overwrite, so a rerun (or a
retried job after lost executors) replaces exactly that date and nothing is
collected to the driver.

    python -m holdcast.plans.job --as-of 2025-01-12 --out /lake/reports \\
        --master /lake/materials --master-format delta \\
        --hierarchy /lake/material-hierarchy --stock /lake/batch-stock \\
        --plan-archive /lake/plan-archive --orders /lake/order-lines \\
        --orders-format delta
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdcast.functions.dates import DateLike, as_date
from holdcast.operators import demand, holding, onhand, report, totals
from holdcast.schemas import (BATCH_INVENTORY, DEMAND_PLAN, MATERIAL_HIERARCHY, MATERIAL_MASTER,
                              ORDER_TRACKING, Tables)
from holdcast.plans import latest, periods
from holdcast.plans.stage import bucketed, co_partitioned
from holdcast.plans.versions import NULL_FOLDER
from holdcast.session import configure
from holdcast.sources.tables import (read_current_partition, read_snapshot_archive, read_table,
                                     write_report)


@dataclass(frozen=True)
class LakePaths:
    master: str
    hierarchy: str
    stock: str
    plan_archive: str
    orders: str
    master_format: str = "parquet"
    orders_format: str = "parquet"
    plan_leaf: str = "apo_snp_35d"


def load_lake(spark: SparkSession, p: LakePaths) -> Tables:
    return Tables(
        read_table(spark, p.master, fmt=p.master_format, schema=MATERIAL_MASTER),
        read_current_partition(spark, p.hierarchy, schema=MATERIAL_HIERARCHY),
        read_table(spark, p.stock, schema=BATCH_INVENTORY),
        read_snapshot_archive(spark, p.plan_archive, p.plan_leaf, schema=DEMAND_PLAN),
        read_table(spark, p.orders, fmt=p.orders_format, schema=ORDER_TRACKING),
    )


@dataclass(frozen=True)
class Kept:
    """Where a daily job keeps what it does not recompute, and the lake folders it follows."""
    root: str
    stock: str
    plan_archive: str
    plan_leaf: str = "apo_snp_35d"

    @property
    def periods(self) -> str:
        return f"{self.root.rstrip('/')}/periods"

    @property
    def latest_plan(self) -> str:
        return f"{self.root.rstrip('/')}/latest_plan"


# Report name -> builder(tables, as_of, day_sums). Reports over all stock
# history (up to the as-of date) take the shared day sums; the as-of reports read only their dates.
REPORTS: dict[str, Callable[[Tables, DateLike, DataFrame | None], DataFrame]] = {
    "holding_report": lambda t, d, s: holding.holding_report(t, d),
    "daily_table": lambda t, d, s: holding.daily_measures(t, d),
    "on_hand_metrics": lambda t, d, s: onhand.on_hand_metrics(t, d),
    "daily_share": lambda t, d, s: totals.daily_share(t, day_sums=s),
    "weekly_share": lambda t, d, s: totals.weekly_share(t, iso=True, day_sums=s),
    "wide_report": lambda t, d, s: report.wide_report_aligned(t, d, day_sums=s),
    "doh_ratio": lambda t, d, s: report.doh_ratio(t, d),
    "bias_28d": lambda t, d, s: demand.bias_28d_aligned(t, d),
    "bias_90d": lambda t, d, s: demand.bias_90d_aligned(t, d),
}
NEEDS_DAY_SUMS = {"daily_share", "weekly_share", "wide_report"}
# Reports over all history: they see no stock snapshot after the as-of date, so an old date can be rerun.
OVER_HISTORY = NEEDS_DAY_SUMS | {"on_hand_metrics"}


def until(tables: Tables, as_of: DateLike) -> Tables:
    """``tables`` without stock snapshots taken after the as-of date. Rows without a snapshot time stay: they
    are a period of their own in every report over history."""
    end = dt.datetime.combine(as_date(as_of) + dt.timedelta(days=1), dt.time())
    seen = F.col("SnapshotDate").isNull() | (F.col("SnapshotDate") < F.lit(end))
    return replace(tables, batch_inventory=tables.batch_inventory.filter(seen))


def refresh_day_sums(spark: SparkSession, tables: Tables, path: str, as_of: DateLike,
                     refresh_days: int | None = None, changed_since: dt.datetime | None = None) -> DataFrame:
    """Keep ``path`` (stock day sums, partitioned by ``day``) current; return all of it.

    With ``refresh_days`` only batch rows whose snapshot falls in
    ``[as_of - refresh_days, as_of + 1)`` are read (a plain timestamp range the
    reader can push down or prune on) and only those days' partitions are
    replaced, so a daily run costs the recent days, not the whole history.
    ``changed_since`` (UTC) adds the days of every stock file written after that time,
    however old the days are, so late rows and corrections are seen as well. Rows without a
    snapshot time are a day of their own (NULL), recomputed by every run.
    Without ``refresh_days``, or when ``path`` holds nothing yet, every day is recomputed.
    A day of the window, or of a full refresh any day, that no longer has a
    batch row loses its partition.
    """
    try:
        spark.read.parquet(path)   # lists the folder; raises when nothing is there yet
        exists = True
    except AnalysisException:
        exists = False
    rows = tables.batch_inventory
    if refresh_days is not None and exists:
        start = dt.datetime.combine(as_date(as_of) - dt.timedelta(days=refresh_days), dt.time())
        end = dt.datetime.combine(as_date(as_of) + dt.timedelta(days=1), dt.time())
        wanted = F.col("SnapshotDate").isNull() | (F.col("SnapshotDate") >= F.lit(start)) & (F.col("SnapshotDate") < F.lit(end))
        if changed_since is not None:
            wanted = wanted | F.to_date("SnapshotDate").isin(_days_of_files(rows, changed_since))
        rows = rows.filter(wanted)
    sums = totals.stock_day_sums(Tables(tables.material_master, tables.material_hierarchy, rows,
                                        tables.demand_plan, tables.order_tracking))
    partial = refresh_days is not None and exists
    write_report(sums, path, partition_by=["day"], replace_all=not partial)
    if partial:
        _drop_empty_days(spark, sums, path, as_of, refresh_days)
    return spark.read.parquet(path)


def keep_day_sums(spark: SparkSession, tables: Tables, path: str, as_of: DateLike,
                  refresh_days: int | None = None, changed_since: dt.datetime | None = None) -> DataFrame:
    """``refresh_day_sums`` that remembers, beside ``path``, how new the stock files it has read are.

    A partial refresh takes the days of all files at least as new as the newest one of the last
    run. Where that is not known (no earlier run, or stock that is not read from files), or is lost
    since a run ended while it was written, every day is recomputed.
    """
    seen = f"{path.rstrip('/')}.seen"
    newest = _newest_file(tables.batch_inventory)        # before the rows are read
    last = _last_seen(spark, seen) if newest is not None else None
    if last is None:
        refresh_days = None
    else:
        changed_since = min(last - dt.timedelta(milliseconds=1), changed_since or last)
    sums = refresh_day_sums(spark, tables, path, as_of, refresh_days, changed_since)
    if newest is not None:
        spark.createDataFrame([(newest,)], "micros bigint").coalesce(1).write.mode("overwrite").parquet(seen)
    return sums


def _newest_file(rows: DataFrame) -> int | None:
    """Modification time of the newest file of ``rows``, in microseconds, from the listing; None where rows have no files."""
    try:
        rows.select("_metadata.file_path").schema
    except AnalysisException:
        return None
    files = rows.inputFiles()
    if not files:
        return None
    listed = rows.sparkSession.read.format("binaryFile").load(files)           # no file is opened
    return listed.agg(F.max(F.unix_micros("modificationTime"))).first()[0]


def _last_seen(spark: SparkSession, path: str) -> dt.datetime | None:
    try:
        row = spark.read.schema("micros bigint").parquet(path).first()
    except AnalysisException:      # no run has ended yet
        return None
    return None if row is None else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=row["micros"])


def _days_of_files(rows: DataFrame, since: dt.datetime) -> list[dt.date]:
    """Snapshot days of the files written after ``since``: at most one value per calendar day."""
    new = rows.filter(F.col("_metadata.file_modification_time") > F.lit(since.replace(tzinfo=dt.timezone.utc)))
    return [r["day"] for r in new.select(F.to_date("SnapshotDate").alias("day")).distinct().collect()
            if r["day"] is not None]


def _drop_empty_days(spark: SparkSession, sums: DataFrame, path: str, as_of: DateLike, refresh_days: int) -> None:
    """Delete the window's partitions for which ``sums`` has no row (at most ``refresh_days`` + 2 of them)."""
    present = {r["day"] for r in sums.select("day").distinct().collect()}
    for day in [None, *(as_date(as_of) - dt.timedelta(days=back) for back in range(refresh_days + 1))]:
        if day not in present:
            name = NULL_FOLDER if day is None else day.isoformat()
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/day={name}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def run_reports(spark: SparkSession, tables: Tables, as_of: DateLike, out_root: str,
                names: list[str] | None = None, day_sums_path: str | None = None,
                refresh_days: int | None = None, changed_since: dt.datetime | None = None,
                kept: Kept | None = None) -> list[str]:
    """Write each report to ``out_root/<name>/as_of=<date>``; returns the names.

    With ``kept`` the run follows what is new: the period reports are versions of kept tables, of which only changed
    days and weeks are rewritten (``plans.periods``; read them with ``read_period``, by version or as-of
    date), the other reports use the kept day sums and the kept latest plan (``plans.latest``).

    Full-history reports read stock day sums instead of every batch row: kept
    current at ``day_sums_path`` (see ``refresh_day_sums``), or, without a path
    and when more than one such report is asked for, computed once and written
    to the shared checkpoint folder. A partial refresh also takes the days of every stock
    file written since the last run (``keep_day_sums``), or since ``changed_since`` (UTC) if that is earlier.
    """
    configure(spark)
    names = names or list(REPORTS)
    day_sums = None
    published: set[str] = set()
    if kept is not None:
        version = periods.refresh_periods(spark, tables, kept.stock, kept.periods, as_of)
        day_sums = periods.read_period(spark, kept.periods, periods.DAY_SUMS, version)
        latest.refresh_latest_plan(spark, kept.plan_archive, kept.plan_leaf, kept.latest_plan, as_of)
        tables = replace(tables, demand_plan=latest.read_latest_rows(spark, kept.latest_plan))
        published = set(periods.REPORTS)
    elif day_sums_path and NEEDS_DAY_SUMS.intersection(names):
        day_sums = keep_day_sums(spark, tables, day_sums_path, as_of, refresh_days, changed_since)
    elif len(NEEDS_DAY_SUMS.intersection(names)) > 1:
        day_sums = totals.stock_day_sums(until(tables, as_of))
    if day_sums is not None and NEEDS_DAY_SUMS.intersection(names) - published:
        # The reports join and window day sums by key: in buckets of the keys they are moved once, here.
        co_partitioned(spark)
        day_sums = bucketed(day_sums.filter(F.col("day").isNull() | (F.col("day") <= F.lit(as_date(as_of)))), "day_sums", totals.KEYS)
    done = []
    for name in names:
        if name in published:
            done.append(name)
            continue
        seen = until(tables, as_of) if name in OVER_HISTORY else tables
        df = REPORTS[name](seen, as_of, day_sums).withColumn("as_of", F.lit(as_date(as_of)))
        write_report(df, f"{out_root.rstrip('/')}/{name}", partition_by=["as_of"])
        done.append(name)
    return done


def _utc(text: str) -> dt.datetime:
    time = dt.datetime.fromisoformat(text)
    return time.astimezone(dt.timezone.utc).replace(tzinfo=None) if time.tzinfo else time


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--as-of", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", required=True)
    ap.add_argument("--master-format", default="parquet")
    ap.add_argument("--hierarchy", required=True)
    ap.add_argument("--stock", required=True)
    ap.add_argument("--plan-archive", required=True)
    ap.add_argument("--orders", required=True)
    ap.add_argument("--orders-format", default="parquet")
    ap.add_argument("--reports", default=",".join(REPORTS))
    ap.add_argument("--day-sums-path", default=None,
                    help="persistent stock day sums, partitioned by day")
    ap.add_argument("--refresh-days", type=int, default=None,
                    help="recompute only this many trailing days of day sums, and the days of files new since the last run")
    ap.add_argument("--changed-since", type=_utc, default=None,
                    help="also the days of stock files written since this time (ISO, UTC unless it has an offset)")
    ap.add_argument("--kept", default=None,
                    help="folder of kept tables: period reports as versions, the latest plan; replaces --day-sums-path")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("holdcast-daily").getOrCreate()
    paths = LakePaths(a.master, a.hierarchy, a.stock, a.plan_archive, a.orders,
                      a.master_format, a.orders_format)
    run_reports(spark, load_lake(spark, paths), a.as_of, a.out, a.reports.split(","),
                a.day_sums_path, a.refresh_days, a.changed_since,
                Kept(a.kept, a.stock, a.plan_archive) if a.kept else None)


if __name__ == "__main__":
    main()
