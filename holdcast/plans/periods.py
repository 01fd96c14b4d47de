"""Daily and weekly reports kept as versioned tables: a run rewrites the days and weeks that changed.

From the stock files that are new, rewritten or gone since the last run come the days whose rows
changed; from those the ISO weeks they lie in. Day sums are recomputed from stock for the days, the day
reports for the same days, and the week reports from the kept day sums of the touched weeks. Everything
is published as one version (``plans.versions``): a reader sees day sums, shares and totals of
the same run, and can still read an older one.

A run's cost: the listing of the stock files, the rows of changed days, seven days of day sums for each
changed week. Its storage: the partitions it rewrites.

Rows without a SnapshotDate form a day, and a week, of their own (NULL), as in the registered
shares. A day or week that has lost all its rows is removed. If master data that the measures use changes,
all reports are recomputed from the kept day sums, without reading stock.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdcast.functions import units as U
from holdcast.functions.dates import DateLike
from holdcast.operators import totals
from holdcast.plans.stage import materialize
from holdcast.plans.versions import Part, Versions
from holdcast.schemas import BATCH_INVENTORY, Tables, conform

DAY_SUMS, FILES = "day_sums", "files"
#: Report -> (partition column, builder over (tables, day sums)).
DAY_REPORTS = {"daily_share": totals.daily_share, "daily_totals": totals.daily_totals}
WEEK_REPORTS = {"weekly_share": lambda t, day_sums: totals.weekly_share(t, iso=True, day_sums=day_sums),
                "weekly_totals": lambda t, day_sums: totals.weekly_totals(t, iso=True, day_sums=day_sums)}
REPORTS = (*DAY_REPORTS, *WEEK_REPORTS)
FACTS = "path string, modified timestamp, length bigint"


def monday(day: Part) -> Part:
    """First day of the ISO week that has ``day``."""
    return None if day is None else day - dt.timedelta(days=day.weekday())


def week_start(year: Column, week: Column) -> Column:
    """First day of an ISO week: the Monday of the week that has January 4, so many weeks on."""
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    return F.date_add(F.date_sub(fourth, F.weekday(fourth)), (week - 1) * 7)


# ---- what changed ----

def stock_files(spark: SparkSession, stock: str) -> DataFrame:
    """(path, modified, length) of the stock files, from the file listing; no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(stock)
    return listed.select("path", F.col("modificationTime").alias("modified"), "length")


def days_by_file(spark: SparkSession, stock: str, files: DataFrame) -> DataFrame:
    """``files`` with the snapshot days each holds (at most one for each calendar day), NULL last.

    Reads the timestamps of those files alone.
    """
    paths = [r["path"] for r in files.select("path").collect()]          # the files of one delivery
    if not paths:
        return files.withColumns({"days": F.lit(None).cast("array<date>"), "unknown": F.lit(False)})
    rows = spark.read.option("basePath", stock).parquet(*paths).select(
        F.to_date(F.col("SnapshotDate").cast("timestamp")).alias("day"), F.col("_metadata.file_path").alias("path"))
    days = rows.groupBy("path").agg(F.collect_set("day").alias("days"), F.max(F.col("day").isNull()).alias("unknown"))
    name = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  (a local path has two spellings)
    found = days.select(name(F.col("path")).alias("_name"), "days", "unknown")
    return files.withColumn("_name", name(F.col("path"))).join(found, "_name", "left").drop("_name")


def _days(files: DataFrame) -> set[Part]:
    """Days of some files: at most one value for each calendar day."""
    known = {r["day"] for r in files.select(F.explode("days").alias("day")).distinct().collect()}
    return known | ({None} if not files.filter("unknown").isEmpty() else set())


def rows_of_days(stock: DataFrame, days: set[Part]) -> DataFrame:
    """The stock rows of some snapshot days, by ranges of timestamps that the reader can push down."""
    known = sorted(d for d in days if d is not None)
    wanted = F.col("SnapshotDate").isNull() if None in days else F.lit(False)
    start = 0
    for i in range(1, len(known) + 1):
        if i == len(known) or known[i] != known[i - 1] + dt.timedelta(days=1):
            first, end = (dt.datetime.combine(d, dt.time()) for d in (known[start], known[i - 1] + dt.timedelta(days=1)))
            wanted = wanted | (F.col("SnapshotDate") >= F.lit(first)) & (F.col("SnapshotDate") < F.lit(end))
            start = i
    return stock.filter(wanted)


def master_mark(tables: Tables) -> str:
    """A mark of the master columns the measures use; it changes when they do."""
    columns = ["MaterialID", U.UPP, U.UPC, U.LIST_PRICE, U.STD_COST]
    row = tables.material_master.agg(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.count(F.lit(1))).first()
    return f"{row[0]}:{row[1]}"


# ---- a run ----

def refresh_periods(spark: SparkSession, tables: Tables, stock: str, root: str, as_of: DateLike | None = None,
                    names: tuple[str, ...] = REPORTS) -> int:
    """Publish the day and week reports over the stock files under ``stock``; returns the version.

    ``tables`` has the master data; its stock is not read. Without a change the current version stays.
    ``names`` are the reports that ``root`` keeps, the same in every run.
    """
    versions = Versions(spark, root)
    log = versions.read(FILES)
    listed = stock_files(spark, stock)
    mark = master_mark(tables)
    whole = conform(spark.read.option("recursiveFileLookup", "true").parquet(stock), BATCH_INVENTORY)

    key = ["path", "modified", "length"]
    if log is None:
        new, gone, days = listed, None, None                     # every day
    else:
        alive = log.select(*key, "days", "unknown")
        new, gone = listed.join(alive, key, "left_anti"), alive.join(listed, key, "left_anti")
    facts = materialize(days_by_file(spark, stock, new), "period-files")
    if log is not None:
        days = _days(facts) | _days(gone)
    repriced = log is not None and versions.note() != mark
    if log is not None and facts.isEmpty() and gone.isEmpty() and not repriced:
        return versions.current()

    draft = versions.begin(as_of, mark)
    if days is None or days:
        rows = whole if days is None else rows_of_days(whole, days)
        draft.write(DAY_SUMS, totals.stock_day_sums(replace(tables, batch_inventory=rows)), "day", days)
    report_days = None if repriced else days
    weeks = None if report_days is None else {monday(d) for d in report_days}
    for name, build in DAY_REPORTS.items():
        if name in names and (report_days is None or report_days):
            draft.write(name, build(tables, day_sums=draft.read(DAY_SUMS, report_days)), "day", report_days)
    of_weeks = None if weeks is None else {None if m is None else m + dt.timedelta(days=i) for m in weeks for i in range(7)}
    for name, build in WEEK_REPORTS.items():
        if name in names and (weeks is None or weeks):
            report = build(tables, day_sums=draft.read(DAY_SUMS, of_weeks))
            draft.write(name, report.withColumn("week_start", week_start(F.col("year"), F.col("week"))), "week_start", weeks)
    _log_files(spark, versions, draft, facts, gone)
    return draft.publish()


def _log_files(spark: SparkSession, versions: Versions, draft, facts: DataFrame, gone: DataFrame | None) -> None:
    """Keep the list of files read, a partition for each day of their times; only changed days are rewritten."""
    dated = facts.withColumn("written", F.to_date("modified"))
    if gone is None:
        draft.write(FILES, dated, "written", None)
        return
    old = versions.read(FILES)
    parts = {r["written"] for r in dated.select("written").union(gone.select(F.to_date("modified").alias("written"))).distinct().collect()}
    if parts:
        stay = versions.read(FILES, parts=parts).join(gone.select("path", "modified", "length"), ["path", "modified", "length"], "left_anti")
        draft.write(FILES, dated.unionByName(stay.select(dated.columns)) if old is not None else dated, "written", parts)


def read_period(spark: SparkSession, root: str, name: str, version: int | None = None, as_of: DateLike | None = None) -> DataFrame | None:
    """A kept report at a version, or as last published for a date up to ``as_of``; None if there is none."""
    versions = Versions(spark, root)
    if as_of is not None:
        version = versions.version_at(as_of)
    table = versions.read(name, version)
    return table.drop("week_start") if table is not None and name in WEEK_REPORTS else table
