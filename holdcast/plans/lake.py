"""Registered queries over lake folders: the tables are written as a lake holds them and read back by the readers.

Each writes below the session's checkpoint folder (dropped when the application ends) what the
reference's storage has: a current partition beside older ones, an archive of snapshot folders by day, stock files
that arrive over several days. The result is what the plain query over the same rows gives.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdcast.functions.dates import on_day
from holdcast.operators import hierarchy, totals
from holdcast.plans import latest, periods
from holdcast.plans.stage import drop_at_end
from holdcast.schemas import BATCH_INVENTORY, DEMAND_PLAN, MATERIAL_HIERARCHY, Tables
from holdcast.session import checkpoint_dir
from holdcast.sources.fixtures import AS_OF
from holdcast.sources.tables import (read_current_partition, read_mixed_folders, read_snapshot_archive, read_table,
                                     write_report)

LEAF = "apo_snp_35d"
# Dates of the hierarchy's older copies with what differs in each, and the day from which the current one holds.
COPIES = {dt.date(2024, 12, 18): 1, dt.date(2024, 12, 30): 2}
CURRENT_FROM = dt.date(2025, 1, 8)
# Fixed values shared with the oracle: the deliveries that a bounded archive read asks for.
ARCHIVE_DAYS = (dt.date(2024, 12, 16), dt.date(2024, 12, 23), dt.date(2025, 1, 6))
# The delivery of rows without a snapshot date: a Monday before all others.
UNDATED = dt.date(1900, 1, 1)


def _folder(spark: SparkSession, name: str) -> str:
    """A folder yet to be written, in one of its own that goes when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/holdcast-{name}-{uuid.uuid4().hex}"
    drop_at_end(spark, path)
    return f"{path}/files"


def _delivery(day: Column) -> Column:
    """The Monday a snapshot is delivered under; ``UNDATED`` without a date."""
    return F.coalesce(F.to_date(F.date_trunc("week", day)), F.lit(UNDATED))


def _deliver(rows: DataFrame, root: str, days: list[dt.date]) -> None:
    """Write the deliveries of some Mondays to ``root/yyyy/MM/dd/leaf``, a folder for each."""
    for d in days:
        rows.filter(_delivery(F.col("SnapshotDate")) == F.lit(d)).write.mode("overwrite").parquet(f"{root}/{d:%Y/%m/%d}/{LEAF}")


def _mondays(plan: DataFrame) -> list[dt.date]:
    """Mondays with a delivery: one for each week of the calendar."""
    return sorted(r["d"] for r in plan.select(_delivery(F.col("SnapshotDate")).alias("d")).distinct().collect())


def hierarchy_current(t: Tables) -> DataFrame:
    """The current partition of a hierarchy that has an older one as well."""
    spark = t.material_hierarchy.sparkSession
    root = _folder(spark, "lake-hierarchy")
    t.material_hierarchy.withColumn("Division", F.lit("old")).write.parquet(f"{root}/Year=2024/Month=1/Day=1")
    t.material_hierarchy.write.parquet(f"{root}/Year=9999/Month=12/Day=31")      # a folder without rows too
    return read_current_partition(spark, root, schema=MATERIAL_HIERARCHY)


def hierarchy_as_of(t: Tables) -> DataFrame:
    """Daily inventory with the hierarchy of each day: two dated copies that differ, and the current one."""
    spark = t.material_hierarchy.sparkSession
    root = _folder(spark, "lake-hierarchy")
    number = F.substring("MaterialID", -4, 4).cast("int")
    for day, change in COPIES.items():
        older = t.material_hierarchy.filter(number % 11 != change).withColumn(
            "Division", F.when(number % 3 == change, F.concat(F.lit(f"{change} "), "Division")).otherwise(F.col("Division")))
        older.write.parquet(f"{root}/Year={day.year}/Month={day.month}/Day={day.day}")
    t.material_hierarchy.write.parquet(f"{root}/Year=9999/Month=12/Day=31")
    return hierarchy.daily_with_hierarchy(t, hierarchy.read_hierarchy_copies(spark, root), dt.date(2024, 12, 16), AS_OF, CURRENT_FROM)


def plan_archive_days(t: Tables) -> DataFrame:
    """Plan rows of three days of an archive."""
    spark = t.demand_plan.sparkSession
    root = _folder(spark, "lake-plan")
    _deliver(t.demand_plan, root, _mondays(t.demand_plan))
    return read_snapshot_archive(spark, root, LEAF, schema=DEMAND_PLAN, days=list(ARCHIVE_DAYS))


def report_rewritten(t: Tables) -> DataFrame:
    """A report partitioned by day, of which a second run has rewritten the last week only."""
    spark = t.batch_inventory.sparkSession
    path = _folder(spark, "lake-report")
    report = totals.daily_share(t)
    recent = F.col("day") >= F.lit(AS_OF - dt.timedelta(days=6))
    write_report(report.withColumn("clear_cases_daily", F.when(recent, F.lit(-1.0)).otherwise(F.col("clear_cases_daily"))), path, ["day"])
    write_report(report.filter(recent), path, ["day"])
    return read_table(spark, path, written=report.schema).select(report.columns)


def stock_mixed(t: Tables) -> DataFrame:
    """The as-of day's stock from folders whose files disagree on types: dates as text, whole numbers narrower.

    Rows with a number that the narrower type cannot hold lie in the folder of the declared types.
    """
    spark = t.batch_inventory.sparkSession
    root = _folder(spark, "lake-stock")
    stock = t.batch_inventory
    day, blocked = F.col("Day"), F.col("InventoryStockBlocked")
    fits = {1: day.isNull() | day.eqNullSafe(day.try_cast("smallint")), 2: blocked.isNull() | blocked.eqNullSafe(blocked.try_cast("int"))}
    part = F.pmod(F.hash("MaterialID"), F.lit(3))
    part = F.when((part == 1) & fits[1], 1).when((part == 2) & fits[2], 2).otherwise(0)
    stock.filter(part == 0).write.parquet(f"{root}/a")
    stock.filter(part == 1).withColumns({"AvailableDate": F.col("AvailableDate").cast("string"), "Day": F.col("Day").cast("smallint")}
                                        ).write.parquet(f"{root}/b")
    stock.filter(part == 2).withColumn("InventoryStockBlocked", F.col("InventoryStockBlocked").cast("int")).write.parquet(f"{root}/c")
    return read_mixed_folders(spark, [f"{root}/{f}" for f in "abc"], BATCH_INVENTORY).filter(on_day("AvailableDate", AS_OF))


def latest_plan_kept(t: Tables) -> DataFrame:
    """The kept latest plan after three runs: new folders, then one that is wrong, then a late one and the wrong one again."""
    spark, plan = t.demand_plan.sparkSession, t.demand_plan
    archive, root = _folder(spark, "lake-archive"), _folder(spark, "lake-latest")
    days = _mondays(plan)
    late, wrong, rest = days[1], days[-2], [d for d in days if d not in (days[1], days[-2])]
    _deliver(plan, archive, rest[:-1])
    latest.refresh_latest_plan(spark, archive, LEAF, root)
    _deliver(plan.withColumns({"ConsensusDemandPlan": F.col("ConsensusDemandPlan") + 1000,
                               "Modified_date": F.date_add("Modified_date", 9)}), archive, [wrong])
    latest.refresh_latest_plan(spark, archive, LEAF, root)
    _deliver(plan, archive, [late, wrong, rest[-1]])
    latest.refresh_latest_plan(spark, archive, LEAF, root, resent=[wrong])
    return latest.read_latest_plan(spark, root)


def _kept_period(t: Tables, name: str) -> DataFrame:
    """A kept report after two runs: most days; then the last days, and late rows of a day long before."""
    spark, stock = t.batch_inventory.sparkSession, t.batch_inventory
    files, root = _folder(spark, "lake-stock"), _folder(spark, "lake-periods")
    recent = F.col("AvailableDate") >= F.lit(AS_OF - dt.timedelta(days=2))
    late = (F.col("Day") == 21) & on_day("AvailableDate", AS_OF, 17)
    for rows in (stock.filter(~recent & ~late), stock.filter(recent | late)):
        rows.write.mode("append").parquet(files)
        periods.refresh_periods(spark, t, files, root, names=(name,))
    return periods.read_period(spark, root, name)


def weekly_share_kept(t: Tables) -> DataFrame:
    return _kept_period(t, "weekly_share")


def daily_share_kept(t: Tables) -> DataFrame:
    return _kept_period(t, "daily_share")
