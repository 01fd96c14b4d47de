"""The latest plan as a kept table: a run reads the snapshot folders that are new, not the archive.

The pick of one row per (DATE, location, material) is a maximum, so the kept rows and
those of a new folder give the same pick as all folders would, whichever came first: a late
folder of an old day is merged like any other. Only the DATEs that new folders name are
rewritten (a plan reaches some 35 days ahead).

A folder that was sent again, or withdrawn, may have held the kept row. Its DATEs are
picked anew from the folders whose DATE range (kept with each folder) meets them.

What is new is told from the names and modification times of the archive's day folders; the
files of folders already read are not listed. Where a store has no folder times, name the days in ``resent``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdcast.functions.dates import DateLike, as_date
from holdcast.operators.demand import PLAN_KEYS, PLAN_ORDER, PLAN_PAYLOAD, latest_rows
from holdcast.plans.versions import Part, Versions
from holdcast.schemas import DEMAND_PLAN, conform

TABLE, FOLDERS = "latest_plan", "folders"
COLUMNS = [*PLAN_KEYS, *PLAN_ORDER]


@dataclass(frozen=True)
class Folder:
    """A day's snapshot folder: where it is, when it changed, and the DATEs it names."""
    day: dt.date
    path: str
    modified: int
    first: Part = None
    last: Part = None
    unknown: bool = False       # it has rows without a DATE

    def meets(self, dates: set[Part]) -> bool:
        return self.unknown and None in dates or self.first is not None and any(
            d is not None and self.first <= d <= self.last for d in dates)


def day_folders(spark: SparkSession, root: str, leaf: str) -> dict[dt.date, Folder]:
    """The folders ``root/yyyy/MM/dd/leaf``: names and times of the folders themselves, no files."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/*/*/*/{leaf}")
    found = {}
    for status in glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or []:
        path = status.getPath().toString()
        year, month, day = path.rstrip("/").split("/")[-4:-1]
        found[dt.date(int(year), int(month), int(day))] = Folder(dt.date(int(year), int(month), int(day)), path,
                                                                  status.getModificationTime())
    return found


def _known(versions: Versions) -> dict[dt.date, Folder]:
    table = versions.read(FOLDERS)
    return {} if table is None else {r["day"]: Folder(**{k: r[k] for k in Folder.__dataclass_fields__}) for r in table.collect()}     # one row a day folder


def _rows(spark: SparkSession, root: str, folders: list[Folder]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], DEMAND_PLAN)
    rows = spark.read.option("basePath", root).parquet(*[f.path for f in folders])
    return conform(rows, DEMAND_PLAN)


def _of_dates(rows: DataFrame, dates: set[Part]) -> DataFrame:
    known = [d for d in dates if d is not None]
    wanted = F.col("DATE").isin(known)
    return rows.filter(wanted | F.col("DATE").isNull() if None in dates else wanted)


def _span(spark: SparkSession, root: str, folder: Folder) -> tuple[Folder, set[Part]]:
    """``folder`` with its DATE range, and its DATEs (some 35 of them)."""
    dates = {r["DATE"] for r in _rows(spark, root, [folder]).select("DATE").distinct().collect()}
    days = [d for d in dates if d is not None]
    return Folder(folder.day, folder.path, folder.modified, min(days, default=None), max(days, default=None), None in dates), dates


def refresh_latest_plan(spark: SparkSession, archive: str, leaf: str, root: str, as_of: DateLike | None = None,
                        resent: list[DateLike] | None = None) -> int:
    """Bring the kept latest plan under ``root`` up to the archive; returns its version."""
    versions = Versions(spark, root)
    known, present = _known(versions), day_folders(spark, archive, leaf)
    again = {as_date(d) for d in resent or []}
    new = [f for day, f in present.items() if day not in known]
    changed = [f for day, f in present.items() if day in known and (day in again or f.modified != known[day].modified)]
    withdrawn = [f for day, f in known.items() if day not in present]
    if not (new or changed or withdrawn):
        return versions.current()

    spans = {f.day: _span(spark, archive, f) for f in [*new, *changed]}
    # DATEs that a changed or withdrawn folder has had: the kept row may be one of its old rows.
    kept = versions.read(TABLE)
    old = [known[f.day] for f in [*changed, *withdrawn]]
    stale = {r["part"] for r in versions.changes() if r["name"] == TABLE and any(f.meets({r["part"]}) for f in old)}
    touched = set().union(*[dates for _, dates in spans.values()]) - stale
    steady = [f for day, f in known.items() if day in present and day not in spans]

    merged = _of_dates(_rows(spark, archive, [spans[d][0] for d in spans]), touched).select(COLUMNS)
    if kept is not None and touched:
        merged = merged.unionByName(versions.read(TABLE, parts=touched).select(COLUMNS))
    if stale:
        sources = [f for f in [*steady, *[f for f, _ in spans.values()]] if f.meets(stale)]
        merged = merged.unionByName(_of_dates(_rows(spark, archive, sources), stale).select(COLUMNS))

    draft = versions.begin(as_of)
    draft.write(TABLE, latest_rows(merged), "DATE", touched | stale)
    days = {f.day for f in [*new, *changed, *withdrawn]}
    facts = [(f.day, f.path, f.modified, f.first, f.last, f.unknown) for f, _ in spans.values()]
    draft.write(FOLDERS, spark.createDataFrame(facts, "day date, path string, modified bigint, first date, last date, unknown boolean"
                                               ).withColumn("snapshot", F.col("day")), "snapshot", days)
    return draft.publish()


def read_latest_plan(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The kept latest plan in the columns of ``demand.latest_plan``."""
    table = Versions(spark, root).read(TABLE, version)
    if table is None:
        return spark.createDataFrame([], DEMAND_PLAN).select(*PLAN_KEYS, *PLAN_PAYLOAD)
    return table.select(*PLAN_KEYS, *PLAN_PAYLOAD)


def read_latest_rows(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The kept rows as a demand plan: every metric that ranks a plan gives on them what it gives on the archive.

    They lack UnitofMeasure (NULL). Sums over all snapshots, as the notebook's 90-day bias has them, need the archive.
    """
    table = Versions(spark, root).read(TABLE, version)
    if table is None:
        return spark.createDataFrame([], DEMAND_PLAN)
    return conform(table.withColumn("UnitofMeasure", F.lit(None).cast("string")), DEMAND_PLAN)
