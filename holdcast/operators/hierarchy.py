"""Hierarchy attributes as they were on a day.

The lake keeps the hierarchy as dated partitions beside the current one (Year=9999). Each partition
is a full copy, valid until the next one's date; the current one is valid after the last dated
one. Copies that did not change are put together, so a material has one row for
each change (``intervals``), and a report of an old date joins the row whose interval has its day.

The join is an interval join without a cross join: intervals are cut at borders of
BUCKET days within the reported range, so rows meet on (material, bucket) and a day only
sees the changes of its own bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdcast.functions.dates import DateLike, as_date, lit_date
from holdcast.operators import totals
from holdcast.operators.report import HIERARCHY_COLUMNS
from holdcast.schemas import MATERIAL_HIERARCHY, Tables
from holdcast.sources.tables import CURRENT_PARTITION

BUCKET = 32
NEVER = "9999-12-31"


def read_hierarchy_copies(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """All partitions of a hierarchy folder: its columns and ``valid_from``, NULL for the current partition."""
    rows = spark.read.format(fmt).option("basePath", root).load(root)
    parts = [F.col(c).cast("int") for c in CURRENT_PARTITION]
    current = parts[0] == CURRENT_PARTITION["Year"]
    return rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in MATERIAL_HIERARCHY.fields],
        F.when(~current, F.make_date(*parts)).alias("valid_from"))


def intervals(copies: DataFrame, current_from: DateLike | None = None) -> DataFrame:
    """(MaterialID, attributes, valid_from, valid_until): a row for each span of days without a change.

    ``copies`` has a row for each material and partition. A material that a copy lacks has no row for its days.
    The current copy holds from ``current_from``, or from the day after the last dated copy; without dated
    copies, always. ``valid_until`` is exclusive.
    """
    dated = copies.agg(F.max("valid_from")).first()[0]                   # one date
    if current_from is not None:
        start = as_date(current_from)
        copies = copies.filter(F.col("valid_from").isNull() | (F.col("valid_from") < F.lit(start)))
        begin = F.lit(start)
    else:
        begin = F.date_add(F.lit(dated), 1) if dated is not None else F.to_date(F.lit("0001-01-01"))
    copies = copies.withColumn("valid_from", F.coalesce("valid_from", begin))
    # One row for each partition: a calendar.
    following = copies.select("valid_from").distinct().withColumn(
        "valid_until", F.coalesce(F.lead("valid_from").over(Window.orderBy("valid_from")), F.to_date(F.lit(NEVER))))
    spans = copies.join(F.broadcast(following), "valid_from")
    value = F.struct(*HIERARCHY_COLUMNS)
    order = Window.partitionBy("MaterialID").orderBy("valid_from", *HIERARCHY_COLUMNS)
    same = (F.lag(value).over(order).eqNullSafe(value)) & (F.lag("valid_until").over(order) == F.col("valid_from"))
    runs = spans.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order))
    return runs.groupBy("MaterialID", "_run", *HIERARCHY_COLUMNS).agg(
        F.min("valid_from").alias("valid_from"), F.max("valid_until").alias("valid_until")).drop("_run")


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BUCKET)


def with_hierarchy_on(df: DataFrame, spans: DataFrame, first: DateLike, last: DateLike, day: str = "day",
                      on: str = "material_id") -> DataFrame:
    """``df`` with the attributes valid on each row's ``day``; NULL where there are none.

    ``first`` to ``last`` are the days of ``df`` that get attributes.
    """
    start, end = F.greatest("valid_from", lit_date(first)), F.least(F.date_sub("valid_until", 1), lit_date(last))
    cut = spans.filter(start <= end).withColumn("_bucket", F.explode(F.sequence(_bucket(start), _bucket(end)))).select(
        F.col("MaterialID").alias("_material"), "_bucket", "valid_from", "valid_until", *HIERARCHY_COLUMNS)
    row = df.withColumn("_day_bucket", _bucket(F.col(day)))
    inside = (F.col(day) >= F.col("valid_from")) & (F.col(day) < F.col("valid_until")) & F.col(day).between(lit_date(first), lit_date(last))
    return row.join(cut, (F.col(on) == F.col("_material")) & (F.col("_day_bucket") == F.col("_bucket")) & inside, "left").select(
        *df.columns, *HIERARCHY_COLUMNS)


def daily_with_hierarchy(tables: Tables, copies: DataFrame, first: DateLike, last: DateLike,
                         current_from: DateLike | None = None) -> DataFrame:
    """Daily inventory from ``first`` to ``last``, each day with the hierarchy of that day."""
    daily = totals.daily_inventory(tables).filter(F.col("day").between(lit_date(first), lit_date(last)))
    return with_hierarchy_on(daily, intervals(copies, current_from), first, last)
