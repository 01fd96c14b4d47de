"""Readers and the report writer.

The reference reads Delta and parquet from a lake path, a "current" partition
through a directory glob, and a multi-snapshot archive through a wildcard.
Here each is a plain ``spark.read`` with an explicit schema so the scan reads
only declared columns, and partition columns stay visible so filters on them
prune directories instead of listing everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdcast.functions.dates import DateLike, as_date
from holdcast.schemas import Tables, conform

# Sentinel partition of the "current" material hierarchy.
CURRENT_PARTITION = {"Year": 9999, "Month": 12, "Day": 31}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None, base_path: str | None = None,
               options: dict[str, str] | None = None, written: T.StructType | None = None) -> DataFrame:
    """Read one table. ``fmt`` is any installed source ("parquet", "delta", ...).

    With a schema the footer-inferred types are cast to it and unused columns are
    pruned before the scan. ``base_path`` keeps partition columns when ``path``
    is a glob below the partition directories. ``options`` go to the reader
    (``header``/``inferSchema`` matter for CSV only; parquet ignores them).
    ``written`` is the schema the files were written with, partition columns too: nothing is then
    inferred from footers or folder names, and a table without files has no rows.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if written is not None:
        reader = reader.schema(written)
    if base_path:
        reader = reader.option("basePath", base_path)
    df = reader.load(path)
    return conform(df, schema) if schema is not None else df


def read_current_partition(spark: SparkSession, root: str, fmt: str = "parquet",
                           schema: T.StructType | None = None,
                           partition: dict[str, int] | None = None) -> DataFrame:
    """Rows of the current partition (``Year=9999/Month=12/Day=31``) of ``root``.

    Loads that partition's own path; ``basePath`` keeps the partition columns.
    No other directory is listed or scanned.
    """
    path = "/".join([root.rstrip("/"), *(f"{k}={v}" for k, v in (partition or CURRENT_PARTITION).items())])
    df = spark.read.format(fmt).option("basePath", root).load(path)
    return conform(df, schema) if schema is not None else df


def read_snapshot_archive(spark: SparkSession, root: str, leaf: str, depth: int = 3,
                          fmt: str = "parquet", schema: T.StructType | None = None,
                          days: list[DateLike] | None = None) -> DataFrame:
    """Union of all archived snapshots ``root/*/*/*/leaf`` in one scan.

    With ``days`` only the folders ``root/yyyy/MM/dd/leaf`` of those days are listed and
    read; days without a folder are skipped, but one at least must have one.
    """
    if days is None:
        middle = "/".join(["*"] * depth)
    else:
        middle = "{" + ",".join(f"{as_date(d):%Y/%m/%d}" for d in days) + "}"
    glob = f"{root.rstrip('/')}/{middle}/{leaf}"
    df = spark.read.format(fmt).option("basePath", root).load(glob)
    return conform(df, schema) if schema is not None else df


# Type changes that keep every value; anything else is refused. Text must be ISO dates or plain numbers.
KEEPS = {("string", "date"), ("string", "timestamp"), ("string", "int"), ("string", "bigint"), ("string", "double"),
         ("tinyint", "int"), ("smallint", "int"), ("tinyint", "bigint"), ("smallint", "bigint"), ("int", "bigint"),
         ("tinyint", "double"), ("smallint", "double"), ("int", "double"), ("float", "double"), ("date", "timestamp"),
         ("tinyint", "string"), ("smallint", "string"), ("int", "string"), ("bigint", "string"), ("timestamp_ntz", "timestamp")}


def read_mixed_folders(spark: SparkSession, folders: list[str], schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Folders of one table whose files were written with different types, as one table of ``schema``.

    A folder is the output of one job and has one schema. Folders are grouped by the types of the declared
    columns; each group is one scan that is given those types, so a filter on a column that
    has the declared type is pushed down to that group's files. Values are then converted and the
    groups joined by a union. A column that is missing, or whose type would lose values, is refused with the folder's name;
    text that is no value of the type fails the query (ANSI casts).
    """
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for folder in folders:                                   # a footer for each folder
        found = spark.read.format(fmt).load(folder).schema
        have = {f.name.lower(): f for f in found.fields}
        own = []
        for field in schema.fields:
            if field.name.lower() not in have:
                raise ValueError(f"{folder}: column {field.name} is missing")
            kind = have[field.name.lower()].dataType
            if kind != field.dataType and (kind.simpleString(), field.dataType.simpleString()) not in KEEPS:
                raise ValueError(f"{folder}: {field.name} is {kind.simpleString()}, which {field.dataType.simpleString()} cannot hold whole")
            own.append(T.StructField(have[field.name.lower()].name, kind))
        own = T.StructType(own)
        groups.setdefault(own.json(), (own, []))[1].append(folder)
    parts = [spark.read.format(fmt).schema(own).load(paths).select(
        [F.col(f.name).cast(want.dataType).alias(want.name) for f, want in zip(own.fields, schema.fields)])
        for own, paths in groups.values()]
    if not parts:
        return spark.createDataFrame([], schema)
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


# The names under which SQL scripts read each table.
VIEW_NAMES = {
    "material_master": "materialmaster_temp",
    "material_hierarchy": "mat_hierarachy_temp",
    "batch_inventory": "batch_inventory_actual_temp",
    "demand_plan": "apo_snp_35d_temp",
    "order_tracking": "otr_var_temp_view",
}


def register_views(tables: Tables, suffix: str = "") -> None:
    """Expose the five tables to ``spark.sql`` under their source names and the scripts' names."""
    for table, name in VIEW_NAMES.items():
        getattr(tables, table).createOrReplaceTempView(f"{name}{suffix}")
    tables.material_master.createOrReplaceTempView(f"material_master{suffix}")
    tables.material_hierarchy.createOrReplaceTempView(f"material_hierarchy{suffix}")
    tables.batch_inventory.createOrReplaceTempView(f"batch_inventory_actual{suffix}")
    tables.demand_plan.createOrReplaceTempView(f"apo_snp_35d{suffix}")
    tables.order_tracking.createOrReplaceTempView(f"order_tracking{suffix}")


def write_report(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 fmt: str = "parquet", replace_all: bool = False) -> None:
    """Write a report; with ``partition_by`` only the partitions present in
    ``df`` are replaced (dynamic overwrite), so a rerun for one as-of date
    rewrites that date alone and a lost task simply retries its files.
    ``replace_all`` drops the partitions that ``df`` does not have."""
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "static" if replace_all else "dynamic").partitionBy(*partition_by)
    writer.save(path)
