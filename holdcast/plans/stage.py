"""Materialise an intermediate that several outputs share.

Writes the DataFrame as parquet under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``) and returns a DataFrame reading it back. Later jobs
start from those files: the expensive lineage (a full scan and shuffle of the
stock table) runs once, and a lost executor costs a re-read of shared files,
not a recomputation. Never ``localCheckpoint``: its blocks die with the
executor. The files go when the application ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from holdcast.session import checkpoint_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    root = checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/holdcast-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    drop_at_end(spark, path)
    return spark.read.parquet(path)


def bucketed(df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """``df`` written once in buckets of ``keys``, sorted in them, and read back as a table.

    Joins, groupings and windows on ``keys``, or on ``keys`` and more columns, then work
    bucket by bucket: no exchange moves these rows again. The files lie in the shared checkpoint folder,
    one a bucket; ``buckets`` is the session's number of shuffle partitions unless given. A join on more
    columns than ``keys`` needs ``spark.sql.requireAllClusterKeysForCoPartition=false`` (``co_partitioned``).
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"holdcast_{name}_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{table}"
    df.repartition(count, *keys).write.bucketBy(count, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    drop_at_end(spark, path)
    return spark.table(table)


def co_partitioned(spark: SparkSession) -> None:
    """Let joins use a partitioning by some of their keys: the other side is then dealt by those as well."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Have the file system delete ``path`` when the application ends; later jobs may read it until then.

    The folder is made if it is not there yet: a file system notes existing paths only.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(place)
    fs.deleteOnExit(place)
