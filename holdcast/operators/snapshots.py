"""Snapshot keys of the batch table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdcast.schemas import Tables


def distinct_snapshots(tables: Tables) -> DataFrame:
    """Distinct (material, location, snapshot timestamp)."""
    return tables.batch_inventory.select(
        F.col("MaterialID").alias("material_id"), F.col("LocationID").alias("location_id"),
        F.col("SnapshotDate").alias("snapshot_date")).distinct()


def latest_snapshot(tables: Tables) -> DataFrame:
    """Each distinct snapshot with the key's latest snapshot next to it.

    The window runs after the distinct, so a partition holds one key's distinct
    snapshot times (bounded by the calendar), never its batch rows.
    """
    d = distinct_snapshots(tables)
    w = Window.partitionBy("material_id", "location_id")
    return d.withColumn("latest_date", F.max("snapshot_date").over(w))
