"""Derive the five inventory tables from the driver's ``part`` and ``lineitem``.

The reference ships no data. These derivations give the reference's columns
realistic shapes (NULL and zero divisors, several batches per day, several plan
snapshots per key, a year boundary) and grow linearly with the driver tables,
so every query built on them scales with the scale factor. The same mapping is
written in SQL for the DuckDB oracle (``holdcast.plans.oracle``).

The modulo conditions only shape values: NULL or zero divisors, missing
prices, materials without a master row, planned materials without stock. No
row is dropped: the dimensions keep every part; stock, plan and order tables
keep every line item, so every query's work grows with the whole input.

All are narrow projections of one scan each, written as Spark SQL over
DataFrame parameters; the plan table is three rows per line item produced by
``explode`` (a generator, no join).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from holdcast.schemas import Tables, conform, MATERIAL_MASTER, MATERIAL_HIERARCHY, \
    BATCH_INVENTORY, DEMAND_PLAN, ORDER_TRACKING

# Fixed values of the fixture mapping (must equal the oracle SQL).
FIRST_STOCK_DAY = dt.date(2024, 12, 16)   # stock and plan dates span 28 days from here
STOCK_DAYS = 28
MATERIAL_BASE = 11000000                  # MaterialID = 11000000 + partkey (8 digits)
LOCATION_BASE = 5000                      # LocationID = 5000 + suppkey % 4
PLAN_SNAPSHOT_LAGS = (0, 1, 100)          # plan snapshots taken 0, 1 and 100 days before DATE
AS_OF = dt.date(2025, 1, 12)              # as-of date every registered query uses


# Materials that no master row has: of 1 in 13 parts; and planned materials that no stock row has: of 1 in 31.
UNKNOWN = "CASE WHEN l_partkey % 13 = 0 THEN 5000000 ELSE 0 END"
PLANNED = "CASE WHEN l_partkey % 13 = 0 THEN 5000000 WHEN l_partkey % 31 = 0 THEN 6000000 ELSE 0 END"

D0 = f"DATE '{FIRST_STOCK_DAY.isoformat()}'"
LAGS = ", ".join(str(d) for d in PLAN_SNAPSHOT_LAGS)

# The mapping as Spark SQL over DataFrame parameters ({part}, {lineitem}): one
# parse and analysis per table instead of one Py4J call per column expression.
MATERIAL_MASTER_SQL = f"""
SELECT CAST({MATERIAL_BASE} + p_partkey AS STRING) AS MaterialID,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_size * 10 END AS ProductPlanningUnitsPerPallet,
  CASE WHEN p_partkey % 19 = 0 THEN NULL WHEN p_partkey % 23 = 0 THEN 0 ELSE 1 + p_size % 12 END
    AS ProductPlanningUnitsPerCase,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS ProductListPrice,
  CASE WHEN p_partkey % 25 = 0 THEN NULL ELSE p_retailprice * 0.5D END AS ProductStandardCost,
  p_partkey AS ProductID, p_name AS ProductDescription
FROM {{part}}"""

MATERIAL_HIERARCHY_SQL = f"""
SELECT CAST({MATERIAL_BASE} + p_partkey AS STRING) AS MaterialID, p_type AS Division,
  CASE WHEN p_partkey % 2 = 0 THEN 'AMBIENT' ELSE 'CHILLED' END AS Network,
  p_brand AS ProductLevel3CategoryID
FROM {{part}}"""

BATCH_INVENTORY_SQL = f"""
SELECT CAST({MATERIAL_BASE} + l_partkey + {UNKNOWN} AS STRING) AS MaterialID,
  CAST({LOCATION_BASE} + l_suppkey % 4 AS INT) AS LocationID,
  {D0} + CAST(l_orderkey % {STOCK_DAYS} AS INT) AS AvailableDate,
  CAST({D0} + CAST(l_orderkey % {STOCK_DAYS} AS INT) AS TIMESTAMP) + INTERVAL 6 HOURS AS SnapshotDate,
  CAST(l_linenumber * 3 AS INT) AS Day,
  CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0.0D END AS InventoryStockUnRestricted,
  CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0.0D END AS InventoryStockRestricted,
  CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0D END AS InventoryStockBlocked,
  CASE WHEN l_linestatus = 'O' THEN CAST(l_linenumber AS DOUBLE) ELSE 0.0D END
    AS InventoryStockInQualityInspection,
  CASE WHEN l_returnflag = 'N' THEN l_quantity END AS PalletStockUnRestricted,
  CASE WHEN l_returnflag = 'A' THEN l_quantity END AS PalletStockRestricted,
  CASE WHEN l_returnflag = 'R' THEN l_quantity END AS PalletStockBlocked
FROM {{lineitem}}"""

# Three snapshot rows per line item from a generator (no join).
DEMAND_PLAN_SQL = f"""
SELECT {D0} + CAST(l_orderkey % {STOCK_DAYS} AS INT) AS DATE,
  CAST({LOCATION_BASE} + l_suppkey % 4 AS INT) AS LocationID,
  CAST({MATERIAL_BASE} + l_partkey + {PLANNED} AS STRING) AS MaterialID, 'CS' AS UnitofMeasure,
  {D0} + CAST(l_orderkey % {STOCK_DAYS} - lag_days AS INT) AS SnapshotDate,
  {D0} + CAST(l_orderkey % {STOCK_DAYS} - lag_days + l_linenumber % 2 AS INT) AS Modified_date,
  l_quantity + lag_days AS ConsensusDemandPlan,
  CAST(l_linenumber AS DOUBLE) AS SalesActualCustomerOrders,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE 2.0D END AS DependentDemand
FROM {{lineitem}} LATERAL VIEW explode(array({LAGS})) snapshots AS lag_days"""

ORDER_TRACKING_SQL = f"""
SELECT CONCAT('0000000000', CAST({MATERIAL_BASE} + l_partkey + {UNKNOWN} AS STRING)) AS MaterialNumber,
  {D0} + CAST((l_orderkey + l_linenumber % 3) % {STOCK_DAYS}
    - CASE WHEN l_linenumber = 5 THEN 28 ELSE 0 END AS INT) AS GoodsIssueDate,
  CASE WHEN l_linenumber = 6 THEN 0.0D ELSE l_quantity END AS ActualQuantityDeliveredInSalesUnits,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS ConfirmedQuantity
FROM {{lineitem}}"""


def _derive(sql: str, schema, **frames: DataFrame) -> DataFrame:
    df = next(iter(frames.values())).sparkSession.sql(sql, **frames)
    same = [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]
    return df if same else conform(df, schema)


def material_master(part: DataFrame) -> DataFrame:
    return _derive(MATERIAL_MASTER_SQL, MATERIAL_MASTER, part=part)


def material_hierarchy(part: DataFrame) -> DataFrame:
    return _derive(MATERIAL_HIERARCHY_SQL, MATERIAL_HIERARCHY, part=part)


def batch_inventory(lineitem: DataFrame) -> DataFrame:
    return _derive(BATCH_INVENTORY_SQL, BATCH_INVENTORY, lineitem=lineitem)


def demand_plan(lineitem: DataFrame) -> DataFrame:
    return _derive(DEMAND_PLAN_SQL, DEMAND_PLAN, lineitem=lineitem)


def order_tracking(lineitem: DataFrame) -> DataFrame:
    return _derive(ORDER_TRACKING_SQL, ORDER_TRACKING, lineitem=lineitem)


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The five tables for one scale-factor folder of driver parquet."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return tables_from(part, lineitem)


def tables_from(part: DataFrame, lineitem: DataFrame) -> Tables:
    """The five tables derived from given ``part`` and ``lineitem`` DataFrames."""
    return Tables(
        material_master=material_master(part),
        material_hierarchy=material_hierarchy(part),
        batch_inventory=batch_inventory(lineitem),
        demand_plan=demand_plan(lineitem),
        order_tracking=order_tracking(lineitem),
    )
