"""Table schemas and the ``Tables`` bundle the metric functions take.

The reference declares no types; these are inferred from how each column is
used. All material keys are strings so that joins between tables never fall
back to an ANSI string-to-number cast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MATERIAL_MASTER = T.StructType([
    T.StructField("MaterialID", T.StringType()),
    T.StructField("ProductPlanningUnitsPerPallet", T.IntegerType()),
    T.StructField("ProductPlanningUnitsPerCase", T.IntegerType()),
    T.StructField("ProductListPrice", T.DoubleType()),
    T.StructField("ProductStandardCost", T.DoubleType()),
    T.StructField("ProductID", T.LongType()),
    T.StructField("ProductDescription", T.StringType()),
])

MATERIAL_HIERARCHY = T.StructType([
    T.StructField("MaterialID", T.StringType()),
    T.StructField("Division", T.StringType()),
    T.StructField("Network", T.StringType()),
    T.StructField("ProductLevel3CategoryID", T.StringType()),
])

BATCH_INVENTORY = T.StructType([
    T.StructField("MaterialID", T.StringType()),
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("AvailableDate", T.DateType()),
    T.StructField("SnapshotDate", T.TimestampType()),
    T.StructField("Day", T.IntegerType()),
    T.StructField("InventoryStockUnRestricted", T.DoubleType()),
    T.StructField("InventoryStockRestricted", T.DoubleType()),
    T.StructField("InventoryStockBlocked", T.DoubleType()),
    T.StructField("InventoryStockInQualityInspection", T.DoubleType()),
    T.StructField("PalletStockUnRestricted", T.DoubleType()),
    T.StructField("PalletStockRestricted", T.DoubleType()),
    T.StructField("PalletStockBlocked", T.DoubleType()),
])

DEMAND_PLAN = T.StructType([
    T.StructField("DATE", T.DateType()),
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("MaterialID", T.StringType()),
    T.StructField("UnitofMeasure", T.StringType()),
    T.StructField("SnapshotDate", T.DateType()),
    T.StructField("Modified_date", T.DateType()),
    T.StructField("ConsensusDemandPlan", T.DoubleType()),
    T.StructField("SalesActualCustomerOrders", T.DoubleType()),
    T.StructField("DependentDemand", T.DoubleType()),
])

ORDER_TRACKING = T.StructType([
    T.StructField("MaterialNumber", T.StringType()),
    T.StructField("GoodsIssueDate", T.DateType()),
    T.StructField("ActualQuantityDeliveredInSalesUnits", T.DoubleType()),
    T.StructField("ConfirmedQuantity", T.DoubleType()),
])

SCHEMAS = {
    "material_master": MATERIAL_MASTER,
    "material_hierarchy": MATERIAL_HIERARCHY,
    "batch_inventory_actual": BATCH_INVENTORY,
    "apo_snp_35d": DEMAND_PLAN,
    "order_tracking": ORDER_TRACKING,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types.

    Missing columns raise (a wrong source should fail at plan time, not give
    NULL metrics); extra columns are pruned here so they never reach the scan.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass(frozen=True)
class Tables:
    """The five inputs of every metric.

    material_master     one row per material (dimension)
    material_hierarchy  one row per material (dimension), current partition
    batch_inventory     batch rows: many per (material, location, day)
    demand_plan         plan rows per (DATE, location, material, snapshot)
    order_tracking      order lines (actuals), no location
    """

    material_master: DataFrame
    material_hierarchy: DataFrame
    batch_inventory: DataFrame
    demand_plan: DataFrame
    order_tracking: DataFrame

    def conformed(self) -> "Tables":
        return Tables(
            conform(self.material_master, MATERIAL_MASTER),
            conform(self.material_hierarchy, MATERIAL_HIERARCHY),
            conform(self.batch_inventory, BATCH_INVENTORY),
            conform(self.demand_plan, DEMAND_PLAN),
            conform(self.order_tracking, ORDER_TRACKING),
        )
