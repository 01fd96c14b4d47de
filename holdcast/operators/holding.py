"""Daily holding, last week, week-over-week and days-on-hand (DataFrame form).

Two families:

* ``plan_stock_rows`` / ``dedup_daily`` / ``daily_measures`` follow the
  reference's plan-driven daily table: the day's plan keys left-joined to the
  day's batch rows and master, then whole-row distinct, then the nine
  measures per batch row.
* ``stock_by_key`` / ``holding_report`` and friends are the corrected form at
  (material, location) grain, stock-driven by default (``driver="plan"``
  gives the planned keys instead): one scan of the stock table for all the
  dates a report needs (``AvailableDate IN (...)`` is pushed to the reader),
  conditional sums in one aggregation, then the master join. Last week is the
  value seven days earlier, not a lag over one day. ``pallet_source`` and
  ``restricted_rule`` choose among the reference's definitions explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdcast.functions import units as U
from holdcast.functions.dates import DateLike, lit_date, on_day
from holdcast.functions.ratios import pct_change_or_zero
from holdcast.plans.joins import left_join_keys_to_rows, with_material_master
from holdcast.schemas import Tables

KEYS = ["MaterialID", "LocationID"]

# Batch columns the daily table carries (H selects these for the day).
DAY_STOCK_COLUMNS = [
    "Day",
    "InventoryStockUnRestricted", "InventoryStockRestricted", "InventoryStockBlocked",
    "PalletStockUnRestricted", "PalletStockRestricted", "PalletStockBlocked",
    "SnapshotDate",
]
MASTER_COLUMNS = [U.UPP, U.UPC, U.LIST_PRICE, U.STD_COST, "ProductID", "ProductDescription"]


def stock_on(tables: Tables, as_of: DateLike, minus_days: int = 0) -> DataFrame:
    """Batch rows available on ``as_of - minus_days``."""
    return tables.batch_inventory.filter(on_day("AvailableDate", as_of, minus_days))


def plan_on(tables: Tables, as_of: DateLike, minus_days: int = 0) -> DataFrame:
    """Plan rows for the planned day ``as_of - minus_days``."""
    return tables.demand_plan.filter(on_day("DATE", as_of, minus_days))


def plan_stock_rows(tables: Tables, as_of: DateLike, minus_days: int = 0) -> DataFrame:
    """The day's plan keys left-joined to the day's batch rows.

    The plan side contributes only its keys, so each planned
    (material, location) appears once with each of its batch rows, or once with
    NULL stock. (The reference repeats every batch row once per plan snapshot
    row and removes the repeats with a whole-row distinct; the distinct rows
    are the same.)
    """
    keys = plan_on(tables, as_of, minus_days).select(*KEYS).distinct()
    stock = stock_on(tables, as_of, minus_days).select(*KEYS, *DAY_STOCK_COLUMNS)
    rows = left_join_keys_to_rows(keys, stock, KEYS)
    return rows.select(lit_date(as_of, minus_days).alias("DATE"), *KEYS, *DAY_STOCK_COLUMNS)


def daily_with_material(tables: Tables, as_of: DateLike) -> DataFrame:
    """``plan_stock_rows`` with the material master columns (left join)."""
    return with_material_master(plan_stock_rows(tables, as_of), tables, MASTER_COLUMNS)


def dedup_daily(tables: Tables, as_of: DateLike) -> DataFrame:
    """Whole-row distinct of ``daily_with_material`` (reference's daily input)."""
    return daily_with_material(tables, as_of).dropDuplicates()


def daily_measures(tables: Tables, as_of: DateLike) -> DataFrame:
    """Nine measures per distinct batch row of the as-of day (defaulting policy)."""
    d = dedup_daily(tables, as_of)
    m = U.defaulted_measures({s: F.col(U.PALLET_STOCK[s]) for s in U.STATUSES})
    return d.select(
        F.col("DATE").alias("date"),
        F.coalesce(F.col("Day"), F.lit(0)).alias("doh_today"),
        F.col("LocationID").alias("location_id"),
        F.col("MaterialID").alias("material_id"),
        *[m[n].alias(n) for n in U.measure_names()],
        F.col("SnapshotDate").alias("snapshot_date"),
    )


# ---------------------------------------------------------------- key grain

# What a pallet is (the reference has three): the PalletStock* columns; the
# InventoryStock* columns read as pallets; base units / units per pallet.
PALLET_SOURCES = ("pallet_stock", "inventory_stock", "units_per_pallet")
# What "restricted" is (also three): the restricted column; quality inspection
# + restricted (units only); blocked + restricted (blocked then counts twice).
RESTRICTED_RULES = ("restricted", "quality_plus_restricted", "blocked_plus_restricted")


def status_quantities(pallet_source: str = "pallet_stock",
                      restricted_rule: str = "restricted") -> dict[str, F.Column]:
    """Per-batch-row quantity per status for a pallet source and restricted rule."""
    if pallet_source not in PALLET_SOURCES:
        raise ValueError(f"pallet_source must be one of {PALLET_SOURCES}")
    cols = U.PALLET_STOCK if pallet_source == "pallet_stock" else U.UNIT_STOCK
    q = {s: F.col(cols[s]) for s in U.STATUSES}
    if restricted_rule == "quality_plus_restricted":
        if pallet_source == "pallet_stock":
            raise ValueError("quality inspection stock exists in units only")
        q["restricted"] = F.col(U.QUALITY_STOCK) + q["restricted"]
    elif restricted_rule == "blocked_plus_restricted":
        q["restricted"] = q["blocked"] + q["restricted"]
    elif restricted_rule != "restricted":
        raise ValueError(f"restricted_rule must be one of {RESTRICTED_RULES}")
    return q


def _as_pallets(qty: F.Column, pallet_source: str) -> F.Column:
    """Summed quantity -> pallets (after the master join)."""
    return U.pallets_from_units(qty) if pallet_source == "units_per_pallet" else qty


def stock_by_key(tables: Tables, as_of: DateLike, days: dict[str, int],
                 pallet_source: str = "pallet_stock", restricted_rule: str = "restricted") -> DataFrame:
    """Batch rows of several days summed to (material, location) in one pass.

    ``days`` maps a label to a day offset from ``as_of``. For each label the
    result has ``{label}_{status}`` pallet sums, ``{label}_rows`` batch-row
    count, ``{label}_day`` (largest ``Day`` value) and ``{label}_snapshot``
    (latest snapshot). One scan, one shuffle with map-side partial sums, so a
    hot key is pre-aggregated before it is shuffled.
    """
    dates = {label: lit_date(as_of, off) for label, off in days.items()}
    qty = status_quantities(pallet_source, restricted_rule)
    s = tables.batch_inventory.filter(F.col("AvailableDate").isin(*dates.values()))
    aggs = []
    for label, d in dates.items():
        hit = F.col("AvailableDate") == d
        for st in U.STATUSES:
            aggs.append(F.sum(F.when(hit, qty[st])).alias(f"{label}_{st}"))
        aggs.append(F.count(F.when(hit, F.lit(1))).alias(f"{label}_rows"))
        aggs.append(F.max(F.when(hit, F.col("Day"))).alias(f"{label}_day"))
        aggs.append(F.max(F.when(hit, F.col("SnapshotDate"))).alias(f"{label}_snapshot"))
    return s.groupBy(*KEYS).agg(*aggs)


def _report_keys(g: DataFrame, tables: Tables, as_of: DateLike, driver: str) -> DataFrame:
    """Rows of the report: keys stocked on the as-of day (``driver="stock"``), or
    the keys planned for that day (``driver="plan"``, the notebook's choice),
    with zeros where a planned key has no stock. Both sides are one row per key,
    so the plan-driven left join has no fan-out."""
    if driver == "stock":
        return g.filter(F.col("today_rows") > 0)
    if driver == "plan":
        keys = plan_on(tables, as_of).select(*KEYS).distinct()
        return keys.join(g, KEYS, "left")
    raise ValueError(f"driver must be 'stock' or 'plan', not {driver!r}")


def _today_measures(g: DataFrame, tables: Tables, pallet_source: str = "pallet_stock") -> DataFrame:
    j = with_material_master(g, tables, [U.UPP, U.UPC, U.LIST_PRICE, U.STD_COST])
    m = U.defaulted_measures({s: _as_pallets(F.col(f"today_{s}"), pallet_source) for s in U.STATUSES})
    return j.withColumns(m)


def daily_holding(tables: Tables, as_of: DateLike, pallet_source: str = "pallet_stock",
                  restricted_rule: str = "restricted") -> DataFrame:
    """Stock on the as-of day at (material, location) grain, nine measures.

    ``pallet_source`` and ``restricted_rule`` pick one of the reference's
    definitions explicitly (see ``PALLET_SOURCES``, ``RESTRICTED_RULES``).
    """
    g = stock_by_key(tables, as_of, {"today": 0}, pallet_source, restricted_rule)
    j = _today_measures(_report_keys(g, tables, as_of, "stock"), tables, pallet_source)
    return j.select(
        lit_date(as_of).alias("date"),
        F.col("LocationID").alias("location_id"),
        F.col("MaterialID").alias("material_id"),
        *U.measure_names(),
        F.col("today_rows").alias("batch_rows"),
        F.col("today_snapshot").alias("snapshot_date"),
    )


def _report_frame(tables: Tables, as_of: DateLike, driver: str = "stock",
                  pallet_source: str = "pallet_stock", restricted_rule: str = "restricted") -> DataFrame:
    g = stock_by_key(tables, as_of, {"today": 0, "yesterday": 1, "last_week": 7},
                     pallet_source, restricted_rule)
    j = _today_measures(_report_keys(g, tables, as_of, driver), tables, pallet_source)
    cols = {}
    for s in U.STATUSES:
        lw = F.coalesce(_as_pallets(F.col(f"last_week_{s}"), pallet_source), F.lit(0.0))
        cols[f"last_week_{s}_pallets"] = lw
        cols[f"wow_{s}_pct"] = pct_change_or_zero(F.col(f"{s}_pallets"), lw)
    cols["doh_today"] = F.coalesce(F.col("today_day"), F.lit(0))
    cols["doh_yesterday"] = F.coalesce(F.col("yesterday_day"), F.lit(0))
    return j.withColumns(cols).withColumns({
        "date": lit_date(as_of),
        "location_id": F.col("LocationID"),
        "material_id": F.col("MaterialID"),
        "snapshot_date": F.coalesce(F.col("today_snapshot"), F.col("last_week_snapshot")),
    })


def last_week_level(tables: Tables, as_of: DateLike) -> DataFrame:
    """Pallets by status seven days before the as-of day, for keys stocked today."""
    r = _report_frame(tables, as_of)
    return r.select("date", "location_id", "material_id",
                    *[f"last_week_{s}_pallets" for s in U.STATUSES])


def week_over_week(tables: Tables, as_of: DateLike) -> DataFrame:
    """Today vs seven days earlier in pallets: (now - prev) / prev * 100, 0 when prev is 0."""
    r = _report_frame(tables, as_of)
    return r.select("date", "location_id", "material_id",
                    *[f"{s}_pallets" for s in U.STATUSES],
                    *[f"last_week_{s}_pallets" for s in U.STATUSES],
                    *[f"wow_{s}_pct" for s in U.STATUSES])


def doh_day_columns(tables: Tables, as_of: DateLike) -> DataFrame:
    """Day-count columns today and yesterday (largest ``Day`` of the key's batches, 0 if none)."""
    r = _report_frame(tables, as_of)
    return r.select("date", "location_id", "material_id", "doh_today", "doh_yesterday")


def holding_report(tables: Tables, as_of: DateLike, driver: str = "stock",
                   pallet_source: str = "pallet_stock", restricted_rule: str = "restricted") -> DataFrame:
    """The holding report: nine measures today, last-week level and change, DOH columns.

    ``driver`` picks the rows: keys with stock on the as-of day (default) or the
    keys planned for that day. ``pallet_source`` / ``restricted_rule`` as in
    ``daily_holding``.
    """
    r = _report_frame(tables, as_of, driver, pallet_source, restricted_rule)
    return r.select(
        "date", "location_id", "material_id", *U.measure_names(),
        *[f"last_week_{s}_pallets" for s in U.STATUSES],
        *[f"wow_{s}_pct" for s in U.STATUSES],
        "snapshot_date", "doh_today", "doh_yesterday",
    )


# The reference report's output column names, keyed by ours.
REFERENCE_NAMES = {
    "date": "Date", "location_id": "Location", "material_id": "Material ID",
    "clear_pallets": "InventoryClear_pallets", "restricted_pallets": "InventoryRestricted_pallets",
    "blocked_pallets": "InventoryBlocked_pallets", "clear_cases": "InventoryClear_cases",
    "restricted_cases": "InventoryRestricted_cases", "blocked_cases": "InventoryBlocked_cases",
    "clear_dollars": "InventoryClear_dollar", "restricted_dollars": "InventoryRestricted_dollar",
    "blocked_dollars": "InventoryBlocked_dollar",
    "last_week_clear_pallets": "Last_Week_Inventory_Clear",
    "last_week_restricted_pallets": "Last_Week_Inventory_Restricted",
    "last_week_blocked_pallets": "Last_Week_Inventory_Blocked",
    "wow_clear_pct": "Last_Week_Inventory_Clear_%",
    "wow_restricted_pct": "Last_Week_Inventory_Restricted_%",
    "wow_blocked_pct": "Last_Week_Inventory_Blocked_%",
    "snapshot_date": "SnapshotDate", "doh_today": "DOH_Today", "doh_yesterday": "DOH_Yesterday",
}


def with_reference_names(report: DataFrame) -> DataFrame:
    """Rename report columns to the reference's names (spaces and % included);
    the three pallet columns also appear as ``Inventory_{Status}``, as there."""
    cols = [F.col(c).alias(REFERENCE_NAMES.get(c, c)) for c in report.columns]
    dup = [F.col(f"{s}_pallets").alias(f"Inventory_{s.capitalize()}") for s in U.STATUSES
           if f"{s}_pallets" in report.columns]
    return report.select(*cols[:3], *dup, *cols[3:])


def lag_previous_day(tables: Tables) -> DataFrame:
    """Daily pallets per key and the previous stocked day's pallets (``lag`` 1).

    The window runs over a daily-grain table (one row per key and day), so the
    previous row is the previous day and ties cannot occur. Window partitions
    hold one key's days: bounded by the calendar, not by batch volume.
    """
    daily = tables.batch_inventory.groupBy(*KEYS, "AvailableDate").agg(
        *[F.sum(U.PALLET_STOCK[s]).alias(s) for s in U.STATUSES])
    w = Window.partitionBy(*KEYS).orderBy("AvailableDate")
    cols = {}
    for s in U.STATUSES:
        cur = F.coalesce(F.col(s), F.lit(0.0))
        cols[f"{s}_pallets"] = cur
        cols[f"prev_{s}_pallets"] = F.coalesce(F.lag(cur, 1).over(w), F.lit(0.0))
    return daily.withColumns(cols).select(
        F.col("MaterialID").alias("material_id"), F.col("LocationID").alias("location_id"),
        F.col("AvailableDate").alias("stock_date"),
        *[f"{s}_pallets" for s in U.STATUSES], *[f"prev_{s}_pallets" for s in U.STATUSES])


def pallets_from_units(tables: Tables) -> DataFrame:
    """Base stock units divided by units per pallet, per key and day."""
    daily = tables.batch_inventory.groupBy(*KEYS, "AvailableDate").agg(
        *[F.sum(U.UNIT_STOCK[s]).alias(f"{s}_units") for s in U.STATUSES])
    j = with_material_master(daily, tables, [U.UPP])
    return j.select(
        F.col("MaterialID").alias("material_id"), F.col("LocationID").alias("location_id"),
        F.col("AvailableDate").alias("stock_date"),
        *[f"{s}_units" for s in U.STATUSES],
        *[U.pallets_from_units(F.col(f"{s}_units")).alias(f"{s}_pallets") for s in U.STATUSES])
