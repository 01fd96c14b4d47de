"""Registered queries: one per operator or metric, over the driver's tables.

Each entry takes ``(spark, sf_dir)``, derives the five inventory tables from
that folder's ``part`` and ``lineitem`` and returns the metric for the fixed
as-of date. Double columns are rounded to four decimals at this boundary
(the oracle does the same) because sums of non-integer money differ in the
last bits between engines; library functions themselves do not round.
"""

from __future__ import annotations

import datetime as dt
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdcast.functions import units as U
from holdcast.functions.dates import since
from holdcast.operators import demand, holding, onhand, report, rolling, snapshots, totals
from holdcast.plans import lake
from holdcast.schemas import Tables
from holdcast.session import configure
from holdcast.sources.fixtures import AS_OF, load_tables

DECIMALS = 4
# From a fortnight before the as-of date to beyond the last window that holds a row: 28 + 14 dates after it.
AROUND = (AS_OF - dt.timedelta(days=14), AS_OF + dt.timedelta(days=42))


def round_doubles(df: DataFrame, places: int = DECIMALS) -> DataFrame:
    """Round every DOUBLE column to ``places`` decimals: ``rint(x * 10^p) / 10^p``.

    Plain IEEE double arithmetic, so Spark and the oracle produce the same bits
    (no per-value BigDecimal, which cost more than the report itself). Nothing
    leaves DOUBLE, so large values, NaN and infinities stay what they are.
    """
    scale = float(10 ** places)
    return df.select([
        (F.rint(F.col(f.name) * scale) / scale).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema.fields])


def _daily_unit(unit: str) -> Callable[[Tables], DataFrame]:
    def run(t: Tables) -> DataFrame:
        d = holding.daily_measures(t, AS_OF)
        return d.select("date", "doh_today", "location_id", "material_id",
                        *[f"{s}_{unit}" for s in U.STATUSES], "snapshot_date")
    return run


METRICS: dict[str, Callable[[Tables], DataFrame]] = {
    # sources
    "scan_inventory": lambda t: t.batch_inventory,
    "scan_material_master": lambda t: t.material_master,
    "scan_hierarchy": lambda t: t.material_hierarchy,
    "scan_plan": lambda t: t.demand_plan,
    "scan_order_tracking": lambda t: t.order_tracking,
    # filters
    "filter_available_on": lambda t: holding.stock_on(t, AS_OF),
    "filter_plan_on": lambda t: holding.plan_on(t, AS_OF),
    "filter_last_90d": lambda t: t.demand_plan.filter(since("SnapshotDate", AS_OF, 90)),
    "filter_last_28d": lambda t: demand.order_lines(t).filter(since("DATE", AS_OF, 28)),
    "filter_by_hierarchy": lambda t: report.filtered_weekly(t, network="AMBIENT"),
    # joins
    "daily_plan_stock": lambda t: holding.plan_stock_rows(t, AS_OF),
    "daily_with_material": lambda t: holding.daily_with_material(t, AS_OF),
    "stock_with_material": totals.stock_with_material,
    "actual_plan_join": lambda t: demand.actual_plan_join(t, AS_OF),
    "weekly_with_hierarchy": report.weekly_with_hierarchy,
    "weekly_daily_aligned": totals.weekly_daily_aligned,
    "on_hand_join": lambda t: onhand.on_hand_join(t),
    # aggregations
    "demand_forecast_90d": lambda t: demand.demand_forecast_90d(t, AS_OF),
    "actual_demand": demand.actual_demand,
    "weekly_inventory": totals.weekly_inventory,
    "weekly_inventory_iso": lambda t: totals.weekly_inventory(t, iso=True),
    "daily_inventory": totals.daily_inventory,
    "weekly_totals": totals.weekly_totals,
    "daily_totals": totals.daily_totals,
    "distinct_snapshots": snapshots.distinct_snapshots,
    "dedup_daily": lambda t: holding.dedup_daily(t, AS_OF),
    # windows
    "latest_plan": lambda t: demand.latest_plan(t.demand_plan),
    "latest_snapshot": snapshots.latest_snapshot,
    "lag_previous_day": holding.lag_previous_day,
    # unit conversions
    "daily_pallets": _daily_unit("pallets"),
    "daily_cases": _daily_unit("cases"),
    "daily_dollars": _daily_unit("dollars"),
    "daily_holding": lambda t: holding.daily_holding(t, AS_OF),
    "daily_holding_inventory_stock": lambda t: holding.daily_holding(
        t, AS_OF, pallet_source="inventory_stock", restricted_rule="quality_plus_restricted"),
    "daily_holding_units_per_pallet": lambda t: holding.daily_holding(
        t, AS_OF, pallet_source="units_per_pallet", restricted_rule="quality_plus_restricted"),
    "stock_units_sql": totals.stock_units_sql,
    "on_hand_metrics": lambda t: onhand.on_hand_metrics(t, AS_OF),
    "on_hand_metrics_as_of": lambda t: onhand.on_hand_metrics(t, AS_OF, join_as_of=True),
    "pallets_from_units": holding.pallets_from_units,
    # week over week, days on hand, report
    "last_week_level": lambda t: holding.last_week_level(t, AS_OF),
    "week_over_week": lambda t: holding.week_over_week(t, AS_OF),
    "doh_day_columns": lambda t: holding.doh_day_columns(t, AS_OF),
    "on_hand_date_columns": lambda t: onhand.with_as_of_columns(onhand.on_hand_join(t), AS_OF),
    "doh_ratio": lambda t: report.doh_ratio(t, AS_OF),
    "holding_report": lambda t: holding.holding_report(t, AS_OF),
    "holding_report_plan_driven": lambda t: holding.holding_report(t, AS_OF, driver="plan"),
    "holding_report_reference_names": lambda t: holding.with_reference_names(holding.holding_report(t, AS_OF)),
    # shares
    "weekly_share": totals.weekly_share,
    "weekly_share_iso": lambda t: totals.weekly_share(t, iso=True),
    "daily_share": totals.daily_share,
    # demand and bias
    "demand_quantity": lambda t: demand.demand_quantity(t.demand_plan),
    "otr_material_id": lambda t: t.order_tracking.select(
        "MaterialNumber", demand.material_id_from_number().alias("MaterialID")),
    "bias_28d": lambda t: demand.bias_28d(t, AS_OF),
    "bias_28d_aligned": lambda t: demand.bias_28d_aligned(t, AS_OF),
    "bias_signed": lambda t: demand.bias_signed(t, AS_OF),
    "bias_90d": lambda t: demand.bias_90d(t, AS_OF),
    "bias_90d_aligned": lambda t: demand.bias_90d_aligned(t, AS_OF),
    # many as-of dates in one pass: a month up to the as-of date, or the weeks around it
    "holding_history": lambda t: rolling.holding_history(t, *rolling.span(AS_OF, 28)),
    "week_over_week_history": lambda t: rolling.week_over_week_history(t, *rolling.span(AS_OF, 28)),
    "doh_ratio_history": lambda t: rolling.doh_ratio_history(t, *rolling.span(AS_OF, 28)),
    "bias_28d_trailing": lambda t: rolling.bias_28d_trailing(t, *AROUND),
    "bias_90d_aligned_range": lambda t: rolling.bias_90d_aligned_range(t, *AROUND),
    "bias_90d_range": lambda t: rolling.bias_90d_range(t, *rolling.span(AS_OF, 4)),
    # the tables as lake folders, read back; kept tables after several runs
    "lake_hierarchy_current": lake.hierarchy_current,
    "lake_hierarchy_as_of": lake.hierarchy_as_of,
    "lake_plan_archive_days": lake.plan_archive_days,
    "lake_report_rewritten": lake.report_rewritten,
    "lake_stock_mixed": lake.stock_mixed,
    "latest_plan_kept": lake.latest_plan_kept,
    "weekly_share_kept": lake.weekly_share_kept,
    "daily_share_kept": lake.daily_share_kept,
    # wide report
    "wide_report_aligned": lambda t: report.wide_report_aligned(t, AS_OF),
}


def run_on(name: str, tables: Tables) -> DataFrame:
    """The registered query ``name`` over given tables (rounded like ``run``)."""
    return round_doubles(METRICS[name](tables))


# Derived (lazy) tables per session and folder: the driver's files are
# read-only, so their listing, footers and fixture plans are built once per
# session instead of once per query. Holds plans, not data.
_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, Tables]]" = weakref.WeakKeyDictionary()


def tables_for(spark: SparkSession, sf_dir: str) -> Tables:
    per_session = _TABLES.setdefault(spark, {})
    if sf_dir not in per_session:
        per_session[sf_dir] = load_tables(spark, sf_dir)
    return per_session[sf_dir]


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the registered query ``name`` over the tables of ``sf_dir``.

    Pins the session settings the fixtures and week keys depend on (UTC).
    """
    configure(spark)
    return round_doubles(METRICS[name](tables_for(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, _n=name: run(_n, spark, sf_dir)) for name in METRICS}
