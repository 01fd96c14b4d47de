"""On-hand metrics in the class script's form.

The script joins plan rows to the master and to *all* batch rows of the key
(no date condition), adds as-of columns, takes a whole-row distinct and
computes cases and dollars. Only the plan's keys reach the output, so here the
distinct plan keys are joined instead of every plan row: the distinct result is
the same and no batch row is repeated once per plan snapshot. For the same reason
batch rows and master rows are made distinct before they are joined, not the joined rows with
their as-of columns: a task then groups six columns instead of twelve.

Its NULL policy: no defaults except price -> 0 for dollars; restricted cases
are (blocked + restricted) as written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdcast.functions import units as U
from holdcast.functions.dates import DateLike, day_text, on_day
from holdcast.plans.joins import left_join_keys_to_rows
from holdcast.schemas import Tables

KEYS = ["MaterialID", "LocationID"]
# Rows whose distinct one task takes (about 100 MB).
ROWS_PER_TASK = 500_000


def on_hand_join(tables: Tables, as_of: DateLike | None = None, distinct: bool = False) -> DataFrame:
    """Planned keys with master attributes and their batch rows.

    ``as_of`` restricts both plan and stock to that day; without it all
    history is joined, as in the script. ``distinct`` gives each joined row once.
    """
    plan, stock = tables.demand_plan, tables.batch_inventory
    if as_of is not None:
        plan = plan.filter(on_day("DATE", as_of))
        stock = stock.filter(on_day("AvailableDate", as_of))
    keys = plan.select(*KEYS).distinct()
    if as_of is None:
        # Too many to broadcast: a task's keys are hashed, so that the many more batch rows need no sort.
        keys = keys.hint("shuffle_hash")
    rows = stock.select(*KEYS, *[U.PALLET_STOCK[s] for s in U.STATUSES], "SnapshotDate")
    j, master = left_join_keys_to_rows(keys, rows, KEYS), tables.material_master.select("MaterialID", U.UPP, U.UPC, U.price(default=None).alias("price"))
    if distinct:
        # A joined row is a batch row beside a master row: each side made distinct gives the distinct pairs.
        j, master = _distinct(j, rows.count()), master.distinct()
    j = j.join(master, "MaterialID", "left")
    return j.select(
        F.col("MaterialID").alias("material_id"), F.col("LocationID").alias("location_id"),
        F.col("PalletStockUnRestricted").alias("clear_in_pallets"),
        F.col("PalletStockBlocked").alias("blocked_in_pallets"),
        F.col("PalletStockRestricted").alias("restricted_in_pallets"),
        F.col(U.UPP).alias("units_per_pallet"), F.col(U.UPC).alias("units_per_case"),
        F.col("price"),
        F.col("SnapshotDate").alias("snapshot_date"),
    )


def _distinct(df: DataFrame, size: int) -> DataFrame:
    """Whole-row distinct in tasks of some ``ROWS_PER_TASK`` of ``size`` rows, however large the input is.

    Dealt by the whole row first: no key is hot, and the tasks before need no table of their rows.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // ROWS_PER_TASK))
    return df.repartition(parts, *df.columns).distinct()


def with_as_of_columns(df: DataFrame, as_of: DateLike) -> DataFrame:
    """``date`` (as-of text), ``doh_today`` (day of month of a snapshot taken on
    the as-of day, else NULL) and ``doh_yesterday`` (day of month of as-of - 1)."""
    today = day_text(as_of)
    snap_day = F.date_format(F.col("snapshot_date"), "yyyy-MM-dd")
    return df.withColumns({
        "date": F.lit(today),
        "doh_today": F.when(snap_day == today, F.date_format(F.col("snapshot_date"), "dd")),
        "doh_yesterday": F.lit(day_text(as_of, "%d", minus_days=1)),
    })


def on_hand_metrics(tables: Tables, as_of: DateLike, join_as_of: bool = False) -> DataFrame:
    """Cases and dollars per distinct joined row."""
    df = with_as_of_columns(on_hand_join(tables, as_of if join_as_of else None, distinct=True), as_of)
    clear, blocked, restricted = (F.col(f"{s}_in_pallets") for s in ("clear", "blocked", "restricted"))
    upp, upc = F.col("units_per_pallet"), F.col("units_per_case")
    price = F.coalesce(F.col("price"), F.lit(0.0))
    cases = {
        "clear": U.cases_propagating(clear, upp, upc),
        "blocked": U.cases_propagating(blocked, upp, upc),
        "restricted": U.cases_propagating(blocked + restricted, upp, upc),
    }
    return df.select(
        "date", "location_id", "material_id",
        "clear_in_pallets", "blocked_in_pallets", "restricted_in_pallets",
        *[cases[s].alias(f"inventory_{s}_cases") for s in ("clear", "blocked", "restricted")],
        *[(cases[s] * price).alias(f"inventory_{s}_dollars") for s in ("clear", "blocked", "restricted")],
        "snapshot_date", "doh_today", "doh_yesterday",
    )
