"""Build ``Tables`` from a few literal rows (unspecified columns are NULL)."""

import datetime as dt

from holdcast.schemas import (BATCH_INVENTORY, DEMAND_PLAN, MATERIAL_HIERARCHY, MATERIAL_MASTER,
                              ORDER_TRACKING, Tables)

AS_OF = dt.date(2025, 1, 12)


def day(offset: int) -> dt.date:
    return AS_OF - dt.timedelta(days=offset)


def ts(offset: int) -> dt.datetime:
    d = day(offset)
    return dt.datetime(d.year, d.month, d.day, 6, 0)


def _df(spark, schema, rows):
    names = [f.name for f in schema.fields]
    unknown = {k for r in rows for k in r} - set(names)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def stock_row(material, location, offset, clear=None, restricted=None, blocked=None, day_count=None,
              quality=0.0, **kw):
    """One batch row ``offset`` days before the as-of date (pallet and unit stock equal)."""
    row = {
        "MaterialID": material, "LocationID": location, "AvailableDate": day(offset),
        "SnapshotDate": ts(offset), "Day": day_count,
        "PalletStockUnRestricted": clear, "PalletStockRestricted": restricted,
        "PalletStockBlocked": blocked,
        "InventoryStockUnRestricted": clear or 0.0, "InventoryStockRestricted": restricted or 0.0,
        "InventoryStockBlocked": blocked or 0.0, "InventoryStockInQualityInspection": quality,
    }
    row.update(kw)
    return row


def tables(spark, master=(), hierarchy=(), stock=(), plan=(), orders=()) -> Tables:
    return Tables(
        _df(spark, MATERIAL_MASTER, list(master)),
        _df(spark, MATERIAL_HIERARCHY, list(hierarchy)),
        _df(spark, BATCH_INVENTORY, list(stock)),
        _df(spark, DEMAND_PLAN, list(plan)),
        _df(spark, ORDER_TRACKING, list(orders)),
    )


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}
