"""Pallet / case / dollar conversions as Column expressions.

Three stock statuses times three units give the nine measures. The reference
has three NULL policies (one per script); each is a function here so callers
pick one explicitly instead of mixing them:

* ``defaulted``: NULL pallets and NULL units per pallet count as 0, a NULL
  units-per-case divisor as 1, price falls back list -> standard cost -> 0.
* ``propagating``: NULL anywhere gives NULL, price falls back list -> cost.

Every division is ``try_divide``: a zero divisor gives NULL instead of the
ANSI error (Spark 4) or ``inf`` (other engines).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STATUSES = ("clear", "restricted", "blocked")
UNITS = ("pallets", "cases", "dollars")

UPP = "ProductPlanningUnitsPerPallet"
UPC = "ProductPlanningUnitsPerCase"
LIST_PRICE = "ProductListPrice"
STD_COST = "ProductStandardCost"

# Stock columns of the batch table per status.
PALLET_STOCK = {
    "clear": "PalletStockUnRestricted",
    "restricted": "PalletStockRestricted",
    "blocked": "PalletStockBlocked",
}
UNIT_STOCK = {
    "clear": "InventoryStockUnRestricted",
    "restricted": "InventoryStockRestricted",
    "blocked": "InventoryStockBlocked",
}
QUALITY_STOCK = "InventoryStockInQualityInspection"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price(list_price: str | Column = LIST_PRICE, std_cost: str | Column = STD_COST,
          default: float | None = 0.0) -> Column:
    """List price, else standard cost, else ``default`` (None keeps NULL)."""
    parts = [col(list_price), col(std_cost)]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def cases_defaulted(pallets: str | Column, upp: str | Column = UPP, upc: str | Column = UPC) -> Column:
    """pallets * units-per-pallet / units-per-case with the defaulting policy."""
    num = F.coalesce(col(pallets), F.lit(0)) * F.coalesce(col(upp), F.lit(0))
    return F.try_divide(num, F.coalesce(col(upc), F.lit(1)))


def cases_propagating(pallets: str | Column, upp: str | Column = UPP, upc: str | Column = UPC) -> Column:
    """pallets * units-per-pallet / units-per-case; NULL in, NULL out."""
    return F.try_divide(col(pallets) * col(upp), col(upc))


def pallets_from_units(units: str | Column, upp: str | Column = UPP) -> Column:
    """Base stock units divided by units per pallet (NULL when 0 or NULL)."""
    return F.try_divide(col(units), col(upp))


def defaulted_measures(pallets: dict[str, Column], suffix: str = "") -> dict[str, Column]:
    """The nine measures, defaulting policy, named ``{status}_{unit}{suffix}``.

    ``pallets`` maps status -> pallet expression; master columns are read by
    their names, so the input must already be joined to the material master.
    """
    out: dict[str, Column] = {}
    for s in STATUSES:
        p = F.coalesce(pallets[s], F.lit(0.0))
        cases = cases_defaulted(p)
        out[f"{s}_pallets{suffix}"] = p
        out[f"{s}_cases{suffix}"] = cases
        out[f"{s}_dollars{suffix}"] = cases * price(default=0.0)
    return out


def propagating_measures(pallets: dict[str, Column], suffix: str = "",
                         price_default: float | None = None) -> dict[str, Column]:
    """The nine measures, propagating policy, named ``{status}_{unit}{suffix}``."""
    out: dict[str, Column] = {}
    for s in STATUSES:
        cases = cases_propagating(pallets[s])
        out[f"{s}_pallets{suffix}"] = pallets[s]
        out[f"{s}_cases{suffix}"] = cases
        out[f"{s}_dollars{suffix}"] = cases * price(default=price_default)
    return out


def measure_names(suffix: str = "") -> list[str]:
    return [f"{s}_{u}{suffix}" for s in STATUSES for u in UNITS]
