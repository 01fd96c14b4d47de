"""DuckDB SQL of the queries that cover many as-of dates: the single-date definition for each date of a list.

Every metric is written as a loop over dates: ``dates`` joined to the rows that the single-date
query of that date would read. The Spark side uses window frames over day sums instead.
"""

from __future__ import annotations

import datetime as dt

from holdcast.plans.oracle import LATEST_PLAN, PALLET_COL, SHIPPED, STATUSES, UNITS, _defaulted, _r, _round, _sql
from holdcast.sources.fixtures import AS_OF


def _dates(first: dt.date, last: dt.date) -> str:
    return f"""
dates AS (SELECT CAST(unnest(generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 DAY)) AS DATE) AS as_of)"""


def _month(days: int) -> str:
    return _dates(AS_OF - dt.timedelta(days=days - 1), AS_OF)


AROUND = _dates(AS_OF - dt.timedelta(days=14), AS_OF + dt.timedelta(days=42))

_SUMS = ", ".join(f"SUM({PALLET_COL[s]}) AS {s}" for s in STATUSES)
DAY_STOCK = f"""
day_stock AS (
  SELECT MaterialID, LocationID, AvailableDate, {_SUMS}, MAX(Day) AS day, MAX(SnapshotDate) AS snapshot
  FROM batch_inventory_actual GROUP BY ALL)"""

# A date's stock beside that of the day before and of the same weekday before it: joins on shifted dates.
SHIFTED = f"""{DAY_STOCK},{_month(28)},
shifted AS (
  SELECT x.as_of, t.MaterialID, t.LocationID, {", ".join(f"t.{s} AS today_{s}, w.{s} AS last_week_{s}" for s in STATUSES)},
    y.clear AS yesterday_clear, t.day AS today_day, y.day AS yesterday_day, t.snapshot AS today_snapshot, w.snapshot AS last_week_snapshot,
    m.* EXCLUDE (MaterialID)
  FROM dates x JOIN day_stock t ON t.AvailableDate = x.as_of
  LEFT JOIN day_stock w ON w.AvailableDate = x.as_of - 7 AND w.MaterialID = t.MaterialID AND w.LocationID = t.LocationID
  LEFT JOIN day_stock y ON y.AvailableDate = x.as_of - 1 AND y.MaterialID = t.MaterialID AND y.LocationID = t.LocationID
  LEFT JOIN material_master m ON m.MaterialID = t.MaterialID)"""

KEY_COLS = "as_of, LocationID AS location_id, MaterialID AS material_id"


def _week_columns() -> str:
    out = []
    for s in STATUSES:
        now, before = f"COALESCE(today_{s}, 0)", f"COALESCE(last_week_{s}, 0)"
        out.append(_r(before, f"last_week_{s}_pallets"))
        out.append(_r(f"CASE WHEN {before} <> 0 THEN ({now} - {before}) / {before} * 100 ELSE 0.0 END", f"wow_{s}_pct"))
    return ", ".join(out)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    measures = ", ".join(_r(_defaulted(f"today_{s}")[u], f"{s}_{u}") for s in STATUSES for u in UNITS)
    q["holding_history"] = _sql(SHIFTED, f"""
SELECT {KEY_COLS}, {measures}, {_week_columns()}, COALESCE(today_snapshot, last_week_snapshot) AS snapshot_date,
  COALESCE(today_day, 0) AS doh_today, COALESCE(yesterday_day, 0) AS doh_yesterday
FROM shifted""")
    pallets = ", ".join(_r(f"COALESCE(today_{s}, 0)", f"{s}_pallets") for s in STATUSES)
    q["week_over_week_history"] = _sql(SHIFTED, f"SELECT {KEY_COLS}, {pallets}, {_week_columns()} FROM shifted")
    today, before = _defaulted("k.today_clear", "k.")["cases"], _defaulted("k.yesterday_clear", "k.")["cases"]
    q["doh_ratio_history"] = _sql(SHIFTED + "," + LATEST_PLAN, f"""
SELECT k.as_of, k.LocationID AS location_id, k.MaterialID AS material_id,
  {_r(today, "clear_cases_today")}, {_r(before, "clear_cases_yesterday")}, {_r("p.ConsensusDemandPlan", "daily_demand_cases")},
  {_r(f"({today}) / NULLIF(p.ConsensusDemandPlan, 0)", "doh_today")},
  {_r(f"({before}) / NULLIF(p.ConsensusDemandPlan, 0)", "doh_yesterday")}
FROM shifted k LEFT JOIN latest_plan p ON p.DATE = k.as_of AND p.LocationID = k.LocationID AND p.MaterialID = k.MaterialID""")
    q["bias_28d_trailing"] = _sql(LATEST_PLAN + "," + SHIPPED + "," + AROUND + """,
ordered AS (
  SELECT x.as_of, s.material, SUM(s.delivered) AS cases
  FROM dates x JOIN shipped s ON s.issued BETWEEN x.as_of - 28 AND x.as_of GROUP BY ALL),
planned AS (
  SELECT x.as_of, p.MaterialID AS material, SUM(p.Demand_Quantity_Cases) AS wanted
  FROM dates x JOIN latest_plan p ON p.DATE BETWEEN x.as_of - 28 AND x.as_of GROUP BY ALL)""", f"""
SELECT o.as_of, o.material AS MaterialID, {_r("o.cases", "Total_Actual_Quantity_Cases")},
  {_r("p.wanted", "Total_Demand_Quantity_Cases")}, {_r("ABS((p.wanted - o.cases) / NULLIF(o.cases, 0))", "Bias_Perc")}
FROM ordered o LEFT JOIN planned p ON p.as_of = o.as_of AND p.material = o.material""")
    q["bias_90d_aligned_range"] = _sql(LATEST_PLAN + "," + SHIPPED + "," + AROUND + """,
ordered AS (
  SELECT x.as_of, s.material, SUM(s.confirmed) AS cases
  FROM dates x JOIN shipped s ON s.issued BETWEEN x.as_of - 90 AND x.as_of GROUP BY ALL),
planned AS (
  SELECT x.as_of, p.MaterialID AS material, SUM(p.ConsensusDemandPlan) AS wanted
  FROM dates x JOIN latest_plan p ON p.DATE BETWEEN x.as_of - 90 AND x.as_of GROUP BY ALL)""", f"""
SELECT p.as_of, p.material AS MaterialID, {_r("p.wanted", "DemandForecast")}, {_r("o.cases", "ActualDemand")},
  {_round("ABS((COALESCE(p.wanted, 0) - o.cases) / NULLIF(o.cases, 0))", 3)} AS Bias
FROM planned p LEFT JOIN ordered o ON o.as_of = p.as_of AND o.material = p.material""")
    q["bias_90d_range"] = _sql(SHIPPED + "," + _month(4) + """,
forecast AS (
  SELECT x.as_of, p.DATE, p.MaterialID, p.LocationID, SUM(p.ConsensusDemandPlan) AS wanted
  FROM dates x JOIN apo_snp_35d p ON p.SnapshotDate >= x.as_of - 90 GROUP BY ALL),
actual AS (SELECT material, SUM(confirmed) AS cases FROM shipped GROUP BY material)""", f"""
SELECT f.as_of, f.DATE, f.LocationID, f.MaterialID, {_r("f.wanted", "DemandForecast")}, {_r("a.cases", "ActualDemand")},
  CAST(ROUND(CAST(CAST(ABS((COALESCE(f.wanted, 0) - COALESCE(a.cases, 0)) / NULLIF(COALESCE(a.cases, 1), 0))
    AS VARCHAR) AS DECIMAL(38, 17)), 3) AS DOUBLE) AS Bias
FROM forecast f LEFT JOIN actual a ON a.material = f.MaterialID""")
    return q
