"""Hand-computed rows for the edge cases of FIXTURES.md ("literal rows")."""

import datetime as dt

import pytest

from holdcast.operators import demand, holding, onhand, totals
from literal import AS_OF, by_key, day, stock_row, tables, ts

MASTER = [
    {"MaterialID": "M1", "ProductPlanningUnitsPerPallet": 10, "ProductPlanningUnitsPerCase": 2,
     "ProductListPrice": 5.0, "ProductStandardCost": 2.0},
    # NULL units per case: defaulted policy divides by 1, propagating gives NULL.
    {"MaterialID": "M2", "ProductPlanningUnitsPerPallet": 10, "ProductPlanningUnitsPerCase": None,
     "ProductListPrice": None, "ProductStandardCost": 3.0},
    # Zero units per case: NULL cases under both policies.
    {"MaterialID": "M3", "ProductPlanningUnitsPerPallet": 10, "ProductPlanningUnitsPerCase": 0,
     "ProductListPrice": 1.0},
    # No price at all.
    {"MaterialID": "M4", "ProductPlanningUnitsPerPallet": 4, "ProductPlanningUnitsPerCase": 1},
]

STOCK = [
    stock_row("M1", 1, 0, clear=4.0, day_count=3),
    stock_row("M1", 1, 0, clear=6.0, blocked=1.0, day_count=6),   # two batches on one day
    stock_row("M1", 1, 1, clear=7.0, day_count=9),                 # yesterday
    stock_row("M1", 1, 7, clear=5.0),                              # last week
    stock_row("M2", 1, 0, clear=3.0),
    stock_row("M2", 1, 7, clear=0.0),                              # last week zero
    stock_row("M3", 1, 0, clear=2.0, restricted=1.0, quality=2.0),  # no stock last week
    stock_row("M4", 1, 0, clear=1.0),
    stock_row("M9", 1, 0, clear=1.0),                              # no master row
    stock_row("M1", 2, 7, clear=8.0),                              # stocked only last week
]


@pytest.fixture(scope="module")
def t(spark):
    return tables(spark, master=MASTER, stock=STOCK)


def test_daily_holding_units_and_defaults(t):
    got = by_key(holding.daily_holding(t, AS_OF), "material_id", "location_id")
    assert set(got) == {("M1", 1), ("M2", 1), ("M3", 1), ("M4", 1), ("M9", 1)}
    m1 = got[("M1", 1)]
    assert (m1["clear_pallets"], m1["clear_cases"], m1["clear_dollars"]) == (10.0, 50.0, 250.0)
    assert (m1["blocked_pallets"], m1["blocked_cases"], m1["blocked_dollars"]) == (1.0, 5.0, 25.0)
    assert m1["restricted_pallets"] == 0.0 and m1["batch_rows"] == 2
    m2 = got[("M2", 1)]   # NULL divisor -> 1, list price NULL -> standard cost
    assert (m2["clear_cases"], m2["clear_dollars"]) == (30.0, 90.0)
    m3 = got[("M3", 1)]   # zero divisor -> NULL
    assert m3["clear_cases"] is None and m3["clear_dollars"] is None
    m4 = got[("M4", 1)]   # no price -> 0 dollars
    assert (m4["clear_cases"], m4["clear_dollars"]) == (4.0, 0.0)
    m9 = got[("M9", 1)]   # no master row -> units per pallet 0
    assert (m9["clear_pallets"], m9["clear_cases"], m9["clear_dollars"]) == (1.0, 0.0, 0.0)


def test_week_over_week_and_doh(t):
    got = by_key(holding.holding_report(t, AS_OF), "material_id", "location_id")
    assert ("M1", 2) not in got   # the report is driven by today's stock
    m1 = got[("M1", 1)]
    assert m1["last_week_clear_pallets"] == 5.0 and m1["wow_clear_pct"] == 100.0
    assert (m1["doh_today"], m1["doh_yesterday"]) == (6, 9)
    m2 = got[("M2", 1)]   # last week zero -> 0 %
    assert m2["last_week_clear_pallets"] == 0.0 and m2["wow_clear_pct"] == 0.0
    m3 = got[("M3", 1)]   # no stock last week -> level 0, 0 %
    assert m3["last_week_clear_pallets"] == 0.0 and m3["wow_clear_pct"] == 0.0
    assert (m3["doh_today"], m3["doh_yesterday"]) == (0, 0)


def test_lag_previous_day_uses_previous_stocked_day(t):
    got = by_key(holding.lag_previous_day(t), "material_id", "location_id", "stock_date")
    assert got[("M1", 1, day(0))]["prev_clear_pallets"] == 7.0
    assert got[("M1", 1, day(1))]["prev_clear_pallets"] == 5.0
    assert got[("M1", 1, day(7))]["prev_clear_pallets"] == 0.0


def test_propagating_policy_sql_form(t):
    got = by_key(totals.daily_inventory(t), "material_id", "location_id", "day")
    m1 = got[("M1", 1, day(0))]
    assert m1["clear_pallets_daily"] == 10.0 and m1["clear_cases_daily"] == 50.0
    m2 = got[("M2", 1, day(0))]   # NULL divisor propagates
    assert m2["clear_cases_daily"] is None and m2["clear_dollars_daily"] is None
    m3 = got[("M3", 1, day(0))]   # restricted = quality + restricted
    assert m3["restricted_pallets_daily"] == 3.0 and m3["restricted_cases_daily"] is None
    m4 = got[("M4", 1, day(0))]   # no price: NULL dollars (no 0 default here)
    assert m4["clear_cases_daily"] == 4.0 and m4["clear_dollars_daily"] is None


def test_daily_share_and_totals(t):
    got = by_key(totals.daily_share(t), "material_id", "location_id", "day")
    today = [r for k, r in got.items() if k[2] == day(0)]
    # pallet total of the day: sum of clear+blocked+restricted over all keys of the day
    total = sum(r["clear_pallets_daily"] + r["blocked_pallets_daily"] + r["restricted_pallets_daily"]
                for r in today)
    assert total == 21.0
    m1 = got[("M1", 1, day(0))]
    assert m1["clear_pallets_daily_pct"] == pytest.approx(10.0 / 21.0 * 100)


def test_week_key_at_year_boundary(spark):
    rows = [stock_row("M1", 1, 0, clear=1.0, SnapshotDate=dt.datetime(2024, 12, 30, 6),
                      AvailableDate=dt.date(2024, 12, 30))]
    t = tables(spark, master=MASTER, stock=rows)
    as_written = totals.weekly_inventory(t).collect()[0]
    iso = totals.weekly_inventory(t, iso=True).collect()[0]
    assert (as_written["year"], as_written["week"]) == (2024, 1)
    assert (iso["year"], iso["week"]) == (2025, 1)


# Eight-character material ids: order lines carry them as the last 8 characters.
M1, M7 = "11000001", "11000007"
PLAN = [
    # (d0, loc 1, M1): two snapshots; the newer one wins.
    {"DATE": day(0), "LocationID": 1, "MaterialID": M1, "SnapshotDate": day(2), "Modified_date": day(2),
     "ConsensusDemandPlan": 100.0, "SalesActualCustomerOrders": 1.0, "DependentDemand": 2.0},
    {"DATE": day(0), "LocationID": 1, "MaterialID": M1, "SnapshotDate": day(1), "Modified_date": day(1),
     "ConsensusDemandPlan": 5.0, "SalesActualCustomerOrders": 1.0, "DependentDemand": 2.0},
    # Same snapshot, later modification wins.
    {"DATE": day(0), "LocationID": 2, "MaterialID": M1, "SnapshotDate": day(1), "Modified_date": day(1),
     "ConsensusDemandPlan": 9.0, "SalesActualCustomerOrders": 0.0, "DependentDemand": 0.0},
    {"DATE": day(0), "LocationID": 2, "MaterialID": M1, "SnapshotDate": day(1), "Modified_date": day(0),
     "ConsensusDemandPlan": 3.0, "SalesActualCustomerOrders": 0.0, "DependentDemand": 0.0},
    # NULL dependent demand -> NULL demand quantity.
    {"DATE": day(0), "LocationID": 1, "MaterialID": "M2", "SnapshotDate": day(1), "Modified_date": day(1),
     "ConsensusDemandPlan": 4.0, "SalesActualCustomerOrders": 1.0, "DependentDemand": None},
]
ORDERS = [
    {"MaterialNumber": "0000000000" + M1, "GoodsIssueDate": day(0),
     "ActualQuantityDeliveredInSalesUnits": 4.0, "ConfirmedQuantity": 4.0},
    {"MaterialNumber": "0000000000" + M1, "GoodsIssueDate": day(0),
     "ActualQuantityDeliveredInSalesUnits": 6.0, "ConfirmedQuantity": None},
    {"MaterialNumber": "0000000000" + M7, "GoodsIssueDate": day(0),   # order without a plan
     "ActualQuantityDeliveredInSalesUnits": 2.0, "ConfirmedQuantity": 2.0},
    {"MaterialNumber": "M2", "GoodsIssueDate": day(0),                 # shorter than 8 characters
     "ActualQuantityDeliveredInSalesUnits": 0.0, "ConfirmedQuantity": 0.0},
    {"MaterialNumber": "0000000000" + M1, "GoodsIssueDate": day(40),  # outside 28 days
     "ActualQuantityDeliveredInSalesUnits": 50.0, "ConfirmedQuantity": 50.0},
]


@pytest.fixture(scope="module")
def d(spark):
    return tables(spark, master=MASTER, plan=PLAN, orders=ORDERS)


def test_latest_plan_and_demand_quantity(d):
    got = by_key(demand.demand_quantity(d.demand_plan), "DATE", "LocationID", "MaterialID")
    assert got[(day(0), 1, M1)]["ConsensusDemandPlan"] == 5.0
    assert got[(day(0), 1, M1)]["Demand_Quantity_Cases"] == 8.0
    assert got[(day(0), 2, M1)]["ConsensusDemandPlan"] == 3.0
    assert got[(day(0), 1, "M2")]["Demand_Quantity_Cases"] is None


def test_bias_28d_as_written(d):
    got = by_key(demand.bias_28d(d, AS_OF), "DATE", "LocationID", "MaterialID")
    # two order lines meet each location's plan row: demand counted once per line
    loc1 = got[(day(0), 1, M1)]
    assert (loc1["Total_Actual_Quantity_Cases"], loc1["Total_Demand_Quantity_Cases"]) == (10.0, 16.0)
    assert loc1["Bias_Perc"] == pytest.approx(0.6)
    loc2 = got[(day(0), 2, M1)]
    assert loc2["Total_Demand_Quantity_Cases"] == 6.0 and loc2["Bias_Perc"] == pytest.approx(0.4)
    m7 = got[(day(0), None, M7)]   # no plan: no location, NULL demand and bias
    assert m7["Total_Demand_Quantity_Cases"] is None and m7["Bias_Perc"] is None
    m2 = got[(day(0), 1, "M2")]      # zero actuals: NULL bias, not an error
    assert m2["Total_Actual_Quantity_Cases"] == 0.0 and m2["Bias_Perc"] is None
    assert len(got) == 4             # the 40-day-old line is outside the window


def test_bias_aligned_and_signed(d):
    got = by_key(demand.bias_28d_aligned(d, AS_OF), "DATE", "MaterialID")
    m1 = got[(day(0), M1)]
    assert (m1["Total_Actual_Quantity_Cases"], m1["Total_Demand_Quantity_Cases"]) == (10.0, 11.0)
    assert m1["Bias_Perc"] == pytest.approx(0.1)
    signed = by_key(demand.bias_signed(d, AS_OF), "DATE", "MaterialID")
    assert signed[(day(0), M1)]["Bias"] == pytest.approx(0.1)


def test_bias_90d_as_written(d):
    got = by_key(demand.bias_90d(d, AS_OF), "DATE", "LocationID", "MaterialID")
    # all snapshots in the window are summed: 100 + 5; confirmed: 4 + NULL + 50
    m1 = got[(day(0), 1, M1)]
    assert (m1["DemandForecast"], m1["ActualDemand"]) == (105.0, 54.0)
    assert m1["Bias"] == round(abs(105.0 - 54.0) / 54.0, 3)


def test_on_hand_metrics_class_form(spark):
    t = tables(spark, master=MASTER, stock=STOCK,
               plan=[{"DATE": day(0), "LocationID": 1, "MaterialID": "M1"},
                     {"DATE": day(0), "LocationID": 1, "MaterialID": "M1"},
                     {"DATE": day(0), "LocationID": 3, "MaterialID": "M5"}])
    rows = onhand.on_hand_metrics(t, AS_OF).collect()
    m1 = [r for r in rows if r["material_id"] == "M1"]
    assert len(m1) == 4   # each batch row of the key once, whatever the plan snapshots
    today = [r for r in m1 if r["doh_today"] is not None]
    assert {r["doh_today"] for r in today} == {"12"} and len(today) == 2
    assert all(r["doh_yesterday"] == "11" and r["date"] == "2025-01-12" for r in rows)
    blocked = [r for r in today if r["blocked_in_pallets"] == 1.0][0]
    assert blocked["inventory_blocked_cases"] == 5.0
    assert blocked["inventory_restricted_cases"] is None   # blocked + NULL restricted
    m5 = [r for r in rows if r["material_id"] == "M5"]     # plan row without stock
    assert len(m5) == 1 and m5[0]["clear_in_pallets"] is None


def test_plan_driven_daily_rows(spark):
    t = tables(spark, master=MASTER, stock=STOCK,
               plan=[{"DATE": day(0), "LocationID": 1, "MaterialID": "M1"}
                     for i in range(3)] + [{"DATE": day(0), "LocationID": 5, "MaterialID": "M2"}])
    rows = holding.plan_stock_rows(t, AS_OF).collect()
    m1 = [r for r in rows if r["MaterialID"] == "M1"]
    assert sorted(r["PalletStockUnRestricted"] for r in m1) == [4.0, 6.0]
    no_stock = [r for r in rows if r["MaterialID"] == "M2"]
    assert len(no_stock) == 1 and no_stock[0]["Day"] is None   # plan row without stock
    # stock without a plan row (M3, M4, M9) is not in the plan-driven table
    assert {r["MaterialID"] for r in rows} == {"M1", "M2"}


def test_reference_column_names(t):
    named = holding.with_reference_names(holding.holding_report(t, AS_OF))
    cols = named.columns
    assert cols[:6] == ["Date", "Location", "Material ID", "Inventory_Clear", "Inventory_Restricted",
                        "Inventory_Blocked"]
    assert "Last_Week_Inventory_Clear_%" in cols and "DOH_Yesterday" in cols
    row = named.filter("`Material ID` = 'M1'").collect()[0]
    assert row["Inventory_Clear"] == row["InventoryClear_pallets"] == 10.0
    assert row["Last_Week_Inventory_Clear_%"] == 100.0


def test_plan_driven_report(spark):
    t = tables(spark, master=MASTER, stock=STOCK,
               plan=[{"DATE": day(0), "LocationID": 1, "MaterialID": "M1"},
                     {"DATE": day(0), "LocationID": 1, "MaterialID": "M1"},
                     {"DATE": day(0), "LocationID": 2, "MaterialID": "M1"}])
    got = by_key(holding.holding_report(t, AS_OF, driver="plan"), "material_id", "location_id")
    assert set(got) == {("M1", 1), ("M1", 2)}       # planned keys only, once each
    assert got[("M1", 1)]["clear_dollars"] == 250.0
    m12 = got[("M1", 2)]                             # planned, no stock today: zeros
    assert (m12["clear_pallets"], m12["clear_cases"], m12["doh_today"]) == (0.0, 0.0, 0)
    assert m12["last_week_clear_pallets"] == 8.0 and m12["wow_clear_pct"] == -100.0
    with pytest.raises(ValueError):
        holding.holding_report(t, AS_OF, driver="other")


def test_pallet_source_and_restricted_rule(t):
    # M3 today: clear 2, restricted 1, quality 2 (units columns mirror pallets in these rows)
    units = by_key(holding.daily_holding(t, AS_OF, pallet_source="inventory_stock",
                                         restricted_rule="quality_plus_restricted"),
                   "material_id", "location_id")
    assert units[("M3", 1)]["restricted_pallets"] == 3.0
    per_pallet = by_key(holding.daily_holding(t, AS_OF, pallet_source="units_per_pallet"),
                        "material_id", "location_id")
    assert per_pallet[("M1", 1)]["clear_pallets"] == 1.0       # 10 units / 10 per pallet
    assert per_pallet[("M9", 1)]["clear_pallets"] == 0.0       # no master: NULL -> 0
    doubled = by_key(holding.daily_holding(t, AS_OF, restricted_rule="blocked_plus_restricted"),
                     "material_id", "location_id")
    assert doubled[("M1", 1)]["restricted_pallets"] == 0.0     # blocked 1 + NULL restricted
    with pytest.raises(ValueError):
        holding.daily_holding(t, AS_OF, restricted_rule="quality_plus_restricted")


def test_wide_report_aligned_rows(spark):
    from holdcast.operators import report, snapshots
    # Two days of ISO week 2025-W02 for (M1, 1), one day for (M2, 1); plan and order for (M1, 1) on day(0).
    s = [stock_row("M1", 1, 0, clear=4.0), stock_row("M1", 1, 1, clear=6.0),
         stock_row("M2", 1, 0, clear=10.0)]
    plan = [{"DATE": day(0), "LocationID": 1, "MaterialID": "M1", "SnapshotDate": day(1),
             "Modified_date": day(1), "ConsensusDemandPlan": 5.0, "SalesActualCustomerOrders": 0.0,
             "DependentDemand": 0.0}]
    orders = [{"MaterialNumber": "M1", "GoodsIssueDate": day(0),
               "ActualQuantityDeliveredInSalesUnits": 4.0, "ConfirmedQuantity": 4.0}]
    t = tables(spark, master=MASTER, stock=s, plan=plan, orders=orders,
               hierarchy=[{"MaterialID": "M1", "Division": "D", "Network": "AMBIENT",
                           "ProductLevel3CategoryID": "P"}])
    got = by_key(report.wide_report_aligned(t, AS_OF), "material_id", "location_id", "day")
    assert set(got) == {("M1", 1, day(0)), ("M1", 1, day(1)), ("M2", 1, day(0))}
    today, yday = got[("M1", 1, day(0))], got[("M1", 1, day(1))]
    assert (today["year"], today["week"]) == (2025, 2)
    assert today["clear_pallets_weekly"] == yday["clear_pallets_weekly"] == 10.0
    assert today["clear_pallets_daily_pct"] == pytest.approx(4.0 / 14.0 * 100)   # day total 4 + 10
    assert today["clear_pallets_weekly_pct"] == pytest.approx(10.0 / 20.0 * 100)  # week total 10 + 10
    assert today["Network"] == "AMBIENT" and got[("M2", 1, day(0))]["Network"] is None
    assert today["Bias_Perc"] == pytest.approx(0.25)       # |5 - 4| / 4 on its own day only
    assert yday["Bias_Perc"] is None

    snaps = snapshots.latest_snapshot(t).collect()
    m1 = [r for r in snaps if r["material_id"] == "M1"]
    assert len(m1) == 2 and {r["latest_date"] for r in m1} == {ts(0)}
