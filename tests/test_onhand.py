"""On-hand metrics over all history: distinct rows in tasks of a bounded size, however large the input is."""

import math

from holdcast.operators import onhand
from literal import AS_OF, stock_row, tables


def _tables(spark):
    master = [{"MaterialID": m, "ProductPlanningUnitsPerPallet": 10, "ProductPlanningUnitsPerCase": 2, "ProductListPrice": price, "ProductStandardCost": cost}
              for m, price, cost in (("a", 2.0, 1.0), ("a", 2.0, 3.0), ("a", None, 4.0), ("b", None, None), ("b", None, None), (None, 1.0, 1.0))]
    stock = [stock_row("a", 1, d, x, 0.0, None) for d in (0, 1) for x in (5.0, 5.0, 6.0, 0.0, -0.0, math.nan, math.nan)]
    stock += [stock_row("c", 2, 3, 1.0)] * 4 + [stock_row(None, 1, 0, 1.0), stock_row("a", None, 0, 1.0), stock_row("z", 1, 0, 9.0)]
    plan = [{"DATE": AS_OF, "MaterialID": m, "LocationID": loc} for m, loc in (("a", 1), ("a", 1), ("b", 1), ("c", 2), (None, 1), ("a", None))]
    return tables(spark, master=master, stock=stock, plan=plan)


def _text(rows):
    return sorted(str(r.asDict()) for r in rows)


def test_distinct_rows_are_those_of_the_whole_join(spark, monkeypatch):
    t = _tables(spark)
    monkeypatch.setattr(onhand, "ROWS_PER_TASK", 2)
    assert _text(onhand.on_hand_join(t, distinct=True).collect()) == _text(onhand.on_hand_join(t).dropDuplicates().collect())
    got = onhand.on_hand_metrics(t, AS_OF).select("material_id", "location_id", "clear_in_pallets", "snapshot_date", "inventory_clear_dollars").collect()
    # a: 4 pallet values on 2 days beside prices 2 and 4; a without a place: the 2 prices; b, c and the key without a material: one each.
    assert len([r for r in got if r["material_id"] == "a" and r["location_id"] == 1]) == 16
    assert len(got) == 16 + 2 + 3


def test_a_task_takes_so_many_rows_and_sorts_none(spark, monkeypatch):
    t = _tables(spark)
    monkeypatch.setattr(onhand, "ROWS_PER_TASK", 2, raising=False)
    plan = onhand.on_hand_metrics(t, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert t.batch_inventory.count() == 21
    assert ", 11), REPARTITION_BY_NUM" in plan                 # half of 21 rows, more than the session's 8
    assert "SortMergeJoin [coalesce" not in plan and "doh_today" not in "".join(x for x in plan.split("\n") if "HashAggregate" in x)
