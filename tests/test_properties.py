"""Random small tables vs a plain-Python computation of the same definitions."""

import math
from collections import defaultdict

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from holdcast.operators import demand, holding
from literal import AS_OF, day, stock_row, tables

MATS = ["M1", "M2", "M3"]
pallet = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5, 7.0]))
stock_rows = st.lists(st.tuples(st.sampled_from(MATS), st.sampled_from([1, 2]),
                                st.sampled_from([0, 1, 7, 8]), pallet, pallet, pallet,
                                st.one_of(st.none(), st.integers(0, 9))), max_size=14)
masters = st.lists(st.tuples(st.sampled_from(MATS), st.one_of(st.none(), st.sampled_from([0, 4, 10])),
                             st.one_of(st.none(), st.sampled_from([0, 1, 3])),
                             st.one_of(st.none(), st.just(2.0)), st.one_of(st.none(), st.just(1.5))),
                   max_size=3, unique_by=lambda r: r[0])

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@SETTINGS
@given(rows=stock_rows, master=masters)
def test_holding_report_matches_definition(spark, rows, master):
    m = [{"MaterialID": k, "ProductPlanningUnitsPerPallet": upp, "ProductPlanningUnitsPerCase": upc,
          "ProductListPrice": lp, "ProductStandardCost": sc} for k, upp, upc, lp, sc in master]
    s = [stock_row(mat, loc, off, clear=c, restricted=r, blocked=b, day_count=dc)
         for mat, loc, off, c, r, b, dc in rows]
    got = {(x["material_id"], x["location_id"]): x
           for x in holding.holding_report(tables(spark, master=m, stock=s), AS_OF).collect()}

    mm = {r["MaterialID"]: r for r in m}
    sums = defaultdict(lambda: defaultdict(lambda: None))
    seen_today = set()
    for mat, loc, off, c, r, b, dc in rows:
        acc = sums[(mat, loc)]
        for name, v in (("clear", c), ("restricted", r), ("blocked", b)):
            if v is not None:
                acc[(off, name)] = (acc[(off, name)] or 0.0) + v
        if dc is not None:
            acc[(off, "day")] = max(acc[(off, "day")] or dc, dc)
        if off == 0:
            seen_today.add((mat, loc))
    assert set(got) == seen_today
    for key in seen_today:
        acc, g = sums[key], got[key]
        mrow = mm.get(key[0], {})
        upp = mrow.get("ProductPlanningUnitsPerPallet") or 0
        upc = mrow.get("ProductPlanningUnitsPerCase")
        upc = 1 if upc is None else upc
        price = next((p for p in (mrow.get("ProductListPrice"), mrow.get("ProductStandardCost"))
                      if p is not None), 0.0)
        for s_ in ("clear", "restricted", "blocked"):
            p = acc[(0, s_)] or 0.0
            cases = None if upc == 0 else p * upp / upc
            assert _close(g[f"{s_}_pallets"], p)
            assert _close(g[f"{s_}_cases"], cases)
            assert _close(g[f"{s_}_dollars"], None if cases is None else cases * price)
            lw = acc[(7, s_)] or 0.0
            assert _close(g[f"last_week_{s_}_pallets"], lw)
            assert _close(g[f"wow_{s_}_pct"], (p - lw) / lw * 100 if lw != 0 else 0.0)
        assert g["doh_today"] == (acc[(0, "day")] or 0)
        assert g["doh_yesterday"] == (acc[(1, "day")] or 0)


plan_rows = st.lists(st.tuples(st.sampled_from([0, 1, 40]), st.sampled_from([1, 2]),
                               st.sampled_from(["11000001", "11000002"]), st.sampled_from([1, 2, 3]),
                               st.sampled_from([1, 2]), st.sampled_from([1.0, 4.0, 9.0]),
                               st.one_of(st.none(), st.just(2.0))), max_size=10)
order_rows = st.lists(st.tuples(st.sampled_from([0, 1, 40]), st.sampled_from(["11000001", "11000002"]),
                                st.one_of(st.none(), st.sampled_from([0.0, 3.0, 5.0]))), max_size=10)


@SETTINGS
@given(plans=plan_rows, orders=order_rows)
@example(plans=[(1, 2, "11000002", 2, 2, 1.0, 2.0), (1, 2, "11000002", 2, 2, 4.0, None)], orders=[(1, "11000002", 2.0)])
def test_bias_28d_matches_line_level_definition(spark, plans, orders):
    p = [{"DATE": day(d), "LocationID": loc, "MaterialID": mat, "SnapshotDate": day(d + snap),
          "Modified_date": day(d + mod), "ConsensusDemandPlan": cdp, "SalesActualCustomerOrders": 1.0,
          "DependentDemand": dd}
         for i, (d, loc, mat, snap, mod, cdp, dd) in enumerate(plans)]
    o = [{"MaterialNumber": "0000000000" + mat, "GoodsIssueDate": day(d),
          "ActualQuantityDeliveredInSalesUnits": a, "ConfirmedQuantity": a} for d, mat, a in orders]
    got = {(r["DATE"], r["LocationID"], r["MaterialID"]): r
           for r in demand.bias_28d(tables(spark, plan=p, orders=o), AS_OF).collect()}

    latest = {}
    for r in p:
        k = (r["DATE"], r["LocationID"], r["MaterialID"])
        # Ties of the two dates as the SQL ranks them: larger quantities first, NULL last.
        order = (r["SnapshotDate"], r["Modified_date"], r["ConsensusDemandPlan"], r["SalesActualCustomerOrders"],
                 r["DependentDemand"] is not None, r["DependentDemand"] or 0.0)
        if k not in latest or order > latest[k][0]:
            latest[k] = (order, r)
    groups = defaultdict(lambda: [[], []])
    for line in o:
        if line["GoodsIssueDate"] < day(28):
            continue
        d, mat = line["GoodsIssueDate"], line["MaterialNumber"][-8:]
        matches = [r for (kd, _, km), (_, r) in latest.items() if kd == d and km == mat]
        for r in matches or [None]:
            g = groups[(d, r["LocationID"] if r else None, mat)]
            g[0].append(line["ActualQuantityDeliveredInSalesUnits"])
            dq = None
            if r is not None and r["DependentDemand"] is not None:
                dq = r["ConsensusDemandPlan"] + r["SalesActualCustomerOrders"] + r["DependentDemand"]
            g[1].append(dq)
    assert set(got) == set(groups)

    def sql_sum(xs):
        xs = [x for x in xs if x is not None]
        return sum(xs) if xs else None

    for k, (acts, dems) in groups.items():
        a, dsum = sql_sum(acts), sql_sum(dems)
        assert _close(got[k]["Total_Actual_Quantity_Cases"], a)
        assert _close(got[k]["Total_Demand_Quantity_Cases"], dsum)
        want = None if (a in (None, 0) or dsum is None) else abs((dsum - a) / a)
        assert _close(got[k]["Bias_Perc"], want)


key = st.tuples(st.sampled_from(["A", "B", "C", None]), st.sampled_from([1, 2]))


@SETTINGS
@given(keys=st.lists(key, max_size=6, unique=True),
       rows=st.lists(st.tuples(key, st.one_of(st.none(), st.integers(0, 3))), max_size=12))
def test_semi_anti_rewrite_equals_left_join(spark, keys, rows):
    from pyspark.sql import types as T

    from holdcast.plans.joins import left_join_keys_to_rows
    ks = T.StructType([T.StructField("m", T.StringType()), T.StructField("l", T.IntegerType())])
    rs = T.StructType(ks.fields + [T.StructField("v", T.IntegerType())])
    kdf = spark.createDataFrame(keys, ks)
    rdf = spark.createDataFrame([(m, l, v) for (m, l), v in rows], rs)
    got = left_join_keys_to_rows(kdf, rdf, ["m", "l"])
    want = kdf.join(rdf, ["m", "l"], "left")
    from collections import Counter
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.select(got.columns).collect()))
