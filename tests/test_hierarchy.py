"""Hierarchy of an old day: changes, gaps, current copy."""

import datetime as dt

from pyspark.sql import functions as F

from holdcast.operators import hierarchy
from literal import AS_OF, by_key, day, stock_row, tables

COPY = "MaterialID string, Division string, Network string, ProductLevel3CategoryID string, valid_from date"


def _copies(spark, *rows):
    return spark.createDataFrame([(m, d, "N", "P", since) for m, d, since in rows], COPY)


def test_two_versions_give_each_day_its_own(spark):
    t = tables(spark, stock=[stock_row("m", 1, i, 1.0) for i in (0, 3, 4, 5, 40)] + [stock_row("gone", 1, i, 1.0) for i in (0, 5)])
    copies = _copies(spark, ("m", "old", day(10)), ("gone", "x", day(10)), ("m", "new", day(4)), ("m", "now", None))
    got = by_key(hierarchy.daily_with_hierarchy(t, copies, day(50), AS_OF, current_from=day(1)), "material_id", "day")
    assert {k: r["Division"] for k, r in got.items()} == {
        ("m", AS_OF): "now", ("m", day(3)): "new", ("m", day(4)): "new", ("m", day(5)): "old", ("m", day(40)): None,
        ("gone", AS_OF): None, ("gone", day(5)): "x"}


def test_copies_without_a_change_are_one_span(spark):
    copies = _copies(spark, *[("m", "a", day(i)) for i in range(300, 100, -1)], ("m", "b", day(100)), ("m", "a", day(99)),
                     ("n", "a", day(300)), ("n", "a", day(150)), ("n", None, day(149)), ("m", "a", None))
    never = dt.date(9999, 12, 31)
    found = set((r["MaterialID"], r["Division"], r["valid_from"], r["valid_until"]) for r in hierarchy.intervals(copies).collect())
    assert found == {("m", "a", day(300), day(100)), ("m", "b", day(100), day(99)), ("m", "a", day(99), never),
                     ("n", "a", day(300), day(299)), ("n", "a", day(150), day(149)), ("n", None, day(149), day(148))}


def test_only_a_current_copy_holds_always(spark):
    t = tables(spark, stock=[stock_row("m", 1, 0, 1.0), stock_row("m", 1, 500, 1.0)])
    got = hierarchy.daily_with_hierarchy(t, _copies(spark, ("m", "now", None)), day(600), AS_OF).collect()
    assert [r["Division"] for r in got] == ["now", "now"]


def test_join_is_on_material_and_bucket(tables_small):
    now = tables_small.material_hierarchy
    copies = now.withColumn("valid_from", F.lit(day(20))).unionByName(now.withColumns({"Division": F.lit("x"), "valid_from": F.lit(day(9))}))
    df = hierarchy.daily_with_hierarchy(tables_small, copies, day(27), AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "_day_bucket" in plan
    assert df.count() == df.select("material_id", "location_id", "day").distinct().count()
