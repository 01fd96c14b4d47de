"""Kept tables: incremental latest plan and period reports equal fresh runs, and old versions stay."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from holdcast.operators import demand, totals
from holdcast.plans import latest, periods
from holdcast.plans.versions import Versions
from literal import AS_OF, day, stock_row, tables

ROUND = 6


def _same(a, b):
    order = sorted(a.columns)
    assert order == sorted(b.columns)
    cut = lambda df: df.select([F.round(c, ROUND).alias(c) if dict(df.dtypes)[c] == "double" else F.col(c) for c in order])
    a, b = cut(a), cut(b)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


# ---- versions ----

def _days(spark, *rows):
    return spark.createDataFrame(list(rows), "x int, day date")


def test_versions_are_whole_and_old_ones_stay(spark, tmp_path):
    v = Versions(spark, str(tmp_path))
    assert v.current() == 0 and v.read("t") is None
    d1, d2 = day(1), day(2)
    draft = v.begin(AS_OF - dt.timedelta(days=1), "a")
    draft.write("t", _days(spark, (1, d1), (2, d2), (3, None)), "day")
    assert v.read("t") is None                                   # nothing before publish
    assert draft.publish() == 1
    draft = v.begin(AS_OF, "b")
    after = draft.write("t", _days(spark, (9, d2)), "day", [d1, d2])
    assert {r["x"] for r in after.collect()} == {9, 3}           # d1 has lost its rows, NULL is untouched
    assert {r["x"] for r in v.read("t").collect()} == {1, 2, 3}
    assert draft.publish() == 2
    assert {(r["x"], r["day"]) for r in v.read("t").collect()} == {(9, d2), (3, None)}
    assert {r["x"] for r in v.read("t", 1).collect()} == {1, 2, 3} and {r["x"] for r in v.read("t", parts=[None]).collect()} == {3}
    assert (v.version_at(AS_OF), v.version_at(day(1)), v.version_at(day(2)), v.note(), v.note(1)) == (2, 1, 0, "b", "a")
    assert v.read("t", 2).schema == v.read("t", 1).schema


def test_rows_outside_the_replaced_days_are_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="not replaced"):
        Versions(spark, str(tmp_path)).begin().write("t", _days(spark, (1, day(1)), (2, day(2))), "day", [day(1)])


def test_two_runs_of_one_number(spark, tmp_path):
    v = Versions(spark, str(tmp_path))
    one, two = v.begin(), v.begin()
    one.write("t", _days(spark, (1, day(1))), "day")
    one.publish()
    two.write("u", _days(spark, (2, day(1))), "day")
    with pytest.raises(RuntimeError, match="another run"):
        two.publish()
    assert v.current() == 1 and v.read("u") is None


def test_a_run_that_ended_early_is_written_over(spark, tmp_path):
    v = Versions(spark, str(tmp_path))
    v.begin().write("t", _days(spark, (1, day(1)), (2, day(2))), "day")          # never published
    draft = v.begin()
    draft.write("t", _days(spark, (3, day(1))), "day")
    draft.publish()
    assert [r["x"] for r in v.read("t").collect()] == [3]


# ---- latest plan ----

def _deliver(rows, root, d, columns=None):
    shutil.rmtree(f"{root}/{d:%Y/%m/%d}/plan", ignore_errors=True)
    rows.drop("delivery").write.parquet(f"{root}/{d:%Y/%m/%d}/plan")


def test_latest_plan_over_deliveries(spark, tables_small, tmp_path, monkeypatch):
    """New, late, re-sent and withdrawn folders: always what the whole archive gives; old folders are not opened."""
    archive, root = str(tmp_path / "archive"), str(tmp_path / "kept")
    plan = tables_small.demand_plan
    part = lambda k: plan.filter(F.pmod(F.hash("SnapshotDate", "ConsensusDemandPlan"), F.lit(4)) == k)
    opened = []
    real = latest._rows
    monkeypatch.setattr(latest, "_rows", lambda s, r, folders: opened.extend(f.day for f in folders) or real(s, r, folders))

    def check(*expected):
        opened.clear()
        version = latest.refresh_latest_plan(spark, archive, "plan", root, AS_OF)
        fresh = demand.latest_plan(spark.read.parquet(f"{archive}/*/*/*/plan"))
        _same(latest.read_latest_plan(spark, root), fresh)
        assert set(opened) == set(expected)
        return version

    _deliver(part(1), archive, day(9))
    _deliver(part(2), archive, day(8))
    assert check(day(9), day(8)) == 1
    assert check() == 1                                                           # nothing new
    wrong = part(3).withColumns({"ConsensusDemandPlan": F.col("ConsensusDemandPlan") + 1000, "Modified_date": F.date_add("Modified_date", 5)})
    _deliver(wrong, archive, day(7))
    assert check(day(7)) == 2
    _deliver(part(0), archive, day(20))                                           # late: an older day
    assert check(day(20)) == 3
    before = latest.read_latest_plan(spark, root, 2)
    count = before.count()
    _deliver(part(3).limit(40), archive, day(7))                                  # sent again, smaller and corrected
    check(day(7), day(8), day(9), day(20))
    shutil.rmtree(f"{archive}/{day(8):%Y/%m/%d}")                                 # withdrawn
    assert check(day(7), day(9), day(20)) == 5
    assert latest.read_latest_plan(spark, root, 2).count() == count               # an old version is still there


def test_only_touched_dates_are_rewritten(spark, tmp_path):
    archive, root = str(tmp_path / "a"), str(tmp_path / "k")
    row = lambda d, snap, x: {"DATE": d, "LocationID": 1, "MaterialID": "m", "SnapshotDate": snap, "Modified_date": snap, "ConsensusDemandPlan": x}
    _deliver(tables(spark, plan=[row(day(3), day(9), 1.0), row(day(2), day(9), 2.0), row(None, day(9), 3.0)]).demand_plan, archive, day(9))
    latest.refresh_latest_plan(spark, archive, "plan", root)
    _deliver(tables(spark, plan=[row(day(2), day(8), 5.0), row(None, day(8), 7.0)]).demand_plan, archive, day(8))
    latest.refresh_latest_plan(spark, archive, "plan", root)
    v = Versions(spark, root)
    assert {r["part"] for r in v.changes() if r["n"] == 2 and r["name"] == "latest_plan"} == {day(2), None}
    got = {r["DATE"]: r["ConsensusDemandPlan"] for r in latest.read_latest_plan(spark, root).collect()}
    assert got == {day(3): 1.0, day(2): 5.0, None: 7.0}


# ---- period reports ----

def _fresh(spark, t, stock):
    from dataclasses import replace
    from holdcast.schemas import BATCH_INVENTORY, conform
    t = replace(t, batch_inventory=conform(spark.read.parquet(stock), BATCH_INVENTORY))
    return {"daily_share": totals.daily_share(t), "daily_totals": totals.daily_totals(t),
            "weekly_share": totals.weekly_share(t, iso=True), "weekly_totals": totals.weekly_totals(t, iso=True)}


def _check(spark, t, stock, root):
    version = periods.refresh_periods(spark, t, stock, root, AS_OF)
    for name, want in _fresh(spark, t, stock).items():
        _same(periods.read_period(spark, root, name), want)
    return version


def _parts(spark, root, n, name):
    return {r["part"] for r in Versions(spark, root).changes() if r["n"] == n and r["name"] == name}


def test_period_reports_follow_changed_files(spark, tables_small, tmp_path):
    stock, root = str(tmp_path / "stock"), str(tmp_path / "kept")
    t, rows = tables_small, tables_small.batch_inventory
    cut = AS_OF - dt.timedelta(days=3)
    late = (F.pmod(F.hash("MaterialID"), F.lit(17)) == 0) & (F.col("AvailableDate") == F.lit(day(20)))
    rows.filter((F.col("AvailableDate") < F.lit(cut)) & ~late).write.parquet(stock)
    assert _check(spark, t, stock, root) == 1
    assert _check(spark, t, stock, root) == 1                                     # nothing new
    rows.filter(F.col("AvailableDate") >= F.lit(cut)).coalesce(1).write.mode("append").parquet(stock)
    assert _check(spark, t, stock, root) == 2
    assert _parts(spark, root, 2, "day_sums") == {day(i) for i in range(4)}
    assert _parts(spark, root, 2, "weekly_share") == {periods.monday(day(0))}
    rows.filter(late).coalesce(1).write.mode("append").parquet(stock)             # late rows of one old day
    assert _check(spark, t, stock, root) == 3
    assert _parts(spark, root, 3, "daily_share") == {day(20)} and _parts(spark, root, 3, "weekly_totals") == {periods.monday(day(20))}
    rows.limit(3).withColumn("SnapshotDate", F.lit(None).cast("timestamp")).coalesce(1).write.mode("append").parquet(stock)
    assert _check(spark, t, stock, root) == 4                                     # a day of their own
    assert _parts(spark, root, 4, "daily_totals") == _parts(spark, root, 4, "weekly_share") == {None}
    old = periods.read_period(spark, root, "daily_totals", 1)
    assert old.agg(F.max("day")).first()[0] == cut - dt.timedelta(days=1)
    assert periods.read_period(spark, root, "daily_totals", as_of=day(1)) is None


def test_rewritten_files_new_prices_and_gone_days(spark, tmp_path):
    stock, root = str(tmp_path / "stock"), str(tmp_path / "kept")
    master = lambda price: [{"MaterialID": "m", "ProductPlanningUnitsPerPallet": 10, "ProductPlanningUnitsPerCase": 2, "ProductListPrice": price}]
    write = lambda offset, *q: tables(spark, stock=[stock_row("m", i, offset, x, 1.0, 2.0) for i, x in enumerate(q)]
                                      ).batch_inventory.coalesce(1).write.mode("overwrite").parquet(f"{stock}/file{offset}")
    t = tables(spark, master=master(2.0))
    for offset in (0, 1, 9):
        write(offset, 5.0, 6.0)
    assert _check_nested(spark, t, stock, root) == 1
    write(1, 7.0)                                                                 # rewritten: fewer rows, other values
    assert _check_nested(spark, t, stock, root) == 2
    assert _parts(spark, root, 2, "day_sums") == {day(1)}
    shutil.rmtree(f"{stock}/file9")                                               # its day and week are gone
    assert _check_nested(spark, t, stock, root) == 3
    assert day(9) not in {r["day"] for r in periods.read_period(spark, root, "daily_share").collect()}
    t = tables(spark, master=master(3.0))                                         # reports from kept day sums
    assert _check_nested(spark, t, stock, root) == 4
    assert _parts(spark, root, 4, "day_sums") == set() and len(_parts(spark, root, 4, "daily_share")) == 2
    assert periods.read_period(spark, root, "daily_share", 1).count() == 6


def _check_nested(spark, t, stock, root):
    assert os.path.isdir(stock)
    version = periods.refresh_periods(spark, t, stock, root, AS_OF)
    for name, want in _fresh(spark, t, f"{stock}/*").items():
        _same(periods.read_period(spark, root, name), want)
    return version


def test_rows_of_days_are_pushed_down_as_ranges(spark, tables_small, tmp_path):
    tables_small.batch_inventory.write.parquet(str(tmp_path / "s"))
    stock = spark.read.parquet(str(tmp_path / "s"))
    days = {day(0), day(1), day(2), day(15)}
    got = periods.rows_of_days(stock, days)
    assert got.exceptAll(stock.filter(F.to_date("SnapshotDate").isin(list(days)))).count() == 0
    assert got.count() == stock.filter(F.to_date("SnapshotDate").isin(list(days))).count() > 0
    pushed = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in pushed
    assert periods.rows_of_days(stock, set()).count() == 0


def test_week_start_is_the_iso_monday(spark):
    days = [dt.date(2015, 12, 28) + dt.timedelta(days=3 * i) for i in range(900)]
    df = spark.createDataFrame([(d, periods.monday(d), *d.isocalendar()[:2]) for d in days], "d date, monday date, y int, w int")
    assert df.filter(periods.week_start(F.col("y"), F.col("w")) != F.col("monday")).count() == 0
    assert spark.createDataFrame([(None, None)], "y int, w int").select(periods.week_start(F.col("y"), F.col("w"))).first()[0] is None
