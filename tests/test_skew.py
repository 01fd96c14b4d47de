"""One hot key holding a third of all rows: every query still equals its oracle.

Every third line item is moved to part 1 / supplier 0, so one (material,
location) holds a third of the stock, plan and order rows. The DuckDB oracle
reads the same skewed ``lineitem`` through an unchanged SQL text. AQE's skew
thresholds are lowered so that its skew-join splitting actually runs.
"""

import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from conftest import SF_ORACLE
from holdcast.plans import catalog, oracle
from holdcast.sources.fixtures import tables_from

HOT = "l_orderkey % 3 = 0"
SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    part = spark.read.parquet(f"{SF_ORACLE}/part.parquet")
    li = spark.read.parquet(f"{SF_ORACLE}/lineitem.parquet")
    li = li.withColumns({"l_partkey": F.when(F.expr(HOT), F.lit(1)).otherwise(F.col("l_partkey")),
                         "l_suppkey": F.when(F.expr(HOT), F.lit(0)).otherwise(F.col("l_suppkey"))})
    # AQE splits a partition between map tasks, and the test file alone would be one task.
    yield tables_from(part, li.repartition(8))
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def con():
    c = duck(SF_ORACLE)
    c.execute(f"""CREATE OR REPLACE VIEW lineitem AS
        SELECT * REPLACE (CASE WHEN {HOT} THEN 1 ELSE l_partkey END AS l_partkey,
                          CASE WHEN {HOT} THEN 0 ELSE l_suppkey END AS l_suppkey)
        FROM read_parquet('{SF_ORACLE}/lineitem.parquet')""")
    return c


def test_hot_key_holds_a_third(skewed):
    n = skewed.batch_inventory.count()
    hot = skewed.batch_inventory.filter((F.col("MaterialID") == "11000001")
                                        & (F.col("LocationID") == 5000)).count()
    assert hot >= 0.3 * n


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_oracle_under_skew(skewed, con, name):
    ok, msg = compare(catalog.run_on(name, skewed), con, oracle.oracle_sql()[name])
    assert ok, f"{name}: {msg}"


def test_skew_join_splits_the_hot_partition(spark, skewed):
    df = catalog.run_on("stock_with_material", skewed)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in plan and "coalesced and skewed" in plan
