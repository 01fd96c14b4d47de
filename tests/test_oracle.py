"""Every registered query against its DuckDB SQL at sf0.01 (the correctness gate)."""

import pytest

import __spark_entry__ as entry
from holdcast.plans import catalog, oracle
from compare import compare, duck
from conftest import SF_ORACLE, SF_SMALL

QUERIES = catalog.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == entry.entry(spark).columns


def test_smoke_scale_runs(spark):
    """Every query also runs on the smallest scale factor."""
    for q in QUERIES.values():
        q(spark, SF_SMALL).write.format("noop").mode("overwrite").save()
