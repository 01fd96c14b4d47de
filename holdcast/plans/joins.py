"""Join shapes shared by the metrics, with their scale reasoning.

* Dimension joins (material master, hierarchy) carry no hint. A dimension
  grows with the catalogue, not with stock volume, but nothing bounds it, so
  Spark decides: the planner broadcasts it when its estimated size is under
  ``spark.sql.autoBroadcastJoinThreshold``, AQE re-checks the measured size at
  runtime, and beyond both it is a sort-merge join whose fact side (the
  preserved side of the left join) AQE can split when one material is hot.
* Calendar totals (one row per day or per week present in the data) are
  broadcast explicitly. Their size is bounded by the calendar span of the
  input, not by its volume: 100 TB of stock over two years still has 731
  days and 105 weeks; even every DATE Spark can represent is under 4 M days.
* Plan keys joined to batch rows: ``left_join_keys_to_rows`` rewrites the
  left join as a semi join plus the keys without a row, so the batch side (which holds
  the hot keys) is never the non-splittable side of an outer join. The plan is
  read once. Batch rows are read once in full, and once more for their two key
  columns alone: one pass over them would have to bring all rows of a key
  together, or shuffle every row a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdcast.schemas import Tables


def with_material_master(df: DataFrame, tables: Tables, columns: list[str]) -> DataFrame:
    """Left join the material master's ``columns`` on ``MaterialID``."""
    mm = tables.material_master.select("MaterialID", *columns)
    return df.join(mm, "MaterialID", "left")


def with_hierarchy(df: DataFrame, tables: Tables, on: str = "MaterialID") -> DataFrame:
    """Left join Division / Network / ProductLevel3CategoryID on material."""
    mh = tables.material_hierarchy.withColumnRenamed("MaterialID", on)
    return df.join(mh, on, "left")


# Sentinel for the NULL-period group of a totals table: period keys are joined
# as BIGINT (dates as day numbers), and no INT or day number equals it.
NULL_PERIOD = -(2 ** 63)


def _period_as_long(df: DataFrame, c: str) -> Column:
    e = F.unix_date(F.col(c)) if isinstance(df.schema[c].dataType, T.DateType) else F.col(c)
    return e.cast("long")


def with_calendar_totals(df: DataFrame, totals: DataFrame, on: list[str]) -> DataFrame:
    """Left join per-period totals, broadcast (size bounded by the calendar).

    ``totals`` is usually an aggregate of ``df`` itself. The totals side gets
    non-nullable keys (``coalesce(key, NULL_PERIOD)``), so the optimizer infers
    no ``IS NOT NULL`` filter for it; both branches then keep the same plan
    below their shuffle and Spark reuses that exchange instead of scanning and
    aggregating the input twice. SQL semantics are unchanged: a NULL key in
    ``df`` matches nothing, and the NULL-period totals row matches nothing.
    """
    keys = [f"_period_{i}" for i in range(len(on))]
    t = totals.select(
        *[F.coalesce(_period_as_long(totals, k), F.lit(NULL_PERIOD)).alias(n) for k, n in zip(on, keys)],
        *[c for c in totals.columns if c not in on])
    cond = [_period_as_long(df, k) == F.col(n) for k, n in zip(on, keys)]
    return df.join(F.broadcast(t), cond, "left").drop(*keys)


def left_join_keys_to_rows(keys: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """``keys LEFT JOIN rows`` for distinct ``keys`` contributing only ``on``.

    Equals the left join: rows whose key is in ``keys`` (semi join, the row
    side may be split by AQE when a key is hot), plus the keys that have no
    row, with NULL row columns (those that find nothing among the distinct row
    keys, which are pre-aggregated before the shuffle).

    Keys are compared null-safely and rows with a NULL key left out, which is
    what ``=`` means here, but lets the optimizer add no ``IS NOT NULL`` to one
    use of ``keys`` only: both uses keep one plan and share its exchange.
    """
    known = rows.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in on))
    wanted = keys.select(*[F.col(c).alias(f"_key_{c}") for c in on])
    same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in on]
    matched = known.join(wanted, same, "left_semi")
    # A left join, as the optimizer would push an anti join below the distinct of one use of ``keys``.
    found = known.select(*on).distinct().withColumn("_found", F.lit(True))
    missing = wanted.join(found, same, "left").filter("_found IS NULL")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name)
             for f in rows.schema.fields if f.name not in on]
    return matched.unionByName(missing.select(*[F.col(f"_key_{c}").alias(c) for c in on], *nulls))
