"""Joins of a fact to a side that has one row per key.

Rows of popular keys are split by adaptive execution, which session.py forces on: it
measures the shuffled partitions, so there is no list of hot keys to keep. Only rows that
cannot match are spread here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(
    fact: DataFrame, dim: DataFrame, on: list[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join a fact to a dimension that has one row per key.

    In a left join rows with a NULL key match nothing; they are dealt out by a hash of
    the row and do not meet in one task.
    """
    if null_safe:
        return null_safe_join(fact, dim, on, how)
    if how != "left":
        return fact.join(dim, on, how)
    unmatched = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    left = fact.withColumn("_spread", F.when(unmatched, F.expr("xxhash64(*)")).otherwise(F.lit(0)))
    return left.join(dim.withColumn("_spread", F.lit(0).cast("bigint")), [*on, "_spread"], how).drop("_spread")


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi join in which NULL keys match each other; keys come from the left."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on])
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])


def attach_group_values(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """``agg(...) over (partition by keys)`` for order-free aggregates.

    A window puts a whole group in one task. Here the group is reduced by partial
    aggregation and its one row is joined back. ``df`` is read twice: pass a stored table.
    """
    return null_safe_join(df, df.groupBy(*keys).agg(*aggs), keys)
