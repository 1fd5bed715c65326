"""Data-quality checks, each returning the rows or counts that break a rule."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_rows) for all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL key combinations that occur more than once."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list with their row counts; NULL is accepted."""
    return (
        df.where(~F.col(column).isin(list(accepted)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent, with their row counts.

    The child is reduced to its distinct keys before the join, so a key that
    holds many rows costs one.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
    keys = keys.agg(F.count(F.lit(1)).alias("n_rows"))
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")
