"""Exact distinct counts that merge: dense ids and bitmaps of them per key, united over any window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Groups that values are numbered in: a window orders one group, some 1 / GROUPS of the values.
GROUPS = 4096


def dense_ids(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, id): the distinct non-NULL values numbered 1, 2, 3, ...; with ``known`` ids only the new ones, numbered on.

    Values are numbered within a hash group, and groups follow each other: no value decides in one place. The
    same values get the same ids however often a lost task is run again.
    """
    found = values.where(F.col(column).isNotNull()).select(column).distinct()
    first = F.lit(0).cast("bigint")
    if known is not None:
        found = found.join(known.select(column), column, "left_anti")
        first = known.agg(F.coalesce(F.max("id"), F.lit(0).cast("bigint")).alias("last")).scalar()
    grouped = found.withColumn("_group", F.pmod(F.xxhash64(column), F.lit(GROUPS)))
    sizes = grouped.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    # GROUPS rows at most.
    sizes = sizes.select("_group", (F.sum("_n").over(Window.orderBy("_group")) - F.col("_n")).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_group").orderBy(column))
    return grouped.withColumn("_number", number).join(F.broadcast(sizes), "_group").select(column, (first + F.col("_before") + F.col("_number")).alias("id"))


def bitmap_rows(df: DataFrame, keys: list[str], id_column: str = "id") -> DataFrame:
    """(keys..., bucket, bits): the ids of each key as bitmaps of 32,768 ids each. NULL ids are in none."""
    known = df.where(F.col(id_column).isNotNull())
    return known.groupBy(*keys, F.bitmap_bucket_number(id_column).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_column)).alias("bits")
    )


def united(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of coarser keys: a row per key and bucket, whatever the number of rows and ids behind them."""
    return rows.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Distinct ids per key over all bitmaps of it."""
    return united(rows, keys).groupBy(*keys).agg(n_ids().alias(out))


def n_ids(where: Column | None = None) -> Column:
    bits = F.bitmap_count("bits")
    return F.coalesce(F.sum(bits if where is None else F.when(where, bits)), F.lit(0).cast("bigint"))
