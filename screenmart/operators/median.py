"""Exact medians of many metrics by distributed selection in rounds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: First ranges: parts of a doubling of the value. No range spans more than 2 ** (1 / STEPS).
STEPS = 1024
#: Ranges that a round cuts the one with the middle rank into.
BUCKETS = 1 << 16


def _first_range(v: Column) -> Column:
    """A bucket number that never falls as the value grows; at most 2 * 1024 * STEPS of them."""
    return F.floor(F.signum(v) * F.log2(1 + F.abs(v)) * STEPS)


def _next_range(v: Column) -> Column:
    """The bucket within the range from ``_low`` to ``_high``, by equal steps."""
    low = F.col("_low") / 2  # halves, so that no difference overflows
    span = F.col("_high") / 2 - low
    return F.when(span > 0, F.least(F.floor((v / 2 - low) / span * BUCKETS), F.lit(BUCKETS - 1))).otherwise(0)


def _same(keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"_t{k}"))
    return out


def _targets(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """The bucket that holds each wanted rank, its rank therein, and the bucket's smallest and largest value."""
    ends = F.sum("_n").over(Window.partitionBy(*keys, "_which").orderBy("_bucket"))
    reached = buckets.withColumn("_end", ends).where((F.col("_end") >= F.col("_rank")) & (F.col("_end") - F.col("_n") < F.col("_rank")))
    within = (F.col("_rank") - (F.col("_end") - F.col("_n"))).alias("_rank")
    return reached.select(*[F.col(k).alias(f"_t{k}") for k in keys], "_which", within, "_low", "_high")


def exact_medians(df: DataFrame, values: Mapping[str, Column], by: list[str] | None = None, rounds: int = 0) -> DataFrame:
    """(by..., metric, median): the continuous 0.5 quantile of each value, per group, NULLs ignored.

    All metrics are read in one scan and counted by value. Their two middle ranks are then looked for together: the
    ranges of values that hold them are found from counts per range, cut anew if asked (``rounds`` times), and only what lies in the
    last ones is ordered. A window sees at most 2 * 1024 * STEPS ranges of a group, or BUCKETS, or the distinct values between two
    numbers that are 1 / (STEPS * BUCKETS ** rounds) of their size apart: of a thousand million evenly spread values half a million,
    and eight with one round. Any cuts give the exact answer. Without rows there are no groups.
    """
    keys = [*(by or []), "_metric"]
    named = F.array(*[F.struct(F.lit(name).alias("_metric"), value.cast("double").alias("_v")) for name, value in values.items()])
    rows = df.select(*(by or []), F.explode(named).alias("_m")).select(*(by or []), "_m.*").where(F.col("_v").isNotNull())
    counted = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))

    ranges = counted.groupBy(*keys, _first_range(F.col("_v")).alias("_bucket")).agg(
        F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    ranges = ranges.withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    both = F.array(*[F.struct(F.lit(i).alias("_which"), F.floor((F.col("_total") + i) / 2).alias("_rank")) for i in (1, 2)])
    targets = _targets(ranges.select("*", F.explode(both).alias("_r")).select("*", "_r.*"), keys)

    for number in range(rounds + 1):
        held = counted.join(targets, _same(keys) & F.col("_v").between(F.col("_low"), F.col("_high")))
        bucket = _next_range(F.col("_v")) if number < rounds else F.col("_v")
        held = held.groupBy(*keys, "_which", "_rank", bucket.alias("_bucket")).agg(
            F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
        )
        targets = _targets(held, keys)
    out = targets.groupBy(*[f"_t{k}" for k in keys]).agg((F.sum(F.when(F.col("_which") == 1, F.col("_low"))) + F.sum(F.when(F.col("_which") == 2, F.col("_low")))).alias("_sum"))
    return out.select(*[F.col(f"_t{k}").alias(k.removeprefix("_")) for k in keys], (F.col("_sum") / 2).alias("median"))


def exact_median(df: DataFrame, value: Column, by: list[str] | None = None, out: str = "median") -> DataFrame:
    """The continuous 0.5 quantile of one value per group. Groups without values are absent; without ``by`` there is one row."""
    medians = exact_medians(df, {out: value}, by).withColumnRenamed("median", "_median")
    if by:
        return medians.select(*by, F.col("_median").alias(out))
    return medians.agg(F.max("_median").alias(out))


def medians_in_a_row(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """One row with the median of each value; NULL where it has none."""
    return exact_medians(df, values).agg(*[F.max(F.when(F.col("metric") == name, F.col("median"))).alias(name) for name in values])
