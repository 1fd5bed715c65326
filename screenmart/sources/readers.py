"""Catalogs over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmart.catalog import Catalog, Options
from screenmart.sources.schemas import RELATIONAL, TABLES, struct_type


def parquet_catalog(spark: SparkSession, base: str, options: Options | None = None) -> Catalog:
    """``base/<table>`` Parquet folders; events are partitioned by ``event_date``."""

    def reader(name: str):
        return lambda: spark.read.schema(struct_type(name)).parquet(f"{base}/{name}")

    return Catalog(spark, {name: reader(name) for name in TABLES}, options or Options())


def jdbc_options(
    options: dict[str, str], table: str, partitions: int, bounds: tuple[int | None, int | None], column: str
) -> dict[str, str]:
    """Reader options of a table in ``partitions`` slices of ``column``."""
    low, high = bounds
    if low is None or high is None:
        return {**options, "dbtable": table}
    slices = {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions)}
    return {**options, "dbtable": table, **slices}


def jdbc_table(
    spark: SparkSession, url: str, table: str, properties: dict[str, str], partitions: int = 64,
    bounds: tuple[int, int] | None = None, column: str = "id",
) -> DataFrame:
    """A relational table read in parallel slices of its key column.

    ``bounds`` only places the slices; rows outside them land in the end slices. Without
    them the key's smallest and largest value are asked for first. An empty table is one slice.
    """
    options = {"fetchsize": "10000", **properties, "url": url}
    if bounds is None:
        ask = f"(select min({column}) as low, max({column}) as high from {table}) as bounds"
        bounds = tuple(spark.read.format("jdbc").options(dbtable=ask, **options).load().first())
    reader = spark.read.format("jdbc").options(**jdbc_options(options, table, partitions, bounds, column))
    declared = struct_type(table.split(".")[-1])
    return reader.load().select(*[F.col(f.name).cast(f.dataType) for f in declared])


def mixed_catalog(
    spark: SparkSession, jdbc_url: str, properties: dict[str, str], events_path: str,
    bounds: dict[str, tuple[int, int]] | None = None, options: Options | None = None,
) -> Catalog:
    """Relational tables over JDBC, events from Parquet."""
    bounds = bounds or {}

    def table(name: str):
        return lambda: jdbc_table(spark, jdbc_url, name, properties, bounds=bounds.get(name))

    sources = {name: table(name) for name in RELATIONAL}
    sources["events"] = lambda: spark.read.schema(struct_type("events")).parquet(events_path)
    return Catalog(spark, sources, options or Options())


def events_since(events: DataFrame, epoch: str) -> DataFrame:
    """Days from ``epoch`` (yyyyMMdd) on; prunes ``event_date`` partitions."""
    return events.where(F.col("event_date") >= F.lit(epoch))
