"""Idempotent copy of event days, remembered in a manifest table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "event_date string"


@dataclass
class BackfillReport:
    copied: list[str] = field(default_factory=list)
    skipped: int = 0
    failed: dict[str, str] = field(default_factory=dict)
    total: int = 0


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """Days already copied; empty when the manifest does not exist yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(manifest)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)


def pending_days(days: DataFrame, manifest: DataFrame) -> DataFrame:
    """Source days the manifest does not hold."""
    return days.select("event_date").distinct().join(manifest, "event_date", "left_anti")


def _exists(spark: SparkSession, path: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def copy_days(
    spark: SparkSession, source: DataFrame, target: str, manifest: str, dry_run: bool = False
) -> BackfillReport:
    """Append the days not copied yet to ``target``, split by day and event name.

    Within a day the files are split by ``event_name`` too: each event family then
    reads its own folders only. Rebalancing splits a dominant event name over many
    tasks and joins the small ones. Days are few (one row per day), so the loop
    runs on the driver; each day's data is one distributed write that fails or
    succeeds as a whole. A day that is complete in the target (``_SUCCESS``) is never
    overwritten, only recorded: the manifest missed it when a run ended in between. What a
    broken write left of a day is replaced.
    """
    done = read_manifest(spark, manifest)
    all_days = source.select("event_date").distinct()
    report = BackfillReport(total=all_days.count())
    todo = sorted(r[0] for r in pending_days(all_days, done).toLocalIterator())
    report.skipped = report.total - len(todo)
    for day in todo:
        if dry_run:
            report.copied.append(day)
            continue
        try:
            folder = f"{target}/event_date={day}"
            if not _exists(spark, f"{folder}/_SUCCESS"):
                (
                    source.where(F.col("event_date") == day)
                    .drop("event_date")
                    .hint("rebalance", F.col("event_name"))
                    .write.mode("overwrite")
                    .partitionBy("event_name")
                    .parquet(folder)
                )
            spark.createDataFrame([(day,)], MANIFEST_SCHEMA).write.mode("append").parquet(manifest)
            report.copied.append(day)
        except Exception as error:  # a failed day must not stop the others
            report.failed[day] = str(error)
    return report
