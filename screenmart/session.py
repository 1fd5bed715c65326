"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings only: master, memory and the shuffle width without adaptive execution belong to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # What one task reads, sorts or builds is bounded at every input size, whatever width the cluster was started with:
    # scans are cut small, exchanges start wide (still without a sort on the writing side), and adaptive execution merges what is small.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Files hold a few bytes a row; without this, millions of rows look small enough to broadcast.
    "spark.sql.sources.fileCompressionFactor": "4",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "screenmart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by the cluster, or None where it names none."""
    return spark.conf.get("spark.checkpoint.dir", None)
