"""Refresh of the days that changed: day-split tables whose folders are replaced day by day."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmart.catalog import REGISTRY, Catalog
from screenmart.plans.event_staging import SESSION_KEYS

DAY = "event_date"


def stored_days(spark: SparkSession, path: str) -> list[str]:
    """The days that a day-split table has folders of."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(n.removeprefix(f"{DAY}=") for n in names if n.startswith(f"{DAY}="))


def overwrite_days(df: DataFrame, path: str, days: Sequence[str]) -> None:
    """Replace the given days of a day-split table by the rows that ``df`` has for them; other days stay as they are.

    Rows are computed into a folder beside the table first, so ``df`` may read the table, and a day that has lost
    all its rows is seen and removed.
    """
    spark, staged = df.sparkSession, f"{path}__staged"
    df.where(F.col(DAY).isin(list(days))).hint("rebalance", F.col(DAY)).write.mode("overwrite").partitionBy(DAY).parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)
    gone = set(days) & set(stored_days(spark, path)) - set(stored_days(spark, staged))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    for day in gone:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{DAY}={day}"), True)


@dataclass
class DayTables(Catalog):
    """A catalog whose day-split datasets are kept as tables and brought up to date by the days that changed.

    Datasets of the layer "rows" follow from one day's events alone. Others also see facts of a whole session, so they
    change on every day on which a session has rows that has rows on a changed day.
    """

    store: str = ""
    kept: tuple[str, ...] = ()
    schemas: dict = field(default_factory=dict)

    def _table(self, name: str) -> str:
        return f"{self.store}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.schemas:
            return self.spark.read.schema(self.schemas[name]).parquet(self._table(name))
        return super().__getitem__(name)

    def _renew(self, name: str, days: Sequence[str]) -> None:
        df = REGISTRY[name].fn(self)
        overwrite_days(df, self._table(name), days)
        self.schemas[name] = df.schema
        self._memo.clear()

    def touched_days(self, days: Sequence[str]) -> list[str]:
        """The days and all others on which one of their sessions has rows; one row per day comes to the driver."""
        rows = [self[n].select(DAY, *SESSION_KEYS) for n in self.kept if REGISTRY[n].layer == "rows" and set(SESSION_KEYS) <= set(self[n].columns)]
        if not rows:
            return sorted(days)
        everywhere = reduce(DataFrame.unionByName, rows)
        user, session = (F.col(k) for k in SESSION_KEYS)
        changed = everywhere.where(F.col(DAY).isin(list(days))).select(user.alias("_user"), session.alias("_session")).distinct()
        same = user.eqNullSafe(F.col("_user")) & session.eqNullSafe(F.col("_session"))
        found = everywhere.join(changed, same, "left_semi").select(DAY).distinct()
        return sorted({*days, *(r[0] for r in found.toLocalIterator())})

    def refresh_days(self, days: Iterable[str]) -> list[str]:
        """Bring all kept tables up to date after events came for ``days``; returns the days that were written."""
        days = sorted(days)
        self._memo.clear()
        for name in self.kept:
            if REGISTRY[name].layer == "rows":
                self._renew(name, days)
        touched = self.touched_days(days)
        for name in self.kept:
            if REGISTRY[name].layer != "rows":
                self._renew(name, touched)
        return touched
