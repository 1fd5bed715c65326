"""Full-refresh tables and named views."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from pyspark import inheritable_thread_target

from screenmart.catalog import REGISTRY, Catalog

Audit = Callable[[DataFrame], None]


def write_table(
    df: DataFrame, path: str, partition_by: Iterable[str] = (), sort_by: Iterable[str] = (), audit: Audit | None = None
) -> str:
    """Write a new version below ``path`` and return its folder.

    Rows are clustered for pruning and row-group statistics. Tables split by day have many folders and are dealt out by
    them; those that are also sorted are split by tenant, into few, and each task writes its rows to them where they lie. A version is a folder of its own, named by
    time and complete only with its ``_SUCCESS`` file; older versions stay as they are, so readers of the last
    one are undisturbed while a build runs or after it fails. ``drop_old_versions`` removes them.

    An ``audit`` reads the rows as stored and raises if they must not be seen: the version is complete, and so
    current, only after it.
    """
    partition_by, sort_by = list(partition_by), list(sort_by)
    version = f"{path}/v{time.time_ns():020d}"
    if partition_by and not sort_by:
        out = df.hint("rebalance", *partition_by)
    elif sort_by and not partition_by:
        out = df.repartitionByRange(*sort_by)  # files hold ranges, so their statistics prune
    else:
        out = df
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    writer = out.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if audit is None:
        writer.parquet(version)
        return version
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(version)
    audit(df.sparkSession.read.schema(df.schema).parquet(version))
    marker = df.sparkSession._jvm.org.apache.hadoop.fs.Path(version, "_SUCCESS")
    marker.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).create(marker).close()
    return version


def complete_versions(spark: SparkSession, path: str) -> list[str]:
    """Versions of a table whose write ended well, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    done = [v for v in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(v, "_SUCCESS"))]
    return sorted(v.toString() for v in done)


def current_version(spark: SparkSession, path: str) -> str | None:
    """The last complete version: what a session that did not build the table reads."""
    return next(reversed(complete_versions(spark, path)), None)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove all but the last ``keep`` complete versions."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for version in complete_versions(spark, path)[: -max(1, keep)]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(version), True)


@dataclass
class _Tracing(Catalog):
    """A catalog that notes which datasets each dataset asks for."""

    reads: dict[str, set[str]] = field(default_factory=dict)
    _open: list[str] = field(default_factory=list)

    def __getitem__(self, name: str) -> DataFrame:
        if self._open:
            self.reads[self._open[-1]].add(name)
        if name not in self.reads and name not in self.written:
            self.reads[name] = set()
            self._open.append(name)
            super().__getitem__(name)
            self._open.pop()
        return super().__getitem__(name)


def dependencies(catalog: Catalog, names: Iterable[str]) -> dict[str, set[str]]:
    """For each name the others of ``names`` that its plan reads, directly or through datasets between."""
    names = list(names)
    traced = _Tracing(catalog.spark, catalog.sources, catalog.options)
    for name in names:
        traced[name]
    out: dict[str, set[str]] = {}
    for name in names:
        seen, todo = set(), [name]
        while todo:
            for other in traced.reads[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    if other not in names:
                        todo.append(other)
        out[name] = seen & set(names)
    return out


def refresh(
    catalog: Catalog, names: Iterable[str], base: str, workers: int = 1, audit: Callable[[str, DataFrame], None] | None = None
) -> dict[str, str]:
    """Rebuild the named datasets; their readers see the written tables.

    With one worker in the given order. With more, as many writes run at once as there are tables whose inputs are written:
    each table waits for those of ``names`` that its plan reads. Plans are made one at a time, each after
    its inputs; writes share the cluster, in scheduler pools named like the tables where it schedules fairly.

    A dataset's readers move to its new version when that is complete, and with an ``audit(name, rows)`` only
    if it does not raise. The first failure ends the refresh; tables written before stay.
    """
    names, paths, lock = list(names), {}, threading.Lock()

    def build(name: str) -> None:
        spec = REGISTRY[name]
        with lock:
            df = spec.fn(catalog)
        catalog.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name if workers > 1 else None)
        check = None if audit is None else lambda stored: audit(name, stored)
        path = write_table(df, f"{base}/{name}", spec.partition_by, spec.sort_by, check)
        with lock:
            paths[name] = path
            catalog.mark_written(name, path, df.schema)

    if workers == 1:
        for name in names:
            build(name)
        return paths
    waits = dependencies(catalog, names)
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(workers) as pool:
        while waits or running:
            ready = [name for name in names if name in waits and not waits[name]]
            if not ready and not running:
                raise ValueError(f"datasets read each other: {sorted(waits)}")
            for name in ready:
                del waits[name]
                running[pool.submit(inheritable_thread_target(catalog.spark)(build), name)] = name
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                name = running.pop(future)
                error = future.exception()
                if error is not None:
                    for other in running:
                        other.cancel()
                    raise error
                for inputs in waits.values():
                    inputs.discard(name)
    return paths


def register_views(catalog: Catalog, names: Iterable[str]) -> None:
    """Expose datasets to SQL as lazy temporary views."""
    for name in names:
        catalog[name].createOrReplaceTempView(name)


@dataclass
class StoringCatalog(Catalog):
    """A catalog that writes datasets of the named layers on first use.

    Cards read stored tables, as in the nightly build; this builds only those a
    card asks for.
    """

    store: str = ""
    layers: tuple[str, ...] = ("mart", "rows", "family")

    def __getitem__(self, name: str) -> DataFrame:
        layer = "family" if name.startswith("stg_ga_") else REGISTRY[name].layer
        if layer in self.layers and name not in self.written:
            refresh(self, [name], self.store)
        return super().__getitem__(name)
