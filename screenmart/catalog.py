"""Named datasets over named sources.

A dataset is a function ``(catalog) -> DataFrame`` without actions. The catalog
resolves a name to the written table when there is one and to the lazy plan
otherwise, so the same code serves a single query and a full build.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DatasetFn = Callable[["Catalog"], DataFrame]


@dataclass(frozen=True)
class Dataset:
    name: str
    fn: DatasetFn
    layer: str
    grain: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()


REGISTRY: dict[str, Dataset] = {}


def dataset(
    layer: str,
    grain: Iterable[str] = (),
    partition_by: Iterable[str] = (),
    sort_by: Iterable[str] = (),
) -> Callable[[DatasetFn], DatasetFn]:
    """Register a function under its own name."""

    def register(fn: DatasetFn) -> DatasetFn:
        REGISTRY[fn.__name__] = Dataset(
            fn.__name__, fn, layer, tuple(grain), tuple(partition_by), tuple(sort_by)
        )
        return fn

    return register


@dataclass(frozen=True)
class Options:
    """Knobs that change what a dataset means."""

    # First event day that counts (yyyyMMdd); prunes event partitions.
    analytics_epoch: str = "20260729"
    # Treat an undecidable energy-program flag as "no" instead of leaving it NULL.
    coalesce_cesn: bool = False
    # (abbreviation, is_tax_credit) columns of the first-generation wide view.
    wide_programs: tuple[tuple[str, bool], ...] | None = None
    # (label, abbreviation) pairs of the first-generation benefit counts.
    benefit_labels: tuple[tuple[str | None, str | None], ...] | None = None


@dataclass
class Catalog:
    spark: SparkSession
    sources: Mapping[str, Callable[[], DataFrame]]
    options: Options = field(default_factory=Options)
    # Path and schema of each written table: types are those of the plan, partition columns included.
    written: dict[str, tuple[str, StructType]] = field(default_factory=dict)
    _memo: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def source(self, name: str) -> DataFrame:
        key = f"source:{name}"
        if key not in self._memo:
            self._memo[key] = self.sources[name]()
        return self._memo[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._memo:
            if name in self.written:
                path, schema = self.written[name]
                self._memo[name] = self.spark.read.schema(schema).parquet(path)
            else:
                self._memo[name] = REGISTRY[name].fn(self)
        return self._memo[name]

    def mark_written(self, name: str, path: str, schema: StructType) -> None:
        """Let later readers of ``name`` scan the table instead of the plan."""
        self.written[name] = (path, schema)
        self._memo.clear()
