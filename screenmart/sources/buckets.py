"""Tables bucketed by screen, so that joins on the screen need no exchange."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from screenmart.catalog import REGISTRY, Catalog

#: Key of each table by which screens and what hangs on them meet.
SCREEN_KEYS = {
    "screener_screen": "id",
    "screener_eligibilitysnapshot": "screen_id",
    "screener_current_benefits": "screen_id",
    "screener_incomestream": "screen_id",
    "screener_expense": "screen_id",
    "screener_householdmember": "screen_id",
    "screener_energycalculatorscreen": "screen_id",
    "mart_screener_data": "id",
}


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Store ``df`` as the catalog table ``table`` at ``path`` in ``buckets`` files per write, each sorted by ``key``.

    Rows are dealt to the buckets before the write, so a bucket is one file. All tables that are to meet need the same number of
    buckets; it stays with the data, so choose it for the size that the tables grow to.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)


@dataclass
class BucketedCatalog(Catalog):
    """A catalog that keeps sources and datasets of SCREEN_KEYS in bucketed tables, written on first use.

    ``names`` prefixes the tables in the session's database.
    """

    store: str = ""
    names: str = "screens"
    buckets: int = 64
    keys: Mapping[str, str] = field(default_factory=lambda: SCREEN_KEYS)
    _done: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def _bucketed(self, name: str, df: DataFrame) -> DataFrame:
        if name not in self._done:
            table = f"{self.names}_{name}"
            write_bucketed(df, table, f"{self.store}/{name}", self.keys[name], self.buckets)
            self._done[name] = self.spark.table(table)
        return self._done[name]

    def source(self, name: str) -> DataFrame:
        if name in self._done or name not in self.keys:
            return self._done[name] if name in self._done else super().source(name)
        return self._bucketed(name, super().source(name))

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._done:
            return self._done[name]
        if name in self.keys:
            return self._bucketed(name, REGISTRY[name].fn(self))
        return super().__getitem__(name)

    def prepare(self, names: Iterable[str]) -> None:
        for name in names:
            if name in REGISTRY:
                self[name]
            else:
                self.source(name)
