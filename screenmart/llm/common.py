"""Shared folders, stored tables and array helpers of the operators."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import warnings
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALL = 2**64
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Odd multiplier of the prefix-sum hash; any odd 64-bit number has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15 | 1
#: A second sum in a prime field: powers of two as modulus have regular strings that clash under every base.
_PRIME, _PRIME_BASE = 2**31 - 1, 1_275_834_377
#: ASCII white space, the only separators of words and the only characters stripped from lines.
SPACES = b" \t\n\x0b\x0c\r"
#: The bits of each byte value, lowest first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _run_folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local"):
            warnings.warn(f"spark.checkpoint.dir is not set: {base} must be a folder that all executors see", stacklevel=3)
    return f"{base.rstrip('/')}/screenmart_llm/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see: below spark.checkpoint.dir, or the warehouse where that is unset."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_stored(spark: SparkSession) -> None:
    """Remove all that this application's operators stored: for callers whose results are written or no longer read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The rows written once as Parquet in a shared folder and read back: cuts lineage, survives executors.

    The folder stays, for the DataFrame is lazy; ``remove_stored`` removes those of the application.
    """
    path = shared_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where PYTHONPATH does not: its sources go out once per application."""
    app = spark.sparkContext.applicationId
    root = Path(__file__).resolve().parents[1]
    if app in _shipped or str(root.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    # Stays until the application ends: Spark serves it to each executor.
    path = f"{tempfile.mkdtemp()}/{root.name}_sources.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def release() -> None:
    """Give memory that nothing uses back to the system: workers live on, and the next stage's start beside them."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


_kept: dict = {}


def kept(key, make: Callable):
    """What ``make`` returned for this key in this worker; another key replaces it."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def _prepare(spark: SparkSession) -> None:
    """This package at hand in the workers, and batches that bound their memory."""
    ship(spark)
    if spark.conf.get(BATCH_ROWS, None) is None:
        spark.conf.set(BATCH_ROWS, "1000")  # texts are long; the default is 10000


def map_arrow(df: DataFrame, run: Callable, schema, keeps: bool = False) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers, in batches that bound their memory.

    Workers serve one stage after the other: what another operator kept is let go unless ``run`` uses it.
    """
    _prepare(df.sparkSession)

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[pa.RecordBatch]:
            for k, batch in enumerate(batches):
                yield batch
                if k % 8 == 7:
                    release()

        if not keeps:
            _kept.clear()
        try:
            yield from run(each())
        finally:
            release()

    return df.mapInArrow(lean, schema)


def map_column(column: Column, run: Callable[[pa.Array], pa.Array], returns: T.DataType, spark: SparkSession) -> Column:
    """An Arrow UDF like ``map_arrow``, for what works on one column and keeps its rows.

    Spark runs one such column over another in the same worker, where two ``map_arrow`` need two workers for each core.
    """
    _prepare(spark)

    def lean(values: pa.Array) -> pa.Array:
        try:
            return run(values)
        finally:
            release()

    return F.arrow_udf(lean, returns)(column)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def slices(texts: list[bytes | str], limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` units together; a longer text makes a range of its own."""
    return cuts(list(map(len, texts)), limit)


def cuts(sizes: list[int], limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """The same of texts whose sizes are known, so that a batch need not be unpacked as a whole."""
    begin = size = 0
    for i, more in enumerate(sizes):
        if i > begin and size + more > limit:
            yield begin, i
            begin, size = i, 0
        size += more
    if begin < len(sizes):
        yield begin, len(sizes)


_tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _length(name: str, size: int) -> int | None:
    """The length of new tables, if those known are too short."""
    known = _tables.get(name)
    return None if known is not None and len(known[0]) >= size else 1 << max(16, size.bit_length())


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``size`` at least; one pair of tables a process, grown as needed."""
    length = _length("power", size)
    if length:
        _tables["power"] = tuple(np.full(length, base, dtype=np.uint64) for base in (_BASE, pow(_BASE, -1, ALL)))
        for table in _tables["power"]:
            table[0] = 1
            np.multiply.accumulate(table, out=table)
    return _tables["power"]


def _prime_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The same in the prime field."""
    length = _length("field", size)
    if length:
        _tables["field"] = tuple(np.ones(length, dtype=np.uint32) for _ in range(2))
        for table, base in zip(_tables["field"], (_PRIME_BASE, pow(_PRIME_BASE, -1, _PRIME)), strict=True):
            done = 1
            while done < length:
                table[done : 2 * done] = table[:done] * np.uint64(pow(base, done, _PRIME)) % np.uint64(_PRIME)
                done *= 2
    return _tables["field"]


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Spans:
    """64-bit hashes of units[start:end]; equal spans hash alike wherever they stand.

    Prefix sums of unit * base**position, modulo 2**64; the inverse power moves a span to position 0, so the cost
    does not depend on the spans' lengths. Regular strings can clash, so these hashes serve where contents decide.
    With ``field`` a second sum in a prime field joins, under which no two strings clash but by chance.
    """

    def __init__(self, units: np.ndarray, field: bool = False):
        power, self.inverse = _powers(len(units) + 1)
        values = units.astype(np.uint64) + np.uint64(1)
        self.sums, self.sums_in_field = np.zeros(len(units) + 1, dtype=np.uint64), None
        np.cumsum(values * power[: len(units)], out=self.sums[1:])
        if field:
            power, self.inverse_in_field = _prime_powers(len(units) + 1)
            values *= power[: len(units)]
            values %= np.uint64(_PRIME)
            self.sums_in_field = np.zeros(len(units) + 1, dtype=np.uint64)
            np.cumsum(values, out=self.sums_in_field[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        at_start = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        size = (ends - starts).astype(np.uint64)
        if self.sums_in_field is not None:
            prime = np.uint64(_PRIME)
            in_field = (self.sums_in_field[ends] - self.sums_in_field[starts]) % prime * self.inverse_in_field[starts] % prime
            size += in_field << np.uint64(32)
        return mix(at_start + mix(size))


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes that stand for the contents."""
    return Spans(units, field=True).hashes(starts, ends)


def quick_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes that bring equal contents together."""
    return Spans(units).hashes(starts, ends)


def same_spans(units: np.ndarray, starts: np.ndarray, lengths: np.ndarray, others: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each span of ``units`` whether as many units of ``others`` from ``at`` on are the same ones."""
    out = np.ones(len(starts), dtype=bool)
    for begin in range(0, len(starts), 1 << 18):
        part = slice(begin, begin + (1 << 18))
        size = lengths[part]
        differ = units[ranges(starts[part], size)] != others[ranges(at[part], size)]
        if differ.any():
            out[part][np.repeat(np.arange(len(size)), size)[differ]] = False
    return out


def distinct_spans(
    units: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, where, back): a span for each distinct content, ordered by hash, and every span's place among them.

    Hashes only bring equal spans together; units decide. Where contents clash in a hash, the
    later one is told apart and listed under the same hash.
    """
    hashes = quick_hashes(units, starts, ends) if hashes is None else hashes
    known, where, back = np.unique(hashes, return_index=True, return_inverse=True)
    lengths = ends - starts
    first = where[back]
    same = lengths[first] == lengths
    same[same] = same_spans(units, starts[same], lengths[same], units, starts[first[same]])
    odd = np.flatnonzero(~same)
    if not len(odd):
        return known, where, back
    clashed: dict[tuple[int, bytes], int] = {}
    for k in odd.tolist():
        content = int(hashes[k]), units[starts[k] : ends[k]].tobytes()
        back[k] = clashed.setdefault(content, len(known) + len(clashed))
    extra = np.full(len(clashed), -1, dtype=np.int64)
    extra[back[odd[::-1]] - len(known)] = odd[::-1]
    where = np.concatenate([where, extra])
    known = hashes[where]
    order = np.argsort(known, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return known[order], where[order], place[back]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of start, start+1, ... for each (start, length), one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def word_spans(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of ASCII-lower-cased texts.

    Returns the joined buffer, word starts and ends in it, and the number of words of each text.
    """
    joined = b"\n".join(texts).translate(LOWER)
    units = np.frombuffer(joined, dtype=np.uint8)
    inside = np.zeros(len(units) + 2, dtype=np.int8)
    inside[1:-1] = ~((units == 32) | ((units >= 9) & (units <= 13)))
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    counts = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths)))))
    return joined, starts, ends, counts


def utf8(texts: Iterable[str | None]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
