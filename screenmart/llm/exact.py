"""Exact dedup with a heavy-hitter split: frequent digests are settled map-side, the rest by an ordinary shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenmart.llm.common import documents, fresh, map_arrow, stored

#: A digest is frequent if more than one row in FREQUENT holds it.
FREQUENT = 1024
#: Counters of one Misra-Gries summary: it undercounts by less than one row in COUNTERS.
COUNTERS = 4 * FREQUENT


def digest(text: str = "text"):
    """SHA-256 of the text with each run of ASCII white space as one blank; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[ \t\n\x0B\f\r]+", " ").cast("binary"), 256))


class MisraGries:
    """At most ``counters`` counts; each falls short of the true one by at most rows / (counters + 1)."""

    def __init__(self, counters: int = COUNTERS):
        self.counters = counters
        self.counts: dict[bytes, int] = {}

    def add(self, values: pa.Array) -> None:
        counted = pc.value_counts(values)
        for key, n in zip(counted.field(0).to_pylist(), counted.field(1).to_pylist(), strict=True):
            self.counts[key] = self.counts.get(key, 0) + n
        if len(self.counts) > self.counters:
            # Lower all by the largest count that does not fit: at least counters + 1 rows go for each one taken off.
            cut = sorted(self.counts.values(), reverse=True)[self.counters]
            self.counts = {key: n - cut for key, n in self.counts.items() if n > cut}


def frequent_digests(rows: DataFrame, total: int) -> DataFrame:
    """(digest): every one that more than total / FREQUENT rows hold, and at most 4/3 FREQUENT in all.

    Each task reduces its rows to one Misra-Gries summary. Summed over tasks, counts fall short by less than
    total / COUNTERS, so frequent digests keep more than 3/4 total / FREQUENT; the sums are at most ``total``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary = MisraGries()
        for batch in batches:
            summary.add(batch.column(0))
        keys, counts = list(summary.counts), list(summary.counts.values())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(counts, pa.int64())], ["digest", "n"])

    summaries = map_arrow(rows.select("digest"), run, "digest binary, n long")
    least = total // FREQUENT - total // COUNTERS
    return summaries.groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") >= max(least, 1)).select("digest")


def _winner():
    """The smallest doc_id, ids before nulls; of rows that repeat it, the first one stored."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row"))


def split_by_frequency(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, digest, row, first, group_size) of frequent and of all other digests, and the frequent ones' winners.

    ``first`` is the (absent, doc_id, row) that stays. The winners are at most 4/3 FREQUENT rows.
    """
    rows = docs.select("doc_id", digest().alias("digest"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "digests")
    frequent = stored(frequent_digests(rows, rows.count()), "frequent_digests")
    reduced = [_winner().alias("first"), F.count(F.lit(1)).alias("group_size")]
    winners = stored(rows.join(F.broadcast(frequent), "digest").groupBy("digest").agg(*reduced), "winners")
    others = rows.join(F.broadcast(frequent), "digest", "left_anti")
    return rows.join(F.broadcast(winners), "digest"), others.join(others.groupBy("digest").agg(*reduced), "digest"), winners


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) for each row of ``docs``, of which doc_id and text are read.

    Texts are equal if identical after each run of ASCII white space became one blank; a null text is
    empty, texts of any length are read whole. SHA-256 stands for the text. Of equal texts the row with the smallest
    doc_id stays: a null id comes last, and of rows that repeat both id and text exactly one is kept. No rows give no rows.

    Digests that a share of rows hold are found by Misra-Gries summaries, counted exactly in a second pass, and
    their winners are broadcast: such rows are settled where they lie. All other groups are smaller than rows / FREQUENT
    and meet by a shuffle of ids and digests; texts are read once and never shuffled.
    """
    settled, ordinary, _ = split_by_frequency(docs)
    kept = (F.col("row") == F.col("first.row")).alias("kept")
    return settled.unionByName(ordinary).select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", kept, "digest")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, all columns as they are, whatever their names.

    Copies of frequent texts are removed map-side, others where their digests meet. Of rows that repeat id and
    text whichever Spark meets first stays.
    """
    own, of, first, keep_of, keep = fresh(docs, "_digest", "_winner_of", "_winner", "_kept_of", "_kept")
    _, ordinary, winners = split_by_frequency(docs)
    winners = winners.select(F.col("digest").alias(of), "first.doc_id").withColumnRenamed("doc_id", first)
    named = docs.withColumn(own, digest())
    hot = named.join(F.broadcast(winners), (F.col(own) == F.col(of)) & F.col("doc_id").eqNullSafe(F.col(first)), "left_semi")
    cold = named.join(F.broadcast(winners), F.col(own) == F.col(of), "left_anti")
    kept = ordinary.where(F.col("row") == F.col("first.row")).select(F.col("digest").alias(keep_of), F.col("doc_id").alias(keep))
    cold = cold.join(kept, (F.col(own) == F.col(keep_of)) & F.col("doc_id").eqNullSafe(F.col(keep)), "left_semi")
    return hot.unionByName(cold).dropDuplicates([own]).drop(own)


def op12_exact_dedup(spark, sf_dir: str) -> DataFrame:
    out = exact_groups(documents(spark, sf_dir))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP12_SQL = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0b\f\r]+', ' ', 'g') as body from documents)
select doc_id, first_value(doc_id) over first as keep_id, count(*) over (partition by body) as group_size,
       row_number() over first = 1 as kept, sha256(body) as text_sha256
from t window first as (partition by body order by doc_id nulls last)
"""
