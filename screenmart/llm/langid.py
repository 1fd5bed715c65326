"""Language ID: n-gram filters that answer with a bitmask of languages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenmart.llm.common import BYTE_BITS, crc_fold, distinct_spans, documents, fresh, map_arrow, mix, ranges, slices, span_hashes, stored
from screenmart.llm.pieces import Encoded, letter_words

UNKNOWN = "und"
LENGTHS = (2, 3, 4)


@dataclass(frozen=True)
class Filters:
    """Per-language Bloom filters, stored across: bit l of word w of a slot belongs to language 64*w+l."""

    languages: tuple[str, ...]
    slots: np.ndarray  # uint64 [words, size]
    hashes: int
    false_positive: np.ndarray  # per language: share of filled slots to the power of hashes
    expected: np.ndarray  # per language: corrected share of own n-grams that its filter knows

    def popcounts(self, grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For texts of ``sizes`` n-grams each, per language: how many of them its filter answers for."""
        slot = np.repeat(np.arange(len(sizes)) * 256, sizes)
        columns = []
        for known in self._masks(grams):
            # Masks of 64 languages at once, counted through one histogram per byte of the mask.
            of_byte = np.ascontiguousarray(known).view(np.uint8).reshape(-1, 8)
            for k in range(min(8, -(-(len(self.languages) - 8 * len(columns)) // 8))):
                histogram = np.bincount(slot + of_byte[:, k], minlength=256 * len(sizes)).reshape(-1, 256)
                columns.append(histogram @ BYTE_BITS)
        return np.concatenate(columns, axis=1)[:, : len(self.languages)]

    def _masks(self, grams: np.ndarray) -> np.ndarray:
        at = _slots(grams, self.slots.shape[1], self.hashes)
        return np.bitwise_and.reduce(self.slots[:, at], axis=1)


def _slots(grams: np.ndarray, size: int, hashes: int) -> np.ndarray:
    """``hashes`` slots of each n-gram; ``size`` is a power of two."""
    step = mix(grams) | np.uint64(1)
    last = np.uint64(size - 1)
    return np.stack([((grams + np.uint64(k) * step) >> np.uint64(20) & last).astype(np.int64) for k in range(hashes)])


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each word with a space on either side, and each word's number of them."""
    units = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    first = np.cumsum(size) - size
    hashes, owners = [], []
    for length in LENGTHS:
        fit = np.maximum(size - length + 1, 0)
        at = ranges(first, fit)
        hashes.append(span_hashes(units, at, at + length))
        owners.append(np.repeat(np.arange(len(words)), fit))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(hashes)[order], np.bincount(owner, minlength=len(words))


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of (text, lang); counted within a batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                chosen = [texts[i] or "" for i in np.flatnonzero(langs == lang)]
                for begin, end in slices(chosen, 1 << 20):
                    joined, units, starts, ends, _ = letter_words(chosen[begin:end])
                    _, at, back = distinct_spans(units, starts, ends)
                    times = np.bincount(back, minlength=len(at))
                    words = [joined[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                    grams, sizes = word_grams(words)
                    found, back = np.unique(grams, return_inverse=True)
                    n = np.bincount(back, weights=np.repeat(times, sizes), minlength=len(found)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"],
                    )

    partial = map_arrow(labelled.select("text", "lang"), run, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(
    labelled: DataFrame, least_share: float = 2e-6, least_ratio: float = 0.1, bits_per_gram: int = 16, hashes: int = 4
) -> Filters:
    """Filters from the rows (text, lang) whose lang is not null.

    An n-gram enters a language's filter if it makes up at least ``least_share`` of that language's
    n-grams, and its share there is at least ``least_ratio`` of its largest share in any
    language. So at most 1/least_share n-grams of a language come to the driver, whatever
    the corpus; all rows are counted. Slots grow with the largest filter only.
    """
    counts = stored(gram_counts(labelled.where("lang is not null")), "grams")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = tuple(sorted(totals))
    if not languages:
        return Filters((), np.zeros((1, 1), dtype=np.uint64), hashes, np.zeros(0), np.zeros(0))
    share = F.col("n") / F.element_at(F.create_map(*[F.lit(x) for kv in totals.items() for x in kv]), F.col("lang"))
    frequent = counts.withColumn("share", share).where(F.col("share") >= least_share)
    most = frequent.groupBy("gram").agg(F.max("share").alias("most"))
    chosen = frequent.join(most, "gram").where(F.col("share") >= least_ratio * F.col("most"))
    table = chosen.select("lang", "gram", "n").toArrow()
    lang_of = np.searchsorted(np.array(languages, dtype=object), np.array(table["lang"].to_pylist(), dtype=object)) if len(table) else np.zeros(0, int)
    grams = table["gram"].to_numpy().view(np.uint64)
    size = 1 << max(6, int(bits_per_gram * np.bincount(lang_of, minlength=1).max()).bit_length())
    slots = np.zeros((len(languages) + 63 >> 6, size), dtype=np.uint64)
    for number in range(len(languages)):
        at = _slots(grams[lang_of == number], size, hashes).ravel()
        slots[number >> 6, at] |= np.uint64(1) << np.uint64(number & 63)
    filled = np.array([(slots[k >> 6] >> np.uint64(k & 63) & np.uint64(1)).mean() for k in range(len(languages))])
    own = np.bincount(lang_of, weights=table["n"].to_numpy().astype(float), minlength=len(languages))
    expected = own / np.array([totals[lang] for lang in languages])
    return Filters(languages, slots, hashes, filled**hashes, np.maximum(expected, 1e-9))


def scorer(filters: Filters) -> Encoded:
    """For each word met so far: its number of n-grams, and each language's popcount."""

    def popcounts(words: list[str]) -> list[list[int]]:
        grams, sizes = word_grams(words)
        return np.concatenate([sizes[:, None], filters.popcounts(grams, sizes)], axis=1).tolist()

    return Encoded(popcounts, letter_words, most=8_000_000 // (len(filters.languages) + 1))


def decide(filters: Filters, known: Encoded, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text.

    A count c of N n-grams holds false positives: the corrected count is (c - N*f) / (1 - f). Its
    share of N, over the share known of the language's own training text, ranks the
    languages; ties go to the smaller name. The score is that share, at most 1.
    """
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    width = len(filters.languages) + 1
    if width == 1:
        return names, scores
    f = filters.false_positive
    for begin, end in slices(texts):
        flat, sizes = known.texts(texts[begin:end])
        sums = np.concatenate((np.zeros((1, width), np.int64), np.cumsum(flat.reshape(-1, width), axis=0, dtype=np.int64)))
        last = np.cumsum(sizes // width)
        counts = sums[last] - sums[last - sizes // width]
        n = np.maximum(counts[:, :1], 1)
        corrected = np.maximum(0.0, (counts[:, 1:] - n * f) / np.maximum(1 - f, 1e-9)) / n / filters.expected
        best = corrected.argmax(axis=1)
        for i in np.flatnonzero(counts[:, 0]).tolist():
            names[begin + i] = filters.languages[best[i]]
            scores[begin + i] = min(1.0, float(corrected[i, best[i]]))
    return names, scores


def predict(docs: DataFrame, filters: Filters, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs`` with lang_pred and score (or other ``names``), from the text alone.

    Columns that have these names already are replaced.

    ``und`` with score 0 where the text is null or has no letter. The filters travel as one
    broadcast, bounded by 1/least_share n-grams a language. Whole texts are read.
    """
    model = docs.sparkSession.sparkContext.broadcast(filters)
    docs = docs.drop(*names)
    schema = T.StructType([*docs.schema, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = scorer(model.value)
        for batch in batches:
            names, scores = decide(model.value, known, [t or "" for t in batch.column(at).to_pylist()])
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_arrow(docs, run, schema)


def identify(docs: DataFrame, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """lang_pred and score for all rows, learned from the rows outside crc fold 2 of 4 that have a lang.

    Rows without a doc_id teach nothing. Empty tables and tables without any lang
    answer ``und`` everywhere.
    """
    taught = docs.where(crc_fold("doc_id", 4) != 2).where("lang is not null")
    return predict(docs, train(taught.select("text", "lang")), names)


def keep_known(docs: DataFrame, least_score: float = 0.35) -> DataFrame:
    """Rows of ``docs`` whose text is in a known language: all but ``und`` and scores under ``least_score``."""
    lang, score = fresh(docs, "lang_pred", "score")
    judged = identify(docs, (lang, score))
    return judged.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least_score)).select(*docs.columns)


def op1_langid(spark, sf_dir: str) -> DataFrame:
    judged = identify(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    held_out = F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False))
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
