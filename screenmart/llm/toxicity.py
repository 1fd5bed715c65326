"""Toxicity by compression: which of two zstandard dictionaries shortens a window more."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenmart.llm.common import crc_fold, documents, map_arrow, slices
from screenmart.llm.pieces import Encoded, letter_words

#: A window compresses at least this many characters: shorter words repeat, so that a match shows in the length.
WINDOW = 24
#: Counted per text: windows that the toxic dictionary makes this many bytes shorter than the ordinary one.
GAINS = (1, 2, 3, 4, 5)
#: The same for phrases, windows of several words: the one that begins at every fourth word has eight.
PHRASE_GAINS = (1, 2, 4, 6, 8)
#: Half a phrase; an unbroken run of over 32 characters counts as several words.
HALF = re.compile(r"(?:\S{1,32}\s?){1,4}")


@dataclass(frozen=True)
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    toxic_phrases: bytes = b""
    ordinary_phrases: bytes = b""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(2 * len(GAINS + PHRASE_GAINS)))
    intercept: float = -20.0
    #: The calibrated share of gains at which a text is toxic is where the score passes this.
    threshold: float = 0.3


def window(word: str) -> bytes:
    """The bytes compressed for one word: it and its blank, repeated up to the window's length."""
    return ((" " + word) * (1 + WINDOW // (len(word) + 1)) + " ").encode("utf-8", "surrogatepass")


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        5, strategy=zstandard.STRATEGY_BTLAZY2, min_match=4, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    content = content if len(content) >= 8 else content.ljust(8)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=params)


def phrases(text: str) -> Iterator[bytes]:
    """The windows of several words of a whole text, each half over the one before."""
    before, alone = "", True
    for found in HALF.finditer(text.lower()):
        if before:
            alone = False
            yield (before + found[0]).encode("utf-8", "surrogatepass")
        before = found[0]
    if before and alone:
        yield before.encode("utf-8", "surrogatepass")


def phrase_compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(content.ljust(8)), compression_params=params)


def phrase_gains(model: Model) -> Callable[[str], np.ndarray]:
    """For each phrase of a text: bytes saved by the toxic dictionary over the ordinary one."""
    toxic, ordinary = phrase_compressor(model.toxic_phrases).compress, phrase_compressor(model.ordinary_phrases).compress
    return lambda text: np.fromiter((len(ordinary(x)) - len(toxic(x)) for x in phrases(text)), dtype=np.int32)


def gains(model: Model) -> Encoded:
    """For each word met so far: bytes saved by the toxic dictionary over the ordinary one."""
    toxic, ordinary = compressor(model.toxic).compress, compressor(model.ordinary).compress

    def gain(words: list[str]) -> list[list[int]]:
        return [[len(ordinary(x)) - len(toxic(x))] for x in map(window, words)]

    return Encoded(gain, letter_words)


def _counted(gain: np.ndarray, text_of: np.ndarray, sizes: np.ndarray, levels: tuple[int, ...]) -> np.ndarray:
    counts = np.stack([np.bincount(text_of[gain >= least], minlength=len(sizes)) for least in levels], axis=1)
    return np.log1p(np.concatenate([counts, 1000 * counts / np.maximum(sizes, 1)[:, None]], axis=1))


def features(known: Encoded, of_phrases: Callable[[str], np.ndarray], texts: list[str]) -> np.ndarray:
    """Per text: logarithms of the counts of windows with each gain, and of their counts per thousand; words, then phrases."""
    out = np.zeros((len(texts), 2 * len(GAINS + PHRASE_GAINS)))
    for begin, end in slices(texts):
        numbers = np.arange(end - begin)
        gain, sizes = known.texts(texts[begin:end])
        out[begin:end, : 2 * len(GAINS)] = _counted(gain, np.repeat(numbers, sizes), sizes, GAINS)
        found = [of_phrases(text) for text in texts[begin:end]]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        out[begin:end, 2 * len(GAINS) :] = _counted(np.concatenate(found), np.repeat(numbers, sizes), sizes, PHRASE_GAINS)
    return out


def scores(model: Model, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ model.weights + model.intercept, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.1, steps: int = 30) -> tuple[np.ndarray, float]:
    """Weights and intercept by Newton steps with a ridge penalty, each row counted ``n`` times."""
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (n * p * (1 - p))[:, None]).T @ z + penalty, z.T @ (n * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(text, toxic, n) of at most ``most`` labelled ids of each class, those with the smallest hashes of doc_id.

    Each text once, with the number ``n`` of its rows.
    """
    ids = None
    for value in (0, 1):
        chosen = labels.where(F.col("toxic") == value).select("doc_id", "toxic").distinct()
        chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        ids = chosen if ids is None else ids.union(chosen)
    # At most 2 * most ids.
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(ids), "doc_id")
    return found.groupBy("text", "toxic").agg(F.count(F.lit(1)).alias("n"))


def class_rows(docs: DataFrame, labels: DataFrame) -> dict[int, int]:
    """How many rows with a text each class has, over all labels."""
    rows = docs.where("text is not null").select("doc_id").join(labels.select("doc_id", "toxic").distinct(), "doc_id")
    return {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}


def spans(taught: DataFrame, lengths: tuple[int, ...] = (5, 6, 7)) -> DataFrame:
    """(kind, key, toxic, ordinary): in how many texts of each class a word, or a span inside a word, stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                joined, _, starts, ends, _ = letter_words([text])
                words = {joined[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)}
                keys = {("word", w) for w in words}
                for w in words:
                    w = f" {w} "
                    keys.update(("span", w[i : i + n]) for n in lengths for i in range(len(w) - n + 1))
                for key in keys:
                    counts.setdefault(key, [0, 0])[toxic] += 1
            columns = zip(*((*key, n[1], n[0]) for key, n in counts.items()), strict=True) if counts else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                ["kind", "key", "toxic", "ordinary"],
            )

    schema = "kind string, key string, toxic long, ordinary long"
    counts = map_arrow(taught.select("text", "toxic"), run, schema)
    return counts.groupBy("kind", "key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def train(
    docs: DataFrame, labels: DataFrame, most: int = 4000, least_share: float = 0.02, ratio: float = 20, size: int = 32768,
    most_phrases: int = 60_000, most_words: int = 200_000, least_texts: int = 3, most_repeats: int = 10,
) -> Model:
    """Two dictionaries and a calibrated score from labelled rows.

    ``labels`` hold doc_id and toxic 0 or 1. The dictionaries learn from rows outside fold 3 of 4
    (crc32), the calibration from fold 3: at most ``most`` rows of each class in either. In the
    calibration a sampled row stands for as many rows as its class has in fold 3 per row sampled, so
    the bound does not move the score. The toxic dictionary holds the spans of letters that stand in
    ``least_share`` of the toxic texts at least, and ``ratio`` times as often as in ordinary ones,
    the most telling last, where zstandard finds them nearest; the ordinary one is trained by zstandard
    on the words of ordinary texts. Beside these two of words stand two of phrases, which zstandard
    trains on the texts of each class. Both pairs are calibrated together, on the rows that taught the dictionaries where
    fold 3 has labels of one class only. Without labels of both classes nothing is toxic.

    What the ordinary dictionaries are trained on is bounded like the rows: ``most_phrases`` phrases of a class, the
    ``most_words`` words that most ordinary texts hold, each in ``least_texts`` of them at least and given to the training as often as
    texts hold it, ``most_repeats`` times at most. These bound what is learned from, never what is scored.

    Ids labelled both 0 and 1 teach both classes; repeated labels of an id count once, its repeated rows each. Null
    texts, null ids and other labels teach nothing. Long texts are read whole.
    """
    labels = labels.where("toxic in (0, 1) and doc_id is not null")
    calibrate = crc_fold("doc_id", 4) == 3
    taught = sample(docs, labels.where(~calibrate), most).cache()
    n = {r["toxic"]: r["n"] for r in taught.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        taught.unpersist()
        return Model()
    counts = spans(taught).cache()
    telling = (F.col("toxic") >= least_share * n[1]) & (F.col("toxic") / n[1] >= ratio * (F.col("ordinary") + 1) / n[0])
    # Each text has boundedly many spans, so few can stand in a fixed share of the texts.
    found = counts.where((F.col("kind") == "span") & telling).collect()
    words = counts.where((F.col("kind") == "word") & (F.col("ordinary") >= least_texts)).select("key", "ordinary")
    words = words.orderBy(F.desc("ordinary"), "key").limit(most_words).collect()
    counts.unpersist()
    of_class = [_phrase_dictionary(taught, value, size, most_phrases) for value in (0, 1)]
    taught.unpersist()
    toxic = _outermost({r["key"]: r["toxic"] for r in found})
    content = "".join(sorted(toxic, key=lambda k: (toxic[k], k))).encode("utf-8", "surrogatepass")
    samples = [f" {r['key']} ".encode("utf-8", "surrogatepass") for r in sorted(words) for _ in range(min(r["ordinary"], most_repeats))]
    order = np.random.default_rng(42).permutation(len(samples))
    model = Model(content, _dictionary([samples[i] for i in order], size), of_class[1], of_class[0])
    fold = labels.where(calibrate)
    measured = _measure(sample(docs, fold, most), model).toPandas()
    if measured["toxic"].nunique() < 2:
        fold = labels.where(~calibrate)
        measured = _measure(sample(docs, fold, most), model).toPandas()
    x = np.stack(measured["x"].to_numpy())
    whole, sampled = class_rows(docs, fold), measured.groupby("toxic")["n"].sum()
    stands_for = measured["n"] * measured["toxic"].map({c: whole[c] / sampled[c] for c in sampled.index})
    weights, intercept = logistic(x, measured["toxic"].to_numpy(float), stands_for.to_numpy(float))
    return replace(model, weights=weights, intercept=intercept)


def _outermost(counts: Counter | dict[str, int]) -> dict[str, int]:
    """Without the spans inside a longer one that is nearly as frequent."""
    inside: dict[str, int] = {}
    for key, n in counts.items():
        for size in range(1, len(key)):
            for i in range(len(key) - size + 1):
                part = key[i : i + size]
                inside[part] = max(inside.get(part, 0), n)
    return {k: n for k, n in counts.items() if inside.get(k, 0) < 0.9 * n}


def _dictionary(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their own bytes serve
        return b"".join(samples)[-size:]


def _phrase_dictionary(taught: DataFrame, value: int, size: int, most: int) -> bytes:
    """Trained on at most ``most`` phrases of the class, those with the smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(phrases(text), pa.binary())], ["phrase"])

    found = map_arrow(taught.where(F.col("toxic") == value).select("text"), run, "phrase binary")
    chosen = found.orderBy(F.xxhash64("phrase"), "phrase").limit(most).toPandas()["phrase"]
    return _dictionary([bytes(x) for x in chosen], size)


def _measure(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of_phrases = gains(model), phrase_gains(model)
        for batch in batches:
            x = features(known, of_phrases, batch.column(0).to_pylist())
            columns = [batch.column(1), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "n", "x"])

    return map_arrow(rows, run, f"toxic {rows.schema['toxic'].dataType.simpleString()}, n long, x array<double>")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with score (0 to 1) and predicted (1 from the model's threshold on), from whole texts.

    A null, empty or blank text has no window and scores as such.
    """
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of_phrases = gains(model), phrase_gains(model)
        for batch in batches:
            s = scores(model, features(known, of_phrases, [t or "" for t in batch.column(at).to_pylist()]))
            columns = [*batch.columns, pa.array(s), pa.array((s >= model.threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_arrow(docs, run, schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    judged = predict(docs, train(docs, labels.where(crc_fold("doc_id", 4) != 2)))
    held_out = F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False))
    return judged.select("doc_id", held_out.alias("held_out"), "score", "predicted")
