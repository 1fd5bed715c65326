"""Language-model scoring by deleted interpolation."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenmart.llm.common import crc_fold, documents, map_arrow, mix, ship, slices, span_hashes, stored, utf8, word_spans

#: Hashes that stand for the begin and the end of a text; words hash to 64 bits as well.
BEGIN, END = np.uint64(1), np.uint64(2)
BLOCK_BYTES = 6 << 20
#: N-grams that one part of the count table gets, at most about.
PART_GRAMS = 400_000
#: Context frequencies by powers of two; 0 is an unseen context.
BUCKETS = 64
COUNTED, TUNED, SCORED = 0, 1, 2


def pack(values: np.ndarray) -> bytes:
    """Integers as byte planes under zstandard."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0xD6E8FEB86659FD93) + word)


@dataclass
class Block:
    """Texts of one use, tokenised: each text is BEGIN, its words, END."""

    ids: np.ndarray
    sizes: np.ndarray  # tokens of each text with both marks
    tokens: np.ndarray  # hash of each token

    @classmethod
    def of(cls, row) -> Block:
        ids = np.array(row["ids"], dtype=object)
        words = np.frombuffer(row["words"], dtype=np.uint64)
        return cls(ids, np.asarray(row["sizes"], dtype=np.int64), words[unpack(row["tokens"], np.int32)])

    def grams(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Sorted distinct words with each token's place among them, the same for pairs, and where texts begin.

        A pair ends at every token but BEGIN; BEGIN's place among the pairs is not used.
        """
        words, word_at = np.unique(self.tokens, return_inverse=True)
        first = np.zeros(len(self.tokens), dtype=bool)
        first[np.cumsum(self.sizes) - self.sizes] = True
        keys = pair_keys(np.concatenate(([BEGIN], self.tokens[:-1])), self.tokens)
        pairs, at = np.unique(keys[~first], return_inverse=True)
        pair_at = np.zeros(len(self.tokens), dtype=np.int64)
        pair_at[~first] = at
        return (words, word_at), (pairs, pair_at), first


BLOCKS = "block string, use int, ids array<long>, sizes array<int>, words binary, tokens binary, n_tokens long"


def blocks(rows: DataFrame) -> DataFrame:
    """Tokenised blocks of about BLOCK_BYTES of text of (doc_id, text, use), stored."""

    def made(use: int, ids: list, sizes: list[np.ndarray], tokens: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate(tokens)
        words, at, n = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(words), dtype=np.int32)
        order = np.argsort(-n, kind="stable")
        rank[order] = np.arange(len(words))  # frequent words get small numbers, which pack well
        columns = [[uuid.uuid4().hex], [use], [ids], [np.concatenate(sizes).astype(np.int32)], [words[order].tobytes()], [pack(rank[at])], [len(flat)]]
        types = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["block", "use", "ids", "sizes", "words", "tokens", "n_tokens"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple[list, list, list, list]] = {}
        for batch in batches:
            ids, uses = batch.column(0).to_pylist(), np.array(batch.column(2).to_pylist())
            texts = utf8(batch.column(1).to_pylist())
            for use in np.unique(uses).tolist():
                chosen = np.flatnonzero(uses == use).tolist()
                part = [texts[i] for i in chosen]
                for a, b in slices(part):
                    joined, starts, ends, counts = word_spans(part[a:b])
                    hashes = span_hashes(np.frombuffer(joined, dtype=np.uint8), starts, ends)
                    hashes[hashes <= END] += np.uint64(3)
                    after = np.cumsum(counts)
                    marks = np.sort(np.concatenate([after - counts, after]), kind="stable")
                    tokens = np.insert(hashes, marks, np.tile([BEGIN, END], b - a))
                    held = open_.setdefault(use, ([], [], [], [0]))
                    held[0].extend(ids[i] for i in chosen[a:b])
                    held[1].append(counts + 2)
                    held[2].append(tokens)
                    held[3][0] += len(joined)
                    if held[3][0] >= BLOCK_BYTES:
                        yield made(use, *held[:3])
                        del open_[use]
        for use, held in open_.items():
            yield made(use, *held[:3])

    return stored(map_arrow(rows.select("doc_id", "text", "use"), run, BLOCKS), "lm_blocks")


ANSWERS = "block string, gram int, part int, kept binary, total binary, n_distinct long, n_tokens long"


def counted(made: DataFrame, parts: int) -> DataFrame:
    """Every block's n-grams with their counts over all blocks, stored.

    A block sends each of its distinct n-grams once, sorted and packed, to the part of the key space it falls
    in; there counts are added up, and go back in the same order. So a very frequent n-gram costs one entry a
    block. ``parts`` is a power of two that grows with the tokens, so a part stays small.
    Rows without a block hold a part's distinct words and tokens in training texts.
    """
    bits = parts.bit_length() - 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, use = Block.of(row), row["use"]
                (words, word_at), (pairs, pair_at), first = block.grams()
                for gram, keys, at in ((1, words, word_at), (2, pairs, pair_at[~first])):
                    n = np.bincount(at, minlength=len(keys)).astype(np.uint32)
                    kept = n if use == COUNTED else np.zeros_like(n)
                    tuned = n if use == TUNED else np.zeros_like(n)
                    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(keys)]))
                    out = [
                        (row["block"], gram, int(part[a]), pack(np.diff(keys[a:b], prepend=np.uint64(0))), pack(kept[a:b]), pack(tuned[a:b]))
                        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
                        if b > a
                    ]
                    types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                        ["block", "gram", "part", "keys", "kept", "tuned"],
                    )

    def answer(part: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in part["keys"]]
        edges = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        kept, tuned = (np.concatenate([unpack(c, np.uint32) for c in part[name]]).astype(np.float64) for name in ("kept", "tuned"))
        kept = np.bincount(at, kept, len(found)).astype(np.int64)
        total = kept + np.bincount(at, tuned, len(found)).astype(np.int64)
        gram, number = int(part["gram"].iat[0]), int(part["part"].iat[0])
        rows = [
            (block, gram, number, pack(kept[at[a:b]]), pack(total[at[a:b]]), None, None)
            for block, a, b in zip(part["block"], edges[:-1], edges[1:], strict=True)
        ]
        if gram == 1:
            tokens = total[found != BEGIN]
            rows.append((None, gram, number, None, None, int((tokens > 0).sum()), int(tokens.sum())))
        return pd.DataFrame(rows, columns=["block", "gram", "part", "kept", "total", "n_distinct", "n_tokens"])

    asked = map_arrow(made, ask, "block string, gram int, part int, keys binary, kept binary, tuned binary")
    return stored(asked.groupBy("gram", "part").applyInPandas(answer, ANSWERS), "lm_counts")


def _known(answers: pd.DataFrame, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts of a block's sorted words and pairs."""
    answers = answers.sort_values(["gram", "part"])
    return tuple(
        np.concatenate([unpack(c, np.int64) for c in answers.loc[answers["gram"] == gram, column]] or [np.zeros(0, np.int64)])
        for gram in (1, 2)
    )


def _events(block: Block, of_word: np.ndarray, of_pair: np.ndarray, tokens: int) -> tuple[np.ndarray, ...]:
    """For each token but BEGIN: bucket of the context, estimates of pair and word, the word's count."""
    (_, word_at), (_, pair_at), first = block.grams()
    word = of_word[word_at]
    context = np.concatenate(([0], word[:-1]))[~first].astype(np.float64)
    word, pair = word[~first].astype(np.float64), of_pair[pair_at[~first]].astype(np.float64)
    bucket = np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0).astype(np.int64)
    return bucket, pair / np.maximum(context, 1), word / max(tokens, 1), word


def shares(events: DataFrame, w: np.ndarray, uniform: float) -> np.ndarray:
    """One E-step over all held-out events: the expected number of events of each bucket that each estimate explains."""
    bucket = F.col("bucket")
    of = [F.get(F.lit(w[:, k].tolist()), bucket) for k in range(3)]
    parts = [F.col("pair") * of[0], F.col("word") * of[1], F.lit(uniform) * of[2]]
    explained = F.col("n") / (parts[0] + parts[1] + parts[2])
    rows = events.groupBy("bucket").agg(*[F.sum(part * explained).alias(f"s{k}") for k, part in enumerate(parts)]).collect()
    out = np.zeros((BUCKETS, 3))
    for r in rows:
        out[r["bucket"]] = r["s0"], r["s1"], r["s2"]
    return out


def weights(events: DataFrame, uniform: float, steps: int = 100) -> np.ndarray:
    """Mixture weights [bucket, (pair, word, uniform)] by expectation-maximisation on held-out events (bucket, pair, word, n).

    Each step is one aggregation over the stored events, exact as they are; BUCKETS rows come back. All buckets share
    five events of the pooled weights, so a bucket without events has those.
    """
    w = np.tile([0.5, 0.4, 0.1], (BUCKETS, 1))
    for _ in range(steps):
        sums = shares(events, w, uniform)
        if not sums.any():
            break
        pooled = sums.sum(axis=0) / sums.sum()
        new = (sums + 5 * pooled) / (sums.sum(axis=1, keepdims=True) + 5)
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    w = np.maximum(w, 1e-7)
    w[0, 0] = 0.0  # an unseen context has no pairs
    return w / w.sum(axis=1, keepdims=True)


def score(docs: DataFrame, train: str = "train", tune_share: int = 10) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each row of ``docs``.

    ``docs`` has doc_id, text and a boolean column ``train`` that marks the rows to learn from. Words are
    ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; each text ends in one end token, which counts. The model mixes the
    maximum-likelihood estimates of a token after its predecessor (or the begin), of the token alone, and a uniform
    1 / (V + 1); the weights depend on the bucket (power of two) of the predecessor's frequency. One in ``tune_share``
    training rows is held out of the counts from which the weights are learned; the scores use the counts of all
    training rows. base_score is the add-half score of the token alone. All logarithms are decimal.

    All counts cover all training rows: no n-gram is pruned. They never meet in one place: blocks of texts and parts of the
    key space exchange them (``counted``). Held-out events are stored with their exact estimates, and each step of the weights
    is an aggregation over them.
    A null text is empty: one end token. Rows with a null mark are scored and teach nothing.
    Repeated rows count as often as they come. No rows give no rows.
    """
    ship(docs.sparkSession)
    tune = F.pmod(F.xxhash64("doc_id"), F.lit(tune_share)) == 0
    use = F.when(F.col(train) & tune, TUNED).when(F.col(train), COUNTED).otherwise(SCORED)
    made = blocks(docs.select("doc_id", "text", use.alias("use")))
    n_tokens = made.agg(F.sum("n_tokens")).first()[0] or 0
    answers = counted(made, 1 << max(0, (2 * n_tokens // PART_GRAMS).bit_length() - 1))
    sums = answers.where("block is null").agg(F.sum("n_distinct"), F.sum("n_tokens")).first()
    distinct, tokens = sums[0] or 0, sums[1] or 0
    kept_tokens = int(made.where(F.col("use") == COUNTED).agg(F.sum(F.col("n_tokens") - F.size("ids"))).first()[0] or 0)
    answers = answers.where("block is not null")

    def cells(key, block: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        if block.empty:
            return pd.DataFrame({"bucket": [], "pair": [], "word": [], "n": []})
        bucket, pair, word, _ = _events(Block.of(block.iloc[0]), *_known(counts, "kept"), kept_tokens)
        events = pd.DataFrame({"bucket": bucket, "pair": pair, "word": word})
        return events.groupby(["bucket", "pair", "word"]).size().rename("n").reset_index()

    tuned = made.where(F.col("use") == TUNED)
    of_tuned = answers.join(tuned.select("block"), "block", "left_semi")
    found = tuned.groupBy("block").cogroup(of_tuned.groupBy("block")).applyInPandas(cells, "bucket int, pair double, word double, n long")
    # In few files: each step of the weights reads all of them.
    events = stored(found.groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n")).hint("rebalance"), "lm_held_out")
    uniform = 1 / (distinct + 1)
    mixture = weights(events, uniform)
    smooth = np.log10(tokens + 0.5 * (distinct + 1))

    def scored(key, block: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if block.empty:
            return pd.DataFrame({n: [] for n in names})
        b = Block.of(block.iloc[0])
        bucket, pair, word, count = _events(b, *_known(counts, "total"), tokens)
        w = mixture[bucket]
        p = np.log10(w[:, 0] * pair + w[:, 1] * word + w[:, 2] * uniform)
        base = np.log10(count + 0.5) - smooth
        at = np.cumsum(b.sizes - 1) - (b.sizes - 1)
        columns = [b.ids, b.sizes - 1, np.add.reduceat((count > 0).astype(np.int64), at), tokens, np.add.reduceat(base, at), np.add.reduceat(p, at)]
        return pd.DataFrame(dict(zip(names, columns, strict=True)))

    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return made.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(scored, schema)


def op3_lm(spark, sf_dir: str) -> DataFrame:
    fold = crc_fold("doc_id", 5)
    docs = documents(spark, sf_dir).select("doc_id", "text", F.coalesce(fold != 1, F.lit(False)).alias("train"))
    held_out = F.coalesce(fold == 1, F.lit(False)).alias("held_out")
    return score(docs).select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")
