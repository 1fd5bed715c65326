"""Token ids in ORC files: run-length encoded, with row indexes and Bloom filters on document ids."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from screenmart.llm.common import documents, kept, map_arrow, shared_path, slices
from screenmart.llm.pieces import Encoded

END = 2
ORC_OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(32 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write each byte as: printable Latin-1 stands for itself."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Coded:
    """Token ids of whole texts: added tokens (``ids`` by their literal) are cut out first, as the library does."""

    def __init__(self, encoded: Encoded, ids: dict[str, int]):
        self.encoded, self.ids = encoded, ids
        # Of several literals that start at one place, the longest is meant.
        self.literals = re.compile(f"({'|'.join(map(re.escape, sorted(ids, key=len, reverse=True)))})") if ids else None

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and each text's number of them."""
        if not any(literal in text for literal in self.ids for text in texts):
            return self.encoded.texts(texts)
        cut = [self.literals.split(text) for text in texts]
        # Parts at odd places are literals; what stands before and after one is split into pieces on its own.
        ids, sizes = self.encoded.texts([part if k % 2 == 0 else "" for parts in cut for k, part in enumerate(parts)])
        counts = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        firsts = np.cumsum(counts) - counts
        at = np.concatenate([first + np.arange(1, n, 2) for first, n in zip(firsts, counts, strict=True)])
        ids = np.insert(ids, np.cumsum(sizes)[at], [self.ids[x] for parts in cut for x in parts[1::2]])
        sizes[at] = 1
        return ids, np.add.reduceat(sizes, firsts)


def _loaded(path: str) -> Coded:
    return kept(("tokenizer", path), lambda: _load(path))


def _load(path: str) -> Coded:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    model, added = tokenizer.model, tokenizer.get_added_tokens_decoder()
    if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
        raise ValueError(f"{path} has added tokens that depend on what stands around them")
    letters = byte_letters()

    def encode(pieces: list[str]) -> list[list[int]]:
        words = (p.encode("utf-8", "surrogatepass").decode("latin-1").translate(letters) for p in pieces)
        return [[token.id for token in model.tokenize(word)] for word in words]

    return Coded(Encoded(encode), {token.content: i for i, token in added.items()})


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def write(docs: DataFrame, tokenizer: str, path: str, end: int = END) -> None:
    """Write (doc_id, row, ids) of all ``docs`` as ORC in ascending doc_id order, null ids first.

    ``ids`` are the whole text's tokens, added ones too, and ``end``; a null text is empty. Texts, not
    ids, are range-partitioned, so one shuffle of the input is all that moves; files follow each
    other in id order, ``row`` numbers the rows in file order, and repeated doc_ids share a file.
    Integers are run-length encoded (version 2) by the writer; each stripe has row-index entries
    and Bloom filters on doc_id.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = _loaded(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                ids, sizes = encoded.texts(texts[a:b])
                ids = np.insert(ids, np.cumsum(sizes), end)
                offsets = np.concatenate(([0], np.cumsum(sizes + 1))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], lists], ["doc_id", "ids"])

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    coded = map_arrow(ordered, run, f"doc_id {kind}, ids array<int>", keeps=True)
    coded.select("doc_id", F.monotonically_increasing_id().alias("row"), "ids").write.options(**ORC_OPTIONS).orc(path)


def read(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """The rows of the files; stripes are read in parallel, and filters on doc_id prune stripes and row groups."""
    return spark.read.schema(f"doc_id {kind}, row bigint, ids array<int>").orc(path)


def summaries(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the rows of ``read``.

    ``start`` counts the ids of all rows before: totals of the files are added up (one row a
    file), and within a file rows follow ``row``. Only three narrow columns are shuffled.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            at = lists.offsets.to_numpy()
            crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_tokens", "ids_crc32"])

    narrow = map_arrow(rows.select("doc_id", "row", "ids"), run, f"doc_id {kind}, row long, n_tokens long, ids_crc32 long")
    narrow = narrow.withColumn("part", F.shiftright("row", 33))
    totals = narrow.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select(
        "part", (F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")).alias("before")
    )
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    return (
        narrow.withColumn("within", within - F.col("n_tokens")).join(before, "part")
        .select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
    )


def op5_orc_tokens(spark, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    docs = documents(spark, sf_dir)
    write(docs, default_tokenizer(), path)
    return summaries(read(spark, path, docs.schema["doc_id"].dataType.simpleString()))
