"""Benchmark decontamination: SimHash of item-sized windows without loss, verified by exact weighted-shingle similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmart.llm.common import documents, fresh, stored

WIDTH = 5
BITS = 64
SPACES = " \t\n\x0b\f\r"


def shingles(df: DataFrame, name: str) -> DataFrame:
    """Column ``name``: hashes of each run of five words of ``text`` in lower case, repeats included."""
    text = F.btrim(F.lower(F.coalesce(F.col("text"), F.lit(""))), F.lit(SPACES))
    hashed = df.withColumn("_words", F.transform(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: F.xxhash64(w)))
    words = F.col("_words")
    at = F.sequence(F.lit(0), F.size(words) - WIDTH)
    run = F.transform(at, lambda i: F.xxhash64(*[words[i + k] for k in range(WIDTH)]))
    return hashed.withColumn(name, F.when(F.size(words) >= WIDTH, run).otherwise(F.array().cast("array<bigint>"))).drop("_words")


def _bits(keep) -> Column:
    """The long whose bit b is set where ``keep`` holds of b."""

    def bit(b: Column) -> Column:
        return F.when(keep(b), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("bigint"), lambda out, b: out.bitwiseOR(bit(b)))


def _lead(hashes: Column, b: Column) -> Column:
    """By how many hashes, repeats counted, a set bit b outnumbers an unset one."""
    ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.call_function("getbit", h, b).cast("int"))
    return ones * 2 - F.size(hashes)


def fingerprint(hashes: Column) -> Column:
    """64 bits as a long: a bit is set if set in over half of the hashes, repeats counted."""
    return _bits(lambda b: _lead(hashes, b) > 0)


def sure_bits(item: Column, similarity: float) -> Column:
    """The bits that the fingerprint of every window as similar as asked has in common with the item's.

    Such a window and the item differ in at most (1 - similarity) / (1 + similarity) of their shingles together, so by
    that much a bit's lead can change; where it is greater the bit cannot turn.
    """
    most = F.size(item) * 2 * F.lit((1 - similarity) / (1 + similarity)) + F.lit(1e-9)
    return _bits(lambda b: (_lead(item, b) > most) | (_lead(item, b) <= -most))


def shared_weight(a: Column, b: Column) -> Column:
    """Sum over shingles of the smaller of their counts in ``a`` and ``b``."""

    def count(x: Column, h: Column) -> Column:
        return F.size(F.filter(x, lambda v: v == h))

    return F.aggregate(F.array_distinct(b), F.lit(0), lambda n, h: n + F.least(count(a, h), count(b, h)))


def prepared(benchmark: DataFrame, similarity: float) -> DataFrame:
    """Items of five words or more: shingles, fingerprint, its sure bits, and anchors.

    A window as similar as asked shares at least ``similarity * 2k / (1 + similarity)`` of the item's k shingles, so
    it lacks too few of them to lack all of the anchors: the first of them in hash order.
    """
    items = shingles(benchmark.select("item_id", "text"), "item").where(F.size("item") > 0)
    k = F.size("item")
    # A text shorter than the item shares more of what it has, and still this much of the item.
    least = F.ceil(k * F.lit(similarity) - F.lit(1e-9)).cast("int")
    anchors = F.slice(F.sort_array("item"), 1, k - least + 1).alias("anchors")
    bits = [fingerprint(F.col("item")).alias("item_fp"), sure_bits(F.col("item"), similarity).alias("sure")]
    return stored(items.select("item_id", "item", k.alias("k"), *bits, anchors), "benchmark_items")


def find(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(doc_id, item_id, window_start, similarity): documents with a window that is nearly a benchmark item.

    A window has the item's number of words (the whole text, where that is shorter). Similarity is the weighted
    Jaccard similarity of five-word shingles: the sum of the smaller counts over the sum of the larger ones.
    One row per document and item, with its most similar window, the last of equals; window_start counts
    words from 0. Texts and items are lower-cased and split at ASCII white space.

    Windows without an anchor of the item cannot be similar, so only documents that hold an anchor are looked into.
    There each window that begins with a shingle of the item, and the last one, is a candidate if it holds enough of
    the item's shingles: moving a window on to the next such shingle never loses a shared one, so the best windows
    are among them. A candidate's fingerprint must have the item's sure bits, which every similar window has, and its exact
    similarity decides.

    Null and empty texts, and texts or items of under five words, match nothing. Rows without doc_id are matched
    under the id null. Rows that repeat an id count as one document. Anchors are joined by their measured size:
    broadcast if small, shuffled if not; a shared passage costs a row per document that holds it. Time is in proportion to a
    text's words, times the item's.
    """
    items = prepared(benchmark, similarity)
    anchors = stored(items.select("item_id", F.explode(F.array_distinct("anchors")).alias("h")), "benchmark_anchors")
    same = F.xxhash64("text").alias("_same")
    held = shingles(docs.select("doc_id", "text", same), "doc").select("doc_id", "_same", F.explode(F.array_distinct("doc")).alias("h"))
    met = stored(held.join(anchors, "h").select("doc_id", "_same", "item_id").distinct(), "anchored")
    met = met.select(F.col("doc_id").alias("_id"), F.col("_same").alias("_of"), "item_id")
    looked = docs.select("doc_id", "text", same).join(met, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_same") == F.col("_of")))
    looked = shingles(looked, "doc").drop("text", "_id", "_of").join(items.drop("anchors"), "item_id")
    n, k = F.size("doc"), F.col("k")
    hits = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.array_contains("item", F.get("doc", i)))
    # Shingles that a window must share with the item; the window's length is that of the text, if it is shorter.
    need = F.ceil(F.lit(similarity) * (F.least(n, k) + k) / F.lit(1 + similarity) - F.lit(1e-9)).cast("int")

    def starts(x: Column) -> Column:
        at, wanted = x["hits"], x["need"]
        inside = F.filter(at, lambda p, j: (p + k <= n) & (F.get(at, j + wanted - 1) < p + k))
        last = F.greatest(n - k, F.lit(0))
        enough = (F.size(at) >= wanted) & (F.get(at, F.size(at) - wanted) >= last)
        return F.array_union(inside, F.when(enough, F.array(last)).otherwise(F.array().cast("array<int>")))

    # A lambda's argument is computed once: without it the hits would be sought again at every step.
    chosen = F.transform(F.array(F.struct(hits.alias("hits"), need.alias("need"))), starts)[0]
    window = F.transform(chosen, lambda s: F.struct(s.alias("window_start"), F.slice("doc", s + 1, k).alias("window")))
    of_item = ["item", "item_fp", "sure"]
    windows = looked.select("doc_id", "item_id", *of_item, F.explode(window).alias("w")).select("doc_id", "item_id", *of_item, "w.*")
    near = windows.where(fingerprint(F.col("window")).bitwiseXOR(F.col("item_fp")).bitwiseAND(F.col("sure")) == 0)
    shared = near.withColumn("shared", shared_weight(F.col("window"), F.col("item")))
    measured = shared.withColumn("similarity", F.col("shared") / (F.size("window") + F.size("item") - F.col("shared")))
    best = F.max(F.struct("similarity", "window_start")).alias("best")
    return (
        measured.where(F.col("similarity") >= similarity).groupBy("doc_id", "item_id").agg(best)
        .select("doc_id", "item_id", F.col("best.window_start").cast("bigint").alias("window_start"), "best.similarity")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without a match of ``find``."""
    (matched,) = fresh(docs, "_matched")
    found = find(docs, benchmark, similarity).select(F.col("doc_id").alias(matched)).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(matched)), "left_anti")


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    return find(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), similarity=0.8)


OP6_SQL = r"""
with dw as (select row_number() over () as r, doc_id, regexp_split_to_array(trim(lower(coalesce(text, '')), e' \t\n\x0b\f\r'), '[ \t\n\x0b\f\r]+') as w from documents),
ds as (select r, doc_id, len(w) - 4 as n, unnest(range(0, len(w) - 4)) as pos, w from dw where len(w) >= 5),
d as (select r, doc_id, n, pos, array_to_string(w[pos + 1 : pos + 5], ' ') as s from ds),
iw as (select item_id, regexp_split_to_array(trim(lower(coalesce(text, '')), e' \t\n\x0b\f\r'), '[ \t\n\x0b\f\r]+') as w from benchmark),
its as (select item_id, len(w) - 4 as k, unnest(range(0, len(w) - 4)) as pos, w from iw where len(w) >= 5),
i as (select item_id, k, array_to_string(w[pos + 1 : pos + 5], ' ') as s, count(*) as c from its group by all),
hits as (select d.r, d.doc_id, d.n, d.pos, i.item_id, i.k, i.s, i.c from d join i on i.s = d.s),
cand as (select r, doc_id, item_id, n, k from hits group by all having count(*) >= 0.8 * (least(any_value(n), any_value(k)) + any_value(k)) / 1.8 - 1e-9),
win as (select c.*, u.start as start from cand c, lateral (select unnest(range(0, greatest(c.n - c.k, 0) + 1)) as start) u),
inter as (
  select r, doc_id, item_id, n, k, start, sum(least(cw, c)) as shared from (
    select w.r, w.doc_id, w.item_id, w.n, w.k, w.start, h.s, h.c, count(*) as cw
    from win w join hits h on h.r = w.r and h.item_id = w.item_id and h.pos >= w.start and h.pos < w.start + w.k
    group by all) group by all),
sim as (select doc_id, item_id, start, shared::double / (least(n, k) + k - shared)::double as similarity from inter)
select doc_id, item_id, max(start)::bigint as window_start, similarity from sim s
where similarity >= 0.8 and similarity = (select max(similarity) from sim t where t.doc_id is not distinct from s.doc_id and t.item_id = s.item_id)
group by doc_id, item_id, similarity
"""
