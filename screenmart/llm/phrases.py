"""Phrase collocations by Toivonen mining: a sample proposes, a full pass counts, and misses are expanded until closed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from screenmart.llm.common import ALL, LOWER, Spans, distinct_spans, documents, map_arrow, mix, ranges, stored

#: Characters that end a piece; no phrase crosses them.
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: One document in SAMPLE proposes phrases.
SAMPLE = 16
#: Bits of the filter of proposed phrases, whatever their number: 8 MB. A fuller filter lets more phrases be counted, no fewer.
FILTER_BITS = 1 << 26
PROBES = 4
#: Bytes of text whose phrases a task reduces at once.
CHUNK = 1 << 20
SALTS = 32

_KIND = np.zeros(256, dtype=np.uint8)  # 0: of a word, 1: between words, 2: between pieces
_KIND[[32, 9]] = 1
_KIND[list(BREAKS)] = 2


def pieces_of(text: bytes, limit: int = CHUNK) -> Iterator[bytes]:
    """The text in parts of about ``limit`` bytes that end where a piece ends: no phrase is cut."""
    begin = 0
    while len(text) - begin > limit:
        cut = max(text.rfind(c, begin, begin + limit) for c in (BREAKS[k : k + 1] for k in range(len(BREAKS))))
        if cut <= begin:
            later = [at for at in (text.find(c, begin + limit) for c in (BREAKS[k : k + 1] for k in range(len(BREAKS)))) if at >= 0]
            if not later:
                break
            cut = min(later)
        yield text[begin:cut]
        begin = cut + 1
    yield text[begin:]


class Words:
    """The words of some texts: a buffer with one blank after each, their bounds, and how many follow in the piece."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts).translate(LOWER), dtype=np.uint8)
        kind = _KIND[raw]
        inside = np.zeros(len(raw) + 2, dtype=np.int8)
        inside[1:-1] = kind == 0
        edge = np.diff(inside)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.n = len(begin)
        piece = np.cumsum(kind == 2)[begin] if self.n else np.zeros(0, np.int64)
        lengths = end - begin
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        self.ends = self.starts + lengths
        self.units = np.full(int((lengths + 1).sum()), 32, dtype=np.uint8)
        self.units[ranges(self.starts, lengths)] = raw[ranges(begin, lengths)]
        last = np.searchsorted(piece, piece, "right")
        #: Words from here to the end of the piece, this one included.
        self.left = last - np.arange(self.n)
        self.spans = Spans(self.units)

    def hashes(self, starts: np.ndarray, width: int) -> np.ndarray:
        return self.spans.hashes(self.starts[starts], self.ends[starts + width - 1])

    def strings(self, starts: np.ndarray, width: int) -> pa.Array:
        begin, end = self.starts[starts], self.ends[starts + width - 1]
        offsets = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int32)
        return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(self.units[ranges(begin, end - begin)]))


class Filter:
    """A Bloom filter over (language, phrase) hashes: knows all that were added, and a few more.

    The PROBES bits of a hash lie in one 64-bit word, so a question costs one read.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def place(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The word that a hash belongs to and its bits there."""
        mask = np.zeros(len(hashes), dtype=np.uint64)
        for k in range(PROBES):
            mask |= np.uint64(1) << (hashes >> np.uint64(6 * k) & np.uint64(63))
        return (hashes >> np.uint64(6 * PROBES) & np.uint64(size // 64 - 1)).astype(np.int64), mask

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at, mask = self.place(hashes, 64 * len(self.bits))
        return self.bits[at] & mask == mask


def keyed(lang: str, hashes: np.ndarray) -> np.ndarray:
    """Phrase hashes told apart by language."""
    seed = (int.from_bytes(lang.encode("utf-8", "surrogatepass"), "little") + len(lang)) % ALL
    return mix(hashes ^ mix(np.array([seed], dtype=np.uint64)))


def known_parts(words: Words, lang: str, longest: int, known: Filter, near: np.ndarray) -> dict[int, np.ndarray]:
    """For each width from 2 on: where phrases begin whose first and last width - 1 words are both known.

    A word is known if the filter has it, a phrase if it has both of these parts and the filter has it. Only places ``near`` count.
    """
    out, tried = {}, np.flatnonzero(near)
    for width in range(1, longest):
        has = np.zeros(words.n + 1, dtype=bool)
        has[tried] = known.has(keyed(lang, words.hashes(tried, width)))
        out[width + 1] = has[:-1] & has[1:] & (words.left > width)
        tried = np.flatnonzero(out[width + 1])
    return out


def of_words(lang: str) -> str:
    """The language under which a filter holds the words of its phrases."""
    return f"{lang}\0"


def holds_missed(words: Words, lang: str, longest: int, missed: Filter) -> dict[int, np.ndarray]:
    """For each width from 2 on: where phrases begin that hold a missed phrase of any width below."""
    plain = words.hashes(np.arange(words.n), 1)
    part = np.zeros(words.n + 1, dtype=bool)
    part[:-1] = missed.has(keyed(of_words(lang), plain))
    all_parts, holds = part[:-1], np.zeros(words.n + 1, dtype=bool)
    out = {}
    for width in range(1, longest):
        # Only where all words stand in some missed phrase can one begin.
        at = np.flatnonzero(all_parts & (words.left >= width))
        found = np.zeros(words.n + 1, dtype=bool)
        found[at] = missed.has(keyed(lang, words.hashes(at, width)))
        holds |= found
        holds[:-1] |= holds[1:]  # now for phrases of one word more
        out[width + 1] = holds[:-1] & (words.left > width)
        all_parts = all_parts & np.concatenate([part[width:-1], np.zeros(min(width, words.n), dtype=bool)])
    return out


def phrase_counts(words: Words, lang: str, widths: range, known: Filter | None, missed: Filter | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, a start of each phrase, its count) of the phrases to be counted.

    Without ``known`` these are all of the given widths. With it, words, and longer phrases whose first and last
    width - 1 words are both known: the proposed phrases and their border. With ``missed``, what holds a missed phrase, is
    made of known or missed words, and was not counted before.
    """
    longest = max(widths)
    if known is None:
        wanted = {width: words.left >= width for width in widths}
    elif missed is None:
        wanted = known_parts(words, lang, longest, known, np.ones(words.n, dtype=bool))
        wanted[1] = np.ones(words.n, dtype=bool)
    else:
        wanted = holds_missed(words, lang, longest, missed)
        near = np.zeros(words.n, dtype=bool)
        for width, places in wanted.items():
            for k in range(width):
                near[k:] |= places[: words.n - k]
        at = np.flatnonzero(near)
        hashes = keyed(lang, words.hashes(at, 1))
        usable = np.zeros(words.n, dtype=bool)
        usable[at] = known.has(hashes) | missed.has(hashes)
        counted_before = known_parts(words, lang, longest, known, near)
        for width, places in wanted.items():
            for k in range(width):
                places[: words.n - k] &= usable[k:]
            wanted[width] = places & ~counted_before[width]
    # Ids of the words and shorter phrases are needed wherever a longer one is wanted.
    needed, cover = {}, np.zeros(words.n, dtype=bool)
    for width in sorted(wanted, reverse=True):
        cover = cover | wanted[width]
        needed[width] = np.flatnonzero(cover)
    touched = cover.copy()
    for width, places in wanted.items():
        for k in range(1, width):
            touched[k:] |= places[: words.n - k]
    at = np.flatnonzero(touched)
    _, where, back = distinct_spans(words.units, words.starts[at], words.ends[at], words.hashes(at, 1))
    word, ids = np.zeros(words.n, dtype=np.int64), np.zeros(words.n, dtype=np.int64)
    word[at] = ids[at] = back
    if 1 in wanted:
        yield 1, at[where], np.bincount(back, minlength=len(where))
    for width in range(2, longest + 1):
        at = needed[width]
        if not len(at):
            return
        _, first, back = np.unique(ids[at] * len(where) + word[at + width - 1], return_index=True, return_inverse=True)
        ids[at] = back
        counts = np.bincount(back[wanted[width][at]], minlength=len(first))
        some = np.flatnonzero(counts)
        yield width, at[first[some]], counts[some]


def counted(rows: DataFrame, widths: range, known=None, missed=None) -> DataFrame:
    """(lang, phrase, c): exact counts over all rows; the phrase '' holds the number of words, if words are counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [None if f is None else Filter(f.value) for f in (known, missed)]
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def reduce(lang: str) -> Iterator[pa.RecordBatch]:
            words = Words(waiting.pop(lang))
            sizes.pop(lang)
            if words.n == 0:
                return
            out = [(pa.array([""]), np.array([words.n]))] if missed is None else []
            out += [(words.strings(at, width), counts) for width, at, counts in phrase_counts(words, lang, widths, *filters)]
            for phrases, counts in out:
                named = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(phrases), np.int8)), pa.array([lang])).dictionary_decode()
                yield pa.RecordBatch.from_arrays([named, phrases, pa.array(counts, pa.int64())], ["lang", "phrase", "c"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                for part in pieces_of(text):
                    waiting.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part)
                    if sizes[lang] >= CHUNK:
                        yield from reduce(lang)
                    elif sum(sizes.values()) >= 4 * CHUNK:
                        yield from reduce(max(sizes, key=sizes.get))
        for lang in list(waiting):
            yield from reduce(lang)

    emitted = map_arrow(rows.select("lang", "text"), run, "lang string, phrase string, c long")
    return emitted.groupBy("lang", "phrase").agg(F.sum("c").alias("c"))


def phrase_hashes(batch: pa.RecordBatch) -> np.ndarray:
    """The filter's hashes of (lang, phrase) rows."""
    texts = [p.encode("utf-8", "surrogatepass") for p in batch.column(1).to_pylist()]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.cumsum(lengths) - lengths
    plain = Spans(np.frombuffer(b"".join(texts), dtype=np.uint8)).hashes(starts, starts + lengths)
    langs = batch.column(0).to_pylist()
    out = np.empty(len(texts), dtype=np.uint64)
    for lang in set(langs):
        own = np.fromiter((x == lang for x in langs), dtype=bool, count=len(langs))
        out[own] = keyed(lang, plain[own])
    return out


def filter_of(phrases: DataFrame, with_words: bool = False) -> np.ndarray:
    """The bits of a filter of the phrases (lang, phrase), at will also of their words; at most FILTER_BITS reach the driver."""
    rows = phrases.select("lang", "phrase")
    if with_words:
        marked = F.concat("lang", F.lit(of_words(""))).alias("lang")
        rows = rows.unionByName(phrases.select(marked, F.explode(F.split("phrase", " ")).alias("phrase")).distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, mask = Filter.place(phrase_hashes(batch), FILTER_BITS)
            columns = [pa.array(at.astype(np.int32)), pa.array(mask.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "bits"])

    slots = map_arrow(rows, run, "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    out[slots["slot"].to_numpy()] = slots["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def not_in(phrases: DataFrame, shared) -> DataFrame:
    """The phrases (lang, phrase) that the filter does not know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~Filter(shared.value).has(phrase_hashes(batch))))

    return map_arrow(phrases.select("lang", "phrase"), run, "lang string, phrase string")


def width_of(phrase: str = "phrase") -> Column:
    return F.size(F.split(phrase, " "))


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, a), (lang, n)): all phrases of 1 to ``longest`` words that occur ``least`` times or more, and word totals.

    One document in SAMPLE proposes phrases, at a support lowered to half of its share. The full pass counts all words,
    the proposed phrases and their negative border: what is not proposed but has proposed first and last parts, wherever
    it occurs. A frequent phrase among these that was not proposed is a miss, and failures of the border are expanded: a further
    pass over all documents counts every phrase around a miss that was not counted yet. That closes the set. For let a
    frequent phrase not be counted in the full pass; of its parts that are not proposed take a shortest one. All parts of
    that one are proposed, so it was counted, is frequent, and is a miss; so the phrase holds a miss and is counted now.
    Filters may take more phrases for proposed or missed than there are; what is counted is still decided by the phrase
    alone, in one pass, over all documents.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text.alias("text"), F.pmod(F.xxhash64("doc_id", text), F.lit(SAMPLE)).alias("part"))
    support = max(2, least // (2 * SAMPLE))
    proposed = stored(counted(rows.where("part = 0"), range(1, longest)).where((F.col("c") >= support) & (F.col("phrase") != "")), "proposed_phrases")
    known = spark.sparkContext.broadcast(filter_of(proposed))
    counts = counted(rows, range(1, longest + 1), known)
    counts = stored(counts.where((F.col("c") >= least) | (F.col("phrase") == "")), "phrase_counts")
    totals = stored(counts.where(F.col("phrase") == "").select("lang", F.col("c").alias("n")), "word_totals")
    frequent = counts.where((F.col("c") >= least) & (F.col("phrase") != ""))
    misses = stored(not_in(frequent.where(width_of() < longest), known), "missed_phrases")
    if not misses.isEmpty():
        missed = spark.sparkContext.broadcast(filter_of(misses, with_words=True))
        more = counted(rows, range(1, longest + 1), known, missed).where(F.col("c") >= least)
        frequent = frequent.unionByName(stored(more, "expanded_phrases"))
    return frequent.withColumnRenamed("c", "a"), totals


def _exact(*factors: str) -> Column:
    out = F.col(factors[0]).cast("decimal(38,0)")
    for name in factors[1:]:
        out = (out * F.col(name).cast("decimal(38,0)")).cast("decimal(38,0)")
    return out


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases.

    Texts are lower-cased (A-Z) and split at BREAKS into pieces, those at blanks and tabs into words. Candidates are phrases of 2 to
    ``longest`` words that occur ``least`` times or more within pieces; overlapping occurrences count. Cut after k words,
    l and r are the counts of the parts and the score floor(1000 a n / (l r)), in decimal arithmetic; the lowest cut counts, ties to the
    smallest k. A candidate inside a longer one that occurs as often is dropped. Rank is by score, then a, both falling, then phrase.

    Null and empty texts have no words; a null lang is 'und', together with that name. Repeated rows count again. No documents or no
    candidates give no rows. Very long texts are cut at piece ends into parts, so memory is bounded by the longest piece.
    Other columns than doc_id, text and lang are not read.
    """
    phrases, totals = frequent_phrases(docs, least, longest)
    words = F.split("phrase", " ")
    candidates = phrases.where(F.size(words) > 1)
    # Counts only fall from a phrase to a longer one, so one word more decides for all longer ones.
    longer = candidates.where(F.size(words) > 2).select("lang", "a", F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " "), F.array_join(F.slice(words, F.lit(2), F.size(words) - 1), " "),
    )).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("most").isNull() | (F.col("most") < F.col("a"))).drop("most")
    cuts = left.select("lang", "phrase", "a", words.alias("w")).select(
        "lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("tail"),
    )
    for part, count in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(part), F.col("a").alias(count)), ["lang", part])
    cuts = cuts.join(totals, "lang").withColumn("thousand", F.lit(1000))
    top_half, bottom = _exact("thousand", "a", "n"), _exact("l", "r")
    exact = ((top_half - top_half % bottom) / bottom).cast("decimal(38,0)").cast("bigint")
    best = F.min(F.struct(exact.alias("score"), "k", "l", "r", "a", "n")).alias("best")
    scored = cuts.groupBy("lang", "phrase").agg(best).select("lang", "phrase", *[F.col(f"best.{c}").alias(c) for c in ("a", "l", "r", "n", "score")])
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A language's phrases meet as SALTS lists of at most ``top``.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = scored.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir), least=100, longest=5, top=2000)


OP11_SQL = r"""
with w as (
  select coalesce(lang, 'und') as lang, list_filter(regexp_split_to_array(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') as w
  from documents
), p as (select lang, w, unnest(range(1, len(w) + 1)) as i from w),
g as (select lang, i, w, unnest(range(1, least(5, len(w) - i + 1) + 1)) as m from p),
f as (select lang, m, array_to_string(w[i : i + m - 1], ' ') as phrase, count(*) as a from g group by all),
n as (select lang, sum(a)::hugeint as n from f where m = 1 group by lang),
c as (select * from f where m > 1 and a >= 100),
longer as (
  select lang, phrase, max(a) as most from (
    select lang, a, array_to_string(string_split(phrase, ' ')[1 : m - 1], ' ') as phrase from c where m > 2
    union all select lang, a, array_to_string(string_split(phrase, ' ')[2 : m], ' ') from c where m > 2) group by all),
kept as (select c.* from c left join longer o on o.lang = c.lang and o.phrase = c.phrase where o.most is null or 100 * o.most < 100 * c.a),
cut as (select *, unnest(range(1, m)) as k from kept),
scored as (
  select x.lang, x.phrase, x.a, x.k, l.a as l, r.a as r, n.n, (1000::hugeint * x.a * n.n) // (l.a::hugeint * r.a) as score
  from cut x join f l on l.lang = x.lang and l.phrase = array_to_string(string_split(x.phrase, ' ')[1 : x.k], ' ')
  join f r on r.lang = x.lang and r.phrase = array_to_string(string_split(x.phrase, ' ')[x.k + 1 : x.m], ' ')
  join n on n.lang = x.lang),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n::bigint as n, score::bigint as score
from best qualify rank <= 2000
"""
