"""Tokenizers, ORC files and language-model scores against the libraries and plain versions."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.orc
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from screenmart.llm import bpe, lm, orc_tokens, pieces
from screenmart.llm.common import LOWER, cuts, shared_path
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def library():
    with open(bpe.default_ranks(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = st.text(st.sampled_from(list("ab e'stmdrvl \n\t'.,!12é中😀 \r\x1cABST' ́")), max_size=24) | st.text(max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_pieces_are_those_of_the_pattern(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    joined, _, starts, ends, counts = pieces.split(texts)
    found = [joined[s:e] for s, e in zip(starts, ends, strict=True)]
    pattern = regex.compile(public_tokenizers.PATTERN)
    assert found == [p for t in texts for p in pattern.findall(t)]
    assert counts.tolist() == [len(pattern.findall(t)) for t in texts]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_bpe_equals_the_library(library, text):
    text = text.encode("utf-8", "ignore").decode()
    merger, encoded = bpe._loaded(bpe.default_ranks())
    ids, _ = encoded.texts([text])
    assert ids.tolist() == library.encode_ordinary(text)
    assert merger.decode(ids.tolist()) == text.encode()


def test_bpe_backtracks_like_plain_merging():
    ranks = {bytes([c]): c for c in range(256)}
    rng = random.Random(7)
    while len(ranks) < 600:  # merges of random pairs over few letters: many awkward overlaps
        a, b = (rng.choice([t for t in ranks if set(t) <= set(b"abc") and len(t) < 6]) for _ in range(2))
        ranks.setdefault(a + b, len(ranks))
    own = bpe.Bpe(ranks)
    for _ in range(2000):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 18)))
        want = [ranks[piece]] if piece in ranks else own.merge(piece)[0]
        assert own.encode(piece) == want


def test_bpe_forgets_without_changing_results(library):
    merger, _ = bpe._loaded(bpe.default_ranks())
    small = pieces.Encoded(lambda ps: [merger.encode(p.encode()) for p in ps], most=5)
    texts = ["one two three four five six seven", "eight nine two one", ""]
    for text in texts * 2:
        assert small.texts([text])[0].tolist() == library.encode_ordinary(text)


def test_remembered_pieces_are_bound_by_their_length(library):
    merger, _ = bpe._loaded(bpe.default_ranks())
    small = pieces.Encoded(lambda ps: [merger.encode(p.encode()) for p in ps], most=50)
    texts = [f"{chr(97 + k) * 300} {k}" for k in range(26)]  # few pieces, many code points
    for text in texts * 2:
        assert small.texts([text])[0].tolist() == library.encode_ordinary(text)
        assert small.units.used <= 16 * small.most + 310


def test_bpe_workers_unpack_a_part_of_a_batch_at_a_time(docs_of, library):
    assert list(cuts([])) == [] and list(cuts([5, 0, 9, 2, 2, 1], 5)) == [(0, 2), (2, 3), (3, 6)]
    path = bpe.default_ranks()
    _, encoded = bpe._loaded(path)
    assert encoded.most <= 300_000 and bpe.PAIRS <= 150_000
    rows = [(1, None), (2, "a b " * 100_000), (3, ""), (4, "c d"), (5, None)]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in bpe.digests(bpe.encode(docs_of(rows).coalesce(1), path), path).collect()}
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_bpe_encodes_and_decodes_in_one_worker(docs_of, odd_rows, library):
    path = bpe.default_ranks()
    docs = docs_of(odd_rows).where("doc_id is not null").withColumn("ids", F.lit("replaced"))
    encoded = bpe.encode(docs, path)
    assert encoded.columns[-1] == "ids" and sorted(encoded.columns) == sorted(docs.columns)
    assert encoded.schema["ids"].dataType.simpleString() == "array<int>"
    found = bpe.digests(encoded, path)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan  # two of them take two workers for each core
    texts = dict(docs.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in found.collect()}
    assert got.keys() == texts.keys()
    for row in encoded.select("doc_id", "ids").collect():
        ids = library.encode_ordinary(texts[row.doc_id] or "")
        assert row.ids == ids and got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()


def test_bpe_round_trip_of_odd_rows(docs_of, odd_rows, library):
    path = bpe.default_ranks()
    docs = docs_of(odd_rows)
    encoded = bpe.encode(docs, path)
    assert encoded.columns == [*[c for c in docs.columns if c != "ids"], "ids"]
    got = sorted(map(str, bpe.digests(encoded, path).collect()))
    want = []
    for i, text in odd_rows:
        ids = library.encode_ordinary(text or "")
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        back = hashlib.sha256((text or "").encode()).hexdigest()
        want.append(f"Row(doc_id={i}, n_tokens={len(ids)}, ids_sha256='{sha}', decoded_sha256='{back}')")
    assert got == sorted(want)
    assert bpe.digests(encoded.limit(0), path).count() == 0


def test_orc_files(spark, docs_of, odd_rows):
    path = shared_path(spark, "test_tokens")
    orc_tokens.write(docs_of(odd_rows), orc_tokens.default_tokenizer(), path)
    rows = orc_tokens.read(spark, path)
    got = orc_tokens.summaries(rows).collect()
    tokenizer = Tokenizer.from_file(orc_tokens.default_tokenizer())
    tokenizer.encode_special_tokens = True
    start, want = 0, []
    # Of rows of one id, and of those without, any order may stand in the files.
    for r in rows.orderBy("row").collect():
        start_of, start = start, start + len(r.ids)
        want.append((r.doc_id, start_of, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    ids = [w[0] for w in want]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    plain = sorted(str([i, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]]) for i, t in odd_rows)
    assert sorted(str([r.doc_id, list(r.ids)]) for r in rows.collect()) == plain


def test_orc_files_hold_added_tokens(spark, docs_of):
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, mark * 2, f"{mark} it's", f"one  {mark}\n\n{mark}\u4e2d", "", None, "none <|endoftext| >", f"end {mark}", "plain"]
    path = shared_path(spark, "test_tokens")
    orc_tokens.write(docs_of(list(enumerate(texts))), orc_tokens.default_tokenizer(), path)
    tokenizer = Tokenizer.from_file(orc_tokens.default_tokenizer())
    want, start = [], 0
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, orc_tokens.END]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, orc_tokens.summaries(orc_tokens.read(spark, path)).collect())) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(TEXTS | st.just("<|endoftext|>"), max_size=5).map("".join), min_size=1, max_size=4))
def test_added_tokens_are_those_of_the_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    tokenizer = Tokenizer.from_file(orc_tokens.default_tokenizer())
    ids, sizes = orc_tokens._loaded(orc_tokens.default_tokenizer()).texts(texts)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert (ids.tolist(), sizes.tolist()) == ([i for x in want for i in x], list(map(len, want)))


def test_orc_files_have_stripes_and_are_pruned(spark, docs_of):
    path = shared_path(spark, "test_tokens")
    orc_tokens.write(docs_of([(k, "some words here") for k in range(50)]), orc_tokens.default_tokenizer(), path)
    files = spark.read.format("binaryFile").load(path).select("path").collect()
    for file in files:
        found = pyarrow.orc.ORCFile(file.path.replace("file:", "")).file_footer_length
        assert found > 0
    one = orc_tokens.read(spark, path).where("doc_id = 17")
    assert "EqualTo(doc_id,17)" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_orc_of_nothing(spark, docs_of):
    path = shared_path(spark, "test_tokens")
    orc_tokens.write(docs_of([]), orc_tokens.default_tokenizer(), path)
    assert orc_tokens.summaries(orc_tokens.read(spark, path)).count() == 0


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER)) + [None]


def model_plainly(rows, tuned):
    """Scores of a dictionary-based model; ``tuned`` tells which training rows are held out of the first counts."""
    train = [(i, t) for i, t, mark in rows if mark]
    n = Counter(w for _, t in train for w in tokens(t))
    total, distinct = sum(n.values()), len(n)
    uniform = 1 / (distinct + 1)

    def counts(some):
        word, pair, context = Counter(), Counter(), Counter()
        for t in some:
            ws = tokens(t)
            word.update(ws)
            pair.update(zip([0, *ws[:-1]], ws, strict=True))
            context.update([0, *ws[:-1]])
        return word, pair, context

    def estimates(t, word, pair, context, size):
        ws = tokens(t)
        for v, w in zip([0, *ws[:-1]], ws, strict=True):
            c = context[v]
            yield int(math.log2(c)) + 1 if c else 0, pair[v, w] / c if c else 0.0, word[w] / max(size, 1)

    kept = counts([t for i, t in train if i not in tuned])
    size = sum(kept[0].values())
    events = [e for i, t in train if i in tuned for e in estimates(t, *kept, size)]
    w = {}
    em = {b: [0.5, 0.4, 0.1] for b in range(64)}
    for _ in range(100 if events else 0):
        sums = {b: [0.0] * 3 for b in em}
        for b, p2, p1 in events:
            share = [em[b][0] * p2, em[b][1] * p1, em[b][2] * uniform]
            for k in range(3):
                sums[b][k] += share[k] / sum(share)
        pooled = [sum(s[k] for s in sums.values()) / len(events) for k in range(3)]
        new = {b: [(s[k] + 5 * pooled[k]) / (sum(s) + 5) for k in range(3)] for b, s in sums.items()}
        done = max(abs(new[b][k] - em[b][k]) for b in em for k in range(3)) < 1e-6
        em = new
        if done:
            break
    for b, x in em.items():
        x = [max(v, 1e-7) for v in x]
        if b == 0:
            x[0] = 0.0
        w[b] = [v / sum(x) for v in x]
    full = counts([t for _, t in train])
    out = []
    for i, t, _ in rows:
        base = sum(math.log10((n[x] + 0.5) / (total + 0.5 * (distinct + 1))) for x in tokens(t))
        model = sum(math.log10(w[b][0] * p2 + w[b][1] * p1 + w[b][2] * uniform) for b, p2, p1 in estimates(t, *full, total))
        out.append((i, len(tokens(t)), sum(n[x] > 0 for x in tokens(t)), total, base, model))
    return sorted(out, key=str)


def test_language_model(spark, odd_rows, monkeypatch):
    rng = random.Random(11)
    rows = [(i, t, i is not None and i % 3 > 0) for i, t in odd_rows] + [(50 + k, prose(rng, 80), k % 5 > 0) for k in range(60)] + [(200, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(5)
    tuned = {r.doc_id for r in docs.selectExpr("doc_id", "pmod(xxhash64(doc_id), 4) = 0 as t").where("t").collect()}
    monkeypatch.setattr(lm, "PART_GRAMS", 3000)  # several parts of the key space
    got = sorted((tuple(r) for r in lm.score(docs, tune_share=4).collect()), key=str)
    want = model_plainly(rows, tuned)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-9)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def test_language_model_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b", False), (2, None, False)], "doc_id long, text string, train boolean")
    got = sorted(map(tuple, lm.score(docs).collect()))
    assert [g[:5] for g in got] == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    assert lm.score(docs.limit(0)).count() == 0


def test_packed_integers():
    for values in (np.zeros(0, np.int64), np.array([5], np.uint64), np.arange(-3, 900, dtype=np.int32)):
        assert (lm.unpack(lm.pack(values), values.dtype) == values).all()
