"""Results that rest on contents, not on hashes, and work that grows with the text alone."""

import collections
import hashlib
import random
import re
import time

import numpy as np
import pytest

from screenmart.llm import bpe, common, decontaminate, langid, lines, orc_tokens, pieces
from screenmart.llm.common import BYTE_BITS
from tests.llm.conftest import prose
from tests.llm.test_mining import thue_morse
from tests.llm.test_text import similar_plainly


def by_length_only(units, starts, ends):
    """A hash under which all spans of one length clash."""
    return (np.asarray(ends) - np.asarray(starts)).astype(np.uint64)


@pytest.fixture
def weak(monkeypatch):
    """All hashing replaced by one that clashes all the time."""
    monkeypatch.setattr(common, "quick_hashes", by_length_only)


def test_regular_strings_do_not_clash():
    x, y = thue_morse(4096)
    units = np.frombuffer((x + y).encode(), dtype=np.uint8)
    for n in (1024, 2048, 4096):
        a, b = common.span_hashes(units, np.array([0, 4096]), np.array([n, 4096 + n]))
        assert a != b


def test_distinct_spans_under_clashes(weak):
    rng = random.Random(1)
    words = [rng.choice(["ab", "ba", "cd", "abc", "cba", "x", "y"]) for _ in range(500)]
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    hashes, where, back = common.distinct_spans(np.frombuffer("".join(words).encode(), np.uint8), starts, ends)
    assert len(where) == len(set(words)) and [words[where[k]] for k in back] == words
    assert (np.diff(hashes.astype(np.int64)) >= 0).all()


@pytest.mark.parametrize("most", [2_500_000, 7])
def test_pieces_are_remembered_by_content(weak, most):
    known = pieces.Encoded(lambda parts: [[*p.encode()] for p in parts], most=most)
    rng = random.Random(2)
    for _ in range(30):
        texts = ["".join(rng.choice("ab ,") for _ in range(rng.randint(0, 30))) for _ in range(5)]
        ids, sizes = known.texts(texts)
        assert bytes(ids.tolist()).decode() == "".join(texts) and sizes.tolist() == [len(t) for t in texts]


def test_clashing_pieces_get_the_library_ids(spark):
    import tiktoken  # noqa: F401  (the rank file is tiktoken's)
    from tokenizers import Tokenizer

    x, y = thue_morse(2048)
    rows = [(1, f"{x}.{y}"), (2, y), (3, x), (4, f"{y} {x}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    path = bpe.default_ranks()
    got = {r.doc_id: r for r in bpe.digests(bpe.encode(docs, path), path).collect()}
    assert all(got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in rows)
    tokenizer = Tokenizer.from_file(orc_tokens.default_tokenizer())
    coded = orc_tokens._loaded(orc_tokens.default_tokenizer())
    ids, sizes = coded.texts([t for _, t in rows])
    assert ids.tolist() == [i for _, t in rows for i in tokenizer.encode(t, add_special_tokens=False).ids]


def test_language_counts_are_those_of_plain_sets(spark, weak):
    """n-gram counts and popcounts against sets and counters, with words that all clash."""
    rng = random.Random(3)
    rows = [(k, " ".join("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(20)), "xy"[k % 2]) for k in range(30)]
    rows += [(90, None, "x"), (91, "A-b 12", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def grams(text):
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
            padded = f" {word} "
            for n in langid.LENGTHS:
                yield from (padded[i : i + n] for i in range(len(padded) - n + 1))

    plain = collections.defaultdict(collections.Counter)
    for _, text, lang in rows:
        plain[lang].update(grams(text))
    units = {g: int(langid.span_hashes(np.array([ord(c) for c in g], np.uint32), np.array([0]), np.array([len(g)]))[0]) for f in plain.values() for g in f}
    assert len(set(units.values())) == len(units)
    counted = {(r.lang, r.gram % 2**64): r.n for r in langid.gram_counts(docs.select("text", "lang")).collect()}
    assert counted == {(lang, units[g]): n for lang, f in plain.items() for g, n in f.items()}

    filters = langid.train(docs.select("text", "lang"), least_share=0.004)
    totals = {lang: sum(f.values()) for lang, f in plain.items()}
    share = {lang: {g: n / totals[lang] for g, n in f.items() if n / totals[lang] >= 0.004} for lang, f in plain.items()}
    kept = {lang: {g for g, s in f.items() if s >= 0.1 * max(o.get(g, 0) for o in share.values())} for lang, f in share.items()}
    scorer = langid.scorer(filters)
    names, scores = langid.decide(filters, scorer, [t or "" for _, t, _ in rows])
    for (_, text, _), name, score in zip(rows, names, scores, strict=True):
        found = list(grams(text))
        if not found:
            assert (name, score) == ("und", 0)
            continue
        answers = filters.popcounts(np.array([units[g] for g in found], np.uint64), np.array([len(found)]))[0]
        exact = np.array([sum(g in kept[lang] for g in found) for lang in filters.languages])
        assert (answers >= exact).all() and (answers - exact <= 3 + 0.02 * len(found)).all()
        f = filters.false_positive
        expected = np.array([sum(plain[x][g] for g in kept[x]) / totals[x] for x in filters.languages])
        corrected = np.maximum(0, (answers - len(found) * f) / (1 - f)) / len(found) / expected
        assert name == filters.languages[corrected.argmax()] and score == pytest.approx(min(1, corrected.max()))
    assert BYTE_BITS.sum() == 1024


def test_decontamination_loses_nothing(spark):
    """Against all windows of all texts: items of few distinct shingles, whose fingerprints are unstable, and random ones."""
    rng = random.Random(4)
    items = [(1, " ".join("xy"[k % 2] for k in range(13))), (2, "la " * 12), (3, " ".join("abc"[k % 3] for k in range(20)))]
    items += [(10 + k, " ".join(rng.choice("ab") for _ in range(rng.randint(5, 25)))) for k in range(25)]
    items += [(50 + k, prose(rng, rng.randint(5, 60))) for k in range(10)]
    docs = [(1, " ".join("yx"[k % 2] for k in range(13))), (2, " ".join("yx"[k % 2] for k in range(40))), (3, "la " * 50)]
    for k in range(60):
        words = items[rng.randrange(len(items))][1].split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = rng.choice(["a", "b", "edit"])
        docs.append((100 + k, " ".join([*prose(rng, rng.randint(0, 9)).split(), *words, *prose(rng, rng.randint(0, 9)).split()])))
    found = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = similar_plainly(docs, items)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert {(1, 1), (2, 1), (3, 2)} <= {(d, i) for d, i, *_ in want} and len(want) > 40


def seconds(run) -> float:
    run()
    best = float("inf")
    for _ in range(2):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return best


def test_line_dedup_is_linear_in_the_lines_of_a_text(spark):
    rng = random.Random(5)

    def took(n):
        text = "\n".join(f"shared line {k}" if k % 2 else f"own {rng.random()}" for k in range(n))
        docs = spark.createDataFrame([(k, text) for k in range(3)], "doc_id long, text string").repartition(3).cache()
        docs.count()
        return seconds(lambda: lines.dedup_lines(docs, least_docs=3).write.format("noop").mode("overwrite").save())

    small, large = took(10_000), took(80_000)
    assert large < 8 * 1.7 * small


def test_byte_merges_are_linear_in_a_piece():
    encoder, _ = bpe._loaded(bpe.default_ranks())
    rng = random.Random(6)

    def took(n):
        piece = "".join(rng.choice("etaoinshrdlu") for _ in range(n)).encode()
        return seconds(lambda: encoder.encode(piece))

    small, large = took(40_000), took(320_000)
    assert large < 8 * 2 * small


def test_decontamination_is_linear_in_a_text(spark):
    item = " ".join("abcdefghij"[k % 10] for k in range(40))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")

    def took(n):
        docs = spark.createDataFrame([(1, " ".join("abcdefghij"[k % 10] for k in range(n)))], "doc_id long, text string")
        return seconds(lambda: decontaminate.find(docs, benchmark).write.format("noop").mode("overwrite").save())

    small, large = took(2_000), took(16_000)
    assert large < 8 * 1.5 * small
