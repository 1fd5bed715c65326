"""Exact dedup, phrase mining and whitening against plain versions."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from screenmart.llm import common, exact, phrases, whitening
from tests.llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- exact dedup -------------------------------------------------------------------


def plain_groups(rows):
    groups = collections.defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    out = []
    for body, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        digest = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, digest) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def test_exact_groups(docs_of, odd_rows):
    rng = random.Random(3)
    rows = [*odd_rows, (60, "same  text\tas nine in every word of it"), (61, " \n")]
    rows += [(100 + k, "hot copy") for k in range(200)] + [(90, "hot copy"), (90, "hot copy")]
    rows += [(1000 + k, prose(rng, 2)) for k in range(300)]
    found = exact.exact_groups(docs_of(rows)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in found], key=repr) == plain_groups(rows)


def test_keep_first_keeps_whole_rows(docs_of, odd_rows):
    rows = [*odd_rows, *[(100 + k, "hot  copy") for k in range(200)], (90, "hot copy"), (90, "hot copy")]
    docs = docs_of(rows)
    kept = exact.keep_first(docs)
    assert kept.columns == docs.columns
    expected = sorted({(r[0], r[4]) for r in plain_groups(rows) if r[3]}, key=repr)
    digests = [(r.doc_id, hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", r.text or "").encode()).hexdigest()) for r in kept.collect()]
    assert sorted(digests, key=repr) == expected


def test_exact_groups_of_nothing(docs_of):
    empty = docs_of([(1, "a")]).where("doc_id < 0")
    assert exact.exact_groups(empty).count() == 0 and exact.keep_first(empty).count() == 0


def test_misra_gries_never_misses_a_heavy_value():
    rng = random.Random(1)
    values = [b"heavy"] * 700 + [b"second"] * 260 + [str(k).encode() for k in range(4000)]
    rng.shuffle(values)
    summary = exact.MisraGries(20)
    for at in range(0, len(values), 100):
        summary.add(pa.array(values[at : at + 100], pa.binary()))
    short = len(values) / 21
    assert len(summary.counts) <= 20
    for value, true in collections.Counter(values).items():
        assert true - short <= summary.counts.get(value, 0) <= true
    assert b"heavy" in summary.counts and b"second" in summary.counts


def test_frequent_digests_over_partitions(spark):
    rows = [(bytes([7]) * 32,)] * 4000 + [(hashlib.sha256(str(k).encode()).digest(),) for k in range(20000)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "digest binary").repartition(7)
    found = [bytes(r[0]) for r in exact.frequent_digests(df, len(rows)).collect()]
    assert bytes([7]) * 32 in found and len(found) <= exact.FREQUENT * 4 / 3


# --- phrases --------------------------------------------------------------------


def plain_collocations(rows, least, top, longest=5):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, min(longest, len(words) - i) + 1):
                    counts[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = collections.Counter()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        scored = []
        for p, a in candidates.items():
            if inside[p] < a:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.fixture
def talk():
    rng = random.Random(9)
    rows = [(k, rng.choice(["en", "de", None, "und"]), prose(rng, 60).replace(" the of", "  The\tOF,")) for k in range(150)]
    rows += [(1000, "en", "a b c d e f " * 400), (1001, "en", "tick " * 50 + ". x x x x x x x x x x x x"), (1002, None, ""), (1003, "en", None), (None, "de", "Ü ü ü ü. ü")]
    rows += [(2000 + k, "fr", "only here once and for all") for k in range(30)] + [(2000, "fr", "only here once and for all")]
    return rows


@pytest.mark.parametrize("sample", [8, 1, 10**9])
def test_collocations(spark, talk, monkeypatch, sample):
    """With all, some or none of the documents in the sample; the last takes a pass for every length."""
    monkeypatch.setattr(phrases, "SAMPLE", sample)
    docs = spark.createDataFrame([(i, t, lang, "x", 1, 2) for i, lang, t in talk], "doc_id long, text string, lang string, phrase string, a long, n long").repartition(3)
    found = sorted(tuple(r) for r in phrases.collocations(docs, least=6, top=40).collect())
    assert found == plain_collocations([(lang, t) for _, lang, t in talk], 6, 40) and len(found) > 30


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    assert phrases.collocations(docs).count() == 0
    assert phrases.collocations(docs.where("doc_id > 1")).count() == 0


def test_scores_past_64_bits(spark):
    big = 3 * 10**15
    df = spark.createDataFrame([(big, 7 * 10**14 + 1, big - 1, big - 2, 1000)], "a long, n long, l long, r long, thousand long")
    up, down = phrases._exact("thousand", "a", "n"), phrases._exact("l", "r")
    assert df.select(((up - up % down) / down).cast("decimal(38,0)").cast("bigint")).first()[0] == 1000 * big * (7 * 10**14 + 1) // ((big - 1) * (big - 2))


def test_long_texts_are_cut_between_pieces_only():
    rng = random.Random(4)
    text = "".join(rng.choice(["word ", "other ", "x.", "y\n", "long" * 30 + " "]) for _ in range(3000)).encode()
    parts = list(phrases.pieces_of(text, 500))
    assert len(parts) > 20
    one = re.split(rb"[.,;:!?\n-\r]", text)
    many = [piece for part in parts for piece in re.split(rb"[.,;:!?\n-\r]", part)]
    assert [p.split() for p in one if p.split()] == [p.split() for p in many if p.split()]


def test_a_full_filter_counts_more_and_loses_nothing(spark, talk, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BITS", 64)
    docs = spark.createDataFrame([(i, t, lang) for i, lang, t in talk], "doc_id long, text string, lang string")
    found = sorted(tuple(r) for r in phrases.collocations(docs, least=6, top=40).collect())
    assert found == plain_collocations([(lang, t) for _, lang, t in talk], 6, 40)


# --- distinct spans -----------------------------------------------------------------


def thue_morse(n):
    """A word and its complement that clash in any hash that sums units times powers modulo 2**64."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_distinct_spans_tell_clashing_contents_apart():
    x, y = thue_morse(2048)
    words = [x, y, "a", x, "b", y, "a", y]
    text = " ".join(words).encode()
    units = np.frombuffer(text, dtype=np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    hashes, where, back = common.distinct_spans(units, starts, ends)
    assert len(where) == 4 and (np.diff(hashes.astype(object)) >= 0).all()
    assert [words[where[k]] for k in back] == words


# --- whitening -------------------------------------------------------------------


@pytest.mark.parametrize("dim", [1, 2, 3, 7, 40])
@pytest.mark.parametrize("kind", ["random", "steep", "twins", "identity", "zero"])
def test_leading_pairs(dim, kind):
    x = np.random.default_rng(dim).standard_normal((4 * dim, dim))
    if kind == "steep":
        x *= np.geomspace(1, 1e-7, dim)
    if kind == "twins":
        x[:, dim // 2 :] = x[:, : dim - dim // 2]
    a = np.eye(dim) * {"identity": 3.0, "zero": 0.0}[kind] if kind in ("identity", "zero") else x.T @ x
    e, v = whitening.leading_pairs(a, 4)
    full = np.sort(np.linalg.eigvalsh(a))[::-1]
    rank = int((full > 1e-13 * full[0]).sum()) if full[0] > 0 else 0
    assert len(e) == min(4, rank)
    if rank:
        assert np.abs(e - full[: len(e)]).max() <= 1e-13 * full[0]
        assert np.abs(a @ v - v * e).max() <= 1e-13 * full[0]
        assert np.abs(v.T @ v - np.eye(len(e))).max() <= 1e-12


def test_counts_by_inertia_are_those_of_the_eigenvalues():
    a = np.random.default_rng(5).standard_normal((30, 30))
    a = a + a.T
    diagonal, side = whitening.tridiagonal(a)
    values = np.linalg.eigvalsh(a)
    for shift in np.linspace(values[0] - 1, values[-1] + 1, 50):
        assert whitening.above(diagonal, side, shift) == (values > shift).sum()


def test_contour_pairs_notice_a_missing_eigenvalue():
    a = np.diag([5.0, 4.0, 3.0, 1.0, 0.5])
    assert np.allclose(whitening.contour_pairs(a, 2.5, 6.0, 3)[0], [5, 4, 3])
    with pytest.raises(ArithmeticError):
        whitening.contour_pairs(a, 2.5, 6.0, 2)


def test_whiten(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((120, 12)) * np.linspace(2, 0.3, 12)
    vectors = [[float(np.float32(c)) for c in v] for v in base]
    rows = [(k, v) for k, v in enumerate(vectors)] + [(500 + k, vectors[3]) for k in range(200)] + [(None, vectors[4]), (3, vectors[3])]
    nan, inf = float("nan"), float("inf")
    odd = [(900, None), (901, []), (902, [None] * 12), (903, [nan] + vectors[0][1:]), (904, [inf] * 12)]
    other = [(950 + k, [float(k), float(k * k % 7), 0.0]) for k in range(20)]
    df = spark.createDataFrame([(i, v, "a", 1.0, 2) for i, v in rows + odd + other], "vec_id long, embedding array<float>, x string, whitened double, n int").repartition(4)
    found = whitening.whiten(df, top=4).collect()
    plain = {}
    for part in (rows, other):
        x = np.floor(256 * np.array([v for _, v in part]))
        fit = np.unique(x, axis=0)
        n, mean = len(fit), fit.mean(axis=0)
        v = (fit - mean).T @ (fit - mean) / n
        e, u = np.linalg.eigh(v)
        e, u = e[::-1], u[:, ::-1]
        for (i, _), row in zip(part, x, strict=True):
            for c in range(min(4, int((e > 1e-9).sum()))):
                plain.setdefault((i, c + 1), []).append((n, int(((n * row - fit.sum(axis=0)) ** 2).sum()), abs((row - mean) @ u[:, c]) / np.sqrt(e[c]), e[c] / e.sum()))
    assert len(found) == sum(map(len, plain.values()))
    signs = collections.defaultdict(set)
    for r in found:
        n, deviation, whitened, explained = plain[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(whitened, abs=1e-8) and r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error < 1e-10
        if r.vec_id == 3:
            signs[r.component].add(r.whitened)
    assert all(len(s) == 1 for s in signs.values())


def test_whiten_without_variance_or_rows(spark):
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)], "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(same.where("vec_id > 9")).count() == 0
    wide = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.6e7, 1.0])], "vec_id long, embedding array<double>")
    assert [r.deviation for r in whitening.whiten(wide).collect()] == [None, None] or all(r.deviation > 0 for r in whitening.whiten(wide).collect())
