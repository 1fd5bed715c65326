"""Language ID, line dedup, SimHash, decontamination and toxicity against plain versions."""

import hashlib
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from screenmart.llm import decontaminate, langid, lines, simhash, toxicity
from screenmart.llm.common import LOWER, crc_fold
from screenmart.llm.components import components
from tests.llm.conftest import DOCS, prose

ALPHABETS = {"aa": "aeiourstln", "bb": "kzxwyqjvou"}


def labelled(spark, n=160):
    rng, rows = random.Random(3), []
    for i in range(n):
        lang = "aa" if i % 2 else "bb"
        text = " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 9))) for _ in range(40))
        rows.append((i, text, lang, "s", len(text)))
    return rows


def test_language_id_finds_the_language_of_held_out_rows(spark):
    rows = [*labelled(spark), (900, None, "aa", "s", 0), (901, "123 !?", "bb", "s", 6), (902, "", None, "s", 0), (None, "x", None, "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert all(got[r[0]].lang_pred == r[2] for r in rows[:160])
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    kept = {r.doc_id for r in langid.keep_known(docs).collect()}
    assert set(range(160)) <= kept and not kept & {900, 901, 902}


def test_language_id_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert langid.identify(docs).count() == 0
    unnamed = spark.createDataFrame([(1, "word", None, "s", 4)], DOCS)
    assert [r.lang_pred for r in langid.identify(unnamed).collect()] == ["und"]


def test_language_id_keeps_clashing_columns(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns
    assert {r.score for r in kept.collect()} == {0.5}


def test_bloom_masks_never_miss_and_rarely_err():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 2**63, 4000).astype(np.uint64)
    slots = np.zeros((2, 1 << 16), dtype=np.uint64)
    for k in range(70):  # over one word of languages
        at = langid._slots(grams[k * 50 : k * 50 + 50], 1 << 16, 4).ravel()
        slots[k >> 6, at] |= np.uint64(1) << np.uint64(k & 63)
    f = langid.Filters(tuple(map(str, range(70))), slots, 4, np.zeros(70), np.ones(70))
    counts = f.popcounts(grams[:3500], np.full(70, 50))
    assert (counts.diagonal() == 50).all()
    assert counts.sum() - counts.diagonal().sum() < 20


def line_dedup_plainly(rows, least):
    key = lambda s: s.strip(" \t\n\x0b\f\r").encode().translate(LOWER).decode()
    docs_of_key = {}
    for i, t in rows:
        for s in (t or "").split("\n"):
            docs_of_key.setdefault(key(s), set()).add(i)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [s for s in all_lines if not key(s) or len(docs_of_key[key(s)]) < least]
        out.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup(docs_of, odd_rows):
    rng = random.Random(2)
    shared = ["Read more.", "  ALL rights reserved\t", "É seul"]
    rows = odd_rows + [(100 + k, "\n".join(rng.choice([*shared, "", f"own {k}"]) for _ in range(6))) for k in range(25)]
    rows += [(200, "read MORE.\nall rights reserved"), (201, "é seul\nown")]
    docs = docs_of(rows)
    got = lines.dedup_lines(docs, least_docs=10)
    assert got.columns == [*[c for c in docs.columns if c != "n_lines"], "n_lines", "n_dropped"]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got.collect()), key=str) == line_dedup_plainly(rows, 10)
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def fingerprint_plainly(text, width):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    parts = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_plainly(rows, width, bits):
    fps = [fingerprint_plainly(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, f"{fps[k]:016x}", least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def test_simhash(docs_of, odd_rows):
    rng = random.Random(8)
    base = prose(rng, 150).split()
    rows = list(odd_rows)
    for k in range(40):  # near copies: a word or two changed
        words = list(base)
        for _ in range(k % 3):
            words[rng.randrange(len(words))] = "changed"
        rows.append((300 + k, " ".join(words)))
    docs = docs_of(rows)
    got = simhash.near_duplicates(docs, width=3, max_bits=3)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=str) == near_plainly(rows, 3, 3)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    first = {c for _, _, c in near_plainly(rows, 3, 3)} - {None}
    assert {r.doc_id for r in kept.collect()} - {None} == first
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_golay_keys_meet_at_every_distance_up_to_three():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**63, 500).astype(np.uint64)
    for bits in (0, 1, 2, 3):
        b = a.copy()
        for i in range(len(b)):
            for k in rng.choice(64, bits, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(k)
        keys, owners = simhash.index_keys(b)
        index = {}
        for key, owner in zip(keys.tolist(), owners.tolist(), strict=True):
            index.setdefault(key, set()).add(owner)
        probes, _ = simhash.probe_keys(a)
        assert all(any(int(y) in index.get(p, ()) for p in ps) for ps, y in zip(probes.reshape(-1, 3).tolist(), b, strict=True))
    table = simhash.golay_table()
    assert (np.bincount(table) == 2048).all()  # perfect: every codeword's ball has the same size


def test_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(200, 260)] + [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(7, None), (None, 8), (9, 9)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == {(x, find(x)) for x in root}
    assert len(got) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def similar_plainly(docs, items, similarity=0.8):
    def shingles(text):
        words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", (text or "").lower()) if w]
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]

    best = {}
    for d, text in docs:
        s = shingles(text)
        for i, item in items:
            t = shingles(item)
            for at in range(max(1, len(s) - len(t) + 1)) if t and s else []:
                w = s[at : at + len(t)]
                shared = sum(min(w.count(x), t.count(x)) for x in set(t))
                value = shared / (len(w) + len(t) - shared)
                if value >= similarity:
                    best[d, i] = max(best.get((d, i), (0, 0)), (value, at))
    return sorted(((d, i, at, value) for (d, i), (value, at) in best.items()), key=str)


def test_decontamination(spark, docs_of, odd_rows):
    rng = random.Random(6)
    items = [(k, prose(rng, 60 + k)) for k in range(8)] + [(90, "too short"), (91, None), (92, "la la la la la la la la la la la la"), (None, prose(rng, 30))]
    docs = list(odd_rows)
    for k in range(24):
        words = items[k % 8][1].split()
        if k >= 8:
            words[k % len(words)] = "edited"
        if k >= 16:
            words = words[2:]
        docs.append((400 + k, prose(rng, k) + " \n" + " ".join(words).upper() + "\t" + prose(rng, k)))
    docs.append((500, "la " * 12))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = docs_of(docs)
    got = decontaminate.find(frame, benchmark)
    assert got.columns == ["doc_id", "item_id", "window_start", "similarity"]
    want = similar_plainly(docs, items)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and len(want) > 10
    kept = decontaminate.keep_clean(frame, benchmark)
    assert kept.columns == frame.columns
    assert kept.count() == len(docs) - sum(1 for d, _ in docs if d in {w[0] for w in want})
    assert decontaminate.find(frame.limit(0), benchmark).count() == 0
    assert decontaminate.find(frame, benchmark.limit(0)).count() == 0


def test_decontamination_plan_is_native(spark, docs_of, odd_rows):
    plan = decontaminate.find(docs_of(odd_rows), spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string"))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())


def test_toxicity_separates_held_out_rows(spark):
    rng, rows, marks = random.Random(9), [], []
    for i in range(600):
        words = prose(rng, 60).split()
        if i % 4 == 0:
            for _ in range(4):
                words[rng.randrange(60)] = rng.choice(["grumblex", "vilethorn", "snarlwick"])
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 4 == 0)))
    rows += [(1000, None), (1001, ""), (1002, "1 2 3"), (None, "vilethorn")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("predicted", F.lit("clash"))
    labels = spark.createDataFrame([*marks, (None, 1), (5, None), (7, 3)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels.where(crc_fold("doc_id", 4) != 2))
    got = {r.doc_id: r for r in toxicity.predict(docs, model).collect()}
    right = [got[i].predicted == toxic for i, toxic in marks]
    assert sum(right) >= 0.98 * len(right)
    assert all(0 <= got[i].score <= 1 for i in got) and got[1000].predicted == 0 and got[None].predicted == 1


def test_toxicity_is_calibrated_alike_when_sampled(spark):
    rng = random.Random(10)
    marks = [(i, int(i % 10 == 0)) for i in range(3000)]
    rows = [(i, prose(rng, 30) + (" grumblex vilethorn" if toxic and i % 20 == 0 else "")) for i, toxic in marks]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    means = []
    for most in (60, 4000):
        judged = toxicity.predict(docs, toxicity.train(docs, labels, most=most)).toPandas()
        # Half of the toxic texts look ordinary: of all that do, 1 in 19 is toxic, far below the threshold.
        assert judged.set_index("doc_id")["predicted"].sum() == 150
        means.append(judged["score"].mean())
    assert all(abs(m - 0.1) < 0.02 for m in means)


def test_toxicity_by_phrases_of_ordinary_words(spark):
    rng, rows, marks = random.Random(11), [], []
    said = "over here lies your very last good morning".split()
    for i in range(1200):
        toxic = int(i % 4 == 0)
        words = [rng.choice([*said, *prose(rng, 8).split()]) for _ in range(60)]
        if toxic:
            words[20:20] = said * 2
        rows.append((i, " ".join(words)))
        marks.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs, labels.where(crc_fold("doc_id", 4) != 2))
    assert model.toxic == b""  # no span tells the classes apart
    got = {r.doc_id: r.predicted for r in toxicity.predict(docs.where(crc_fold("doc_id", 4) == 2), model).collect()}
    truth = dict(marks)
    caught = sum(got[i] for i in got if truth[i])
    assert caught >= 0.8 * sum(truth[i] for i in got) and caught >= 0.8 * sum(got.values())


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.predicted for r in toxicity.predict(docs, model).collect()] == [0]
    assert toxicity.predict(docs.limit(0), model).count() == 0


def test_sha_of_an_empty_document(docs_of):
    got = lines.dedup_lines(docs_of([(1, None)])).select(F.sha2("text", 256).alias("s")).first()
    assert got.s == hashlib.sha256(b"").hexdigest()


def test_toxicity_with_one_class_in_the_calibration_fold(spark):
    """Calibrated on the taught rows then; labels that contradict or repeat each other do not matter."""
    rng = random.Random(12)
    marks = [(i, int(i % 4 == 0)) for i in range(400)]
    rows = [(i, prose(rng, 40) + (" grumblex vilethorn snarlwick" if toxic else "")) for i, toxic in marks]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, *marks[:40], (1, 1), (9999, 1)], "doc_id long, toxic int")
    labels = labels.where((crc_fold("doc_id", 4) != 3) | (F.col("toxic") == 0))
    judged = {r.doc_id: r.predicted for r in toxicity.predict(docs, toxicity.train(docs, labels)).collect()}
    assert sum(judged[i] == toxic for i, toxic in marks) >= 0.97 * len(marks)
