import random

import pytest

WORDS = "the of and to in is that for with on are this edition reader amber copper violet harbor meadow lantern".split()
CLASHES = "_same string, score double, lang_pred string, h long, pos int, n_lines long, ids array<int>, fp long, block string, _drop int, key string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ly", "."]) for _ in range(n))


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names operators use inside."""

    def make(rows, lang="en"):
        extra = "x", 0.5, "zz", 1, 2, 3, [4], 5, "b", 6, "k"
        full = [(i, t, lang, "s", None if t is None else len(t), *extra) for i, t in rows]
        return spark.createDataFrame(full, f"{DOCS}, {CLASHES}").repartition(3)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, a very long one, repeated rows, ties, and odd characters."""
    rng = random.Random(5)
    long = prose(rng, 40_000)
    rows = [(None, None), (None, "no id here"), (1, None), (2, ""), (3, " \t\n "), (4, long), (5, "a"), (6, "one two"), (7, "it's\r\nÉté ünï 中文 😀 12,5")]
    rows += [(8, "same text as nine in every word of it"), (9, "same text as nine in every word of it"), (9, "same text as nine in every word of it")]
    return rows + [(10 + k, prose(rng, 30)) for k in range(20)]
