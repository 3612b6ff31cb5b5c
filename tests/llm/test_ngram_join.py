"""The n-gram join against sets of word tuples taken from the strings themselves."""

import random
import re

import pytest

from seamwright.llm import ngram_join

SCHEMA = "doc_id long, text string, rep string, n int, cell double"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(words[i : i + min(k, len(words))]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent):
    """(doc_id, n_shingles, component_id) of every row, sorted; rows of null doc_id link with nothing."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), None if d is None else least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def check(spark, rows, k=4, percent=85):
    df = spark.createDataFrame([(d, t, "x", 1, 2.0) for d, t in rows], SCHEMA)
    got = ngram_join.near_duplicates(df, k, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, k, percent)


def prose(rng, n, words=300):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


@pytest.mark.parametrize("text", ["word", None])
def test_one_row(spark, text):
    check(spark, [(1, text)])


def test_batches_of_short_texts(spark):
    check(spark, [(i, f"only{i % 7}") for i in range(40)] + [(50, ""), (51, "x " * 50)] + [(100 + i, " ".join(prose(random.Random(i), 6))) for i in range(30)])


def test_rows_of_one_doc_id(spark):
    rng = random.Random(3)
    a, b = " ".join(prose(rng, 60)), " ".join(prose(rng, 60))
    check(spark, [(5, a), (5, b), (6, a + " one"), (7, b + " one"), (5, a), (8, None), (8, "word"), (9, "word"), (None, a), (None, None)])


def test_words_that_cancel_in_polynomials(spark):
    t = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    u = t.translate(str.maketrans("ab", "ba"))
    check(spark, [(1, t), (2, u), (3, f"{t} x y z"), (4, f"{u} x y z"), (5, " ".join(t)), (6, " ".join(u))])


@pytest.mark.parametrize("small", [False, True])
def test_random_groups(spark, monkeypatch, small):
    if small:
        for name, value in {"GROUP": 200, "BLOCK": 4, "LOW": 64, "HIGH": 128, "LEAST_HEAVY": 3, "COUNTERS": 64, "HEAVY": 1 << 30}.items():
            monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(17)
    rows, common = [], prose(rng, 12)
    for g in range(12):
        base = prose(rng, rng.choice([8, 25, 60, 120]))
        for _ in range(rng.choice([1, 2, 9, 30])):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(50)}"
            words = words + common if g % 3 == 0 else words
            rows.append((len(rows), (" " if rng.random() < 0.5 else "\n").join(w.upper() if rng.random() < 0.1 else w for w in words)))
    check(spark, rows, *((4, 85) if small else (5, 80)))


def test_empty(spark):
    assert ngram_join.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
