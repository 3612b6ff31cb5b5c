"""Scores against n-grams counted one by one; labels of one class, or none."""

import math

import numpy as np
import pytest

from seamwright.llm import toxicity
from seamwright.llm import words as w

SCHEMA = "doc_id long, text string, score string, label string"
MASK = (1 << 64) - 1


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def buckets(word):
    """Every n-gram of the word's runs of letters and digits, one mark at either end of a run."""
    runs, now = [], []
    for c in [*word.lower(), " "]:
        if c.isalpha() or c.isdigit():
            now.append(ord(c))
        elif now:
            runs.append([0, *now, 0])
            now = []
    for run in runs:
        for n in toxicity.SIZES:
            for i in range(len(run) - n + 1):
                yield mix((n + sum((p + 1) * int(w._PLACE[k]) for k, p in enumerate(run[i : i + n]))) & MASK) >> 64 - toxicity.BITS


def test_scores(spark):
    data = [(i, ("you idiot moron " if i % 3 == 0 else "dear friend hello ") + f"text{i} é日 it's a-b {i % 5}", i % 3 == 0) for i in range(90)]
    df = spark.createDataFrame([(i, t, "s", "l") for i, t, _ in data] + [(200, None, "s", "l"), (201, "", "s", "l"), (202, "idiot " * 50_000, "s", "l")], SCHEMA)
    labels = spark.createDataFrame([(i, int(bad)) for i, _, bad in data] + [(200, None), (0, 1)], "doc_id long, toxic int")
    model = toxicity.trained(df, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    for i, t, bad in data:
        z = model["bias"] + sum(float(model["weights"][b]) for word in t.split() for b in buckets(word))
        assert math.isclose(got[i], 1 / (1 + math.exp(-max(-60, min(60, z)))), rel_tol=1e-4, abs_tol=1e-9) and (got[i] >= 0.7) == bad
    assert got[200] == got[201] == pytest.approx(1 / (1 + math.exp(-model["bias"]))) and got[202] > 0.99 and np.count_nonzero(model["weights"]) > 20


@pytest.mark.parametrize(("labels", "want"), [([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, None)], 0.0), ([(77, 1)], 0.0)])
def test_one_class_or_none(spark, labels, want):
    df = spark.createDataFrame([(1, "one text", "s", "l"), (2, "two", "s", "l"), (3, None, "s", "l")], SCHEMA)
    model = toxicity.fit(df.join(spark.createDataFrame(labels, "doc_id long, toxic int"), "doc_id").filter("toxic IS NOT NULL").selectExpr("doc_id", "text", "toxic AS label"))
    assert [round(r["score"], 6) for r in toxicity.score(df, model).collect()] == [want] * 3
