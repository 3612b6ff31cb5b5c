"""Predictions and spans against word scores counted one by one and a full table of paths."""

import random

import numpy as np

from seamwright.llm import langid
from seamwright.llm import words as w

MASK = (1 << 64) - 1
SCHEMA = "doc_id long, text string, lang string, score string"


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def word_row(word, model):
    """(letters, score per language) of one word."""
    runs, now = [], []
    for c in [*word.lower(), " "]:
        if c.isalpha():
            now.append(ord(c))
        elif now:
            runs.append(now)
            now = []
    score = np.zeros(len(model["langs"]))
    for run in runs:
        marked = [0, *run, 0]
        for n in langid.SIZES:
            source = run if n == 1 else marked
            for i in range(len(source) - n + 1):
                score += model["logs"][mix((n + sum((p + 1) * int(w._PLACE[k]) for k, p in enumerate(source[i : i + n]))) & MASK) >> 64 - langid.BITS]
    points = np.array([p for run in runs for p in run], np.uint64)
    for s in set(langid._scripts(points).tolist()) if len(points) else ():
        able = model["uses"][:, s]
        if able.any():
            score[~able] -= 2 * langid.PENALTY
        else:
            score[:] = 0
    return len(points), score


def best_value(table):
    """The greatest sum over all paths, less the penalty for each change."""
    value = np.zeros(table.shape[1])
    for t, row in enumerate(table):
        value = (np.maximum(value, value.max() - langid.PENALTY) if t else value) + row
    return value.max()


def test_predictions(spark):
    rng = random.Random(3)
    words = {"en": "the of and with this that mind river".split(), "fr": "le la des que dans une été rivière".split(), "ru": "и в не на что река мысль".split()}
    make = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice(["", "", ",", "."]) for _ in range(n))
    data = [(i, make(lang := ["en", "fr", "ru"][i % 3], rng.randrange(5, 40)), lang) for i in range(120)]
    mixed = [(200 + i, "\n".join(make(rng.choice(["en", "fr", "ru"]), rng.randrange(1, 12)) for _ in range(4)), None) for i in range(40)]
    odd = [(300, None, "en"), (301, "", None), (302, "12 !? --", None), (303, "日本 the", None), (304, "THE é12x μ", None), (305, "the " * 4000 + "что " * 3000, None)]
    df = spark.createDataFrame([(*d, "s") for d in data + mixed + odd], SCHEMA)
    model = langid.trained(df)
    assert model["langs"] == ["en", "fr", "ru"]
    got = {r["doc_id"]: r for r in langid.label_spans(df, model).collect()}
    for d, text, _ in data + mixed + odd:
        r = got[d]
        rows = [word_row(x, model) for x in (text or "").split()]
        if not sum(n for n, _ in rows):
            assert (r["lang_pred"], r["score"], r["spans"]) == ("und", 0.0, [])
            continue
        table, length = np.array([s for _, s in rows]), np.array([n for n, _ in rows])
        path = np.concatenate([np.full(s["end"] - s["first"], model["langs"].index(s["lang"])) for s in r["spans"]])
        assert len(path) == len(rows) and r["spans"][0]["first"] == 0
        value = table[np.arange(len(path)), path].sum() - langid.PENALTY * np.count_nonzero(np.diff(path))
        assert value >= best_value(table) - 0.02  # single precision against double
        share = np.bincount(path, length, 3)
        assert r["lang_pred"] == model["langs"][int(share.argmax())] and 0 < r["score"] <= 1
    assert [s["lang"] for s in got[305]["spans"]] == ["en", "ru"] and all(got[d]["lang_pred"] == lang for d, _, lang in data)
    assert langid.label_spans(df, langid.fit(df.limit(0).select("doc_id", "text", "lang"))).filter("lang_pred <> 'und'").count() == 0
