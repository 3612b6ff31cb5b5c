import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seamwright.llm import resampling as rs

SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def buckets(text):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target):
    have, want = Counter(), Counter()
    for _, t in docs:
        have.update(buckets(t))
    for t in target:
        want.update(buckets(t))
    total, goal = have.total(), want.total()
    gain = {b: math.floor(1000 * math.log((want[b] + 1) * (total + 10_000) / ((have[b] + 1) * (goal + 10_000)))) for b in have}
    rows = []
    for i, t in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        own = buckets(t)
        weight = sum(gain[b] for b in own)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(t))])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: 5 * len(fit) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def made(seed, n):
    rng = random.Random(seed)
    parts = ["a", "B", "é", "漢字", "7", "Z9", "x" * 70, "y" * 300, "Q" * 64, "q" * 63, "the", "The", "of"]
    gaps = [" ", "\n", "-", ".", "\x00", "  ", "_", "`"]
    return ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("chunk", [1 << 21, 200, 50])
def test_features_of_texts_and_their_pieces(monkeypatch, chunk):
    monkeypatch.setattr(rs, "_CHUNK", chunk)
    texts = [*made(1, 300), None, "", " ", "a", "A b", "a-b c"]
    found, counted = [[] for _ in texts], np.zeros(len(texts), int)
    for grams, own, first in rs.features([None if t is None else t.encode() for t in texts]):
        counted[first : first + len(own)] += own
        for bucket, doc in grams:
            for b, d in zip(bucket.tolist(), doc.tolist(), strict=True):
                found[d].append(b)
    assert [sorted(f) for f in found] == [sorted(buckets(t)) for t in texts]
    assert counted.tolist() == [len(words(t)) for t in texts]


def test_shift_is_the_crc_of_what_follows():
    rng = random.Random(2)
    for size in [0, 1, 2, 31, 63, 64, 65, 127, 128, 1000, 70_001]:
        a, b = rng.randbytes(9), rng.randbytes(size)
        joined = rs.shift(np.array([zlib.crc32(a)], np.uint32), np.array([size]))[0] ^ np.uint32(zlib.crc32(b))
        assert joined == zlib.crc32(a + b)


def test_against_brute_force(spark):
    docs = list(enumerate(made(3, 400))) + [(400, None), (401, ""), (None, made(4, 9)[-1]), (5, "again " * 30), (6, made(3, 7)[6])]
    target = made(9, 30) + [None, ""]
    got = rs.ranked(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(i, t) for i, t in enumerate(target)], SCHEMA))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target)


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    docs = [(i, "word " * 25) for i in range(40)]
    df = spark.createDataFrame(docs, SCHEMA)
    assert rs.ranked(none, df).collect() == []
    assert sorted(map(tuple, rs.ranked(df, none).collect()), key=str) == brute(docs, [])  # ties but for the lot
    long = [(1, "ab " * 1_500_000), (2, "z" * 3_000_000 + " end")]
    assert sorted(map(tuple, rs.ranked(spark.createDataFrame(long, SCHEMA), df).collect()), key=str) == brute(long, [t for _, t in docs])


def test_resampled_keeps_rows_whole_and_follows_the_target(spark):
    docs = [(i, " ".join(f"{'blue' if i % 10 == 0 else 'red'}{k % 7}" for k in range(40)), i * 2, "x") for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score long, digest string")
    target = spark.createDataFrame([(0, " ".join(f"blue{k % 7}" for k in range(90)))], SCHEMA)
    won = rs.resampled(df, target)
    assert won.columns == df.columns and won.count() == 20
    assert won.filter(F.col("doc_id") % 10 != 0).count() == 0
