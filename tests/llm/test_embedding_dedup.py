"""Filters and blocks against all cosines; recall at the threshold."""

import random

import numpy as np
import pytest

from seamwright.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<double>, rep int, copies string"


def brute(rows):
    def valid(d, v):
        return d is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    units = [embedding_dedup.scaled(np.array([v], float))[0] if valid(d, v) else None for d, v in rows]
    n, parent, links = len(rows), list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if units[i] is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, links[i], least[root(i)] if units[i] is not None else d, d == (least[root(i)] if units[i] is not None else d) and d is not None or (d is None)) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize(("block", "head"), [(1024, 32_768), (5, 12)])
def test_rows(spark, monkeypatch, block, head):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "HEAD", head)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((12, 16))
    rows = [(k, (base[k % 12] + 0.12 * rng.standard_normal(16)).tolist()) for k in range(90)]
    rows += [(k, base[0].tolist()) for k in (200, 201, 202)] + [(200, base[1].tolist()), (200, base[0].tolist())]  # copies, and one id on two vectors
    rows += [(300, (base[2] * 1e200).tolist()), (301, (base[2] * 1e-200).tolist()), (302, (base[2] * 1e307).tolist())]
    rows += [(400, [0.0] * 16), (401, [-0.0] * 15 + [1.0]), (402, [0.0] * 15 + [1.0]), (403, None), (404, []), (405, [None] + [1.0] * 15), (406, [float("nan")] * 16), (407, [float("inf")] * 16), (408, [1.0, 2.0]), (409, [1.0, 2.1]), (None, base[0].tolist())]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(d, v, 1, "x") for d, v in rows], SCHEMA)
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    assert got == brute(rows)


def test_recall_at_the_threshold():
    for dim, n in ((64, 50_000), (32, 2_000_000), (16, 500)):
        size, blocks, cap = embedding_dedup.settings(n, dim)
        code = embedding_dedup.ProductCode(dim, size, blocks)
        rng = np.random.default_rng(dim)
        a = embedding_dedup.scaled(rng.standard_normal((400, dim)))
        b = rng.standard_normal((400, dim))
        b = embedding_dedup.scaled(b - (a * b).sum(1, keepdims=True) * a)
        b = 0.9 * a + np.sqrt(1 - 0.81) * b
        lists = [code.decode(x, cap) for x in (a, b)]
        assert np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(*lists, strict=True)]) >= 0.97
    assert len(set(map(tuple, code.codes[0].round(6).tolist()))) == size


def test_list_decoding_is_complete():
    code = embedding_dedup.ProductCode(12, 9, 3)
    unit = embedding_dedup.scaled(np.random.default_rng(4).standard_normal((20, 12)))
    p = code.products(unit)
    for r, found in enumerate(code.decode(unit, 0.7)):
        total = p[0][r][:, None, None] + p[1][r][None, :, None] + p[2][r][None, None, :]
        assert found.tolist() == np.flatnonzero(total.ravel() >= 0.7 * total.max() - 1e-12).tolist()
