import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from seamwright.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """{(depth, turns): (conv_id, parent conv_id, n_convs, n_children, n_leaves, saved, sha)} as a sorted list."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, pt_symbol(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {c: own.get(c - c % 20, [])[: (h := zlib.crc32(str(c).encode()) % 4)] + v[h:] for c, v in own.items()}
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append((c, len(turns) == d))
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in nodes) for q in below)
        saved = sum((len(nodes[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        children = sum(len(q) == len(p) + 1 for q in below)
        ends = ",".join(map(str, sorted(c for c, end in members if end)))
        out.append((min(c for c, _ in members), len(p), min(c for c, _ in nodes[p[:-1]]) if p else None, len(members), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def pt_symbol(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32] + f"{len(re.findall(r'[^\x20\x09-\x0D]+', text)):08X}"


def made(seed, n, longest=6):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 3 * n), n):
        for t in range(rng.randint(1, longest)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a b", "a", "", None, "x  y\tz"])))
    return rows


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    out = pt.trie(pt.rebuilt(df), **options).drop("turn")
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize(("ranges", "fan"), [(1, 2), (2, 2), (9, 2), (40, 3), (40, 512)])
def test_against_brute_force(spark, ranges, fan):
    rows = made(ranges, 70)
    assert got(spark, rows, ranges=ranges, fan=fan) == brute(rows)


def test_a_hot_conversation_and_a_long_one_over_many_ranges(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 1200, 20) for t in range(3)]
    rows += [(7000, t, "user", f"long {t % 5}") for t in range(300)] + [(7020, t, "user", f"long {t % 5}") for t in range(150)]
    rows += [(9999, t, "user", f"turn {t}") for t in range(2)]  # nothing of its own when h > 1, and no base
    small = rows[:180] + rows[-2:]
    assert got(spark, small, ranges=16, fan=2) == brute(small)
    whole = got(spark, rows, ranges=16, fan=4)
    assert whole == got(spark, rows, ranges=1)
    root = next(r for r in whole if r[1] == 0)
    assert root[:5] == (0, 0, None, 63, root[4]) and max(r[1] for r in whole) == 300


def test_edges(spark):
    assert got(spark, []) == []
    rows = [(1, 0, None, None), (None, 0, "user", "lost"), (1, 0, None, None), (1, 0, "", ""), (5, None, "user", "w " * 100_000)]
    assert got(spark, rows, ranges=2) == brute(rows)
    df = spark.createDataFrame([(*r, "u", b"s", 3) for r in made(5, 12)], SCHEMA + ", seq string, digits binary, range int")
    assert sorted(map(tuple, pt.trie(pt.rebuilt(df)).drop("turn").collect()), key=str) == brute(made(5, 12))


def test_turns_name_the_nodes(spark):
    rows = made(3, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    nodes = pt.trie(pt.rebuilt(df))
    named = nodes.filter("depth > 0").join(pt.turns(df), "turn")
    assert named.count() == nodes.filter("depth > 0").count()
    assert nodes.filter("depth = 0").select(F.col("turn").isNull()).first()[0]


def test_loser_tree_gives_the_sorted_sequence_with_its_lcps():
    rng = random.Random(1)
    symbols = [bytes([i]) * pt.WIDTH for i in range(3)]
    for k in (1, 2, 3, 5, 8):
        items = [(b"".join(rng.choice(symbols) for _ in range(rng.randint(0, 6))), c) for c in range(60)]
        runs = [pt.Run(*pt.packed(sorted(items[i::k]))) for i in range(k)]
        out = list(pt.merged(runs))
        assert [(s, c) for _, s, c in out] == sorted(items)
        before = b""
        for lcp, seq, _ in out:
            assert lcp == pt.common(before, seq, 0)
            before = seq
