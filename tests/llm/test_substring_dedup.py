"""Lines, sentences and passages against a walk through the words in Python."""

import random
import re

import numpy as np
import xxhash

from seamwright.llm import substring_dedup

SCHEMA = "doc_id long, text string, _cut string, first int"


def units(text, least):
    """(first word, end word, normalised words) of lines and sentences, and the words' places."""
    words = [(m.start(), m.end(), m[0].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
    line = [text.count("\n", 0, a) for a, _, _ in words]
    found, n = set(), len(words)
    for i in range(n):
        for whole in (True, False):
            cut = lambda k: k in (0, n) or line[k] != line[k - 1] or (not whole and words[k - 1][2][-1] in ".!?")  # noqa: B023, E731
            if cut(i):
                j = next(k for k in range(i + 1, n + 1) if cut(k))
                if whole or j - i >= least:
                    found.add((i, j, " ".join(w for _, _, w in words[i:j])))
    return sorted(found), words


def keys(doc_id, text):
    """What a document is known by, in order of rank."""
    k = xxhash.xxh64(text.encode(), seed=42).intdigest()
    a = xxhash.xxh64(text.encode(), seed=xxhash.xxh64(np.int32(1).tobytes(), seed=42).intdigest()).intdigest()
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return doc_id is None, signed(a) if doc_id is None else doc_id, signed(k), text


def brute(rows, least, least_run):
    """Spans of all documents, and what the text of each is without them."""
    docs, left = sorted({keys(d, t or "") for d, t in rows}), {}
    owner, out = {}, []
    for doc in docs:
        for _, _, u in units(doc[3], least)[0]:
            owner.setdefault(u, doc)
    for doc in docs:
        found, words = units(doc[3], least)
        first_end, marked = {}, []
        for i, j, u in found:
            if owner[u] != doc or i >= first_end.setdefault(u, j):
                marked.append((i, j, u))
        spans, upto = [], -1
        for i, j, u in marked:
            if i > upto:
                spans.append([])
            spans[-1].append((i, j, u))
            upto = max(upto, j)
        left[doc] = doc[3]
        for s in spans[::-1]:
            held = {k for i, j, _ in s for k in range(i, j)}
            keep = min((owner[u][1] for _, _, u in s if not owner[u][0]), default=None)
            if len(held) >= least_run:
                left[doc] = left[doc][: words[min(held)][0]] + left[doc][words[max(held)][1] :]
                out.append((None if doc[0] else doc[1], words[min(held)][0], words[max(held)][1], len(held), len(s), keep))
    return sorted(out, key=str), left


def table(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)


def corpus():
    rng = random.Random(4)
    lines = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice([1, 2, 4, 9]))) + rng.choice(["", ".", "!"]) for _ in range(30)]
    rows = []
    for k in range(40):
        text = rng.choice(["\n", " "]).join(rng.choice([x, x.upper(), x.replace(" ", "\t ")]) for x in rng.choices(lines, k=rng.choice([1, 3, 8])))
        rows.append((rng.choice([k, k, 7, None]), text if rng.random() < 0.9 else "é " + text + " 😀"))
    return rows + rows[:6] + [(90, None), (91, ""), (None, None), (92, " \n ")]


def test_lines_and_sentences(spark):
    rows = corpus()
    df = table(spark, rows)
    for least_run in (0, 4):
        spans = substring_dedup.removals(df, least_run=least_run, passage=0)
        want, left = brute(rows, substring_dedup.LEAST_WORDS, least_run)
        assert sorted((tuple(r)[:6] for r in spans.collect()), key=str) == want
    got = substring_dedup.cleaned(df, spans)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((d, t and left[keys(d, t)], "x", 1) for d, t in rows), key=str)


def test_null_ids_keep_what_repeats_nothing(spark):
    rng = random.Random(9)
    words = lambda n: " ".join(f"v{rng.randrange(9999)}" for _ in range(n))
    passage, own, other = words(60), words(50), words(50)
    rows = [(None, passage), (None, f"{own}\n{passage}\n{other}"), (4, f"{words(20)}\n{passage}"), (4, words(30))]
    df = table(spark, rows)
    texts = {r["text"] for r in substring_dedup.cleaned(df, substring_dedup.removals(df)).collect()}
    assert texts == {"", f"{own}\n\n{other}", rows[2][1], rows[3][1]}


def test_passages_inside_lines(spark):
    rng = random.Random(12)
    words = lambda n: [f"u{rng.randrange(5000)}" for _ in range(n)]
    rows, shared = [], [words(n) for n in (35, 60, 200)]
    for k in range(30):
        rows.append((k, " ".join(words(rng.randrange(5, 60)) + rng.choice(shared) + words(rng.randrange(5, 60)))))
    least = substring_dedup.PASSAGE + substring_dedup.WINDOW - 1
    cut = {d: set() for d, _ in rows}
    for r in substring_dedup.removals(table(spark, rows)).collect():
        cut[r["doc_id"]] |= set(range(r["start"], r["end"]))
    seen = set()
    for d, text in rows:
        places = [(m.start(), m[0]) for m in re.finditer(r"\S+", text)]
        run = [w for _, w in places]
        old = [k for k in range(len(run) - least + 1) if tuple(run[k : k + least]) in seen]
        covered = {j for k in old for j in range(k, k + least)}
        gone = {j for j, (a, _) in enumerate(places) if a in cut[d]}
        assert gone <= covered  # nothing that repeats nothing leaves
        assert all(gone & set(range(k, k + least)) for k in old) and len(covered) - len(gone) <= 2 * (substring_dedup.WINDOW - 1)
        seen |= {tuple(run[k : k + least]) for k in range(len(run) - least + 1)}
    assert any(cut.values())


def test_digests_of_lines_that_cancel(spark):
    t = ["ab"[bin(i).count("1") & 1] for i in range(1024)]
    u = ["ba"["ab".index(c)] for c in t]
    assert substring_dedup.removals(table(spark, [(1, " ".join(t)), (2, " ".join(u))]), passage=0).collect() == []
    assert substring_dedup.removals(table(spark, [])).collect() == []
