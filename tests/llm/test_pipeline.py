"""The pipeline's rows against each stage done in Python; odd tables."""

import hashlib
import random
import re

import sentencepiece

import corpus_pipeline
from seamwright.llm import langid, mixing, sp_codec
from seamwright.llm import words as w

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = r"[\x20\x09-\x0D]+"


def rows():
    rng = random.Random(14)
    words = {"en": [f"the{c}ing" for c in "abcdefgh"] + "the of and with this that".split(), "fr": [f"le{c}que" for c in "abcdefgh"] + "le la des que dans une".split()}
    make = lambda i, n: " ".join(f"{rng.choice(words[['en', 'fr'][i % 2]])}" for _ in range(n))
    out = [(i, make(i, rng.randrange(30, 90)), ["en", "fr"][i % 2], ["a", "b", "b", None][i % 4], 1) for i in range(90)]
    for i in range(0, 24, 3):
        own = out[i][1].split()
        out += [(100 + i, "\n".join(own), None, "c", 1), (200 + i, " ".join([*own[:9], "new", *own[10:]]), None, "a", 1), (i, " ".join([*own, "more"]), None, "b", 1)]
    return out + [(300, None, None, "a", 0), (301, "", "en", "a", 0), (302, "12 34", "en", None, 0), (None, out[2][1], "en", "a", 0), (None, make(0, 50), "en", "b", 0), out[40]]


def shingles(text, k=5):
    x = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(x[i : i + min(k, len(x))]) for i in range(max(1, len(x) - k + 1))} if x else set()


def brute(docs, model):
    cache = w.WordCache(lambda some: langid.word_scores(some, model))
    kept = [d for d in docs if (f := langid.identify(d[1] and d[1].encode(), model, cache))[0] != "und" and f[1] >= 0.3]
    best = {}
    for d in kept:
        key = re.sub(SPACE, " ", d[1])
        best[key] = min(best.get(key, d), d, key=lambda x: (x[0] is None, x[0] or 0))
    kept, seen = [], set()
    for d in docs:  # one row for each text
        key = re.sub(SPACE, " ", d[1] or "")
        if d in best.values() and key not in seen and best[key] == d:
            seen.add(key)
            kept.append(d)
    sets = [shingles(d[1]) for d in kept]
    group = list(range(len(kept)))
    for i, a in enumerate(sets):
        for j in range(i):
            if kept[i][0] is not None and kept[j][0] is not None and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    rank = lambda i: (kept[i][0] or 0, hashlib.md5(kept[i][1].encode()).digest())
    kept = [d for i, d in enumerate(kept) if d[0] is None or rank(i) == min(rank(j) for j in range(len(kept)) if group[j] == group[i])]
    size = lambda d: len(re.findall(r"[^\x20\x09-\x0D]+", d[1]))
    sources = sorted({d[3] for d in kept}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(d) for d in kept if d[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    held = set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in held)
        free = sum(weight[s] for s in sources if s not in held)
        more = {s for s in sources if s not in held and 3 * total[s] * free <= weight[s] * rest}
        if not more:
            break
        held |= more
    target = {s: 3.0 * total[s] if s in held else weight[s] * rest / free for s in sources}

    def copies(d, seed):
        rate = target[d[3]] / total[d[3]]
        coin = int(hashlib.md5(f"{seed}:{'' if d[0] is None else d[0]}".encode()).hexdigest()[:13], 16) / float(1 << 52)
        return int(rate) + (coin < rate - int(rate))

    seed = {s: min(range(mixing.TRIES), key=lambda k: (abs(sum(copies(d, k) * size(d) for d in kept if d[3] == s) - target[s]), k)) for s in sources}
    sp = sentencepiece.SentencePieceProcessor(model_file=sp_codec.default_path())
    return sorted(((d[0], d[2], d[3], *sp.encode(d[1])) for d in kept for _ in range(copies(d, seed[d[3]]))), key=str)


def test_rows(spark, tmp_path):
    docs = rows()
    df = spark.createDataFrame(docs, SCHEMA)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = sorted(((r["doc_id"], r["lang"], r["source"], *r["ids"]) for r in out.collect()), key=str)
    want = brute(docs, langid.trained(df))
    assert got == want and 40 < len(want)
    assert all(r["misses"] == 0 and r["n_ids"] == len(r["ids"]) for r in out.collect())


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
