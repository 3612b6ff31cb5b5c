import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seamwright.operators import enrich, tokens


def lists(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(30)]
    return [(i, [words[min(int(rng.expovariate(0.25)), 29)] for _ in range(rng.choice([0, 1, 2, 3, 12]))]) for i in range(n)]


def brute(rows, sizes, min_df, share):
    seen, every = Counter(), Counter()
    for _, t in rows:
        grams = [(n, " ".join(t[i : i + n])) for n in sizes for i in range(len(t) - n + 1)]
        every.update(grams)
        seen.update(set(grams))
    return sorted((n, term, d, every[n, term]) for (n, term), d in seen.items() if min_df <= d <= share * len(rows))


@pytest.mark.parametrize(("sizes", "min_df", "bits"), [((1, 2, 3), 4, 1 << 23), ((3,), 3, 1 << 23), ((2, 4), 2, 1 << 23), ((1, 2, 3), 4, 64)])
def test_levels_equal_all_ngrams(spark, monkeypatch, sizes, min_df, bits):
    monkeypatch.setattr(tokens, "FILTER_BITS", bits)  # with 64 bits nearly all pass, and the counts are the same
    rows = lists(len(sizes))
    got = tokens.ngram_vocabulary(spark.createDataFrame(rows, "doc_id long, tokens array<string>"), sizes, min_df, 0.5)
    assert sorted((r["n"], r["term"], r["doc_freq"], r["corpus_freq"]) for r in got.collect()) == brute(rows, sizes, min_df, 0.5)


def test_rare_ngrams_are_not_counted(spark):
    rows = [(i, ["a", "b", f"x{i}", "a", "b"]) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    common = tokens.ngram_counts(df, 1).filter("doc_freq >= 8").select("term")
    assert tokens.ngram_counts(df, 2).count() == 101
    assert [tuple(r) for r in tokens.ngram_counts(df, 2, common).collect()] == [("a b", 50, 100)]
    assert tokens.ngram_vocabulary(df.limit(0)).collect() == []


def test_inject_finds_each_phrase_where_it_starts(spark):
    rng = random.Random(4)
    docs = [(i, [rng.choice("abcd") for _ in range(rng.randint(0, 12))]) for i in range(60)]
    terms = [(" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 4))), f"__{rng.randint(0, 5)}__") for _ in range(25)] + [("a", None), (None, "__n__")]
    want = {}
    for i, t in docs:
        first = {}
        for term, token in terms:
            p = term.split(" ") if term else []
            if token and 1 <= len(p) <= 3:
                for at in range(len(t) - len(p) + 1):
                    if t[at : at + len(p)] == p:
                        first[token] = min(first.get(token, at), at)
        want[i] = t + [x for _, x in sorted((at, x) for x, at in first.items()) if x not in t]
    df, lk = spark.createDataFrame(docs, "doc_id long, tokens array<string>"), spark.createDataFrame(terms, "term string, injected string")
    for least in ("10485760", "-1"):  # by broadcast, by shuffle
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
        assert {r["doc_id"]: r["tokens"] for r in enrich.inject(df, lk).collect()} == want
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert enrich.inject(df, lk.limit(0)).filter(F.size("tokens") > 12).count() == 0


def test_each_level_is_counted_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(i, ["a", "b", "c", f"x{i}"]) for i in range(40)], "doc_id long, tokens array<string>")
    got = tokens.ngram_vocabulary(df.mapInArrow(count, df.schema), max_share=1.0)
    assert sorted(r["term"] for r in got.collect()) == ["a", "a b", "a b c", "b", "b c", "c"]
    assert seen.value <= 4 * 40  # three levels and the number of documents


def test_texts_are_cut_as_lists_are(spark):
    texts = ["The AI, the\tAir", None, "", "ai", "a-i b c", "Ünï çode ÄBCÉ abcd", "x1y2 ABC\x00def  ", "ß ſ K İstanbul ai", "no ai-no"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lists, cut = tokens.token_arrays(docs), tokens.token_texts(docs)
    assert sorted(r[0] for r in lists.select("doc_id").collect()) == sorted(r[0] for r in cut.select("doc_id").collect())
    for n in (1, 2, 3):
        assert sorted(map(tuple, tokens.ngram_counts(lists, n).collect())) == sorted(map(tuple, tokens.ngram_counts(cut, n).collect()))


def test_counts_of_repeated_keys(spark):
    docs = spark.createDataFrame([(1, "the end the"), (1, "end AI"), (2, None), (None, "one ONE"), (None, "two"), (3, "")], "doc_id long, text string")
    want = tokens.positions(docs).groupBy("doc_id", "token").agg(F.count("*").alias("tf"))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, tokens.counted(docs).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
