import random

import pytest
from pyspark.sql import functions as F

from seamwright.operators import charts, enrich, fields, filters, insights, tokens, topics


def test_letter_tokens_and_stop(spark):
    df = spark.createDataFrame([(1, "Hands-on, AI in 3D!"), (2, None), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["token"] for r in tokens.positions(df).groupBy("doc_id").agg(F.sort_array(F.collect_list("token")).alias("token")).collect()}
    assert got == {1: ["ai", "hands"]}


def test_position_cap_counts_leading_empty(spark):
    df = spark.createDataFrame([(1, " one two three")], "doc_id long, text string")
    assert [r["token"] for r in tokens.positions(df, limit=2).collect()] == ["one"]


def test_consolidation(spark):
    f = spark.createDataFrame([("word", 9), ("words", 8), ("classes", 7), ("class", 6), ("motiv", 5), ("bus", 4), ("boss", 3), ("activ", 2)], "token string, corpus_freq long")
    got = {r["token"]: (r["flag_type"], r["replacement"]) for r in tokens.consolidation_candidates(f, 7, {"bus": "buses", "activ": "active"}).collect()}
    assert got == {"word": ("", ""), "words": ("", "word"), "classes": ("", "class"), "class": ("", ""), "motiv": ("truncation", ""), "bus": ("", "buses"), "boss": ("", "")}


def test_map_is_one_pass(spark):
    df = spark.createDataFrame([(["a", "b", "c"],)], "t array<string>")
    m = F.create_map(F.lit("a"), F.lit("b"), F.lit("b"), F.lit("x"))
    assert df.select(tokens.apply_map(F.col("t"), m)).first()[0] == ["b", "x", "c"]


def test_filters(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 7), (3, "b", None)], "id int, g string, v int")
    assert [r["id"] for r in filters.apply_filters(df, [{"field": "g", "op": "in", "values": ["a", "b"]}, {"field": "v", "op": "range", "min": 5}]).collect()] == [1]
    assert filters.apply_filters(df, []).count() == 3
    assert [r["id"] for r in filters.apply_filters(df, [{"field": "g", "op": "is_null"}]).collect()] == [2]
    assert filters.exclude_groups(df, "g", ["a"]).count() == 2
    with pytest.raises(ValueError):
        filters.apply_filters(df, [], "or")
    for bad in ({"field": "zz", "op": "eq", "value": 1}, {"field": "g", "op": "like"}, {"field": "v", "op": "range"}, {"field": "g", "op": "in", "values": []}):
        with pytest.raises(ValueError):
            filters.validate(df, [bad])
    s = filters.summary(df, [{"field": "v", "op": "not_null"}]).first()
    assert (s["rows_in"], s["rows_out"], s["rows_dropped"]) == (3, 2, 1)


def test_fiscal(spark):
    df = spark.createDataFrame([("2023-06-30",), ("2023-07-01",), (None,)], "d string").select(F.to_date("d").alias("d"))
    assert [tuple(r) for r in df.select(fields.fiscal_year(F.col("d")), fields.fiscal_half(F.col("d"))).collect()] == [("FY23", "H2"), ("FY24", "H1"), (None, None)]


def test_waterfall(spark):
    df = spark.createDataFrame([(["x", "__b__", "__a__"],), (["x"],)], "t array<string>")
    assert [r[0] for r in df.select(fields.token_waterfall(F.col("t"), ["__a__", "__b__"])).collect()] == ["a", "__NA__"]


def test_injection_appends_only(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"])], "doc_id long, tokens array<string>")
    lk = spark.createDataFrame([("b", "__y__"), ("a", "__x__"), ("a", "b")], "term string, injected string")
    got = {r["doc_id"]: r["tokens"] for r in enrich.inject(df, lk).collect()}
    assert got == {1: ["a", "b", "__x__", "__y__"], 2: ["c"]}


def test_bridge_bounds(spark):
    df = spark.createDataFrame([("g", 1, 0, 0.3), ("g", 1, 1, 0.7), ("g", 2, 0, 0.0)], "grp string, p long, topic int, w double")
    got = topics.bridge(df, "grp", "p", "topic", "w", 0.3).collect()
    assert sorted((r["p"], r["topic"]) for r in got) == [(1, 0), (1, 1)]


def greedy(n, edges):
    """One row after another: what it duplicates among the kept, the best first."""
    kept, out = [], {}
    for x in range(n):
        hit = next((y for y in kept if (y, x) in edges), None)
        if hit is None:
            kept.append(x)
        else:
            out[x] = hit
    return out


@pytest.mark.parametrize(("n", "m", "seed"), [(3, 2, 0), (40, 60, 1), (200, 900, 2), (60, 59, None)])
def test_dropped_equals_the_sequential_rule(spark, n, m, seed):
    rng = random.Random(seed)
    edges = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)} if seed is not None else {(k, k + 1) for k in range(20)}  # a chain: many rounds
    ranked = spark.createDataFrame([(f"i{(k * 7) % n if seed is None else k:04d}", k) for k in range(n)], "insight_id string, place long")
    name = {r["place"]: r["insight_id"] for r in ranked.collect()}
    pairs = spark.createDataFrame([(min(name[a], name[b]), max(name[a], name[b])) for a, b in edges], "insight_id_a string, insight_id_b string")
    got = {(r[0], r[1]) for r in insights.dropped(ranked, pairs).collect()}
    assert got == {(name[x], name[y]) for x, y in greedy(n, edges).items()}


def test_dedupe_by_all_three_overlaps(spark):
    rows = [("a", 0.9), ("b", 0.8), ("c", 0.7), ("d", 0.7)]
    df = spark.createDataFrame(rows, "insight_id string, mean_share double")
    pairs = spark.createDataFrame([("a", "b", 0.6, 0.6, 0.55), ("b", "c", 0.8, 0.0, 0.0), ("a", "d", 0.59, 1.0, 1.0)], "insight_id_a string, insight_id_b string, topics_overlap double, title_overlap double, words_overlap double")
    stay, audit = insights.dedupe(df, insights.duplicates(pairs), [F.desc("mean_share"), F.asc("insight_id")])
    assert sorted(r[0] for r in stay.select("insight_id").collect()) == ["a", "c", "d"]
    assert [(r["dropped_insight_id"], r["matched_kept_insight_id"], r["topics_overlap"]) for r in audit.collect()] == [("b", "a", 0.6)]


def test_rule():
    assert topics.n_components(1000, 1000, 15) == 15 and topics.n_components(10_000, 10_000, 25) == 25
    assert topics.n_components(10, 10, 15) == 4 and topics.n_components(1000, 1000, 15, small=True) == 8


def test_tvd_one_sided(spark):
    a = spark.createDataFrame([("x", 1.0)], "category string, pct double")
    b = spark.createDataFrame([("y", 1.0)], "category string, pct double")
    assert charts.total_variation(a, b).first()[0] == 1.0


def test_bins(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.1,), (99.0,)], "v double")
    assert [r[0] for r in df.select(charts.fixed_bin(F.col("v"), [0.0, 10.0, 20.0])).collect()] == [0, 0, 1, None]
