import json

from pyspark.sql import functions as F

from seamwright.operators import charts, enrich, insights, labels, tokens


def test_candidates_and_checks(spark):
    item = "struct<title: string>"
    df = spark.createDataFrame([([("a",), ("b",)], [("g2", [("c",)]), ("g1", [("d",), ("e",)])])], f"key_insights array<{item}>, by_group array<struct<key: string, value: array<{item}>>>")
    got = [(r["insight_id"], r["category_bucket"], r["insight"]["title"]) for r in insights.candidates(df).collect()]
    assert got == [("KI_001", None, "a"), ("KI_002", None, "b"), ("BG_001", "g2", "c"), ("BG_002", "g1", "d"), ("BG_003", "g1", "e")]
    text = "title string, finding string, evidence_basis string, scope_or_caveat string, why_it_matters string, source_topics array<struct<group: string, topic_id: double>>"
    rows = [(" t ", "f", "e", "s", None, [("g", 1.0), (" g", 1.0), ("x", 2.0), ("g", None)]), ("t", "", None, "s", "w", None)]
    a, b = insights.normalized(spark.createDataFrame(rows, text), ["g"]).collect()
    assert a["title"] == "t" and a["problem"] is None and [tuple(s) for s in a["source_topics"]] == [("g", 1)] and len(a["source_topics_claimed"]) == 4
    assert b["problem"] == "missing finding, evidence_basis" and b["source_topics"] == []


def scored(spark, rows):
    df = spark.createDataFrame(rows, "insight_id string, supporting_projects long, n_topics long, n_claimed long, flags array<string>, mean_share double")
    return insights.confidence(df, 40.0, 4.0, 0.5, 70, 40)


def test_confidence(spark):
    a, b = scored(spark, [("a", 50, 2, 4, ["coherent", "mixed"], 0.4), ("b", 0, 0, 0, None, None)]).collect()
    assert (a["volume_score"], a["breadth_score"], a["quality_score"], a["bridge_score"], a["cleanliness_score"]) == (100.0, 50.0, 80.0, 80.0, 25.0)
    assert a["confidence_score"] == round(30 + 5 + 16 + 20 + 3.75, 1) and a["confidence_band"] == "high"
    assert b["confidence_score"] == 0.0 and b["confidence_band"] == "low"


def test_tiers(spark):
    df = scored(spark, [("top", 50, 2, 2, ["coherent", "coherent"], 0.5), ("struck", 50, 0, 2, [], 0.5), ("few", 1, 1, 1, ["coherent"], 0.5), ("early", 50, 2, 2, ["coherent"], 0.5)])
    df = df.withColumn("early_rejected_reason_code", F.when(F.col("insight_id") == "early", "duplicate"))
    rule = {"confidence": 60, "projects": 20, "quality": 50, "bridge": 50}
    got = {r["insight_id"]: (r["tier"], r["rejected_reason_code"]) for r in insights.tiers(df, {**rule, "topics": 2}, rule, rule).collect()}
    assert got == {"top": ("top", None), "struck": ("rejected", "verification_failed"), "few": ("rejected", "low_support"), "early": ("rejected", "duplicate")}


def test_topline_and_nested(spark):
    schema = "insight_id string, section string, category_bucket string, title string, supporting_projects long, n_topics long, mean_share double, verification_ratio double"
    rows = [(f"K{i}", insights.KEY, None, f"t{i}", 10 - i, 1, 0.5, 1.0 if i else 0.1) for i in range(4)]
    rows += [("B1", "by_group", "g", "x", 5, 1, 0.5, 1.0), ("B2", "by_group", "g", "y", 5, 1, 0.5, 1.0), ("B3", "by_group", "f", "z", 1, 1, 0.5, 0.2), ("B4", "by_group", None, "z", 1, 1, 0.5, 1.0)]
    top = insights.topline(spark.createDataFrame(rows, schema), 2, 0.75)
    got = {r["insight_id"]: (r["report_section"], r["report_order"]) for r in top.collect()}
    assert got == {
        "K1": ("main_cross", 1), "K2": ("main_cross", 2), "K0": ("appendix_cross", 1), "K3": ("appendix_cross", 2), "B1": ("main_by_group", 1),
        "B2": ("appendix_by_group", 1), "B3": ("appendix_by_group", 1), "B4": ("appendix_by_group", 1),
    }
    doc = json.loads(insights.nested(top).first()["document"])
    assert [x["insight_id"] for x in doc[insights.KEY]] == ["K0", "K3", "K1", "K2"] and [x["insight_id"] for x in doc["by_group"]["g"]] == ["B2", "B1"]
    assert json.loads(insights.nested(top.filter("section = 'by_group'")).first()["document"]).get(insights.KEY, []) == []


def test_pairs_meet_once(spark):
    rows = [(i, "b", [i % 3, i % 2], ["t", f"u{i % 4}"], [f"w{i % 5}", None] if i % 7 else None) for i in range(30)]
    df = spark.createDataFrame(rows, "insight_id int, bucket string, topics array<int>, title array<string>, words array<string>")
    got = insights.screened_pairs(df, "bucket").collect()
    jac = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if set(a) | set(b) else 0.0
    want = {(x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and (jac(x[2], y[2]) >= 0.3 or jac(x[3], y[3]) >= 0.45 or (x[4] and y[4] and jac(x[4], y[4]) >= 0.4))}
    assert len(got) == len(want) and {(r["insight_id_a"], r["insight_id_b"]) for r in got} == want


def test_labels(spark):
    topics = spark.createDataFrame([("g", 0, ["one", "two words", "three"]), ("g", 1, ["four"])], "grp string, topic_id int, top_terms array<string>")
    weights = spark.createDataFrame([("g", 0, k, float(k)) for k in range(4)], "grp string, topic_id int, p int, weight double")
    texts = spark.createDataFrame([(k, f"text {k}") for k in (0, 1, 3)], "p int, text string")
    shown = labels.payloads(topics, weights, texts, "grp", "p", snippets=2, terms=2)
    got = {r["topic_id"]: r for r in shown.collect()}
    assert got[0]["unigrams"] == "one, three" and got[0]["bigrams"] == "two words" and got[0]["snippets"] == "- text 3\n- " and got[1]["snippets"] == ""

    def model(prompt):
        if "four" in prompt:
            raise RuntimeError("down")
        return '```json\n{"proposed_label": "L", "description": "d", "coherence_flag": "odd"}\n```'

    told = labels.label_topics(shown, "grp", model, tries=1)
    by = {r["topic_id"]: r for r in told.collect()}
    assert (by[0]["proposed_label"], by[0]["coherence_flag"], by[0]["problem"]) == ("L", "unclear", None) and "call failed" in by[1]["problem"]
    twice = told.filter("topic_id = 0").unionByName(told.filter("topic_id = 0")).unionByName(told.filter("topic_id = 0").withColumn("topic_id", F.lit(7)))
    assert {(r["topic_id"], r["problem"]) for r in labels.label_order(twice, topics, "grp").collect()} == {(0, "labelled more than once"), (1, "no label"), (7, "no such topic")}
    lines = labels.topic_lines(told.filter("problem IS NULL").join(topics, ["grp", "topic_id"]), "grp")
    assert lines.first()["lines"] == "  g | topic 0 | label: L | coherence: unclear | top_terms: one, two words, three | description: d"
    assert [tuple(r) for r in labels.synthesize(lines, "grp", "Write.", lambda p: p[-6:]).collect()] == [("g", "Write.", None)]


def test_vector_terms(spark):
    df = spark.createDataFrame([(1, ["__framing_x__", "Hands-on", "3d", "a_b", "end-"]), (2, [])], "doc_id long, tokens array<string>")
    assert [r["token"] for r in tokens.vector_terms(df).collect()] == ["hands-on", "a_b", "end"]
    assert [r["token"] for r in tokens.vector_terms(df, (2, 2), "array").collect()][:2] == ["__framing_x__ Hands-on", "Hands-on 3d"]


def test_enrichment(spark):
    df = spark.createDataFrame([("2-4%",), (" 5% ",), ("x-3",), (None,), ("7",)], "t string")
    assert [r[0] for r in df.select(enrich.target_share(F.col("t"))).collect()] == [3.0, 5.0, None, None, 7.0]
    names = spark.createDataFrame([("subject_x",), ("barrier",), ("sensitive_context_y",)], "c string").select(enrich.category_token(F.col("c")))
    assert [r[0] for r in names.collect()] == ["__subject_x__", "__framing_barrier__", "__sensitive_context_y__"]
    assert spark.range(1).select(enrich.plain_term(F.lit(" (New__York) ")).alias("t"), enrich.plain_term(F.lit(None).cast("string")).alias("n")).first() == ("new york", "")


def test_chart_edges(spark):
    p = spark.createDataFrame([(1, "x", None), (2, "x", "s"), (3, "y", "s")], "id int, a string, b string")
    m = spark.createDataFrame([("i", 1), ("i", 1), ("i", 2)], "insight_id string, id int")
    got = {(r["insight_id"], r["field"], r["category"]): (r["n"], r["pct"]) for r in charts.by_insight(p, m, ["a", "b"], "id").collect()}
    assert got[("i", "a", "x")] == (2, 1.0) and got[("i", "b", None)] == (1, 0.5) and got[("full_corpus", "b", None)] == (1, 0.3333)
    d = charts.distinctness(charts.by_insight(p, m, ["a", "b"], "id"), spark.createDataFrame([("i", 2)], "insight_id string, n int"), least=1).collect()
    assert {r["field"]: r["tvd"] for r in d} == {"a": 0.3333, "b": 0.1667} and d[0]["mean_tvd"] == 0.25
    assert spark.createDataFrame([(1.0, None), (None, None)], "a double, b double").select(charts.row_mean(["a", "b"])).collect() == [(1.0,), (None,)]
