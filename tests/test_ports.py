import json

import pytest

from seamwright.operators import ports, topics
from seamwright.sources import reports


def test_gate_and_failures(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["d", "e"],), (["x", "y"],)], "terms array<string>")

    def model(prompt):
        if "a, b" in prompt:
            return '```json\n{"decision": "inject", "injected": "__t__"}\n```'
        if "d, e" in prompt:
            return '{"decision": "split", "groups": [{"injected": "__s__", "terms": ["d", "other"]}]}'
        raise RuntimeError("down")

    got = {(r.term, r.injected) for r in ports.gate_clusters(df, model, tries=2, wait=0).collect()}
    assert got == {("a", "__t__"), ("b", "__t__"), ("c", "__t__"), ("d", "__s__")}


def test_classify_and_verify(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "term string")

    def model(prompt):
        terms = json.loads(prompt[prompt.index("["):])
        return json.dumps({x: {"a": "one", "b": "not in the set"}.get(x) for x in terms})

    assert {(r.term, r.category) for r in ports.classify_terms(df, ["one", "two"], model, batch=2, wait=0).collect()} == {("a", "one"), ("b", None), ("c", None)}
    claims = spark.createDataFrame([(1, ["p", "q"], "keep p"), (2, ["p"], "fail")], "insight_id int, topic_keys array<string>, prompt string")
    got = ports.verify_topics(claims, "prompt", lambda x: '["p", "z"]' if x == "keep p" else "no json", wait=0).collect()
    assert [(r.verified, r.ratio) for r in got] == [(["p"], 0.5), ([], 0.0)]


def test_themes_drop_subsets(spark):
    rows = [("a", "b", ["x", "y", "z"]), ("c", "d", ["x", "y", "z"]), ("a", "b", ["x", "y"]), ("c", "d", ["x", "y"]), ("a", "b", ["p", "q"])]
    got = topics.cross_group_themes(spark.createDataFrame(rows, "group_a string, group_b string, terms array<string>")).collect()
    assert [(r.theme, r.n_groups) for r in got] == [("x,y", 4), ("x,y,z", 4)]


def test_reports(spark):
    df = spark.createDataFrame([(1, "</script>"), (2, None)], "id int, s string")
    page = reports.html_report("t", {"rows": df})
    assert page.count("</script>") == 1 and "&lt;/script&gt;" in page
    assert reports.describe(df) == reports.describe(df.orderBy("s"))
    assert reports.manifest("s", "r", {"o": df}, {}, 1.0)["outputs"]["o"]["rows"] == 2
    with pytest.raises(ValueError):
        reports.html_report("t", {"rows": df}, most=1)


def test_judged_pairs(spark):
    rows = spark.createDataFrame([(k, "t" + k, "f") for k in "abc"], "insight_id string, title string, finding string")
    pairs = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.4), ("b", "c", 0.6)], "insight_id_a string, insight_id_b string, topics_overlap double")

    def model(prompt):
        if "0.400" in prompt:
            raise RuntimeError("down")
        return '{"duplicate": %s, "reason": "r"}' % ("true" if "title: tb" in prompt and "title: ta" in prompt else "false")

    got = ports.judge_pairs(pairs, rows, model, shown=("title", "finding"), tries=1).collect()
    assert {(r["insight_id_a"], r["insight_id_b"]): r["duplicate"] for r in got} == {("a", "b"): True, ("a", "c"): False, ("b", "c"): False}
