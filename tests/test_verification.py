import json

import pytest
from pyspark.sql import functions as F

from seamwright.operators import enrich, fields, labels, ports

CLAIMS = "array<struct<group: string, topic_id: int>>"


def test_claims_by_section(spark):
    rows = [
        ("K1", "key_insights", "cut", [("a", 1), ("b", 2)]), ("K2", "key_insights", "down", [("a", 1)]), ("K3", "key_insights", "odd", [("a", 1)]), ("K4", "key_insights", "none", [("a", 1), ("b", 2)]),
        ("K5", "key_insights", "unlabelled", [("c", 9)]), ("K6", "key_insights", "empty", None), ("B1", "by_group", "narrow", [("a", 1)]), ("B2", "by_group", "cut", [("a", 1), ("b", 2)]), ("K7", "key_insights", "stranger", [("a", 1)]),
    ]
    df = spark.createDataFrame(rows, f"insight_id string, section string, title string, source_topics {CLAIMS}").withColumns({"finding": F.lit(None).cast("string"), "evidence_basis": F.lit("e")})
    names = spark.createDataFrame([("a", 1, "A", "d"), ("b", 2, "B", None), ("a", 1, "Z", "later")], "group string, topic_id int, label string, description string")

    def model(prompt):
        assert "label: A" in prompt and "narrow" not in prompt and "unlabelled" not in prompt
        if "Title: down" in prompt:
            raise RuntimeError("down")
        if "Title: odd" in prompt:
            return "no json"
        kept = {"cut": [("a", 1), ("a", 1)], "none": [], "stranger": [("b", 2), ("x", 3), ("a", None)]}[prompt.split("\n")[0][7:]]
        return json.dumps({"verified_topics": [{"group": g, "topic_id": k} for g, k in kept]})

    out = ports.verify_claims(df, names, model, ["a", "b", "c"], {"by_group": 2}, tries=1)
    got = {r["insight_id"]: ([tuple(x) for x in r["verified"]], r["problem"]) for r in out.collect()}
    assert got == {
        "K1": ([("a", 1)], None), "K2": ([("a", 1)], "call failed: RuntimeError: down"), "K3": ([("a", 1)], "not the JSON asked for"), "K4": ([], None), "K5": ([("c", 9)], None),
        "K6": ([], None), "B1": ([("a", 1)], None), "B2": ([("a", 1)], None), "K7": ([("b", 2)], None),
    }
    stats = {r["section"]: tuple(r)[1:] for r in ports.verification_stats(out).collect()}
    assert stats == {"key_insights": (7, 2, 1, 8, 5), "by_group": (2, 1, 0, 3, 2)}


@pytest.mark.parametrize(("field", "want"), [("school_state", "wide"), ("Teacher_ZIP", "thin"), ("other", "plain")])
def test_family(field, want):
    assert fields.family(field, {"wide": ["state"], "thin": ["zip", "county"]}, "plain") == want


def test_injected_tokens_are_stripped_and_coherence_is_counted(spark):
    df = spark.createDataFrame([(["a", "__cat_x__", "b"],), ([],), (None,)], "t array<string>")
    assert [r[0] for r in df.select(enrich.strip_injected(F.col("t"))).collect()] == [["a", "b"], [], None]
    flags = spark.createDataFrame([("coherent",), ("mixed",), ("coherent",), (None,)], "coherence_flag string")
    assert {(r["coherence_flag"], r["n"]) for r in labels.coherence_counts(flags).collect()} == {("coherent", 2), ("mixed", 1), (None, 1)}
