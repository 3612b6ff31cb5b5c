"""From weights through the factorisation to evidence, and runs written and read back."""

import statistics

import pytest

from seamwright.operators import factorise, insights
from seamwright.sources import runs


def test_evidence_is_that_of_w(spark):
    rows = [("g", d, w, 1.0 + d % 3) for d in range(30) for w in (("a", "b", "c") if d % 2 else ("x", "y", "z"))] + [("g", 30, w, 1.0) for w in "abxy"]
    rows += [("h", d, w, 1.0) for d in range(10) for w in ("k", "l", "m")]
    model = factorise.nmf(spark.createDataFrame(rows, "grp string, doc_id long, token string, tfidf double"), "grp", {"g": 2, "h": 1})
    w = {}
    for r in model.weights().collect():
        w.setdefault((r["grp"], r["doc_id"]), {})[r["topic_id"]] = r["weight"]
    shares = {}
    for (g, d), by in w.items():
        for k, x in by.items():
            if (share := x / sum(by.values())) >= 0.15:
                shares.setdefault(f"grp={g}|topic={k}", {})[d] = share
    got = {r["topic_key"]: r for r in insights.topic_evidence(model.weights(), model.topics(), "grp", "doc_id").collect()}
    assert set(got) == set(shares) and len(got) == 3
    for key, by in shares.items():
        assert got[key]["supporting_projects"] == len(by)
        assert got[key]["mean_share"] == pytest.approx(statistics.mean(by.values()), abs=1e-6) and got[key]["median_share"] == pytest.approx(statistics.median(by.values()), abs=1e-6)
        assert {int(x) for x in got[key]["top_project_ids"].split(",")} == set(by)
    planted = {frozenset(r["label"].split(", ")): {int(x) for x in r["top_project_ids"].split(",")} for r in got.values()}
    assert planted[frozenset("abc")] == {d for d in range(30) if d % 2} | {30} and planted[frozenset("xyz")] == {d for d in range(30) if d % 2 == 0} | {30}
    assert planted[frozenset("klm")] == set(range(10))


def test_numbers_of_terms_follow_their_order(spark):
    terms = [(g, f"t{k:03d}") for g in "abc" for k in range(50)]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    got = factorise._numbered(spark.createDataFrame(terms, "g string, token string")).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted((r["g"], r["token"], r["idx"]) for r in got) == [(g, t, int(t[1:])) for g, t in terms]


def test_runs_are_read_back_together(spark, tmp_path):
    root = str(tmp_path / "runs")
    schema = "insight_id string, category_bucket string, n long"
    with pytest.raises(FileNotFoundError):
        runs.load_runs(spark, root, {"insights": schema})
    made = lambda *rows: spark.createDataFrame(rows, schema)
    runs.write_run(spark, root, "20240101_a", {"insights": made(("I1", "x", 1)), "labels": made(("L", None, 0))}, "state", "none", 1000, inputs={"docs": made(("d", "e", 2))})
    runs.write_run(spark, root, "20240102_b", {"insights": made(("I1", "y", 2), ("I2", "y", 3))}, "grade", "none", 1005)
    made(("lost", "z", 9)).write.parquet(f"{root}/20240103_c/insights.parquet")  # no manifest: not finished
    found = runs.find_runs(spark, root)
    assert list(found) == ["20240101_a", "20240102_b"] and found["20240101_a"]["inputs"]["docs"]["rows"] == 1 and found["20240101_a"]["files"]["insights"]["bytes"] > 0
    got = runs.load_runs(spark, root, {"insights": schema, "labels": schema, "absent": schema})
    assert sorted((r["run_id"], r["insight_id"], r["category_bucket"], r["n"]) for r in got["insights"].collect()) == [
        ("20240101_a", "20240101_a__I1", "state::x", 1), ("20240102_b", "20240102_b__I1", "grade::y", 2), ("20240102_b", "20240102_b__I2", "grade::y", 3),
    ]
    assert got["labels"].count() == 1 and got["absent"].count() == 0
    runs.write_run(spark, root, "20240104_d", {"insights": made(("I9", "y", 2))}, "grade", "state", 1000)
    with pytest.raises(ValueError, match="20240101_a"):
        runs.load_runs(spark, root, {"insights": schema})
    assert runs.load_runs(spark, root, {"insights": schema}, runs=["20240104_d"])["insights"].count() == 1
    with pytest.raises(ValueError, match="populations"):
        runs.write_run(spark, root, "20240105_e", {"insights": made()}, "grade", "none", 2000)
        runs.load_runs(spark, root, {"insights": schema}, primary="20240101_a", runs=["20240101_a", "20240105_e"])
