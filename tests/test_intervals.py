import datetime
import random

from pyspark.sql import functions as F

from seamwright.operators.intervals import covering, first_match


def test_covering_against_all_pairs(spark):
    rng = random.Random(1)
    spans = [(k, lo, lo + rng.choice([0, 1, 2, 3, 8, 9, 1000, 10**6])) for k in range(200) for lo in [rng.randint(-500, 500)]]
    values = [rng.randint(-600, 10**6) if rng.random() < 0.2 else rng.randint(-600, 600) for _ in range(300)]
    want = sorted((v, k) for v in values for k, lo, hi in spans if lo <= v < hi)
    iv = spark.createDataFrame(spans, "k int, lo long, hi long")
    got = covering(spark.createDataFrame([(v,) for v in values], "v long"), F.col("v"), iv)
    assert sorted((r["v"], r["k"]) for r in got.collect()) == want
    assert covering(spark.createDataFrame([(1,)], "v long"), F.col("v"), iv.limit(0)).count() == 0


def test_ten_thousand_intervals_and_no_nested_loop(spark):
    iv = spark.range(10_000).select(F.col("id").alias("lo"), (F.col("id") + 1 + F.col("id") % 50).alias("hi"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("name"), (-F.col("id")).alias("rank"))
    rows = spark.range(0, 12_000).select((F.col("id") - 500).alias("v"))
    out = first_match(rows, "v", iv, "name", "rank", "bin")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {r["v"]: r["bin"] for r in out.collect()}
    assert len(got) == 12_000 and got[-1] is None and got[0] == "b0" and got[10_500] is None
    for v in range(0, 10_100, 37):
        best = next((k for k in range(min(v, 9999), max(-1, v - 60), -1) if k <= v < k + 1 + k % 50), None)
        assert got[v] == (None if best is None else f"b{best}"), v


def test_dates_nulls_and_names(spark):
    day = datetime.date
    iv = spark.createDataFrame([(day(2024, 1, 1), day(2024, 2, 1), "jan", 2), (day(2024, 1, 15), day(2024, 3, 1), "late", 1), (day(2024, 5, 1), day(2024, 5, 1), "none", 0)], "lo date, hi date, name string, o int")
    rows = spark.createDataFrame([(day(2024, 1, 1), "x"), (day(2024, 1, 20), "y"), (day(2024, 2, 1), "y"), (day(2024, 3, 1), "z"), (None, None), (day(2024, 5, 1), "q")], "d date, name string")
    got = sorted(((r["d"], r["name"], r["bin"]) for r in first_match(rows, "d", iv, "name", "o", "bin").collect()), key=str)
    assert got == sorted([(day(2024, 1, 1), "x", "jan"), (day(2024, 1, 20), "y", "late"), (day(2024, 2, 1), "y", "late"), (day(2024, 3, 1), "z", None), (None, None, None), (day(2024, 5, 1), "q", None)], key=str)
