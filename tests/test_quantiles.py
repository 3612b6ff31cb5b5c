import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seamwright.operators import charts
from seamwright.operators.quantiles import quantile_columns, quantiles

WANTED = {"lo": 0.0, "a": 0.25, "m": 0.5, "b": 0.9, "hi": 1.0}


def made(seed):
    rng = random.Random(seed)
    kinds = [lambda: rng.gauss(0, 1), lambda: float(rng.randint(-3, 3)), lambda: rng.random() * 1e-9, lambda: math.exp(rng.uniform(-40, 40)) * rng.choice([-1, 1]), lambda: None]
    return [(rng.choice(["x", "y", None]), rng.choice(kinds)()) for _ in range(400)] + [("one", 4.5), ("none", None)]


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_by_group_and_of_all(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: [r[q] for q in WANTED] for r in quantiles(df, ["g"], "v", WANTED).collect()}
    assert set(got) == {"x", "y", None, "one"}
    for g, found in got.items():
        assert found == pytest.approx(np.quantile([v for k, v in rows if k == g and v is not None], list(WANTED.values())).tolist(), rel=1e-12)
    one = df.agg(F.count("v").alias("n")).withColumns(quantile_columns(df, "v", WANTED)).first()
    assert [one[q] for q in WANTED] == pytest.approx(np.quantile([v for _, v in rows if v is not None], list(WANTED.values())).tolist(), rel=1e-12)


def test_edges(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert quantiles(df, ["g"], "v", WANTED).collect() == [] and quantiles(df, [], "v", WANTED).collect() == []
    assert df.agg(F.count("v").alias("n")).withColumns(quantile_columns(df, "v", {"m": 0.5})).first()["m"] is None
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,), (-1.0,), (float("-inf"),)], "v double")
    got = quantiles(odd, [], "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}).first()
    assert (got["a"], got["b"], got["c"], got["d"]) == (float("-inf"), -1.0, 1.0, float("inf")) and math.isnan(got["e"])
    long = spark.createDataFrame([(i,) for i in range(10)], "v long")
    assert quantiles(long, [], "v", {"m": 0.5}).first()["m"] == 4.5


def test_no_percentile_and_no_cross_join_in_the_plan(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    plan = quantiles(df, ["g"], "v", {"m": 0.5})._jdf.queryExecution().toString()
    assert "percentile" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_quantile_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 0, 0, 1, 2, 3, 4, 5, 6]] + [(None,)], "v double")
    edges = charts.quantile_edges(df, "v", 5)
    got = [r[0] for r in df.select(charts.quantile_bin(F.col("v"), edges)).collect()]
    assert got == [0, 0, 0, 0, 1, 1, 2, 2, 3, 3, None] or got[-1] is None
    edge = list(dict.fromkeys(np.quantile([0, 0, 0, 0, 1, 2, 3, 4, 5, 6], [0, 0.2, 0.4, 0.6, 0.8, 1.0]).tolist()))
    assert got[:-1] == [max(0, sum(e < v for e in edge) - 1) for v in [0, 0, 0, 0, 1, 2, 3, 4, 5, 6]]
