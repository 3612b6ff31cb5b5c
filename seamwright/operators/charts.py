"""Distributions: counts with shares, bins, distances between groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .quantiles import quantile_columns


def value_counts(df: DataFrame, field: str, by: list[str] | None = None, keep_null: bool = True) -> DataFrame:
    by = by or []
    rows = df if keep_null else df.filter(F.col(field).isNotNull())
    counts = rows.groupBy(*by, F.col(field).alias("category")).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(*by)), 4))


def fixed_bin(value: Column, edges: list[float]) -> Column:
    """Number of the right-closed bin (the first also holds its left edge); null outside all."""
    out = F.when((value >= edges[0]) & (value <= edges[1]), 0)
    for k in range(1, len(edges) - 1):
        out = out.when((value > edges[k]) & (value <= edges[k + 1]), k)
    return out


def quantile_edges(df: DataFrame, field: str, parts: int = 5) -> list[Column]:
    """Linear-interpolation quantiles in order, equal ones included; null without values."""
    return list(quantile_columns(df, field, {f"q{k}": k / parts for k in range(parts + 1)}).values())


def quantile_bin(value: Column, edges: list[Column]) -> Column:
    """Number of the right-closed bin between the distinct edges (the first also holds its left edge); null outside all."""
    below = [F.when((e < value) & (F.lit(True) if k == 0 else e > edges[k - 1]), 1).otherwise(0) for k, e in enumerate(edges)]
    return F.when((value >= edges[0]) & (value <= edges[-1]), F.greatest(F.lit(0), sum(below[1:], below[0]) - 1))


def weighted_average(value: str, weight: str) -> Column:
    return F.when(F.sum(weight) != 0, F.sum(F.col(value) * F.col(weight)) / F.sum(weight))


def total_variation(a: DataFrame, b: DataFrame) -> DataFrame:
    """Half the sum of absolute differences of two distributions (category, pct)."""
    both = a.select("category", F.col("pct").alias("p")).join(b.select("category", F.col("pct").alias("q")), "category", "full")
    return both.agg(F.round(F.sum(F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("q", F.lit(0.0)))) / 2, 4).alias("tvd"))


def separators(group: DataFrame, corpus: DataFrame, by: str, least: float = 0.005, top: int = 2) -> DataFrame:
    """Categories that a group has more of than the corpus by over ``least``, the ``top`` largest."""
    rows = group.join(corpus.select("category", F.col("pct").alias("base")), "category", "left").withColumn("diff", F.round(F.col("pct") - F.coalesce("base", F.lit(0.0)), 4))
    ranked = rows.filter(F.col("diff") > least).withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("diff"), "category")))
    return ranked.filter(F.col("rank") <= top).select(by, "category", "diff", "rank")


def by_insight(projects: DataFrame, members: DataFrame, fields: list[str], key: str, top: dict[str, int] | None = None) -> DataFrame:
    """insight_id, field, category, n, pct: value counts of every field for every insight and, as ``full_corpus``, for all projects.

    Fields are unpivoted, so projects are read and counted once for all of them; null is a category.  top: for these fields an
    insight shows its most frequent categories only (shares are still of all).  members: insight_id, key."""
    rows = projects.select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("category")) for f in fields])).alias("x")).select(key, "x.*")
    counts = members.distinct().join(rows, key).groupBy("insight_id", "field", "category").agg(F.count("*").alias("n"))
    both = counts.unionByName(rows.groupBy("field", "category").agg(F.count("*").alias("n")).withColumn("insight_id", F.lit("full_corpus")))
    out = both.withColumn("pct", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("insight_id", "field")), 4))
    if top:
        most = F.create_map(*[F.lit(x) for kv in top.items() for x in kv])
        place = F.row_number().over(Window.partitionBy("insight_id", "field").orderBy(F.desc("n"), F.asc_nulls_last("category")))
        limit = F.when(F.col("insight_id") != "full_corpus", F.try_element_at(most, F.col("field")))
        out = out.withColumn("_r", place).filter(limit.isNull() | (F.col("_r") <= limit)).drop("_r")
    return out.select("insight_id", "field", "category", "n", "pct")


def distinctness(counts: DataFrame, sizes: DataFrame, least: int = 500) -> DataFrame:
    """insight_id, field, tvd of the insights with more than ``least`` projects, and ``mean_tvd`` over the fields.

    counts: what ``by_insight`` gives; sizes: insight_id, n."""
    base = counts.filter("insight_id = 'full_corpus'").select("field", "category", F.col("pct").alias("q"))
    own = counts.filter("insight_id <> 'full_corpus'").join(sizes.filter(F.col("n") > least).select("insight_id"), "insight_id", "left_semi")
    # half the sum over both sides: what an insight has, and what only the corpus has
    same = (base["field"] == own["field"]) & base["category"].eqNullSafe(own["category"])
    found = own.join(base, same, "left").select("insight_id", own["field"], F.abs(F.col("pct") - F.coalesce("q", F.lit(0.0))).alias("d"), F.coalesce("q", F.lit(0.0)).alias("met"))
    total = base.groupBy("field").agg(F.sum("q").alias("all"))
    per = found.groupBy("insight_id", "field").agg(F.sum("d").alias("d"), F.sum("met").alias("met")).join(total, "field")
    # shares have four digits, so the sum is a whole number of these; its half is rounded up where it must be
    whole = F.round((F.col("d") + F.col("all") - F.col("met")) * 10_000)
    per = per.select("insight_id", "field", (F.floor((whole + 1) / 2) / 10_000).alias("tvd"))
    return per.withColumn("mean_tvd", F.round(F.avg("tvd").over(Window.partitionBy("insight_id")), 4))


def xmax(counts: DataFrame, room: float = 1.2) -> DataFrame:
    """field, xmax: where an axis ends that holds every insight's shares."""
    return counts.groupBy("field").agg(F.round(F.max("pct") * room, 4).alias("xmax"))


def row_mean(columns: list[str], digits: int = 4) -> Column:
    """Mean of a row's columns; nulls don't count, and without any the mean is null."""
    there = F.array_compact(F.array(*[F.col(c).cast("double") for c in columns]))
    return F.round(F.when(F.size(there) > 0, F.aggregate(there, F.lit(0.0), lambda s, x: s + x) / F.size(there)), digits)


def weighted_shares(df: DataFrame, by: str, columns: dict[str, str], weight: str) -> DataFrame:
    """by, label, weighted_avg: a label's column weighted by ``weight``; nulls of the column count in the weights only, 0 without weight."""
    total = F.sum(weight)
    wide = df.groupBy(by).agg(*[F.round(F.when(total > 0, F.sum(F.col(c) * F.col(weight)) / total).otherwise(0.0), 4).alias(k) for k, c in columns.items()])
    return wide.unpivot([by], list(columns), "label", "weighted_avg")


def label_distance(a: DataFrame, b: DataFrame, value: str = "weighted_avg", scale: float = 100.0) -> DataFrame:
    """Half the sum of differences over the labels that both have (inner join), in parts of ``scale``."""
    both = a.select("label", F.col(value).alias("p")).join(b.select("label", F.col(value).alias("q")), "label")
    return both.agg(F.round(F.sum(F.abs(F.col("p") - F.col("q"))) / 2 / scale, 4).alias("distance"))


def map_rows(projects: DataFrame, members: DataFrame, field: str, key: str) -> DataFrame:
    """insight_id, category, n, pct without nulls, ``full_corpus`` included."""
    counts = by_insight(projects.filter(F.col(field).isNotNull()), members, [field], key)
    return counts.drop("field")


def group_summary(members: DataFrame, group: str, key: str) -> DataFrame:
    """One row: groups, median and largest number of distinct members, and the largest group (ties by name).  Null groups are left out."""
    sizes = members.filter(F.col(group).isNotNull()).groupBy(group).agg(F.countDistinct(key).alias("n"))
    largest = F.max_by(F.col(group), F.struct("n", F.transform(F.split(F.col(group).cast("string"), ""), lambda c: -F.ascii(c))))
    return sizes.agg(F.count("*").alias("n_groups"), F.max("n").alias("largest_size"), largest.alias("largest")).withColumns(quantile_columns(sizes, "n", {"median_size": 0.5}))
