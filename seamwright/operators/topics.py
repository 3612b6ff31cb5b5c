"""Topics: shares, ranks and themes across groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .quantiles import quantile_columns


def bridge(weights: DataFrame, group: str, project: str, topic: str, weight: str, least: float) -> DataFrame:
    """Share of each topic in a project's total weight (0 when the total isn't positive), where it reaches ``least``."""
    total = F.sum(weight).over(Window.partitionBy(group, project))
    share = F.when(total > 0, F.col(weight) / total).otherwise(0.0)
    key = F.concat(F.lit(f"{group}="), F.col(group).cast("string"), F.lit("|topic="), F.col(topic).cast("string"))
    return weights.withColumn("topic_share", share).filter(F.col("topic_share") >= least).withColumn("topic_key", key)


def rank(weights: DataFrame, group: str, project: str, topic: str, weight: str) -> DataFrame:
    return weights.withColumn("rank", F.row_number().over(Window.partitionBy(group, topic).orderBy(F.desc(weight), project)) - 1)


def cross_group_pairs(topics: DataFrame, group: str, least: int = 3) -> DataFrame:
    """Pairs of topics of different groups that share at least ``least`` top terms: theme, group and topic of either."""
    a = topics.select(F.col(group).alias("group_a"), F.col("topic_id").alias("topic_a"), F.col("top_terms").alias("ta"))
    b = topics.select(F.col(group).alias("group_b"), F.col("topic_id").alias("topic_b"), F.col("top_terms").alias("tb"))
    pairs = a.select("*", F.explode("ta").alias("term")).join(b.select("*", F.explode("tb").alias("term")), "term").filter("group_a < group_b")
    same = pairs.groupBy("group_a", "topic_a", "group_b", "topic_b").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    return same.filter(F.size("terms") >= least).withColumn("theme", F.array_join("terms", ","))


def cross_group_themes(pairs: DataFrame, least_groups: int = 4, label: int = 5) -> DataFrame:
    """Equal term sets of ``pairs`` merged; those over enough groups stay, unless within one of more groups (or as many, and before it)."""
    sides = pairs.select("terms", F.explode(F.array("group_a", "group_b")).alias("g"))
    themes = sides.groupBy("terms").agg(F.countDistinct("g").alias("n_groups")).filter(F.col("n_groups") >= least_groups)
    themes = themes.withColumn("theme", F.array_join("terms", ",")).withColumn("label", F.array_join(F.slice("terms", 1, label), ","))
    a, b = (themes.select(F.col("theme").alias(f"t{x}"), F.col("n_groups").alias(f"n{x}"), F.size("terms").alias(f"s{x}"), F.explode("terms").alias("term")) for x in "ab")
    ahead = (F.col("nb") > F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("tb") < F.col("ta")))
    inside = a.join(b, "term").filter((F.col("sa") < F.col("sb")) & ahead).groupBy("ta", "tb", "sa").agg(F.count("*").alias("c")).filter("c = sa")
    return themes.join(inside.select(F.col("ta").alias("theme")).distinct(), "theme", "left_anti").select("theme", "label", "n_groups")


def n_components(docs: int, vocabulary: int, base: int = 15, per_topic: int = 15, small: bool = False, small_cap: int = 8) -> int:
    """Topics of a group, four at least: ``base``, one for ``per_topic`` documents, one for eight terms, and where groups are ``small`` no more than ``small_cap``."""
    return max(4, min(base, max(4, docs // per_topic), max(4, vocabulary // 8), small_cap if small else base))


def components_of(docs: Column, vocabulary: Column, base: int = 15, per_topic: int = 15, small: Column | None = None, small_cap: int = 8) -> Column:
    """``n_components`` as a column."""
    part = lambda c, k: F.greatest(F.lit(4), F.floor(c / k))
    cap = F.lit(base) if small is None else F.when(small, small_cap).otherwise(base)
    return F.greatest(F.lit(4), F.least(F.lit(base), part(docs, per_topic), part(vocabulary, 8), cap)).cast("int")


def slices(sizes: DataFrame, group: str, base: int = 15, least_vocabulary: int = 60, least_nnz: int = 300, small_below: float = 125, per_topic: int = 15, small_cap: int = 8) -> DataFrame:
    """group, docs, vocabulary, nnz, n_components, skip_reason (null: the group is factorised).

    sizes: group, docs, vocabulary, nnz.  Groups are small when their median size is below ``small_below``."""
    small = quantile_columns(sizes, "docs", {"m": 0.5})["m"] < small_below
    k = components_of(F.col("docs"), F.col("vocabulary"), base, per_topic, small, small_cap)
    why = F.when(F.col("vocabulary") < least_vocabulary, "low_retained_vocab").when(F.col("nnz") < least_nnz, "low_tfidf_nnz").when(F.col("vocabulary") < F.col("n_components"), "vocab_below_topic_count")
    return sizes.select(group, "docs", "vocabulary", "nnz", k.alias("n_components")).withColumn("skip_reason", why)


def slice_sizes(weights: DataFrame, group: str, key: str = "doc_id") -> DataFrame:
    return weights.groupBy(group).agg(F.countDistinct(key).alias("docs"), F.countDistinct("token").alias("vocabulary"), F.count("*").alias("nnz"))
