"""TF-IDF in long form: smooth idf ln((1 + n) / (1 + df)) + 1, rows of unit length, contrasts between groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def tfidf(terms: DataFrame, n_docs: int | Column, key: str = "doc_id", min_df: int = 1, max_share: float = 1.0) -> DataFrame:
    """terms: key, token (one row an occurrence), or ``tokens.counted``, with tf.  Returns key, token, tf, df, idf, tfidf."""
    tf = terms if "tf" in terms.columns else terms.groupBy(key, "token").agg(F.count("*").alias("tf"))
    df = tf.groupBy("token").agg(F.count("*").alias("df")).filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_share) * n_docs))
    raw = tf.join(df.hint("shuffle_hash"), "token").withColumn("idf", F.log((F.lit(1.0) + n_docs) / (1.0 + F.col("df"))) + 1.0).withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))  # one exchange by document; a document's terms fit a task
    return raw.withColumn("norm", norm).select(key, "token", "tf", "df", "idf", (F.col("raw") / F.col("norm")).alias("tfidf"))


def matrix_stats(weights: DataFrame, n_docs: int | Column, key: str = "doc_id") -> DataFrame:
    got = weights.agg(F.count("*").alias("nnz"), F.countDistinct("token").alias("n_terms"))
    return got.select(F.lit(n_docs).cast("long").alias("n_docs"), "n_terms", "nnz", F.round(1.0 - F.col("nnz") / (F.lit(n_docs) * F.col("n_terms")), 4).alias("sparsity"))


def category_slice(weights: DataFrame, groups: DataFrame, group: str, top: int, key: str = "doc_id", min_size: int = 1) -> DataFrame:
    """Mean weight, weight times idf, prevalence and contrast per group and token; the rest of the corpus is total less group."""
    sizes = groups.groupBy(group).agg(F.count("*").alias("size"))
    n = groups.agg(F.count("*")).scalar()
    rows = weights.join(groups.select(key, group), key)
    by = rows.groupBy(group, "token").agg(F.sum("tfidf").alias("w"), F.count("*").alias("n_in"), F.first("idf").alias("idf"), F.first("df").alias("df"))
    by = by.join(sizes.filter(F.col("size") >= min_size), group)
    out = by.select(group, "token", (F.col("w") / F.col("size")).alias("tf"), "idf", (F.col("w") / F.col("size") * F.col("idf")).alias("tfidf"), (F.col("n_in") / F.col("size")).alias("prevalence"),
                    (F.col("n_in") / F.col("size") - F.when(n > F.col("size"), (F.col("df") - F.col("n_in")) / (n - F.col("size"))).otherwise(0.0)).alias("contrast"), F.col("n_in").alias("project_count"))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(F.round("tfidf", 9)), "token"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= top)
