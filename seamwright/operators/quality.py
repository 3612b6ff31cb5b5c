"""Quality reports and gates of a corpus and of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import quantile_columns


def quality_report(tokens: DataFrame, stopwords, label: str, window: int = 200, key: str = "doc_id") -> DataFrame:
    """One row: label, documents, distinct and all tokens, least, median and greatest tokens a document, the stopwords among the
    ``window`` most frequent tokens (sorted, comma-joined), and the gate: there are none.  tokens: key, token, one row an occurrence."""
    per = tokens.groupBy(key).agg(F.count("*").alias("n"))
    freq = tokens.groupBy("token").agg(F.count("*").alias("n"))
    top = freq.orderBy(F.desc("n"), "token").limit(window)
    bad = top.filter(F.col("token").isin(*stopwords)).agg(F.array_join(F.sort_array(F.collect_list("token")), ",")).scalar()
    docs = per.agg(F.count("*").alias("n_docs"), F.min("n").alias("least"), F.max("n").alias("most")).withColumns(quantile_columns(per, "n", {"p50": 0.5}))
    total = freq.agg(F.struct(F.count("*").alias("u"), F.sum("n").alias("t"))).scalar()
    out = docs.select(F.lit(label).alias("checkpoint"), "n_docs", total["u"].alias("vocabulary"), total["t"].alias("n_tokens"), "least", "p50", "most", bad.alias("stopword_violations"))
    return out.withColumn("no_stopwords", F.col("stopword_violations") == "")


def compatible(primary: dict, other: dict, within: float = 1.0) -> None:
    """Raises ValueError unless two runs used the same filters on populations that differ by ``within`` percent at most.

    primary, other: filter_fields_key, output_row_count."""
    if primary.get("filter_fields_key") != other.get("filter_fields_key"):
        raise ValueError(f"filters differ: {primary.get('filter_fields_key')!r} and {other.get('filter_fields_key')!r}")
    a, b = int(primary.get("output_row_count") or 0), int(other.get("output_row_count") or 0)
    if a > 0 and b > 0 and 100 * abs(a - b) / a > within:
        raise ValueError(f"populations differ by more than {within} %: {a} and {b} rows")
