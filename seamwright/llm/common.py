"""Shared plumbing: durable intermediate tables, frequent keys, ordered prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..durable import durable, shared_dir

__all__ = ["attach", "durable", "partitions", "picked", "shared_dir", "table", "with_offsets"]
#: A key is frequent when it holds at least 1/FREQUENT of all rows, so there are at most FREQUENT such keys.
FREQUENT = 1000
#: So many (doc_id, digest) keys, of some 70 bytes each, may be broadcast.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def attach(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, total: int, how: str = "left") -> DataFrame:
    """rows joined (left or inner) with groups (one row per key) without a hot task.

    Keys with at least 1/FREQUENT of the rows - at most FREQUENT of them - go by broadcast; all others go
    through a shuffled join in which no key can hold more than that share.
    """
    bound = max(total // FREQUENT, 1000)
    hot = F.broadcast(groups.filter(F.col(size) > bound))
    rest = groups.filter(F.col(size) <= bound)
    return rows.join(hot, key, "inner").unionByName(rows.join(hot, key, "left_anti").join(rest, key, how))


def with_offsets(df: DataFrame, order: list[Column], amount: str, out: str, name: str) -> DataFrame:
    """Adds ``out``: the sum of ``amount`` over all rows before this one in ``order``, in any number of partitions.

    Rows are range-partitioned and written; only one sum per partition reaches the driver.
    """
    spark = df.sparkSession
    n = partitions(spark)
    ranged = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    kept = durable(ranged, name)
    sums = sorted((r["_part"], r["s"] or 0) for r in kept.groupBy("_part").agg(F.sum(amount).alias("s")).collect())
    before, at = [], 0
    for part, s in sums:
        before.append((part, at))
        at += s
    base = spark.createDataFrame(before, "_part int, _base long")
    w = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        kept.withColumn("_own", F.coalesce(F.sum(amount).over(w), F.lit(0)))
        .join(F.broadcast(base), "_part")
        .withColumn(out, F.col("_base") + F.col("_own"))
        .drop("_part", "_base", "_own")
    )


def picked(df: DataFrame, renamed: dict[str, Column]) -> DataFrame:
    """Only the named columns, so that extra input columns can never clash with those an operator adds."""
    return df.select(*[c.alias(k) for k, c in renamed.items()])
