"""Exact quantiles without a buffer of all values.

Values are counted, and each belongs to a bucket that grows with the value (256 to the octave).  Counts of buckets, of which
a group has some hundred thousand at most, tell which buckets hold the wanted ranks; only their values are ordered, a bucket a
task.  Everything is one lazy plan of sums, joins on the group and windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Buckets to the octave, and what values are multiplied by before: those under its inverse share a bucket.
_FINE, _SCALE = 256.0, float(1 << 20)
#: The bucket of not-a-number, which is greater than all values, and of values beyond all octaves.
_NAN, _FAR = 1 << 40, float(1 << 30)


def _bucket(v: Column) -> Column:
    size = F.least(F.lit(_FAR), F.lit(_FINE) * F.log2(1.0 + F.abs(v) * _SCALE))
    return F.when(F.isnan(v), F.lit(_NAN)).otherwise((F.signum(v) * F.floor(size)).cast("long"))


def quantiles(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """The keys (null is a key) and one column for each wanted quantile, interpolated between the two ranks beside it.

    Null values don't count; a group of nulls only has no row, nor has an empty table."""
    names = [f"_k{i}" for i in range(len(keys))]
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))
    counted = counted.withColumn("_b", _bucket(F.col("_v")))
    sizes = counted.groupBy(*names, "_b").agg(F.sum("_c").alias("_n"))
    whole = Window.partitionBy(*names)
    sizes = sizes.withColumn("_before", F.sum("_n").over(whole.orderBy("_b")) - F.col("_n")).withColumn("_last", F.sum("_n").over(whole) - 1)
    places = {q: F.col("_last") * F.lit(float(p)) for q, p in wanted.items()}
    held = [(F.col("_before") <= F.ceil(at)) & (F.floor(at) < F.col("_before") + F.col("_n")) for at in places.values()]
    near = sizes.filter(reduce(Column.__or__, held)).select(*[F.col(n).alias(f"{n}r") for n in names], F.col("_b").alias("_br"), "_before", "_last")
    same = [F.col(n).eqNullSafe(F.col(f"{n}r")) for n in names]
    inside = counted.join(near, reduce(Column.__and__, [F.col("_b") == F.col("_br"), *same]))
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*names, "_b").orderBy("_v"))
    inside = inside.withColumn("_upto", upto)

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto")), F.col("_v")))

    ends = [x for q, at in places.items() for x in (value_at(F.floor(at)).alias(f"_lo_{q}"), value_at(F.ceil(at)).alias(f"_hi_{q}"))]
    out = inside.groupBy(*names).agg(F.first("_last").alias("_last"), *ends) if names else inside.agg(F.first("_last").alias("_last"), *ends).filter("_last IS NOT NULL")
    between = [(F.when(F.ceil(at) == F.floor(at), F.col(f"_lo_{q}")).otherwise((F.ceil(at) - at) * F.col(f"_lo_{q}") + (at - F.floor(at)) * F.col(f"_hi_{q}"))).alias(q) for q, at in places.items()]
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], *between)


def quantile_columns(rows: DataFrame, value: str, wanted: dict[str, float]) -> dict[str, Column]:
    """The wanted quantiles of all rows as columns (a scalar subquery); null where there is no value."""
    found = quantiles(rows, [], value, wanted).select(F.struct(*wanted).alias("q")).scalar()
    return {q: found.getField(q) for q in wanted}


def with_quantiles(grouped: DataFrame, rows: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """grouped (one row per key) and the wanted quantiles, null where a group has no value."""
    found = quantiles(rows, keys, value, wanted)
    right = found.select(*[F.col(k).alias(f"_q{i}") for i, k in enumerate(keys)], *wanted)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_q{i}")) for i, k in enumerate(keys)])
    return grouped.join(right, same, "left").drop(*[f"_q{i}" for i in range(len(keys))])
