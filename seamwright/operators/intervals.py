"""Joins of values with a table of intervals, without comparing every value with every interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _level(length: Column) -> Column:
    """The least power of two (as exponent) that isn't shorter."""
    return F.ceil(F.log2(length.cast("double"))).cast("int")


def _cells(intervals: DataFrame) -> DataFrame:
    """Each interval [lo, hi) with the one or two cells of its level that hold it: level, cell."""
    size = intervals.withColumn("level", _level(F.col("hi") - F.col("lo")))
    ends = F.array_distinct(F.array(F.call_function("shiftright", F.col("lo"), F.col("level")), F.call_function("shiftright", F.col("hi") - 1, F.col("level"))))
    return size.withColumn("cell", F.explode(ends))


def covering(values: DataFrame, value: Column, intervals: DataFrame) -> DataFrame:
    """All pairs of a row of values and an interval [lo, hi) that holds its value (a long).  intervals: lo, hi and others.

    Intervals are filed by length: one of up to 2^k lies in two cells of that width at most.  A value meets, for each length that
    occurs - 64 at most - the one cell it lies in, so the join is on equal keys and only the cell's intervals are compared."""
    filed = _cells(intervals.filter("lo < hi"))
    levels = filed.select("level").distinct().agg(F.sort_array(F.collect_list("level"))).scalar()
    rows = values.withColumn("_at", value).withColumn("level", F.explode(levels)).withColumn("cell", F.call_function("shiftright", F.col("_at"), F.col("level")))
    return rows.join(filed, ["level", "cell"]).filter((F.col("lo") <= F.col("_at")) & (F.col("_at") < F.col("hi"))).drop("level", "cell", "_at")


def first_match(rows: DataFrame, column: str, intervals: DataFrame, label: str, order: str, out: str) -> DataFrame:
    """rows with ``out``: the label of the interval of the lowest ``order`` that holds the value (a long or a date), null without one.

    intervals: lo, hi (as the value; the end is not in), label, order.  Each distinct value is looked up once, so a value that
    many rows have costs one search, and the rows meet a table of as many values as there are."""
    dates = rows.schema[column].dataType.typeName() == "date"
    number = (lambda c: F.unix_date(c).cast("long")) if dates else (lambda c: F.col(c).cast("long"))
    some = intervals.select(number("lo").alias("lo"), number("hi").alias("hi"), F.col(label).alias("_label"), F.col(order).alias("_order"))
    values = rows.select(F.col(column).alias("_value")).filter("_value IS NOT NULL").distinct()
    named = covering(values, number("_value"), some).groupBy("_value").agg(F.min_by("_label", "_order").alias(out))
    return rows.join(named, F.col(column) == F.col("_value"), "left").drop("_value")
