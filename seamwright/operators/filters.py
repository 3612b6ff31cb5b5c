"""Declarative row filters: eq, in, range, is_null, not_null; all must hold, null never passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a rule of each operator must have, and the predicate it stands for (column, rule, cast to the column's type).
_OPS = {
    "eq": (lambda r: "value" in r, "value", lambda c, r, cast: c == cast(r["value"])),
    "in": (lambda r: isinstance(r.get("values"), (list, tuple)) and len(r["values"]) > 0, "values that aren't empty", lambda c, r, cast: c.isin(*map(cast, r["values"]))),
    "range": (lambda r: r.get("min") is not None or r.get("max") is not None, "min or max", lambda c, r, cast: _within(c, *(None if r.get(k) is None else cast(r[k]) for k in ("min", "max")))),
    "is_null": (lambda r: True, "", lambda c, r, cast: c.isNull()),
    "not_null": (lambda r: True, "", lambda c, r, cast: c.isNotNull()),
}


def _within(c: Column, low: Column | None, high: Column | None) -> Column:
    out = F.lit(True) if low is None else c >= low
    return out if high is None else out & (c <= high)


def validate(df: DataFrame, rules: list[dict], logic: str = "and") -> None:
    """Raises ValueError for the first thing wrong."""
    if logic != "and":
        raise ValueError(f"filter logic must be 'and', not {logic!r}")
    for rule in rules:
        if rule.get("field") not in df.columns:
            raise ValueError(f"unknown field {rule.get('field')!r}")
        if rule.get("op") not in _OPS:
            raise ValueError(f"unsupported op {rule.get('op')!r}")
        complete, needs, _ = _OPS[rule["op"]]
        if not complete(rule):
            raise ValueError(f"{rule['op']} needs {needs}")


def predicate(df: DataFrame, rules: list[dict]) -> Column:
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def one(rule):
        return F.coalesce(_OPS[rule["op"]][2](F.col(rule["field"]), rule, lambda v: F.lit(v).cast(kinds[rule["field"]])), F.lit(False))

    return reduce(lambda a, b: a & b, map(one, rules), F.lit(True))


def apply_filters(df: DataFrame, rules: list[dict], logic: str = "and") -> DataFrame:
    validate(df, rules, logic)
    return df.filter(predicate(df, rules))


def summary(df: DataFrame, rules: list[dict], logic: str = "and") -> DataFrame:
    validate(df, rules, logic)
    got = df.agg(F.count("*").alias("rows_in"), F.coalesce(F.sum(predicate(df, rules).cast("long")), F.lit(0)).alias("rows_out"))
    return got.select(F.lit(len(rules)).alias("n_rules"), "rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("rows_dropped"), F.round(100.0 * F.col("rows_out") / F.greatest("rows_in", F.lit(1)), 4).alias("retained_pct"))


def exclude_groups(df: DataFrame, field: str, groups: list[str]) -> DataFrame:
    """Anti-filter on the value as text; null groups stay."""
    return df.filter(F.col(field).isNull() | ~F.col(field).cast("string").isin(*groups))
