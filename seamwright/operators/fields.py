"""Derived calendar, status and priority fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_quarter(date: Column) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("_Q"), F.quarter(date).cast("string"))


def fiscal_year(date: Column) -> Column:
    """Years start in July: FY24 is July 2023 to June 2024."""
    year = F.year(date) + F.when(F.month(date) >= 7, 1).otherwise(0)
    return F.concat(F.lit("FY"), F.lpad((year % 100).cast("string"), 2, "0"))


def fiscal_half(date: Column) -> Column:
    return F.when(date.isNull(), None).when(F.month(date) >= 7, "H1").otherwise("H2")


def funding_status(done: Column, expires: Column, as_of: Column, live: bool = True) -> Column:
    status = F.when(done.isNotNull(), "Funded").when(expires <= as_of, "Expired")
    return status.otherwise("Live") if live else status


def waterfall(*cases: tuple[Column, str], default: str) -> Column:
    """The label of the first case that holds; null conditions don't."""
    out = None
    for condition, label in cases:
        c = F.coalesce(condition, F.lit(False))
        out = F.when(c, label) if out is None else out.when(c, label)
    return F.lit(default) if out is None else out.otherwise(default)


def token_waterfall(tokens: Column, priority: list[str], default: str = "__NA__") -> Column:
    """The first token of the priority list that the row has, without its marks."""
    found = F.filter(F.array(*[F.lit(p) for p in priority]), lambda p: F.array_contains(tokens, p))
    return F.coalesce(F.regexp_replace(F.get(found, F.lit(0)), "^__|__$", ""), F.lit(default))


def experience_years(date: Column, start_year: Column) -> Column:
    """Whole years from a start year to a date's year."""
    return F.year(date) - start_year


def modulo_sample(id_col: Column, of: int = 50, keep: int = 1) -> Column:
    """The rows of one residue class: a sample that a caller asks for."""
    return F.pmod(id_col, F.lit(of)) == keep


def zip5(zip_code: Column) -> Column:
    return F.substring(zip_code, 1, 5)


def date_bins(date: Column, bins: list[tuple[str, str, str]]) -> Column:
    """(label, first day, last day): the first bin that holds the date, both ends included."""
    out = None
    for label, first, last in bins:
        c = date.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        out = F.when(c, label) if out is None else out.when(c, label)
    return out


def local_date(timestamp: Column, zone: str = "America/New_York") -> Column:
    return F.to_date(F.from_utc_timestamp(timestamp, zone))


def crossed(*parts: Column, missing: str = "Unknown") -> Column:
    """Fields joined to one grouping field; null parts get a name."""
    return F.concat_ws(" | ", *[F.coalesce(p.cast("string"), F.lit(missing)) for p in parts])


def ordered_by(value: Column, order: list[str]) -> Column:
    """Sort key for an explicit order of categories; others come after them, null last."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), value)
    return F.when(value.isNull(), len(order) + 2).when(place > 0, place.cast("int")).otherwise(len(order) + 1)


def family(field: str, families: dict[str, list[str]], default: str) -> str:
    """The first family one of whose words the name of a grouping field holds: how thin its groups are likely to be."""
    name = field.lower()
    return next((k for k, words in families.items() if any(w in name for w in words)), default)
