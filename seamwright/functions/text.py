"""Text and identifier functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize(text: Column) -> Column:
    """Lower case, underscores as spaces, white space collapsed, punctuation off both ends."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(text), "_", " "), "[ \\t\\r\\n]+", " "), F.lit(" .,;:!?'\"()"))


def term_type(term: Column) -> Column:
    n = F.size(F.split(term, " "))
    return F.when(n == 1, "unigram").when(n == 2, "bigram").otherwise("ngram")


def topic_key(group: Column, topic: Column) -> Column:
    return F.concat_ws("|", group, topic.cast("string"))


def parse_topic(key: Column) -> Column:
    """The id behind the last bar; null if it isn't a number."""
    return F.substring_index(key, "|", -1).try_cast("double").cast("int")


def slug(text: Column, cap: int = 64) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""), 1, cap)


def json_number(text: Column, field: str) -> Column:
    return F.get_json_object(text, f"$.{field}").try_cast("long")


def clean_label(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "__[a-z_]+__\\s*", ""))


def link(base: str, fields: list[str], filter_field: str, ids: Column, limit: int = 500, most: int = 200) -> Column:
    """The address of a page that lists rows by id; null without ids.  An address holds ``most`` ids at most."""
    if not fields:
        raise ValueError("a link needs at least one field")
    quoted = F.url_encode(F.array_join(F.slice(ids.cast("array<string>"), 1, most), ","))
    address = F.concat(F.lit(f"{base}?fields="), F.url_encode(F.lit(",".join(fields))), F.lit("&f["), F.url_encode(F.lit(filter_field)), F.lit("]="), quoted, F.lit(f"&limit={limit}"))
    return F.when(F.size(ids) > 0, address)
