"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text is normalised (each run of ``[\\x20\\x09-\\x0D]`` becomes one space) and cut where its own content says so:
after at least ``MIN_CHUNK`` characters, behind the next place whose last four characters fit ``CUT``, or at
``MAX_CHUNK``.  Each chunk gets a 128-bit identifier.  The distinct (identifier, chunk) pairs are grouped once to
verify that no identifier stands for two contents; if one did, the identifiers become SHA-256 and are verified
again.  From then on documents are compared as ordered lists of identifiers (recipes), which move once; rows find
their group by the digest of their text.  ``exact_groups`` moves no text after the verification, and
``distinct_documents`` only where more rows go than may be broadcast.

Defined cases: null text counts as empty; empty texts are equal to each other; a row repeated with the same doc_id
counts in group_size and is ``kept`` like its twin; a null doc_id never wins over a number; an empty table gives no
rows; extra columns of the input are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach, durable, picked

MIN_CHUNK, MAX_CHUNK = 512, 8192
CUT = "(?<=[aeiou][nrst][gdhe] )"


def normalised(text: Column) -> Column:
    """Single spaces are left alone, so that only runs that change are rewritten."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*", " ")


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?:{CUT}|\z)|.{{1,{MAX_CHUNK}}}"), F.lit(0))


def _identifier(chunk: Column, strong: bool) -> Column:
    return F.array(F.sha2(chunk, 256)) if strong else F.array(F.xxhash64(chunk), F.xxhash64(F.lit(1), chunk))


def verified(texts: DataFrame, strong: bool) -> bool:
    """Whether every identifier stands for one chunk content.  Each distinct content of a task moves once."""
    pieces = texts.select(F.explode(chunks(F.col("t"))).alias("chunk"))
    distinct = pieces.select(_identifier(F.col("chunk"), strong).alias("id"), "chunk").distinct()
    return distinct.groupBy("id").count().filter("count > 1").isEmpty()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    texts = picked(docs, {"doc_id": F.col(id_col), "t": normalised(F.col(text_col))})
    strong = not verified(texts, False)
    if strong and not verified(texts, True):
        raise ValueError("two chunks share a SHA-256")
    recipe = F.flatten(F.transform(chunks(F.col("t")), lambda c: _identifier(c, strong)))
    rows = durable(texts.select("doc_id", F.sha2("t", 256).alias("text_sha256"), recipe.alias("recipe")), "recipes")
    groups = rows.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.first("text_sha256").alias("text_sha256"))
    groups = durable(groups.filter("group_size > 1").drop("recipe"), "groups")
    out = attach(rows.drop("recipe"), groups, "text_sha256", "group_size", rows.count())
    return out.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def distinct_documents(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of equal texts: that of the smallest doc_id, once if that row is repeated."""
    tag = uuid.uuid4().hex[:8]  # for names that no column of docs has
    ids, sha, own = f"_id{tag}", f"_sha{tag}", f"_own{tag}"
    found = exact_groups(docs).select(F.col("doc_id").alias(ids), F.unhex("text_sha256").alias(sha), "kept", "group_size")
    found = durable(found.filter("group_size > 1"), "decisions")
    lost = found.filter("NOT kept").select(ids, sha).distinct()
    twice = durable(found.filter("kept").groupBy(ids, sha).agg(F.count("*").alias("n")).filter("n > 1").select(ids, sha), "repeats")
    lost = durable(lost.unionByName(twice), "lost")
    few = lost.count() <= BROADCAST_ROWS
    keyed = docs.withColumn(own, F.unhex(F.sha2(normalised(F.col("text")), 256)))
    same = keyed["doc_id"].eqNullSafe(F.col(ids)) & (keyed[own] == F.col(sha))
    out = keyed.join(F.broadcast(lost) if few else lost, same, "left_anti")
    if not twice.isEmpty():  # rows that repeat doc_id and text alike: one of each
        out = out.unionByName(keyed.join(F.broadcast(twice) if few else twice, same, "left_semi").dropDuplicates(["doc_id", own]))
    return out.drop(own)


ORACLE = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""
