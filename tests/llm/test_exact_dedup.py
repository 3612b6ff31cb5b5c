"""Rows that are equal after normalising, but not byte for byte."""

import pytest

from seamwright.llm import exact_dedup, ngram_join

SCHEMA = "doc_id long, text string, kept string, text_sha256 int"


@pytest.mark.parametrize("bound", [exact_dedup.BROADCAST_ROWS, 0])
def test_distinct_documents(spark, monkeypatch, bound):
    monkeypatch.setattr(exact_dedup, "BROADCAST_ROWS", bound)
    rows = [(1, "a  b"), (1, "a b"), (2, "a\nb"), (3, "c"), (3, "c"), (3, "d"), (None, "e"), (None, "e"), (None, "a b"), (4, None), (5, ""), (6, " "), (6, "x" * 30_000 + " y"), (7, "x" * 30_000 + "\ty")]
    df = spark.createDataFrame([(d, t, "k", 9) for d, t in rows], SCHEMA)
    left = exact_dedup.distinct_documents(df)
    assert left.columns == df.columns
    got = sorted(((r["doc_id"], " ".join((r["text"] or "").split())[:5]) for r in left.collect()), key=str)
    assert got == sorted([(1, "a b"), (3, "c"), (3, "d"), (None, "e"), (4, ""), (6, ""), (6, "xxxxx")], key=str)
    assert exact_dedup.distinct_documents(df.limit(0)).count() == 0


def test_chunk_identifiers_that_clash(spark, monkeypatch):
    """With a weak identifier the verification fails and SHA-256 takes over; results stay."""
    from pyspark.sql import functions as F

    whole = exact_dedup._identifier
    monkeypatch.setattr(exact_dedup, "_identifier", lambda chunk, strong: whole(chunk, True) if strong else F.array(F.length(chunk).cast("long"), F.lit(0).cast("long")))
    df = spark.createDataFrame([(1, "one", "k", 0), (2, "two", "k", 0), (3, "one", "k", 0)], SCHEMA)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in exact_dedup.exact_groups(df).collect()) == [(1, 1, 2), (2, 2, 1), (3, 1, 2)]


@pytest.mark.parametrize("bound", [exact_dedup.BROADCAST_ROWS, 0])
def test_one_document_of_each_near_group(spark, monkeypatch, bound):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", bound)
    a, b = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    rows = [(5, a), (5, b), (6, a + " one"), (7, b + " one"), (7, "other words"), (5, b + " two"), (None, a), (8, None), (9, " ")]
    df = spark.createDataFrame([(d, t, "k", 9) for d, t in rows], SCHEMA)
    left = ngram_join.distinct_documents(df)
    assert left.columns == df.columns
    got = sorted((r["doc_id"], r["text"]) for r in left.filter("doc_id IS NOT NULL AND doc_id < 8").collect())
    assert (5, a) in got and (7, "other words") in got and len(got) == 3 and got[1][1] in (b, b + " two")
    assert left.filter("doc_id IS NULL OR doc_id >= 8").count() == 3
