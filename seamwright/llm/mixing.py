"""Mixing sources to target weights.

Tokens (words) are summed per source; each source's target is its weight's share of a total, held at ``limit``
times its size with the excess reshared.  A source's repetition rate is target / size; each of its documents is
taken floor(rate) times and once more when a hash-seeded coin, uniform on [0, 1), falls below the fraction of the
rate.  ``tries`` seeds are tossed for every source at once and the seed whose sum comes nearest to the target is
used for that source (ties: the lowest), which narrows the spread that few long documents cause; ``tries=1`` is a
single toss.  The coin depends on doc_id and seed alone, so reruns agree.

Defined cases: null text has size 0 and is taken by the same rule (0 words); a null source is a source, last in
order; a source without words has target 0 and rate 0; repeated rows of one doc_id share their coin; a null doc_id
tosses as the empty string; an empty table gives no rows; extra columns are kept by ``mixed`` and ignored by
``plan``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, picked, with_offsets

WEIGHTS, LIMIT, TRIES = (5, 2, 1), 3, 16
#: Up to so many sources go by broadcast (each some tens of bytes); more go through a salted join.
BROADCAST_SOURCES, SALTS = 100_000, 32


def coin(doc_id, seed):
    """Uniform on [0, 1): the first 52 bits of an MD5 of seed and doc_id."""
    text = F.concat_ws(":", seed.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _copies(rate, doc_id, seed):
    return (F.floor(rate) + F.when(coin(doc_id, seed) < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """source, source_size, target.  The water level is found by a few rounds of three sums, whatever the number of sources."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_offsets(by.withColumn("_one", F.lit(1)), [F.col("source").asc_nulls_last()], "_one", "_rank", "sources")
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = durable(ranked.select("source", "source_size", w.alias("w")), "weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    rest, weight = total, None
    while True:
        # a source is held when limit * size <= rest * w / weight, all in whole numbers
        held = F.lit(False) if weight is None else (F.col("source_size").cast("decimal(38,0)") * (limit * weight) <= F.col("w").cast("decimal(38,0)") * rest)
        got = ranked.select(F.when(held, F.col("source_size") * limit).otherwise(0).alias("h"), F.when(held, 0).otherwise(F.col("w")).alias("f")).agg(F.sum("h"), F.sum("f")).first()
        new = (total - (got[0] or 0), got[1] or 0)
        if new == (rest, weight) or not new[1]:
            break
        rest, weight = new
    level = (F.col("w") * F.lit(rest)).cast("double") / F.lit(float(weight or 1))
    return ranked.select("source", "source_size", F.least((F.col("source_size") * limit).cast("double"), level).alias("target"))


def _with_source(rows: DataFrame, right: DataFrame, few: bool) -> DataFrame:
    """rows with the columns of right for their source (null is a source)."""
    right = right.withColumnRenamed("source", "_s")
    if few:
        return rows.join(F.broadcast(right), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    salted = right.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("_j", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return rows.join(salted, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_j") == F.col("_k"))).drop("_s", "_j", "_k")


def rates(docs: DataFrame, weights=WEIGHTS, limit: int = LIMIT, tries: int = TRIES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"):
    """(sizes: doc_id, source, size; rates: source, source_size, target, rate, seed; whether these are few)."""
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sizes = durable(picked(docs, {"doc_id": F.col(id_col), "source": F.col(source_col), "size": words}), "sizes")
    goal = targets(sizes, weights, limit).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    goal = durable(goal, "targets")
    few = goal.count() <= BROADCAST_SOURCES
    if tries == 1:
        return sizes, goal.withColumn("seed", F.lit(0)), few
    sums = [F.sum(F.col("size") * _copies(F.col("rate"), F.col("doc_id"), F.lit(k))).alias(f"t{k}") for k in range(tries)]
    best = _with_source(sizes, goal, few).groupBy("source", "source_size", "target", "rate").agg(*sums)
    order = F.array_sort(F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k).alias("seed")) for k in range(tries)]))
    return sizes, durable(best.select("source", "source_size", "target", "rate", order[0]["seed"].alias("seed")), "seeds"), few


def plan(docs: DataFrame, weights=WEIGHTS, limit: int = LIMIT, tries: int = TRIES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sizes, rated, few = rates(docs, weights, limit, tries, id_col, text_col, source_col)
    rows = _with_source(sizes, rated, few).withColumn("copies", _copies(F.col("rate"), F.col("doc_id"), F.col("seed")))
    return rows.withColumn("taken", F.col("size") * F.col("copies")).drop("rate", "seed")


def mixed(docs: DataFrame, weights=WEIGHTS, limit: int = LIMIT, tries: int = TRIES) -> DataFrame:
    """docs, each row as often as the mix takes it.  Texts don't move: only the rates of sources are joined."""
    _, rated, few = rates(docs, weights, limit, tries)
    tag = f"_m{uuid.uuid4().hex[:8]}"
    row = docs.select("doc_id", "source", F.struct(*[F.col(c) for c in docs.columns]).alias(tag))
    out = _with_source(row, rated.select("source", "rate", "seed"), few).withColumn("copies", _copies(F.col("rate"), F.col("doc_id"), F.col("seed")))
    return out.filter("copies > 0").select(F.explode(F.array_repeat(F.col(tag), F.col("copies").cast("int"))).alias(tag)).select(f"{tag}.*")


ORACLE = rf"""
WITH s AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
b AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM s GROUP BY source),
r AS (SELECT *, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS w FROM b),
o AS (SELECT *, row_number() OVER (ORDER BY source_size * 1.0 / w, source NULLS LAST) AS k FROM r),
c AS (SELECT *, (SELECT sum(source_size) FROM b) - coalesce(sum(3 * source_size) OVER p, 0) AS rest,
             (SELECT sum(w) FROM r) - coalesce(sum(w) OVER p, 0) AS weight
      FROM o WINDOW p AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT rest, weight FROM c WHERE 3 * source_size * weight > w * rest ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(3.0 * source_size, CAST(w * rest AS DOUBLE) / weight)::DOUBLE AS target FROM r, f),
d AS (SELECT s.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
e AS (SELECT d.*, seed, CAST(size * (floor(rate) + CASE WHEN
        CAST('0x' || substr(md5(seed || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0 < rate - floor(rate)
        THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM d, range({TRIES}) g(seed)),
q AS (SELECT source, seed, abs(sum(taken) - any_value(target)) AS off FROM e GROUP BY source, seed),
z AS (SELECT source, seed FROM q QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, seed) = 1)
SELECT doc_id, size, source_size, target, taken FROM e JOIN z ON e.seed = z.seed AND e.source IS NOT DISTINCT FROM z.source
"""
