"""Target-distribution importance resampling over hashed n-grams.

A document's features are its runs of 1 to ``SIZES`` consecutive words; a feature's bucket is the CRC-32 of its bytes
modulo ``BUCKETS``.  No n-gram is ever put together as a string: each distinct word of a batch gets its CRC once, and the
CRC of a longer run follows from those of its parts, ``crc(A + B) = S(len(B)) * crc(A) ^ crc(B)``, where ``S(n)`` is the
32 x 32 matrix over GF(2) that shifts a CRC past n bytes.  Matrices are composed by squaring and applied as four tables of
256 numbers; lengths of 64 and more as a product of a short shift and powers of two.

Two passes over the corpus: bucket counts (10,000 sums for each partition), then each document's sum of gains.  The 10,000
gains, a fixed number whatever the corpus, are all that the driver sends to the tasks.  Ranks are prefix sums over ranges
of the score, so no task holds all documents.

Defined cases: null text has no words, so no features, weight 0 and no rank; a null doc_id takes part in the lot as the
empty string and loses ties; rows that repeat a doc_id are scored one by one; an empty corpus gives no rows; an empty target
gives every bucket the gain of t = 0; words of any length count whole; extra columns are ignored by ``ranked`` and kept by
``resampled``.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import durable, picked, with_offsets
from .words import lower_ascii, ranges, trim

BUCKETS, SIZES, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: Bytes of text worked on at once, and the shortest shift that is put together from others.
_CHUNK, _DIRECT = 1 << 21, 64
#: Bytes of words: digits, letters of any script; A-Z are lower-cased before.
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _step_table() -> np.ndarray:
    """CRC-32 of each byte, reflected polynomial 0xEDB88320."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_STEP = _step_table()


def _tables(matrix: np.ndarray) -> np.ndarray:
    """A GF(2) matrix (its 32 columns as numbers) as four tables: the products with all values of each byte of a vector."""
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1 == 1
    return np.array([np.bitwise_xor.reduce(np.where(bits, matrix[8 * k : 8 * k + 8], np.uint32(0)), axis=1) for k in range(4)], np.uint32)


def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    return tables[0][x & 255] ^ tables[1][(x >> 8) & 255] ^ tables[2][(x >> 16) & 255] ^ tables[3][x >> 24]


def _shifts() -> tuple[np.ndarray, list[np.ndarray]]:
    """(tables for shifts by 0 .. 63 bytes; for 64, 128, 256 ... bytes)."""
    one = np.uint32(1) << np.arange(32, dtype=np.uint32)
    direct, matrix = [], one.copy()
    for _ in range(_DIRECT):
        direct.append(_tables(matrix))
        matrix = _STEP[matrix & 255] ^ (matrix >> 8)  # one byte more
    powers = []
    for _ in range(26):
        powers.append(_tables(matrix))
        matrix = _apply(powers[-1], matrix)  # the square
    return np.array(direct).reshape(-1), powers


_SHORT, _POWERS = _shifts()


def shift(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """S(by) * crc for each pair."""
    at = ((by & (_DIRECT - 1)) << 10).astype(np.int64)
    out = _SHORT[at + (crc & 255)] ^ _SHORT[at + 256 + ((crc >> 8) & 255)] ^ _SHORT[at + 512 + ((crc >> 16) & 255)] ^ _SHORT[at + 768 + (crc >> 24)]
    far = np.flatnonzero(by >= _DIRECT)
    if len(far):
        high, part = by[far] >> 6, out[far]
        for k, tables in enumerate(_POWERS):
            has = (high >> k) & 1 == 1
            if has.any():
                part[has] = _apply(tables, part[has])
        out[far] = part
    return out


def word_crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRC of each word, computed once for each distinct one.  data is lower-cased already."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    own = data[ranges(starts, sizes)]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(own)]).dictionary_encode()
    distinct, which = words.dictionary, words.indices.to_numpy()
    at = np.frombuffer(distinct.buffers()[1], np.int64)[: len(distinct) + 1]
    held = np.frombuffer(distinct.buffers()[2], np.uint8)
    length = np.diff(at)
    crc = np.full(len(distinct), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(length, _DIRECT + 1), kind="stable")
    long = int(np.searchsorted(-length[order], -_DIRECT))  # longer than the tables' reach: byte by byte in C
    for i in order[:long].tolist():
        crc[i] = zlib.crc32(held[at[i] : at[i + 1]])
    order = order[long:]
    first, size, value = at[order], length[order], crc[order]
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k))
        value[:n] = _STEP[(value[:n] ^ held[first[:n] + k]) & 255] ^ (value[:n] >> 8)
    crc[order] = ~value
    return crc[which]


_SPACE = np.uint32(zlib.crc32(b" "))


def _joined(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRC of left + space + right."""
    spaced = _STEP[left & 255] ^ (left >> 8) ^ _SPACE
    return shift(spaced, size) ^ right


def _words(text: bytes, doc: np.ndarray, ends: np.ndarray):
    """(crc, size, document) of all words of texts that lie one after another in ``text``, each ended by a byte that is no word's."""
    data = lower_ascii(np.frombuffer(text, np.uint8))
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[data]
    edge = np.diff(inside)
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sizes = stops - starts
    return word_crcs(data, starts, sizes), sizes, doc[np.searchsorted(ends, starts, side="right")]


def _pieces(text: bytes):
    """A long text in pieces of about _CHUNK bytes cut behind a byte that is no word's."""
    at = 0
    while at < len(text):
        end = min(len(text), at + _CHUNK)
        while end < len(text) and (_WORD[text[end - 1]] or 65 <= text[end - 1] <= 90):
            end += 1
        yield text[at:end]
        at = end


def features(texts: list[bytes | None], sizes: int = SIZES, buckets: int = BUCKETS):
    """Yields (buckets, documents they belong to, words of each document) for groups of texts; documents are numbers in ``texts``.

    A text longer than a group comes in several, each with the last words of the one before in front."""
    at = 0
    while at < len(texts):
        first, held, parts = at, 0, []
        while at < len(texts) and held < _CHUNK and len(texts[at] or b"") <= _CHUNK:
            parts.append(texts[at] or b"")
            held += len(parts[-1]) + 1
            at += 1
        if parts:
            ends = np.cumsum([len(p) + 1 for p in parts])
            crc, size, doc = _words(b" ".join(parts), np.arange(first, at + 1), ends)
            yield _grams(crc, size, doc, 0, sizes, buckets), np.bincount(doc - first, minlength=at - first), first
            continue
        crc, size = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        for piece in _pieces(texts[at]):
            new, new_size, _ = _words(piece, np.array([at, at]), np.array([len(piece) + 1]))
            kept = min(len(crc), sizes - 1)
            crc, size = np.concatenate((crc[len(crc) - kept :], new)), np.concatenate((size[len(size) - kept :], new_size))
            yield _grams(crc, size, np.full(len(crc), at), kept, sizes, buckets), np.array([len(new)]), at
        at += 1


def _grams(crc, size, doc, skip: int, sizes: int, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, documents) of the runs of each size that end behind the first ``skip`` words."""
    out, run = [(crc[skip:] % buckets, doc[skip:])], crc
    for n in range(1, sizes):
        run = _joined(run[:-1], crc[n:], size[n:]) if len(crc) > n else run[:0]  # run[i] has n + 1 words from word i
        own = doc[n:]
        good = np.flatnonzero(own == doc[: len(own)]) if len(run) else np.zeros(0, np.int64)
        good = good[good + n >= skip]
        out.append((run[good] % buckets, own[good]))
    return out


def bucket_counts(docs: DataFrame, text_col: str = "text", sizes: int = SIZES, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how often features of all texts fall into each bucket that has any."""
    ship(docs.sparkSession)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for grams, _, _ in features(batch.column(0).to_pylist(), sizes, buckets):
                for bucket, _ in grams:
                    total += np.bincount(bucket, minlength=buckets)
        trim()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    parts = picked(docs, {"text": F.col(text_col).cast("binary")}).mapInArrow(run, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", sizes: int = SIZES, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain: floor(1000 ln(target's smoothed share / corpus's smoothed share)), one row a bucket."""
    spark = docs.sparkSession
    have, want = durable(bucket_counts(docs, text_col, sizes, buckets), "corpus-buckets"), durable(bucket_counts(target, target_col, sizes, buckets), "target-buckets")
    total, goal = (x.agg(F.sum("n")).first()[0] or 0 for x in (have, want))
    rows = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    rows = rows.join(have.withColumnRenamed("n", "s"), "bucket", "left").join(want.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    up = (F.col("t") + 1).cast("double") * F.lit(float(total + buckets))
    down = (F.col("s") + 1).cast("double") * F.lit(float(goal + buckets))
    return rows.select("bucket", F.floor(1000 * F.log(up / down)).alias("gain"))


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", sizes: int = SIZES, keep: dict | None = None) -> DataFrame:
    """doc_id, n_features, weight, n_words and the kept columns, one row per document."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(gain)
    keep = keep or {}
    names = ["doc_id", "n_features", "weight", "n_words", *keep]

    def run(batches):
        table = shared.value
        for batch in batches:
            n = batch.num_rows
            weight, counted, words = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for grams, own, first in features(batch.column(1).to_pylist(), sizes, len(table)):
                words[first : first + len(own)] += own
                for bucket, doc in grams:
                    if len(doc):
                        edge = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
                        weight[doc[edge]] += np.add.reduceat(table[bucket], edge)
                        counted[doc[edge]] += np.diff(np.concatenate((edge, [len(doc)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x) for x in (counted, weight, words)), *(batch.columns[2:])], names)
        trim()

    rows = picked(docs, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("binary")} | keep)
    return rows.mapInArrow(run, "doc_id long, n_features long, weight long, n_words long" + "".join(f", {k} binary" for k in keep))


def lot(doc_id, seed: int = SEED):
    """floor(1000 times a Gumbel number) of seed and doc_id alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, sizes: int = SIZES, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", keep: dict | None = None) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null if it isn't drawn), and the kept binary columns."""
    table = np.zeros(buckets, np.int64)
    for row in gains(docs, target, text_col, target_col, sizes, buckets).collect():  # as many rows as buckets
        table[row["bucket"]] = row["gain"]
    rows = weights(docs, table, id_col, text_col, sizes, keep)
    rows = rows.withColumn("score", F.col("weight") + lot(F.col("doc_id"), seed)).withColumn("_fit", (F.col("n_words") >= least_words).cast("long"))
    rows = durable(rows, "scores")
    drawn = (rows.agg(F.sum("_fit")).first()[0] or 0) * percent // 100
    order = [F.col("_fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    placed = with_offsets(rows, order, "_fit", "_before", "ranks")
    rank = F.when((F.col("_fit") == 1) & (F.col("_before") < drawn), F.col("_before") + 1)
    return placed.select("doc_id", "n_features", "weight", "score", rank.alias("rank"), *(keep or {}))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, **options) -> DataFrame:
    """The drawn rows of docs, all columns as they are.  Rows that repeat doc_id and text come together if one of them is drawn."""
    tag = uuid.uuid4().hex[:8]
    own, other, ids = f"_own{tag}", f"_key{tag}", f"_id{tag}"
    key = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    won = ranked(docs, target, percent, keep={"digest": key}, **options).filter("rank IS NOT NULL")
    won = durable(won.select(F.col("doc_id").alias(ids), F.col("digest").alias(other)), "drawn")
    keyed = docs.withColumn(own, key)
    return keyed.join(won, keyed["doc_id"].eqNullSafe(F.col(ids)) & (keyed[own] == F.col(other)), "left_semi").drop(own)


ORACLE = rf"""
WITH RECURSIVE bits AS (SELECT b, 0 AS i, b AS v FROM range(256) r(b)
  UNION ALL SELECT b, i + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE i < 8),
step AS MATERIALIZED (SELECT b, v FROM bits WHERE i = 8),
w AS MATERIALIZED (SELECT 0 AS kind, row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS l FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS MATERIALIZED (SELECT kind, r, unnest([array_to_string(l[i:i + n - 1], ' ') FOR i IN range(1, len(l) - n + 2)]) AS feature FROM w, range(1, {SIZES + 1}) g(n) WHERE len(l) >= n),
d AS MATERIALIZED (SELECT feature, hex(encode(feature)) AS h, octet_length(encode(feature)) AS size FROM (SELECT DISTINCT feature FROM f)),
far AS (SELECT max(size) AS far FROM d),
part AS (SELECT 0 AS k, b, v FROM step UNION ALL SELECT k + 1, part.b, xor(step.v, part.v >> 8) FROM part JOIN step ON step.b = part.v & 255 WHERE k < (SELECT far FROM far)),
start AS (SELECT 0 AS k, 4294967295 AS v UNION ALL SELECT k + 1, xor(step.v, start.v >> 8) FROM start JOIN step ON step.b = start.v & 255 WHERE k < (SELECT far FROM far)),
digit AS (SELECT b, printf('%02X', b) AS h FROM range(256) r(b)),
tab AS MATERIALIZED (SELECT k, digit.h, v FROM part JOIN digit USING (b)),
x AS (SELECT feature, size, unnest(range(0, size)) AS i, h FROM d),
c AS (SELECT x.feature, any_value(x.size) AS size, bit_xor(tab.v) AS v FROM x JOIN tab ON tab.k = x.size - 1 - x.i AND tab.h = substr(x.h, CAST(2 * x.i + 1 AS BIGINT), 2) GROUP BY x.feature),
crc AS MATERIALIZED (SELECT feature, xor(xor(c.v, start.v), 4294967295) % {BUCKETS} AS bucket FROM c JOIN start ON start.k = c.size),
n AS (SELECT bucket, count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM f JOIN crc USING (feature) GROUP BY bucket),
z AS (SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM n),
g AS (SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (s_all + {BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * (t_all + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain FROM n, z),
p AS (SELECT r, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN crc USING (feature) JOIN g USING (bucket) WHERE kind = 0 GROUP BY r),
q AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(l) >= {LEAST_WORDS} AS fit,
  CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
  FROM w LEFT JOIN p USING (r) WHERE kind = 0),
o AS (SELECT *, row_number() OVER (ORDER BY fit DESC, score DESC, doc_id NULLS LAST) AS k FROM q)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND k <= (SELECT count(*) FROM q WHERE fit) * {PERCENT} // 100 THEN k END AS rank FROM o
"""
