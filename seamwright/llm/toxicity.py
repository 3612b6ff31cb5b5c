"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the n-grams of each word (letters and digits, a mark at either end), hashed.  On the labelled sample the
documents of either class that hold an n-gram are counted; the log of the ratio of their smoothed shares scales that
n-gram's count, and logistic regression with an L2 penalty weighs the scaled features.  A text's score is
``sigmoid(bias + sum over its words of the word's n-gram weights)``: as the sum runs over words, each distinct word is
computed once per worker.  N-grams with a ratio near 1 or in very few documents are no evidence of either class and get no
weight, so that the sum over a very long clean text stays put; all others are features, however many.

Training: at most about ``TRAIN_ROWS`` labelled documents (whole texts), chosen by hash.

Defined cases: null and empty texts score sigmoid(bias); labels that are null are left out; a document labelled twice
counts twice; with labels of one class only, or none, every score is that class's share (0 without labels); rows repeat
as they come; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import picked
from .words import WordCache, blocks, grams, held, letters

#: Bound on the expected number of training documents.
TRAIN_ROWS = 20_000
BITS, SIZES = 18, (3, 4, 5, 6)
#: Least absolute log-count ratio and least number of documents of an n-gram that counts as evidence.
LEAST_RATIO, LEAST_DOCS = 1.5, 5
ALPHA, L2, STEPS = 1.0, 1e-5, 600


def _count(batches):
    """bucket, label, documents that hold the bucket; bucket -1: documents."""
    held = np.zeros((2, 1 << BITS), np.int64)
    docs = np.zeros(2, np.int64)
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            docs[label] += 1
            seen = np.zeros(1 << BITS, bool)
            for part in blocks(text or b""):
                if words := list(dict.fromkeys(part.split())):
                    for _, bucket in grams(*letters(words, True), SIZES, BITS):
                        seen[bucket] = True
            held[label] += seen
    for label in (0, 1):
        at = np.flatnonzero(held[label])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.full(len(at) + 1, label, np.int32)), pa.array(np.append(held[label][at], docs[label]))], ["bucket", "label", "n"])


def _features(place: np.ndarray):
    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                total = np.zeros(place.max() + 2, np.int64)
                for part in blocks(text or b""):
                    if words := part.split():
                        for _, bucket in grams(*letters(words, True), SIZES, BITS):
                            total += np.bincount(place[bucket] + 1, minlength=len(total))
                at = np.flatnonzero(total[1:])
                out.append((at.astype(np.int32), total[1:][at].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([a for a, _ in out], pa.list_(pa.int32())), pa.array([b for _, b in out], pa.list_(pa.int32()))], ["label", "at", "n"])

    return run


def _regress(y: np.ndarray, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """Logistic regression by Adam on the full sample."""
    w, b = np.zeros(k), float(np.log(y.mean() / (1 - y.mean())))
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, STEPS + 1):
        z = b + np.bincount(rows, values * w[cols], len(y))
        e = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - y
        g = np.append(np.bincount(cols, values * e[rows], k) / len(y) + L2 * w, e.mean())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS, seed: int = 11) -> dict:
    """labelled: doc_id, text, label (0 or 1).  The model: a weight for each of 2**BITS buckets and a bias."""
    ship(labelled.sparkSession)
    n = labelled.count()
    share = min(1.0, rows / n) if n else 1.0
    sample = labelled.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    sample = sample.select(F.col("text").cast("binary").alias("text"), F.col("label").cast("int").alias("label")).repartition(8)
    got = sample.mapInArrow(_count, "bucket int, label int, n long").groupBy("bucket", "label").agg(F.sum("n").alias("n")).toArrow()
    bucket, label, n = (got.column(k).to_numpy() for k in ("bucket", "label", "n"))
    docs = np.array([n[(bucket < 0) & (label == c)].sum() for c in (0, 1)], float)
    model = {"id": uuid.uuid4().hex, "weights": np.zeros(1 << BITS, np.float32), "bias": -60.0 if not docs.sum() else 60.0 if not docs[0] else -60.0}
    if not docs.all():
        return model
    held = np.zeros((2, 1 << BITS))
    np.add.at(held, (label[bucket >= 0], bucket[bucket >= 0]), n[bucket >= 0])
    ratio = np.log((held[1] + ALPHA) / (docs[1] + 2 * ALPHA)) - np.log((held[0] + ALPHA) / (docs[0] + 2 * ALPHA))
    kept = np.flatnonzero((np.abs(ratio) >= LEAST_RATIO) & (held.sum(0) >= LEAST_DOCS))
    if not len(kept):
        model["bias"] = float(np.log(docs[1] / docs[0]))
        return model
    place = np.full(1 << BITS, -1, np.int64)
    place[kept] = np.arange(len(kept))
    got = sample.mapInArrow(_features(place), "label int, at array<int>, n array<int>").toArrow()
    y = got.column("label").to_numpy().astype(float)
    lengths = np.array(got.column("at").combine_chunks().value_lengths().to_numpy(zero_copy_only=False), int)
    cols, counts = (got.column(k).combine_chunks().flatten().to_numpy() for k in ("at", "n"))
    w, b = _regress(y, np.repeat(np.arange(len(y)), lengths), cols, counts * ratio[kept][cols], len(kept))
    model["weights"][kept], model["bias"] = (w * ratio[kept]).astype(np.float32), b
    return model


def word_weights(words: list[bytes], model: dict) -> np.ndarray:
    out = np.zeros(len(words))
    for word, bucket in grams(*letters(words, True), SIZES, BITS):
        out += np.bincount(word, model["weights"][bucket], len(words))
    return out


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        cache = held(m["id"], lambda: WordCache(lambda words: word_weights(words, m)))
        for batch in batches:
            total = [m["bias"] + sum(float(cache.get(words).sum()) for part in blocks(t or b"") if (words := part.split())) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(np.array(total, float), -60, 60))), pa.float64())], ["doc_id", "score"])

    return picked(docs, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("binary")}).mapInArrow(run, "doc_id long, score double")


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """A model from the labelled documents that aren't held out."""
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out()).select("doc_id", F.col("toxic").alias("label"))
    n = known.count()
    share = min(1.0, rows / n) if n else 1.0
    known = known.filter(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    return fit(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"), rows)
