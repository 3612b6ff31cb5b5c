"""Language identification of mixed-language text.

The script ranges of a word's letters narrow its candidate languages to those that use the script.  Each word is
scored per language by smoothed character n-grams, and a Viterbi pass with a fixed penalty for each switch labels
runs of words.  The prediction is the language with the most letters.

Most texts hold one language.  For those the constant path is proved optimal without a step through the words: if
no stretch of words gains more than one penalty by leaving the best single language, no path with a switch can win.
All other texts take the exact Viterbi pass.

Training: ``fit`` counts n-grams over at most about ``TRAIN_ROWS`` labelled documents, whole texts, chosen by hash.

Defined cases: null, empty or letterless text gives ``und`` with score 0; ties go to the first language in code point
order; without any labelled row every text gives ``und``; rows repeat as they come; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import picked
from .words import WordCache, blocks, grams, held, letters, trim

#: Bound on the expected number of training documents.
TRAIN_ROWS = 20_000
BITS, SIZES = 16, (1, 2, 3, 4)
#: Nats that a change of language must gain.
PENALTY = 12.0
SMOOTH = 0.5
#: A language uses a script if the script has at least this share of its letters.
SHARE = 0.01
#: First code points of blocks and their scripts (Unicode block ranges).
RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "other"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"),
)
_STARTS = np.array([a for a, _ in RANGES])
SCRIPTS = sorted({s for _, s in RANGES})
_SCRIPT_OF = np.array([SCRIPTS.index(s) for _, s in RANGES])


def _scripts(points: np.ndarray) -> np.ndarray:
    return _SCRIPT_OF[np.searchsorted(_STARTS, points.astype(np.int64), "right") - 1]


def _sample(docs: DataFrame, rows: int, seed: int) -> DataFrame:
    n = docs.count()
    share = min(1.0, rows / n) if n else 1.0
    return docs.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))


def _count(batches):
    """lang, kind (0 n-gram, 1 script), bucket, n: summed over a task."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            count, script = held.setdefault(lang, (np.zeros(1 << BITS, np.int64), np.zeros(len(SCRIPTS), np.int64)))
            for part in blocks(text or b""):
                if not (words := part.split()):
                    continue
                points, of = letters(words)
                script += np.bincount(_scripts(points[points > 0]), minlength=len(SCRIPTS))
                for _, bucket in grams(points, of, SIZES, BITS):
                    count += np.bincount(bucket, minlength=1 << BITS)
    for lang, both in held.items():
        for kind, values in enumerate(both):
            at = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(values[at])], ["lang", "kind", "bucket", "n"])


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS, seed: int = 7) -> dict:
    """labelled: doc_id, text, lang (not null).  The model has one row of 2**BITS log-probabilities per language."""
    ship(labelled.sparkSession)
    sample = _sample(labelled, rows, seed).select(F.col("text").cast("binary").alias("text"), "lang").repartition(8)
    counts = sample.mapInArrow(_count, "lang string, kind int, bucket int, n long").groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
    kind, bucket, n = (counts.column(k).to_numpy() for k in ("kind", "bucket", "n"))
    names = counts.column("lang").to_pylist()
    langs = sorted(set(names))
    of = np.array([langs.index(x) for x in names], int) if langs else np.zeros(0, int)
    gram, script = np.zeros((len(langs), 1 << BITS)), np.zeros((len(langs), len(SCRIPTS)))
    np.add.at(gram, (of[kind == 0], bucket[kind == 0]), n[kind == 0])
    np.add.at(script, (of[kind == 1], bucket[kind == 1]), n[kind == 1])
    logs = np.log((gram + SMOOTH) / (gram.sum(1, keepdims=True) + SMOOTH * (1 << BITS)))
    uses = script >= SHARE * np.maximum(script.sum(1, keepdims=True), 1)
    return {"id": uuid.uuid4().hex, "langs": langs, "logs": np.ascontiguousarray((logs - logs.mean(0)).T.astype(np.float32)) if langs else logs.T, "uses": uses}


def word_scores(words: list[bytes], model: dict) -> np.ndarray:
    """One row a word: its letters, then its score in each language.  Scripts that a language doesn't use rule it out, unless no language uses any."""
    k = len(model["langs"])
    out = np.zeros((len(words), k + 1), np.float32)
    points, of = letters(words)
    is_letter = points > 0
    out[:, 0] = np.bincount(of[is_letter], minlength=len(words))
    for word, bucket in grams(points, of, SIZES, BITS):
        part = model["logs"][bucket]
        for j in range(k):
            out[:, j + 1] += np.bincount(word, part[:, j], len(words)).astype(np.float32)
    script = _scripts(points[is_letter])
    for s in np.unique(script):
        has = np.unique(of[is_letter][script == s])
        able = model["uses"][:, s]
        if able.any():
            out[np.ix_(has, 1 + np.flatnonzero(~able))] -= 2 * PENALTY
        else:
            out[has, 1:] = 0
    return out


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best label for each row: sums of scores less penalty for each change; ties to the lower label."""
    total = scores.sum(0, dtype=np.float64)
    best = int(total.argmax())
    k = scores.shape[1]
    if k == 1 or len(scores) == 0:
        return np.zeros(len(scores), np.int64)
    gain = np.cumsum(np.delete(scores, best, 1).max(1).astype(np.float64) - scores[:, best])
    before = np.minimum.accumulate(np.concatenate(([0.0], gain[:-1])))
    if (gain - before).max() <= penalty:
        return np.full(len(scores), best, np.int64)
    value, back = [0.0] * k, np.zeros((len(scores), k), np.int16)
    labels = range(k)
    for t, row in enumerate(scores.astype(np.float64).tolist()):
        top = max(labels, key=value.__getitem__)
        cut = value[top] - penalty
        if t:
            for j in labels:
                if value[j] < cut:
                    value[j], back[t, j] = cut, top
                else:
                    back[t, j] = j
        for j in labels:
            value[j] += row[j]
    path = np.zeros(len(scores), np.int64)
    at = max(labels, key=value.__getitem__)
    for t in range(len(scores) - 1, -1, -1):
        path[t] = at
        at = back[t, at]
    return path


def identify(text: bytes | None, model: dict, cache: WordCache, penalty: float = PENALTY):
    """(language or und, score, runs of words as (first, end, language)).  Runs cover the words from the first with letters on."""
    rows = [cache.get(words) for part in blocks(text or b"") if (words := part.split())]
    if not rows or not model["langs"]:
        return "und", 0.0, []
    table = np.concatenate(rows)
    length, scores = table[:, 0].astype(np.float64), table[:, 1:]
    if not length.any():
        return "und", 0.0, []
    path = viterbi(scores, penalty)
    k = len(model["langs"])
    share = np.bincount(path, length, k)
    best = int(share.argmax())
    total = scores[path == best].sum(0, dtype=np.float64) if (path == best).any() else scores.sum(0)
    odds = np.exp(np.clip(np.delete(total, best) - total[best], -50, 50)).sum() if k > 1 else 0.0
    ends = np.flatnonzero(np.diff(path)) + 1
    runs = [(int(a), int(b), model["langs"][path[a]]) for a, b in zip([0, *ends], [*ends, len(path)], strict=True)]
    return model["langs"][best], float(share[best] / length.sum() / (1 + odds)), runs


SCHEMA = "doc_id long, lang_pred string, score double, spans array<struct<first:int,end:int,lang:string>>"


def label_spans(docs: DataFrame, model: dict, penalty: float = PENALTY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score and spans, the runs of words by number (first, end exclusive)."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        cache = held(m["id"], lambda: WordCache(lambda words: word_scores(words, m)))
        for batch in batches:
            found = [identify(t, m, cache, penalty) for t in batch.column(1).to_pylist()]
            spans = pa.array([[{"first": a, "end": b, "lang": x} for a, b, x in f[2]] for f in found], pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), spans], ["doc_id", "lang_pred", "score", "spans"])

    return picked(docs, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("binary")}).mapInArrow(run, SCHEMA)


def accepted(docs: DataFrame, model: dict, least: float = 0.3, penalty: float = PENALTY, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose text has a language with a score of at least ``least``."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        cache = held(m["id"], lambda: WordCache(lambda words: word_scores(words, m)))
        for batch in batches:
            found = (identify(None if t is None else t.encode("utf-8", "replace"), m, cache, penalty) for t in batch.column(at).to_pylist())
            yield batch.filter(pa.array([lang != "und" and score >= least for lang, score, _ in found], pa.bool_()))
        trim()

    return docs.mapInArrow(run, docs.schema)


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def trained(docs: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """A model from the documents that aren't held out."""
    return fit(docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang"), rows)
