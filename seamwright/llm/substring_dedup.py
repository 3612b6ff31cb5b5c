"""Substring deduplication by hashing lines, the sentences in them, and passages chosen by content.

Units are the lines of a text; in lines of more than one, their sentences (a sentence ends with a word that ends in
``.``, ``!``, ``?`` or another script's mark) of at least ``LEAST_WORDS`` words; and passages of ``PASSAGE`` words
anywhere: of every ``WINDOW`` neighbouring ones the one of least hash, so that any ``PASSAGE + WINDOW - 1`` words that two
texts share hold a passage that is a unit of both, whatever stands around them.  In scripts that are written without
spaces every character is a word.  A unit is normalised (A-Z lower-cased, white space of any length alike) and named by a
128-bit BLAKE2b digest of its normalised bytes: units of one digest are equal, as nobody can make two that aren't.
Digests are grouped over all documents; the earliest occurrence by (doc_id, text, place) stays and every other one is
marked (in one text, if it doesn't overlap the first).  Marked units that touch or overlap form a span, which therefore
holds marked words only.  Spans of fewer than ``least_run`` words (default 0: none) stay; a caller who wants to leave
licence lines and headings alone sets it.  Spans are code points of the original text.  At either end of a shared run up
to ``WINDOW - 1`` words may stay, where no line or sentence begins or ends there; shared runs of fewer than
``PASSAGE + WINDOW - 1`` words leave only if they hold a unit.

Defined cases: null and empty texts have no units; a document is a doc_id with a text, so rows of one doc_id (or of none)
with different texts are documents of their own, and rows that repeat both count as one and share its spans; documents
of one doc_id rank by a digest of their texts; a null doc_id ranks last, and keep_id is null where only such documents
hold the unit; an empty table gives no rows; extra columns are ignored (and kept by ``cleaned``).
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ship
from .common import attach, durable, picked
from .words import window_hashes, word_spans

LEAST_WORDS = 3
PASSAGE, WINDOW = 20, 16
#: Last bytes of words that end a sentence, for marks of two and three bytes.
_ENDS = {n: np.array([int.from_bytes(c.encode(), "big") for c in "؟۔։።।॥။។。！？｡．…‼⁇⁈⁉" if len(c.encode()) == n]) for n in (2, 3)}
#: Code points of scripts written without spaces, with their punctuation: Thai and Lao, Myanmar, Khmer, kana, Han, full-width forms.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3000, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF00, 0xFF9F))
#: A unit in seven numbers: its document (see ``document_keys``), its digest, first and end word, first and end code point
#: (two in one, the first one high), and flags: 1 if an equal unit stands before it in this text, 2 if the doc_id is null.
_SCHEMA = "a long, k long, d1 long, d2 long, words long, places long, flags int"


def _words(text: bytes):
    """(bytes, first bytes, end bytes, hashes, normalised bytes, first bytes therein) of the words; characters of scripts without spaces are words of their own, a mark behind stays with its character."""
    data = np.frombuffer(text, np.uint8)
    lead = np.flatnonzero(data >= 0xE0)
    if len(lead):
        wide = np.concatenate((data, np.zeros(3, np.uint8))).astype(np.int32)
        code = (wide[lead] & 15) << 12 | (wide[lead + 1] & 63) << 6 | wide[lead + 2] & 63
        four = data[lead] >= 0xF0
        own = four & (data[lead] == 0xF0) & (wide[lead + 1] >= 0xA0) & (wide[lead + 1] < 0xB0)  # planes 2 and 3: Han
        for low, high in _UNSPACED:
            own |= ~four & (code >= low) & (code <= high)
        value = (wide[lead] << 16) | (wide[lead + 1] << 8) | wide[lead + 2]
        own_marks = own & np.isin(value, _ENDS[3])
        lead, size, marks = lead[own], np.where(four, 4, 3)[own], own_marks[own]
    if not len(lead):
        return data, *(got := word_spans(text)), *_normal(text, got)
    cuts = np.union1d(lead[~marks], lead + size)
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = np.setdiff1d(cuts, lead[marks])
    spaced = np.insert(data, cuts, 32).tobytes()
    starts, ends, hashes = got = word_spans(spaced)
    at = np.insert(np.arange(len(data)), cuts, -1)
    return data, at[starts], at[ends - 1] + 1, hashes, *_normal(spaced, got)


def _normal(text: bytes, words) -> tuple[bytes, np.ndarray]:
    """The words in lower case with one space behind each, and where each begins."""
    size = words[1] - words[0] + 1
    return b" ".join([*text.lower().split(), b""]), np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))


def _closes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which words end a sentence."""
    out = np.isin(data[ends - 1], (33, 46, 63))
    if (data >= 0x80).any():
        wide = np.concatenate((np.zeros(2, np.uint8), data)).astype(np.int32)
        two = (wide[ends] << 8) | wide[ends + 1]
        out |= np.isin(two, _ENDS[2]) | np.isin((wide[ends - 1] << 16) | two, _ENDS[3])
    return out


def _slid(x: np.ndarray, n: int, best) -> np.ndarray:
    """The best of each n neighbours."""
    size = 1
    while size < n:
        step = min(size, n - size)
        x = best(x[:-step], x[step:])
        size += step
    return x


def passages(hashes: np.ndarray, size: int = PASSAGE, window: int = WINDOW) -> np.ndarray:
    """First words of the passages that are units: those of least hash among ``window`` neighbours."""
    if len(hashes) < size or not size:
        return np.zeros(0, np.int64)
    key = window_hashes(hashes, size)
    n = min(window, len(key))
    least = _slid(key, n, np.minimum)
    pad = np.zeros(n - 1, np.uint64)
    chosen = _slid(np.concatenate((pad, least, pad)), n, np.maximum) == key
    new = np.concatenate(([True], key[1:] != key[:-1]))  # in a run of one word, passages side by side and the last
    chosen &= ((np.arange(len(key)) - np.flatnonzero(new)[np.cumsum(new) - 1]) % size == 0) | np.append(new[1:], True)
    return np.flatnonzero(chosen)


def units(text: bytes, least: int = LEAST_WORDS, passage: int = PASSAGE, window: int = WINDOW):
    """(digests, first words, end words, first bytes, end bytes, whether an equal unit stands before each in this text)."""
    data, starts, ends, hashes, normal, at = _words(text)
    if not len(starts):
        return None
    line = np.cumsum(data == 10)[starts]
    new_line = np.concatenate(([True], line[1:] != line[:-1]))
    new_sentence = new_line | np.concatenate(([True], _closes(data, ends)[:-1]))
    lines, sentences = np.flatnonzero(new_line), np.flatnonzero(new_sentence)
    line_end, sentence_end = np.append(lines[1:], len(starts)), np.append(sentences[1:], len(starts))
    long = sentence_end - sentences >= least
    # a line of one sentence that is long enough is that sentence
    own = (np.diff(np.append(np.searchsorted(sentences, lines), len(sentences))) > 1) | (line_end - lines < least)
    some = passages(hashes, passage, window)
    first = np.concatenate((sentences[long], lines[own], some))
    end = np.concatenate((sentence_end[long], line_end[own], some + passage))
    order = np.lexsort((end, first))
    first, end = first[order], end[order]
    seen: dict[bytes, int] = {}
    digests, again = [], []
    for a, b, e in zip(at[first].tolist(), (at[end] - 1).tolist(), end.tolist(), strict=True):
        digests.append(d := hashlib.blake2b(normal[a:b], digest_size=16).digest())
        again.append(seen.setdefault(d, e))
    return digests, first, end, starts[first], ends[end - 1], first >= np.array(again, np.int64)  # passages may overlap the first of their kind


def document_keys(doc_id, text):
    """(a, k): a document is a doc_id with a text (64-bit hash k); without doc_id a second hash stands for it."""
    return F.coalesce(doc_id, F.xxhash64(F.lit(1), text)).alias("a"), F.xxhash64(text).alias("k")


def unit_table(docs: DataFrame, least: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE, window: int = WINDOW) -> DataFrame:
    ship(docs.sparkSession)
    names = [x.split()[0] for x in _SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            owner, digests, parts = [], [], []
            for row, text in enumerate(batch.column(3).to_pylist()):
                got = units(text, least, passage, window) if text else None
                if got is None or not len(got[0]):
                    continue
                a, b = got[3], got[4]
                if not text.isascii():
                    at = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
                    a, b = at[a], at[b]
                owner.append(np.full(len(a), row))
                digests += got[0]
                parts.append(((got[1] << 32) | got[2], (a << 32) | b, got[5]))
            if parts:
                own = np.concatenate(owner)
                words, places, again = (np.concatenate(x) for x in zip(*parts, strict=True))
                d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                a, k, none = (batch.column(c).to_numpy(zero_copy_only=False)[own] for c in range(3))
                yield pa.RecordBatch.from_arrays([*map(pa.array, (a, k, d[:, 0], d[:, 1], words, places, (again + 2 * none).astype(np.int32)))], names)

    rows = picked(docs, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("binary")})
    return rows.select(*document_keys(F.col("doc_id"), F.col("text")), F.col("doc_id").isNull().cast("int").alias("none"), "text").mapInArrow(run, _SCHEMA)


def removals(docs: DataFrame, least: int = LEAST_WORDS, least_run: int = 0, passage: int = PASSAGE, window: int = WINDOW) -> DataFrame:
    """One row per removed span: doc_id, start, end, n_words, n_units, keep_id (lowest doc_id that keeps a unit of it), and a, k (see ``document_keys``)."""
    rows = durable(unit_table(docs, least, passage=passage, window=window), "units")
    none = F.col("flags") >= 2
    rank = F.struct(none.alias("none"), "a", "k")
    groups = rows.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(rank).alias("owner")).filter("n > 1")
    marked = attach(rows, durable(groups, "digests"), ["d1", "d2"], "n", rows.count(), "inner").filter((F.col("flags") % 2 == 1) | (rank != F.col("owner")))
    high, low = lambda c: F.shiftright(c, 32), lambda c: F.col(c).bitwiseAND(0xFFFFFFFF)
    keep = F.when(~F.col("owner.none"), F.col("owner.a")).alias("keep")
    marked = marked.select(none.alias("none"), "a", "k", high("words").alias("first"), low("words").alias("end"), high("places").alias("start_at"), low("places").alias("end_at"), keep)
    document = ["none", "a", "k"]
    w = Window.partitionBy(*document).orderBy("first", "end")
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    marked = marked.withColumn("before", F.coalesce(F.max("end").over(upto), F.lit(-1)))
    marked = marked.withColumn("new", F.coalesce((F.lag("first").over(w) != F.col("first")) | (F.lag("end").over(w) != F.col("end")), F.lit(True)))  # repeated rows bring each unit again
    marked = marked.withColumn("run", F.sum((F.col("first") > F.col("before")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = F.greatest(F.col("end") - F.greatest("first", "before"), F.lit(0))
    spans = marked.withColumn("own", own).groupBy(*document, "run").agg(
        F.min("start_at").alias("start"), F.max("end_at").alias("end"), F.sum("own").alias("n_words"), F.sum(F.col("new").cast("long")).alias("n_units"), F.min("keep").alias("keep_id")
    )
    return spans.filter(F.col("n_words") >= least_run).select(F.when(~F.col("none"), F.col("a")).alias("doc_id"), "start", "end", "n_words", "n_units", "keep_id", "a", "k")


def cleaned(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs with the spans cut out of ``text``; the spans of a document travel with it, offsets stay those of the original."""
    tag = uuid.uuid4().hex[:8]  # for names that no column of docs has
    ids, cut, a, k = (f"_{c}{tag}" for c in ("id", "cut", "a", "k"))
    per = spans.groupBy(F.col("doc_id").alias(ids), F.col("a").alias(a), F.col("k").alias(k)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cut))
    own_a, own_k = document_keys(docs["doc_id"].cast("long"), docs["text"].cast("binary"))
    joined = docs.join(per, docs["doc_id"].cast("long").eqNullSafe(F.col(ids)) & (own_a == F.col(a)) & (own_k == F.col(k)), "left")
    keep_from = F.concat(F.array(F.lit(0).cast("long")), F.transform(cut, lambda c: c["end"]))
    keep_to = F.concat(F.transform(cut, lambda c: c["start"]), F.array(F.length("text").cast("long")))
    kept = F.array_join(F.zip_with(keep_from, keep_to, lambda a, b: F.substring("text", (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))), "")
    return joined.withColumn("text", F.when(F.col(cut).isNull(), F.col("text")).otherwise(kept)).select(*docs.columns)
