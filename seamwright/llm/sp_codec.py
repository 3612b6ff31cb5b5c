"""SentencePiece encoding and decoding on the tokenizers library.

``parse`` reads the model protobuf's wire format; ``build`` makes a tokenizer of it: the normaliser (precompiled map,
extra white space, dummy prefix, the marker for spaces), the model (unigram scores, or BPE merges ranked by the scores
of what they make) and byte fallback, with the matching decoder.

Ids come from the tokenizers library.  Parity is verified: every text is also encoded by the sentencepiece library as a whole.
Where that differs each of the text's cuts is encoded by both and takes sentencepiece's ids where they differ; if the text still
differs (a cut at a wrong place), it has sentencepiece's ids.  ``misses`` counts the cuts and whole texts that differ.

For BPE models with byte fallback and an identity normaliser a text is cut before each run of spaces and around line feeds
where no piece of the vocabulary reaches across (checked on the vocabulary): merges never cross such a cut and no
character is unknown, so the ids of the cuts are those of the text.  Each distinct cut is encoded once per worker, in
batches that the library spreads over threads.  All other models (unigram above all, whose runs of unknown characters may
span a cut) get whole texts, in batches too.  A marker that stands in the text is a space to such a model, and is taken for
one before the text is cut.

Defined cases: null text counts as empty; an empty text has no ids and decodes to itself; characters outside the
vocabulary become bytes; rows repeat as they come; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import picked
from .words import IdTable, cached_ids, frugal, held, trim

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Threads that a worker encodes with.
THREADS = 2
#: Cuts encoded at once, and bytes of text looked up at once.
SLICE, LOOKED_UP = 1 << 14, 1 << 20
#: One text in so many is compared as a whole, if it has no more bytes than this: all, of any length.
WHOLE, WHOLE_BYTES = 1, float("inf")
_MARK = MARK.encode()
_CUT, _EDGE = re.compile(rb" *[^ \n]+| +|\n"), re.compile(rb"[^ ][ \n]")


def _parts(text: bytes, size: int):
    """A text in parts cut before a line feed or the first of a run of spaces."""
    at = 0
    while at < len(text):
        edge = _EDGE.search(text, at + size)
        end = edge.start() + 1 if edge else len(text)
        yield text[at:end]
        at = end


def _fields(data: bytes):
    """(field number, value) of one protobuf message; varints as ints, the rest as bytes."""
    at = 0

    def varint():
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value = data[at : at + size]
            at += size
        yield key >> 3, value


def parse(data: bytes) -> dict:
    """pieces as (text, score, type); kind; unk; normaliser settings."""
    pieces, trainer, norm = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            f = dict(_fields(value))
            pieces.append((f[1].decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            norm = dict(_fields(value))
    return {
        "pieces": pieces, "kind": trainer.get(3, UNIGRAM), "unk": next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0), "bytes": bool(trainer.get(35, 0)),
        "map": norm.get(2, b""), "prefix": bool(norm.get(3, 1)), "squeeze": bool(norm.get(4, 1)), "mark": bool(norm.get(5, 1)),
    }


def merges(pieces) -> list[tuple[str, str]]:
    """Every way to make a piece of two others, best score first; ways to make the same piece by the left part's place."""
    score = {t: s for t, s, kind in pieces if kind in (NORMAL, USER)}
    found = []
    for text, s in score.items():
        for i in range(1, len(text)):
            if text[:i] in score and text[i:] in score:
                found.append((-s, text, i))
    found.sort()
    return [(t[:i], t[i:]) for _, t, i in found]


def build(model: dict, prefix: bool = True):
    """The tokenizer.  prefix=False leaves out the dummy prefix, for cuts of a text that already has it."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    pieces = model["pieces"]
    if model["kind"] == UNIGRAM:
        core = models.Unigram([(t, s) for t, s, _ in pieces], model["unk"], byte_fallback=model["bytes"])
    else:
        core = models.BPE({t: i for i, (t, _, _) in enumerate(pieces)}, merges(pieces), unk_token=pieces[model["unk"]][0], fuse_unk=True, byte_fallback=model["bytes"])
    tok = Tokenizer(core)
    steps = []
    if model["map"]:
        steps.append(normalizers.Precompiled(model["map"]))
    if model["squeeze"]:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
    if model["prefix"] and prefix:
        steps.append(normalizers.Prepend(" "))
    steps.append(normalizers.Replace(" ", MARK))
    tok.normalizer = normalizers.Sequence(steps)
    tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if model["prefix"] else [])])
    user = [AddedToken(t, normalized=True, special=False) for t, _, kind in pieces if kind == USER]
    if user:
        tok.add_tokens(user)
    return tok


def cuttable(model: dict) -> bool:
    """Whether the ids of a text are those of its cuts: BPE without unknown characters, no piece reaches over a cut, and the normaliser leaves the text as it is."""
    plain = model["kind"] == BPE and model["bytes"] and not model["map"] and not model["squeeze"]
    return plain and not any(MARK in t.lstrip(MARK) or "\n" in t for t, _, kind in model["pieces"] if kind in (NORMAL, USER))


class Codec:
    def __init__(self, path: str, threads: int = THREADS):
        frugal()
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))  # read once a process
        import sentencepiece

        with open(path, "rb") as f:
            data = f.read()
        self.model = parse(data)
        self.cut = cuttable(self.model)
        self.tok = build(self.model, prefix=not self.cut)
        # cuts come with their own prefix, so the reference must not add one
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=data + b"\x1a\x02\x18\x00" if self.cut else data)
        self.full = sentencepiece.SentencePieceProcessor(model_proto=data) if self.cut else self.bare
        lines = [i for i, (t, _, kind) in enumerate(self.model["pieces"]) if kind == BYTE and t == "<0x0A>"]
        self.line = lines[0] if self.cut and self.model["bytes"] and lines else None
        self.cache = IdTable(self._encode, limit=250_000, limit_bytes=32 << 20)
        self.table = [self._bytes(t, kind) for t, _, kind in self.model["pieces"]]
        self.right: dict[bytes, list[int] | None] = {}  # cuts that were compared: sentencepiece's ids where the libraries differ

    @staticmethod
    def _bytes(text: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        return b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else text.replace(MARK, " ").encode()

    def _both(self, texts: list[str]) -> tuple[list[list[int]], Callable[[], list[list[int]]]]:
        """Ids of the tokenizers library, and those of sentencepiece when they are called for."""
        os.environ["TOKENIZERS_PARALLELISM"] = "true"  # read at each call, and other operators in this process may say otherwise
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)], lambda: self.bare.encode(texts, num_threads=1)

    def _encode(self, cuts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """In slices: the library holds far more for a token than its id."""
        got = [self._slice(cuts[i : i + SLICE])[0]() for i in range(0, len(cuts), SLICE)]
        return np.concatenate([flat for flat, _ in got]), np.concatenate([sizes for _, sizes in got])

    def _slice(self, cuts: list[bytes]):
        """What gives ids and numbers of ids of the tokenizers library, and what gives those of sentencepiece."""
        # cuts never hold a line feed with other text, and no piece does, so many go as lines of one text
        feed = [i for i, c in enumerate(cuts) if c == b"\n"]
        rows = [c for c in cuts if c != b"\n"]
        if self.line is None:
            mine, theirs = self._both([c.decode("utf-8", "replace") for c in cuts])
            flat = lambda got: (np.fromiter((i for x in got for i in x), np.int32), np.array([len(x) for x in got], np.int64))
        else:
            mine, theirs = self._both([b"\n".join(rows[i : i + 64]).decode("utf-8", "replace") for i in range(0, len(rows), 64)])
            flat = lambda got: self._lines(got, feed)
        return lambda: flat(mine), lambda: flat(theirs())

    def _compared(self, text: bytes) -> tuple[np.ndarray, int]:
        """Ids of a text with sentencepiece's where a cut's differ, and how many cuts do."""
        used, misses = [np.zeros(0, np.int32)], 0
        for part in _parts(self._spaced(text), LOOKED_UP):
            cuts = _CUT.findall(part)
            if len(self.right) > self.cache.limit:
                self.right.clear()
            new = [c for c in dict.fromkeys(cuts) if c not in self.right]
            for i in range(0, len(new), SLICE):
                some = new[i : i + SLICE]
                mine, theirs = ([x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] for flat, sizes in (get() for get in self._slice(some)))
                self.right.update({c: None if a == b else b for c, a, b in zip(some, mine, theirs, strict=True)})
            ids, sizes = self.cache.get(cuts)
            ends = np.cumsum(sizes)
            for c, start, end in zip(cuts, (ends - sizes).tolist(), ends.tolist(), strict=True):
                right = self.right[c]
                misses += right is not None
                used.append(ids[start:end] if right is None else np.array(right, np.int32))
        return np.concatenate(used), misses

    def _lines(self, got: list[list[int]], feed: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of the lines of all texts, with those of a lone line feed put in its place."""
        flat = np.concatenate([np.zeros(0, np.int32), *(np.array([*ids, self.line], np.int32) for ids in got)])
        ends = np.flatnonzero(flat == self.line)
        sizes = np.diff(np.concatenate(([-1], ends))) - 1
        flat = np.delete(flat, ends)
        for i in feed:
            flat = np.insert(flat, int(sizes[:i].sum()), self.line)
            sizes = np.insert(sizes, i, 1)
        return flat, sizes

    def pieces(self, text: bytes) -> list[bytes]:
        """The cuts of a text."""
        return _CUT.findall(self._spaced(text))

    def _spaced(self, text: bytes) -> bytes:
        """A text as it is cut: with its prefix, and spaces for markers."""
        text = text.replace(_MARK, b" ")
        return b" " + text if text and self.model["prefix"] else text

    def _whole(self, texts: list[bytes | None]):
        """Texts in batches of about LOOKED_UP bytes, without cuts; a difference is one of the whole text."""
        at = 0
        while at < len(texts):
            batch, held_bytes = [], 0
            while at < len(texts) and held_bytes < LOOKED_UP:
                batch.append((texts[at] or b"").decode("utf-8", "replace"))
                held_bytes += len(texts[at] or b"")
                at += 1
            got, full = self._both(batch)
            for mine, theirs in zip(got, full(), strict=True):
                yield np.array(mine if mine == theirs else theirs, np.int32), int(mine != theirs)

    def encode(self, texts: list[bytes | None]):
        """Yields (ids, cuts on which the two libraries differ) for each text."""
        if not self.cut:
            yield from self._whole(texts)
            return
        at = 0
        for ids, ends in cached_ids([self._spaced(t or b"") for t in texts], _CUT.findall, self.cache, LOOKED_UP, _parts):
            for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                text, own, misses, theirs = texts[at] or b"", ids[a:b], 0, None
                if (_MARK in text or zlib.crc32(text) % WHOLE == 0) and len(text) <= WHOLE_BYTES:
                    theirs = self.full.encode(text.decode("utf-8", "replace"))
                    theirs = np.fromiter(theirs, np.int32, len(theirs))
                if theirs is None or not np.array_equal(own, theirs):
                    own, misses = self._compared(text)
                    if theirs is not None and not np.array_equal(own, theirs):
                        own, misses = theirs, misses + 1
                yield own, misses
                at += 1

    def decode(self, ids) -> bytes:
        out = b"".join(map(self.table.__getitem__, ids))
        return out[1:] if self.model["prefix"] and out[:1] == b" " else out


def codec(path: str, threads: int = THREADS) -> Codec:
    return held(f"pieces:{path}", lambda: Codec(path, threads))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, path: str | None = None, threads: int = THREADS, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, ids, misses, and the string columns named in ``keep``."""
    ship(docs.sparkSession)
    path = path or default_path()
    names = ["doc_id", "ids", "misses", *keep]

    def run(batches):
        c = codec(path, threads)
        for batch in batches:
            got = list(c.encode(batch.column(1).to_pylist()))
            ends = np.concatenate(([0], np.cumsum([len(i) for i, _ in got]))).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *(i for i, _ in got)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array([m for _, m in got], pa.int64()), *(batch.column(2 + k) for k in range(len(keep)))], names)
            del got, ids
            trim()

    rows = picked(docs, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("binary")} | {c: F.col(c).cast("string") for c in keep})
    return rows.mapInArrow(run, "doc_id long, ids array<int>, misses long" + "".join(f", {c} string" for c in keep))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text from doc_id, ids."""
    ship(encoded.sparkSession)
    path = path or default_path()

    def run(batches):
        c = codec(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if i is None else c.decode(i).decode("utf-8", "replace") for i in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None, threads: int = THREADS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every text: doc_id, n_ids, ids_crc32 (little-endian unsigned 32-bit), misses, same."""
    ship(docs.sparkSession)
    path = path or default_path()

    def run(batches):
        c = codec(path, threads)
        for batch in batches:
            rows = []
            texts = batch.column(1).to_pylist()
            for t, (ids, misses) in zip(texts, c.encode(texts), strict=True):
                rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), misses, c.decode(ids.tolist()) == (t or b"")))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], pa.bool_() if k == 3 else pa.int64()) for k in range(4))], ["doc_id", "n_ids", "ids_crc32", "misses", "same"])

    return picked(docs, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("binary")}).mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, misses long, same boolean")
