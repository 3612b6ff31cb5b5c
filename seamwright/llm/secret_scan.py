"""Secret scanning: three fixed patterns, and random strings exposed by their token efficiency.

Natural words and names cost few tokens per character under a byte-pair vocabulary; random strings cost many.  A
candidate is a maximal run of ``[A-Za-z0-9+/_=-]`` with ``LEAST`` or more letters and digits - ``PLAIN`` or more if they are
letters of one case, but for a capital in front, as natural words are.  Known digests (a run of hex digits of a usual digest
length) and identifiers are excluded.  Identifiers are UUIDs, numbers, and two or more parts joined by ``_``, ``-``, ``/``,
``=`` or ``+``, each a number or a word: letters in lower case, upper case or capitalised that are at most ``SHORT`` or by
themselves token-efficient.  What then has fewer than ``RATIO`` characters per token is a span of kind ``random``.  Where
spans of the fixed patterns lie in a run, what is left between them is judged, and one random piece makes the whole run
random; a run that lies in one of them is no span of its own.

Fixed patterns, on ASCII in either case for ``assign``: see ASSIGN, ACCESS and the runs of 16 or more ``[0-9a-f]``.  A
match that is too short is dropped but still takes its characters.  Spans are code points of the whole text, end
exclusive, of the whole match.

Defined cases: null counts as empty; without spans the strings are empty (the digest is that of the empty string); equal
starts are ordered assign, access, hex, random; rows repeat as they come; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import picked

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST, PLAIN, RATIO = 12, 20, 2.0
#: Letters of a part of an identifier that needn't be token-efficient.
SHORT = 3
DIGESTS = {32, 40, 48, 56, 64, 96, 128}
_UUID = re.compile(rb"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_HEX = re.compile(rb"[0-9a-f]+|[0-9A-F]+")
_JOINT = re.compile(rb"[_/=+-]+")
_MIXED = re.compile(rb"[0-9]|[a-z][^A-Za-z]*[A-Z]|[A-Z][^A-Za-z]*[A-Z][^A-Za-z]*[a-z]")
_PART = re.compile(rb"[0-9]+|[a-z]+|[A-Z]+|[A-Z][a-z]+")
_ENCODINGS: dict[str, object] = {}


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_IS_HEX = _class(b"0123456789abcdef")
_JOINTS = b"+/_=-"
_IS_RUN = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" + _JOINTS)


def runs(data: np.ndarray, member: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal runs of at least ``least`` members."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = member[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])  # starts and ends in turn
    starts, ends = edges[::2], edges[1::2]
    long = np.flatnonzero(ends - starts >= least)
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def encoding(path: str | None = None):
    """The tiktoken encoding of a rank file (default: the public byte_bpe_50k)."""
    import public_tokenizers
    import tiktoken

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    if path not in _ENCODINGS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def efficient(run: bytes, enc, ratio: float) -> bool:
    return len(run) >= ratio * len(enc.encode_ordinary(run.decode()))


def excluded(run: bytes, enc, ratio: float = RATIO) -> bool:
    """Known digests and identifiers."""
    if (_HEX.fullmatch(run) and len(run) in DIGESTS) or _UUID.fullmatch(run) or run.isdigit():
        return True
    parts = [p for p in _JOINT.split(run) if p]
    if len(parts) < 2 or not all(map(_PART.fullmatch, parts)):
        return False
    return all(p.isdigit() or len(p) <= SHORT or efficient(p, enc, ratio) for p in parts)


def random_string(run: bytes, enc, ratio: float = RATIO, least: int = LEAST) -> bool:
    size = len(run.translate(None, _JOINTS))
    if size < least or (size < PLAIN and not _MIXED.search(run)):
        return False
    return not efficient(run, enc, ratio) and not excluded(run, enc, ratio)


def scan(text: bytes, enc, ratio: float = RATIO, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, sorted."""
    if not text:
        return []
    data = np.frombuffer(text, np.uint8)
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(a, 2, b) for a, b in runs(data, _IS_HEX, 16)]
    base = sorted((a, b) for a, _, b in found)
    begins, upto = [a for a, _ in base], [0]
    for _, b in base:
        upto.append(max(upto[-1], b))
    for a, b in runs(data, _IS_RUN, least):
        first = bisect_right(begins, a)
        if upto[first] >= b:  # within a fixed span
            continue
        at, pieces = max(a, upto[first]), []
        for start, end in base[first : bisect_left(begins, b)]:
            pieces.append((at, start))
            at = max(at, end)
        if any(y - x >= least and random_string(text[x:y], enc, ratio, least) for x, y in [*pieces, (at, b)]):
            found.append((a, 3, b))
    if found and not text.isascii():
        at = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        found = [(int(at[a]), k, int(at[b])) for a, k, b in found]
    return sorted(found)


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, vocabulary: str | None = None, ratio: float = RATIO, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    ship(docs.sparkSession)

    def run(batches):
        enc = encoding(vocabulary)
        for batch in batches:
            found = [scan(t, enc, ratio, least) if t else [] for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(x[1] == k for x in f) for f in found], pa.int64()) for k in range(4)]
            digest = [hashlib.sha256(_joined(x for x in f if x[1] < 3).encode()).hexdigest() for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array(digest, pa.string()), pa.array([_joined(f) for f in found], pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"])

    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return picked(docs, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("binary")}).mapInArrow(run, schema)
