"""Vectorised word spans and word-shingle hashes over whole texts.

Texts are UTF-8 bytes.  A word is a maximal run of bytes outside
``[\\x20\\x09-\\x0D]`` - the same runs, on any valid text, as the regular
expression ``[^\\x20\\x09-\\x0D]+`` finds on code points, as those white-space
characters are single bytes that never occur inside a multi-byte character.

Shingle hashes are 64 bits wide: every byte of a word stands for a random
number of its own for each place in the word (tabulation), whose sum is the
word's value; the values of a shingle's words are combined with one odd
multiplier per place, and a finaliser mixes the bits.  The numbers are fixed
and independent of the text, so two different words or shingles share a value
with probability about 2**-64; no polynomial is involved whose terms could
cancel.  Nothing here depends on Python's ``hash`` (which differs between
workers).
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: A random number for each place in a word (the last row is for bytes further on, mixed with their place) and byte.
_PLACES = 48
_BYTE = np.random.default_rng(20240601).integers(0, 2**64, (_PLACES + 1) * 256, dtype=np.uint64)
_PLACE = np.random.default_rng(20240602).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_CHUNK = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_spans(text: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first bytes, end bytes, one uint64 for each word), in order.  Long texts go through in blocks cut at word ends."""
    if len(text) > _CHUNK:
        parts, at = [], 0
        for piece in blocks(text):
            a, b, h = word_spans(piece, lower) if len(piece) <= _CHUNK else _spans(piece, lower)
            parts.append((a + at, b + at, h))
            at += len(piece)
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    return _spans(text, lower)


def word_hashes(text: bytes, lower: bool = True) -> np.ndarray:
    return word_spans(text, lower)[2]


def _spans(text: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(text, np.uint8)
    none = np.zeros(0, np.int64)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return none, none, np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    own = data[inside[1:-1].view(bool)]
    place = np.arange(len(own), dtype=np.int32) - np.repeat(first.astype(np.int32), sizes)
    far = np.flatnonzero(place >= _PLACES) if sizes.max() > _PLACES else ()
    value = _BYTE[(np.minimum(place, _PLACES) << 8) + (lower_ascii(own) if lower else own)]
    if len(far):
        value[far] = mix64(value[far] + place[far].astype(np.uint64) * _STEP)
    return starts, ends, mix64(np.add.reduceat(value, first) + sizes.astype(np.uint64) * _PLACE[63])


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash for each n neighbours, their order included, put together from those of 1, 2, 4, ... neighbours."""

    def both(x, y):
        return mix64(x * _PLACE[61] + mix64(y + _PLACE[62]))

    power, size, out, done = hashes, 1, None, 0
    while True:
        if n & size:
            m = max(len(hashes) - done - size + 1, 0)
            out, done = (power if out is None else both(out[:m], power[done:])), done + size
        size *= 2
        if size > n:
            return out
        power = both(power[: -size // 2], power[size // 2 :])


def shingle_hashes(text: bytes, n: int, lower: bool = True) -> np.ndarray:
    """The sorted distinct n-word shingles of a text; with 1 to n - 1 words, the whole sequence as one."""
    words = word_hashes(text, lower)
    if not len(words):
        return words
    k = min(n, len(words))
    value = np.full(len(words) - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        value = value + words[i : len(words) - k + 1 + i] * _PLACE[i]
    value = mix64(value)
    value.sort()
    return value[np.concatenate(([True], value[1:] != value[:-1]))]


def set_digest(hashes: np.ndarray) -> tuple[int, int]:
    """A 128-bit digest of a set of hashes: two sums, the second over values mixed once more.  (0, 0) for none."""
    if not len(hashes):
        return 0, 0
    n = np.array([len(hashes)], np.uint64)
    both = np.concatenate((hashes.sum(keepdims=True) + n * _PLACE[52], mix64(hashes + _PLACE[53]).sum(keepdims=True) + n * _PLACE[54]))
    a, b = mix64(both).view(np.int64).tolist()
    return a, b


def blocks(text: bytes, size: int = _CHUNK):
    """A text in pieces cut at word ends, so that very long texts need bounded memory."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end


_HELD: dict[str, object] = {}


def trim(beyond: int = 0) -> None:
    """Gives freed memory back to the system: idle workers would keep it beside the next stage's.  Does nothing for less than 8 MB."""
    if 0 < beyond < 8 << 20:
        return
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def frugal() -> None:
    """Has the allocator return large blocks at once and keep one arena for all threads: for workers that encode in small steps."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        for option, value in ((-3, 1 << 20), (-1, 1 << 20), (-8, 1)):  # M_MMAP_THRESHOLD, M_TRIM_THRESHOLD, M_ARENA_MAX
            libc.mallopt(option, value)
    except (OSError, AttributeError):  # another C library
        pass


def held(key: str | None, make=None):
    """The one cache of this worker, made anew when another was asked for before: workers live through many stages."""
    if key not in _HELD:
        _HELD.clear()
        trim()
        if key is not None:
            _HELD[key] = make()
    return _HELD.get(key)


class WordCache:
    """Rows of numbers for words, computed once for each distinct word a worker meets.

    ``fill`` maps a list of words (bytes) to an array with one row for each.  The cache is emptied when it holds
    more than ``limit`` words or ``limit_bytes`` bytes of them, so its memory is bounded.
    """

    def __init__(self, fill, limit: int = 600_000, limit_bytes: int = 64 << 20):
        self.fill, self.limit, self.limit_bytes = fill, limit, limit_bytes
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.held, self.rows = 0, None

    def index(self, words: list[bytes]) -> np.ndarray:
        """Positions in self.rows, valid until the next call."""
        if len(self.at) > self.limit or self.held > self.limit_bytes:
            self.clear()
        new = list(set(words).difference(self.at))
        if new:
            rows = self.fill(new)
            n = len(self.at)
            if self.rows is None or n + len(new) > len(self.rows):
                grown = np.zeros((max(1024, 2 * (n + len(new))), *rows.shape[1:]), rows.dtype)
                if n:
                    grown[:n] = self.rows[:n]
                self.rows = grown
            self.rows[n : n + len(new)] = rows
            self.at.update(zip(new, range(n, n + len(new)), strict=True))
            self.held += sum(map(len, new))
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))

    def get(self, words: list[bytes]) -> np.ndarray:
        at = self.index(words)
        return self.rows[at] if len(at) else np.zeros((0,), np.float32)


def letters(words: list[bytes], digits: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all words, each word between zeros, other characters than letters (and digits) as zeros; and each one's word."""
    text = b"\n".join(words).decode("utf-8", "replace").lower()
    points = np.frombuffer(f"\n{text}\n".encode("utf-32-le", "replace"), np.uint32)
    of = np.cumsum(points == 10) - 1
    seen, place = np.unique(points, return_inverse=True)
    good = np.array([(c := chr(p)).isalpha() or (digits and c.isdigit()) for p in seen.tolist()], bool)
    return np.where(good[place], points, 0).astype(np.uint64), np.minimum(of, len(words) - 1)


def grams(points: np.ndarray, of: np.ndarray, sizes, bits: int):
    """For each n-gram that lies in one run of letters, a zero at either end included: its word and its bucket.  Yields one pair a size."""
    zero = points == 0
    for n in sizes:
        m = len(points) - n + 1
        if m <= 0:
            continue
        value = np.full(m, n, np.uint64)
        for i in range(n):
            value = value + (points[i : m + i] + np.uint64(1)) * _PLACE[i]
        good = np.ones(m, bool)
        for i in range(1, n - 1):
            good &= ~zero[i : m + i]
        good &= ~(zero[:m] & zero[n - 1 :]) if n < 3 else good
        at = np.flatnonzero(good)
        yield of[at + (1 if n > 1 else 0)], (mix64(value[at]) >> np.uint64(64 - bits)).astype(np.int64)


class IdTable:
    """Lists of numbers for pieces of text, computed once for each distinct piece.

    Pieces are kept and looked up in Arrow arrays; only new ones become Python objects.  ``fill`` maps a list of pieces to
    (all their numbers, how many each has).  When the table holds more than ``limit`` pieces or ``limit_bytes`` bytes of
    them, only those met again since they came stay, if they are at most half of it.
    """

    def __init__(self, fill, limit: int = 900_000, limit_bytes: int = 96 << 20):
        self.fill, self.limit, self.limit_bytes = fill, limit, limit_bytes
        self._keep(np.zeros(0, np.int64))

    def _keep(self, which: np.ndarray) -> None:
        if not len(which):
            self.pieces = pa.array([], pa.binary())
            self.start, self.size, self.met, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
            return
        self.flat, self.size = self.flat[ranges(self.start[which], self.size[which])], self.size[which]
        self.pieces, self.start, self.met = self.pieces.take(pa.array(which)), np.cumsum(self.size) - self.size, np.zeros(len(which), np.int64)

    def find(self, distinct: pa.Array, times: np.ndarray) -> np.ndarray:
        """Numbers of distinct pieces in start and size, valid until the next call; times: how often each is met now."""
        if len(self.pieces) > self.limit or self.pieces.nbytes > self.limit_bytes:
            often = np.flatnonzero(self.met > 1)
            self._keep(often if len(often) <= self.limit // 2 and self.pieces.take(pa.array(often)).nbytes <= self.limit_bytes // 2 else often[:0])
        found = pc.index_in(distinct, value_set=self.pieces)
        number = found.fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh = distinct.take(pa.array(new))
            flat, sizes = self.fill(fresh.to_pylist())
            number[new] = np.arange(len(self.pieces), len(self.pieces) + len(new))
            self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(sizes) - sizes))
            self.pieces, self.flat, self.size = pa.concat_arrays([self.pieces, fresh]), np.concatenate((self.flat, flat)), np.concatenate((self.size, sizes))
            self.met = np.concatenate((self.met, np.zeros(len(new), np.int64)))
        self.met[number] += times
        return number

    def get(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(the lists of all pieces, one after another; their lengths)."""
        if not pieces:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        found = pa.array(pieces, pa.binary()).dictionary_encode()
        place = found.indices.to_numpy()
        which = self.find(found.dictionary, np.bincount(place))[place]
        sizes = self.size[which]
        return self.flat[ranges(self.start[which], sizes)], sizes


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, size many."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + (int(starts.max()) if len(starts) else 0) < 1 << 31 else np.int64  # half the memory to walk through
    out = np.repeat((starts - ends + sizes).astype(kind), sizes)
    out += np.arange(total, dtype=kind)
    return out


def in_order(flat: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists given one after another, the k-th meant for places[k], put in the order of places."""
    order = np.argsort(places)
    return flat[ranges((np.cumsum(sizes) - sizes)[order], sizes[order])], sizes[order]


def cached_ids(texts: list[bytes | None], cut, cache: IdTable, size: int = _CHUNK, split=blocks):
    """Yields (ids, end of each text in them) for groups of texts of about ``size`` bytes; cut maps bytes to pieces,
    split a long text to parts of about ``size`` bytes whose pieces are those of the text."""
    at = 0
    while at < len(texts):
        pieces, counts, held = [], [], 0
        first = at
        while at < len(texts) and held < size:
            text = texts[at] or b""
            if len(text) > 2 * size:
                break
            own = cut(text)
            pieces += own
            counts.append(len(own))
            held += len(text)
            at += 1
        if at > first:
            ids, sizes = cache.get(pieces)
            yield ids, np.concatenate(([0], np.cumsum(sizes)))[np.cumsum(counts)]
        else:  # a very long text goes through in blocks
            parts = [cache.get(cut(part))[0] for part in split(texts[at], size)]
            ids = np.concatenate(parts)
            yield ids, np.array([len(ids)])
            at += 1
