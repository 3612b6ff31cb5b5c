"""Token-id shards compressed by a Re-Pair grammar, with random access.

Documents are put in ascending doc_id order (nulls first, equal ids by text), encoded, each ended with ``END`` and cut
into shards of about ``SHARD`` ids.  In every shard pairs of neighbouring symbols are replaced by nonterminals, in rounds,
until no pair occurs ``LEAST`` (two) times; no pair spans two documents.  The shard's image holds the rules, the expansion
length of each rule, the remaining symbols and, for each document, where its symbols and its ids end, so any document (or
any range of ids in one) is decoded without the others.

Image, all little-endian: magic ``SWRP``, then eight uint32: version, vocabulary size, rules, rounds, documents,
symbols, bits per symbol, 0; then rules per round (uint32), doc_id (int64; the least int64 for null), id ends and symbol
ends (uint64 each), left and right of each rule, its expansion length (uint32), symbols.  Left, right and symbols take
``bits`` bits each, lowest first, every list padded to a multiple of eight numbers, so number k lies at a known bit.

Shards are rows of a Parquet table (part, shard, first_id, last_id, own_start, n_docs, n_ids, image): Spark's committer
makes a lost executor harmless and any file system will do.  Each row is a row group of its own, so that a filter on
first_id and last_id opens the shard that holds a document and no other (``document``); ``directory`` lists the shards
with their absolute starts.

Encoding goes by words: the tokenizer drops white space and never joins what it separates, so the ids of a text are
those of its words in order.  Arrow folds case (where the file's normaliser does), splits and numbers the words of a
group of texts; marks behind letters, which the splitting expression sets apart, are numbered for themselves; every
distinct piece is encoded once per worker.  New pieces of letters skip the normaliser and the splitting expression, which
would leave them as they are.

Defined cases: null text counts as empty and gives just the end id; repeated doc_ids stand next to each other; an empty
table gives no rows; extra columns are ignored; an empty shard is never written.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import durable, partitions, picked
from .words import IdTable, blocks, held, in_order, ranges

END, SHARD = 2, 1 << 21
#: Least occurrences of a pair.
LEAST = 2
#: Bytes of text whose words are looked up at once.
GROUP = 12 << 20
_NONE = np.int32((1 << 31) - 1)
_MAGIC = b"SWRP"
_NULL = -(1 << 63)


def _byte_letters() -> str:
    """The character that byte-level tokenizers show for each byte (the published GPT-2 rule)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(other)) for b in range(256))


class WordEncoder:
    """Ids by word for one tokenizer file."""

    #: Letters that the normaliser leaves alone, and ASCII marks but the one that special tokens begin with.
    _LETTERS, _MARKS = "[a-zß-öø-ÿ]+", r"[!-/:;=-@\[-`{-~]+"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.vocabulary = self.tok.get_vocab_size()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in ([spec["normalizer"], *(spec["normalizer"] or {}).get("normalizers", [])] if spec["normalizer"] else [])]
        splits = [x["type"] for x in ([spec["pre_tokenizer"], *(spec["pre_tokenizer"] or {}).get("pretokenizers", [])] if spec["pre_tokenizer"] else [])]
        self.folds = "Lowercase" in steps
        # the short cut holds for this shape of file; any other goes the general way
        self.fast = None
        if self.folds and set(steps) <= {"Sequence", "NFC", "Replace", "Lowercase"} and set(splits) == {"Sequence", "Split", "ByteLevel"} and spec["model"].get("end_of_word_suffix") == "</w>":
            self.fast = Tokenizer(self.tok.model)
            self.fast.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.closes = np.zeros(self.vocabulary, bool)
            self.closes[[i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]] = True
            self.shown = dict(enumerate(_byte_letters())) | {32: " "}
        self.cache = IdTable(self._fill)

    def _fill(self, words: list[bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads here; the library reads this at each call
        if self.fast:
            plain = pc.match_substring_regex(pa.array(words, pa.binary()).view(pa.string()), f"^{self._LETTERS}$").to_numpy(zero_copy_only=False)
        else:
            plain = np.zeros(len(words), bool)
        ids, sizes, places = [np.zeros(0, np.int32)], [], []
        for quick in (True, False):
            at = np.flatnonzero(plain == quick)
            if not len(at):
                continue
            places.append(at)
            if quick:
                own = [words[i] for i in at.tolist()]
                texts = [b" ".join(own[k : k + 512]).decode("latin-1") for k in range(0, len(own), 512)]
                texts = [t if t.isascii() else t.translate(self.shown) for t in texts]
                flat = np.concatenate([np.array(e.ids, np.int32) for e in self.fast.encode_batch_fast(texts, add_special_tokens=False)])
                cut = np.flatnonzero(self.closes[flat]) + 1  # one word end a word
                if len(cut) != len(at) or cut[-1] != len(flat):
                    raise ValueError("word ends of the short cut don't fit")
                ids.append(flat)
                sizes.append(np.diff(np.concatenate(([0], cut))))
            else:
                lists = [e.ids for e in self.tok.encode_batch_fast([words[i].decode("utf-8", "replace") for i in at.tolist()], add_special_tokens=False)]
                ids.append(np.fromiter((x for one in lists for x in one), np.int32))
                sizes.append(np.array([len(x) for x in lists], np.int64))
        return in_order(np.concatenate(ids), np.concatenate(sizes), np.concatenate(places))

    def _words(self, texts: pa.Array):
        """(words of each text, every word's number, the distinct words' cores and the marks behind these)."""
        plain = texts.view(pa.string())
        low = plain
        if self.folds:
            low = pc.ascii_lower(plain)
            special = pc.match_substring(plain, "<|")  # case is kept where a special token's text might arise by folding
            if pc.any(special).as_py():
                low = pc.if_else(special, plain, low)
        parts = pc.ascii_split_whitespace(low)
        found = parts.flatten().dictionary_encode()
        cores = names = found.dictionary
        marks = pa.array([""] * len(names), pa.string())
        if self.fast:
            both = pc.extract_regex(names, f"^(?P<core>{self._LETTERS})(?P<marks>{self._MARKS})$")
            cores, marks = pc.coalesce(pc.struct_field(both, "core"), names), pc.fill_null(pc.struct_field(both, "marks"), "")
        return pc.list_value_length(parts).to_numpy(), found.indices.to_numpy(), cores, marks

    def _group(self, texts: pa.Array):
        """(ids of all texts, each followed by END; where each text's end)."""
        counts, index, cores, marks = self._words(texts)
        n = len(cores)
        pieces = pa.concat_arrays([cores, marks]).dictionary_encode()
        of = pieces.indices.to_numpy()
        met = np.bincount(index, minlength=n)
        times = np.bincount(of, np.concatenate((met, met)), len(pieces.dictionary)).astype(np.int64)
        number = self.cache.find(pieces.dictionary.view(pa.binary()), times)[of].reshape(2, n).T.ravel()
        own, begin = self.cache.size[number], self.cache.start[number]
        flat = np.append(self.cache.flat[ranges(begin, own)], np.int32(END))  # the lists of the distinct words, then END as one more
        sizes = np.append(own.reshape(n, 2).sum(1), 1).astype(np.int32)
        start = np.cumsum(sizes, dtype=np.int32) - sizes
        ends = np.cumsum(counts, dtype=np.int64)
        index = np.insert(index, ends, n)
        size = sizes[index]
        return flat[ranges(start[index], size)], np.cumsum(size, dtype=np.int64)[ends + np.arange(len(ends))]

    def encode(self, texts: pa.Array):
        """Yields (ids, ends) for groups of texts (binary), each text's ids followed by END."""
        texts = pc.fill_null(texts, b"")
        upto = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        at = 0
        while at < len(texts):
            before = upto[at - 1] if at else 0
            end = int(np.searchsorted(upto, before + GROUP)) + 1
            if end > at + 1 and upto[min(end, len(texts)) - 1] - before > 2 * GROUP:
                end -= 1  # a very long text goes by itself
            if end == at + 1 and upto[at] - before > 2 * GROUP:  # in blocks cut at white space
                parts = [self._group(pa.array([b], pa.binary()))[0] for b in blocks(texts[at].as_py(), GROUP)]
                ids = np.concatenate([*(p[:-1] for p in parts), np.array([END], np.int32)])
                yield ids, np.array([len(ids)])
            else:
                yield self._group(texts.slice(at, end - at))
            at = end


def word_encoder(path: str) -> WordEncoder:
    return held(f"words:{path}", lambda: WordEncoder(path))


def _hashed(code: np.ndarray) -> np.ndarray:
    return code * np.uint64(0x9E3779B97F4A7C15)


def _overlapping(at: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Which pairs, in runs of one symbol, overlap a counted one before them: every other one."""
    same = np.flatnonzero((code[1:] == code[:-1]) & (at[1:] == at[:-1] + 1)) + 1
    if not len(same):
        return same
    begins = np.concatenate(([True], np.diff(same) > 1))
    nth = np.arange(len(same)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
    return same[nth % 2 == 0]


def compress(ids: np.ndarray, ends: np.ndarray, vocabulary: int, rounds: int | None = None, rules: int | None = None, least: int = LEAST):
    """(left, right, rules per round, symbols, symbol ends): Re-Pair in rounds, until no pair occurs ``least`` times.

    A round counts every pair exactly (in a run of one symbol, every other place) by sorting (pair, place) numbers, ranks
    those of at least ``least`` occurrences by frequency and replaces an occurrence where it ranks before both overlapping
    neighbours.  Pairs that come to fewer than ``least`` replacements wait for the next round.  Only pairs with a symbol of
    the last round and pairs that were frequent then can be frequent, so later rounds look at those places alone.
    ``rounds`` and ``rules`` end it earlier.
    """
    seq = ids.astype(np.int32)
    flags = np.zeros(len(seq), np.uint8)  # 1: the last symbol of a document, 2: a pair to look at begins here
    flags[ends - 1] = 1
    at = np.flatnonzero(flags[:-1] == 0)
    lefts, rights, per = [], [], []
    top = vocabulary
    while len(at) and (rounds is None or len(per) < rounds) and (rules is None or top < vocabulary + rules):
        symbol, place = int(top - 1).bit_length(), len(seq).bit_length()
        if 2 * symbol + place > 63:
            raise ValueError("too many ids and symbols for one shard")
        code = (seq[at].astype(np.uint64) << np.uint64(symbol)) | seq[at + 1].astype(np.uint64)
        overlap = _overlapping(at, code)
        key = (code << np.uint64(place)) | at.astype(np.uint64)
        key[overlap] = np.iinfo(np.uint64).max  # behind all others
        flags &= 1
        flags[at[overlap]] |= 2
        key.sort()
        key = key[: len(key) - len(overlap)]
        code, at = key >> np.uint64(place), (key & np.uint64((1 << place) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        count = np.diff(np.append(first, len(code)))
        hot = count >= least
        if not hot.any():
            break
        at = at[np.repeat(hot, count)]
        pairs, count = code[first[hot]], count[hot]
        # most frequent first, ties by hash: in a copied passage a third of the pairs win at once
        order = np.argsort(((len(seq) - count).astype(np.uint64) << np.uint64(64 - place)) | (_hashed(pairs) >> np.uint64(place)))
        rank = np.empty(len(pairs), np.int32)
        rank[order] = np.arange(len(pairs), dtype=np.int32)
        flags[at] |= 2
        ranks = np.full(len(seq) + 2, _NONE, np.int32)
        ranks[at + 1] = np.repeat(rank, count)
        mine = ranks[1:-1]
        at = np.flatnonzero((mine < ranks[:-2]) & (mine < ranks[2:]))
        mine = mine[at]
        good = np.bincount(mine, minlength=len(pairs)) >= least  # always so for the first
        if rules is not None:
            good &= np.cumsum(good) <= vocabulary + rules - top
        own = good[mine]
        at, mine = at[own], mine[own]
        seq[at] = (top - 1 + np.cumsum(good))[mine]
        flags[at] = 2 | flags[at + 1]
        flags[at[at > 0] - 1] |= 2
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, flags = seq[keep], flags[keep]
        at = np.flatnonzero(flags[:-1] == 2)
        made = pairs[order][good]
        lefts.append((made >> np.uint64(symbol)).astype(np.int64))
        rights.append((made & np.uint64((1 << symbol) - 1)).astype(np.int64))
        per.append(len(made))
        top += len(made)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *lefts]), np.concatenate([none, *rights]), np.array(per, np.int64), seq, np.flatnonzero(flags & 1) + 1


def packed(numbers: np.ndarray, bits: int) -> bytes:
    """Numbers of ``bits`` bits each; eight of them take ``bits`` bytes."""
    x = np.zeros((-(-len(numbers) // 8), 8), np.uint64)
    x.ravel()[: len(numbers)] = numbers
    out = np.zeros((len(x), bits), np.uint8)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        value = x[:, k] << np.uint64(shift)
        for i in range(byte, min(bits, byte + (bits + shift + 7) // 8)):
            out[:, i] |= (value >> np.uint64(8 * (i - byte))).astype(np.uint8)
    return out.tobytes()


def unpacked(image: np.ndarray, first: int, end: int, bits: int) -> np.ndarray:
    """Numbers [first, end) of a packed list."""
    if first >= end:
        return np.zeros(0, np.int32)
    a, b = first // 8, -(-end // 8)
    rows = image[a * bits : b * bits].reshape(b - a, bits)
    out = np.empty((b - a, 8), np.int32)
    for k in range(8):
        byte, shift = divmod(k * bits, 8)
        value = np.zeros(b - a, np.uint64)
        for i in range(byte, min(bits, byte + (bits + shift + 7) // 8)):
            value |= rows[:, i].astype(np.uint64) << np.uint64(8 * (i - byte))
        out[:, k] = (value >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.ravel()[first - 8 * a : end - 8 * a]


def pack(doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray, vocabulary: int, **how) -> bytes:
    left, right, per, seq, symbol_ends = compress(ids, ends, vocabulary, **how)
    length = np.ones(vocabulary + len(left), np.int64)
    at = vocabulary
    for n in per.tolist():
        length[at : at + n] = length[left[at - vocabulary : at - vocabulary + n]] + length[right[at - vocabulary : at - vocabulary + n]]
        at += n
    bits = max(1, int(vocabulary + len(left) - 1).bit_length())
    head = _MAGIC + struct.pack("<8I", 2, vocabulary, len(left), len(per), len(doc_ids), len(seq), bits, 0)
    keys = np.array([_NULL if d is None else d for d in doc_ids], "<i8")
    plain = (per.astype("<u4"), keys, ends.astype("<u8"), symbol_ends.astype("<u8"))
    return b"".join((head, *(x.tobytes() for x in plain), packed(left, bits), packed(right, bits), length[vocabulary:].astype("<u4").tobytes(), packed(seq, bits)))


class Shard:
    """A shard image opened for random access."""

    def __init__(self, image: bytes):
        if image[:4] != _MAGIC:
            raise ValueError("not a token shard")
        version, self.vocabulary, rules, rounds, docs, self.size, self.bits, _ = struct.unpack_from("<8I", image, 4)
        if version != 2:
            raise ValueError(f"shard version {version}")
        at = 36

        def take(n, kind):
            nonlocal at
            out = np.frombuffer(image, kind, n, at)
            at += out.nbytes
            return out

        bytes_of = lambda n: -(-n // 8) * self.bits
        self.per = take(rounds, "<u4").astype(np.int64)
        self.doc_ids, self.ends, self.symbol_ends = take(docs, "<i8"), take(docs, "<u8").astype(np.int64), take(docs, "<u8").astype(np.int64)
        self.left, self.right = (unpacked(take(bytes_of(rules), np.uint8), 0, rules, self.bits) for _ in range(2))
        self.lengths, self.packed = take(rules, "<u4").astype(np.int64), take(bytes_of(self.size), np.uint8)

    def symbols(self, first: int = 0, end: int | None = None) -> np.ndarray:
        return unpacked(self.packed, first, self.size if end is None else end, self.bits)

    def _sizes(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        out = np.ones(len(symbols), np.int64)
        rule = np.flatnonzero(symbols >= self.vocabulary)
        out[rule] = self.lengths[symbols[rule] - self.vocabulary]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """All rules of a level at once; expansion lengths say where each part goes."""
        size = self._sizes(symbols)
        out = np.empty(int(size.sum()), np.int32)
        rule = symbols >= self.vocabulary
        place = np.cumsum(size) - size
        out[place[~rule]] = symbols[~rule]
        place, now = place[rule], symbols[rule] - self.vocabulary
        while len(now):
            left, right = self.left[now], self.right[now]
            sides = ((place, left), (place + self._sizes(left), right))
            place, now = [], []
            for at, part in sides:
                rule = part >= self.vocabulary
                plain = np.flatnonzero(~rule)
                out[at[plain]] = part[plain]
                deep = np.flatnonzero(rule)
                place.append(at[deep])
                now.append(part[deep] - self.vocabulary)
            place, now = np.concatenate(place), np.concatenate(now)
        return out

    def everything(self) -> np.ndarray:
        """All ids of the shard: rules are expanded once, in the order they were made, and symbols copy from these."""
        size = np.concatenate((np.ones(self.vocabulary, np.int64), self.lengths))
        start = np.cumsum(size) - size
        if start[-1] + size[-1] > self.vocabulary + 4 * int(self.ends[-1]):  # rules that hold long ones again and again
            return self.expand(self.symbols())
        flat = np.empty(int(start[-1] + size[-1]), np.int32)
        flat[: self.vocabulary] = np.arange(self.vocabulary)
        parts = np.stack((self.left, self.right), 1)
        first = 0
        for n in self.per.tolist():
            sides = parts[first : first + n].ravel()
            out = flat[ranges(start[sides], size[sides])]
            at = int(start[self.vocabulary + first])
            flat[at : at + len(out)] = out
            first += n
        symbols = self.symbols()
        return flat[ranges(start[symbols], size[symbols])]

    def document(self, k: int, first: int = 0, end: int | None = None) -> np.ndarray:
        """Ids [first, end) of the k-th document; expansion lengths lead to the symbols that hold them."""
        symbols = self.symbols(int(self.symbol_ends[k - 1]) if k else 0, int(self.symbol_ends[k]))
        if not first and end is None:
            return self.expand(symbols)
        size = self._sizes(symbols)
        upto = np.cumsum(size)
        end = int(upto[-1]) if end is None else min(end, int(upto[-1]))
        if first >= end:
            return np.zeros(0, np.int32)
        a, b = int(np.searchsorted(upto, first, "right")), int(np.searchsorted(upto, end, "left")) + 1
        skipped = int(upto[a] - size[a])
        return self.expand(symbols[a:b])[first - skipped : end - skipped]


def _gathered(batches):
    """doc_ids and texts of as many batches as make up a group."""
    ids, texts, size = [], [], 0
    for batch in batches:
        ids += batch.column(0).to_pylist()
        texts.append(batch.column(1))
        size += batch.column(1).nbytes
        if size >= GROUP:
            yield ids, pa.concat_arrays(texts)
            ids, texts, size = [], [], 0
    if ids:
        yield ids, pa.concat_arrays(texts)


_SHARDS = "part int, shard long, first_id long, last_id long, own_start long, n_docs long, n_ids long, image binary"


def write(docs: DataFrame, path: str, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and writes; returns the table of shards as read back, see _SHARDS."""
    ship(docs.sparkSession)
    names = [x.split()[0] for x in _SHARDS.split(", ")]

    def run(batches):
        encoder = word_encoder(path)
        part = TaskContext.get().partitionId()
        keys, lists, held, number, own = [], [], 0, 0, 0

        def flush():
            nonlocal keys, lists, held, number, own
            ends = np.cumsum([len(x) for x in lists])
            image = pack(keys, np.concatenate(lists), ends, encoder.vocabulary)
            ids = [_NULL if k is None else k for k in (keys[0], keys[-1])]  # in order, nulls first
            out = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *(pa.array([x], pa.int64()) for x in (number, *ids, own, len(keys), held)), pa.array([image], pa.binary())], names)
            keys, lists, number, own, held = [], [], number + 1, own + held, 0
            return out

        for ids_of, texts in _gathered(batches):
            at = 0
            for ids, ends in encoder.encode(texts):
                for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    keys.append(ids_of[at])
                    lists.append(ids[a:b])
                    held += b - a
                    at += 1
                    if held >= shard:
                        yield flush()
        if keys:
            yield flush()

    rows = picked(docs, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("binary")})
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    ranged = rows.repartitionByRange(partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), order[1])
    # a row group for each shard: the writer holds one at a time, and a reader that filters by id opens no other
    return durable(ranged.mapInArrow(run, _SHARDS), "token-shards", **{"parquet.block.row.count.limit": 1})


def _bases(shards: DataFrame) -> DataFrame:
    """part, base: the ids before each part.  One sum a part reaches the driver."""
    sums = sorted((r["part"], r["n"]) for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    base, at = [], 0
    for part, n in sums:
        base.append((part, at))
        at += n
    return shards.sparkSession.createDataFrame(base, "part int, base long")


def directory(shards: DataFrame) -> DataFrame:
    """part, shard, first_id, last_id (null: documents without one), start (ids of all shards before), n_docs, n_ids."""
    ids = [F.when(F.col(c) != _NULL, F.col(c)).alias(c) for c in ("first_id", "last_id")]
    return shards.drop("image").join(F.broadcast(_bases(shards)), "part").select("part", "shard", *ids, (F.col("base") + F.col("own_start")).alias("start"), "n_docs", "n_ids")


def document(shards: DataFrame, doc_id: int, first: int = 0, end: int | None = None) -> DataFrame:
    """doc_id, ids: ids [first, end) of the documents of that id.  Reads the shards whose range holds the id only."""
    ship(shards.sparkSession)

    def run(batches):
        for batch in batches:
            for image in batch.column(0).to_pylist():
                s = Shard(image)
                at = np.flatnonzero(s.doc_ids == doc_id).tolist()
                lists = [s.document(k, first, end).astype(np.int32) for k in at]
                yield pa.RecordBatch.from_arrays([pa.array([doc_id] * len(at), pa.int64()), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "ids"])

    held_by = shards.filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).select("image")
    return held_by.mapInArrow(run, "doc_id long, ids array<int>")


def read(shards: DataFrame) -> DataFrame:
    """Decodes every document from its shard: doc_id, start, n_tokens, ids_crc32."""
    ship(shards.sparkSession)
    def run(batches):
        for batch in batches:
            for start, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = Shard(image)
                ids = s.everything().astype("<u4")
                first = np.concatenate(([0], s.ends[:-1]))
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(first.tolist(), s.ends.tolist(), strict=True)]
                keys = pa.array(s.doc_ids, pa.int64(), mask=s.doc_ids == _NULL)
                yield pa.RecordBatch.from_arrays([keys, pa.array(start + first), pa.array(s.ends - first), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    placed = shards.join(F.broadcast(_bases(shards)), "part").select((F.col("base") + F.col("own_start")).alias("start"), "image")
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
