"""Prefix trie of conversations by an LCP-aware external mergesort.

A turn becomes a symbol of 20 bytes - 16 of its SHA-256 and its number of words - and a conversation the sequence of its
symbols, so texts are read once and never move.  Sequences are sorted by symbols, then conv_id:

1. runs: each task sorts what it holds, up to ``RUN_BYTES`` at once.  A run is cut at the range borders and packed: for each
   conversation the number of turns it shares with the one before it (LCP) and only the symbols behind them.
2. merge: one range at a time, a loser tree merges its runs.  Every contender carries its LCP with the last winner; unequal
   LCPs decide without a look at the turns, equal ones are compared from there on.  The merged stream drives a stack of open
   nodes: an LCP of d closes all nodes deeper than d, which are then finished and leave with their sums.
3. spine: a node that is a prefix of a range's border may go on in the next range.  Such nodes - as many a range as its
   borders are long - leave with what is known of them, and are merged in the order of ranges by the same kind of stack,
   ``FAN`` ranges a task, in as many rounds as that takes.

Borders are (sequence, conv_id) pairs drawn from a sample and decide only how work is dealt, so copies of one conversation,
or of one first turn, spread over as many ranges as their number asks for.  Memory: a run, a range, the open path, and the
borders (one for ``RANGE_BYTES`` of symbols); a conversation must fit a row (20 bytes a turn).  The SHA-256 of one node's
members is one sequence by definition: where it spans ranges, one task streams its blocks of ids in order.

Defined cases: null role or text counts as empty; null turns come first, turns that share a number in the order of their
symbols; rows without conv_id belong to no conversation and are ignored; equal rows are turns of their own; an empty table
has no node, not even a root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import attach, durable, partitions, picked, with_offsets

WIDTH, BLOCK, SHARED = 20, 20, 4
RUN_BYTES, RANGE_BYTES, FAN = 8 << 20, 8 << 20, 512
#: Sampled conversations for each border.
SAMPLED = 32
EMPTY = hashlib.sha256(b"").hexdigest()


def symbol(role: Column, text: Column) -> Column:
    """A turn as 40 hexadecimal digits: 32 of its SHA-256, 8 for its number of words."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(words), 8, "0"))


def sequences(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, digits: each conversation's symbols in order, as one string."""
    rows = picked(conversations, {"conv_id": F.col(id_col).cast("long"), "turn": F.col(turn_col), "s": symbol(F.col(role_col), F.col(text_col))}).filter("conv_id IS NOT NULL")
    turns = F.sort_array(F.collect_list(F.struct("turn", "s")))
    return rows.groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda x: x["s"]), "").alias("digits"))


def rebuilt(conversations: DataFrame, block: int = BLOCK, shared: int = SHARED, **columns) -> DataFrame:
    """conv_id, seq: the first h turns of conversation c - c % block, then c's own behind its first h; h = crc32(c) % shared."""
    own = durable(sequences(conversations, **columns), "sequences")
    digits = 2 * WIDTH
    heads = own.filter(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("_base"), F.substring("digits", 1, digits * (shared - 1)).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int") * digits
    rows = own.withColumn("_base", F.col("conv_id") - F.col("conv_id") % block).join(heads, "_base", "left")
    seq = F.concat(F.coalesce(F.col("_head"), F.lit("")).substr(F.lit(1), h), F.col("digits").substr(h + 1, F.length("digits")))
    return rows.select("conv_id", F.unhex(seq).alias("seq"))


def common(a: bytes, b: bytes, start: int) -> int:
    """How many symbols a and b share, of which ``start`` are known."""
    n, at, block = min(len(a), len(b)), start * WIDTH, 64 * WIDTH
    while n - at >= block and a[at : at + block] == b[at : at + block]:
        at += block
    while at < n and a[at : at + WIDTH] == b[at : at + WIDTH]:
        at += WIDTH
    return at // WIDTH


def packed(items: list[tuple[bytes, int]]) -> tuple[bytes, bytes, bytes, bytes]:
    """A sorted run as (ids, LCPs, numbers of symbols behind them, those symbols)."""
    lcps, tails, before = [], [], b""
    for seq, _ in items:
        k = common(before, seq, 0)
        lcps.append(k)
        tails.append(seq[k * WIDTH :])
        before = seq
    return np.array([c for _, c in items], "<i8").tobytes(), np.array(lcps, "<u4").tobytes(), np.array([len(x) // WIDTH for x in tails], "<u4").tobytes(), b"".join(tails)


class Run:
    """A packed run, read from its start.  lcp: with what the merge gave out last."""

    __slots__ = ("at", "conv", "done", "ends", "ids", "lcp", "lcps", "seq", "tails")

    def __init__(self, ids: bytes, lcps: bytes, sizes: bytes, tails: bytes):
        self.ids, self.lcps = np.frombuffer(ids, "<i8").tolist(), np.frombuffer(lcps, "<u4").tolist()
        self.ends = [0, *(np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64) * WIDTH).tolist()]
        self.tails, self.at, self.seq, self.done = tails, -1, b"", False
        self.advance()

    def advance(self) -> None:
        self.at += 1
        if self.at == len(self.ids):
            self.done = True
            return
        k = self.lcps[self.at]
        self.seq = self.seq[: k * WIDTH] + self.tails[self.ends[self.at] : self.ends[self.at + 1]]
        self.lcp, self.conv = k, self.ids[self.at]


def _wins(a: Run, b: Run) -> bool:
    """Whether a comes before b; the loser's LCP becomes that with the winner."""
    if a.done or b.done:
        return b.done
    if a.lcp != b.lcp:  # the one that shares more with the last winner is the lesser
        return a.lcp > b.lcp
    h = common(a.seq, b.seq, a.lcp)
    x, y = a.seq[h * WIDTH : (h + 1) * WIDTH], b.seq[h * WIDTH : (h + 1) * WIDTH]
    first = a.conv <= b.conv if x == y else x < y
    (b if first else a).lcp = h
    return first


def merged(runs: list[Run]):
    """(LCP with the sequence before, sequence, conv_id) of all runs in order, by a loser tree."""
    k = len(runs)
    losers: list[Run | None] = [None] * k

    def play(node: int) -> Run:
        if node >= k:
            return runs[node - k]
        a, b = play(2 * node), play(2 * node + 1)
        first = _wins(a, b)
        losers[node] = b if first else a
        return a if first else b

    place = {id(r): k + i for i, r in enumerate(runs)}
    winner = play(1) if k > 1 else runs[0]
    while not winner.done:
        yield winner.lcp, winner.seq, winner.conv
        at = place[id(winner)] >> 1
        winner.advance()
        while at:
            if not _wins(winner, losers[at]):
                winner, losers[at] = losers[at], winner
            at >>= 1


class Node:
    """An open node: sums over its finished children, which are all but those that may go on in another range."""

    __slots__ = ("children", "convs", "depth", "ends", "key", "least", "leaves", "order", "parent", "saved", "state", "symbol", "waiting", "words")

    def __init__(self, depth: int, last: bytes, state=None, parent: bytes | None = None, order: int = 0):
        self.depth, self.symbol, self.state, self.parent, self.order = depth, last, state, parent, order
        self.key = state.digest() if state else None
        self.words = int.from_bytes(last[16:], "big") if last else 0
        self.least, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends: list[int] = []
        self.waiting: list[int] = []

    def finish(self) -> None:
        self.leaves = self.leaves or 1
        self.saved += (self.convs - 1) * self.words

    def add(self, child: Node) -> None:
        """A finished child; one that isn't adds nothing until it is."""
        self.convs += child.convs
        self.least = child.least if self.least is None else min(self.least, child.least)
        self.children += 1
        self.leaves += child.leaves
        self.saved += child.saved


FIELDS = "key binary, parent_key binary, range int, place int, symbol binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends binary"
_NAMES = [f.split()[0] for f in FIELDS.split(", ")]
_KINDS = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}
_TYPES = [_KINDS[f.split()[1]] for f in FIELDS.split(", ")]


def _batch(rows: list[list]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in _NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def _state():
    return hashlib.blake2b(digest_size=16)


def _keys(seq: bytes | None) -> set[bytes]:
    """Keys of all prefixes of a border."""
    state = _state()
    out = set() if seq is None else {state.digest()}
    for at in range(0, len(seq or b""), WIDTH):
        state.update(seq[at : at + WIDTH])
        out.add(state.digest())
    return out


def nodes_of(number: int, stream, left: bytes | None, right: bytes | None) -> list[list]:
    """Rows of the nodes of one range.  Nodes on its borders have a key and wait for the other ranges."""
    rows: list[list] = []
    path: list[Node] = []
    counter = 0
    shared = -1 if right is None else 0  # how deep the open path follows the right border
    onleft = -1  # and the left one

    def close(upto: int) -> None:
        while len(path) > upto:
            node = path.pop()
            above = path[-1] if path else None
            if node.key is not None:
                ends = np.array(node.ends, "<i8").tobytes() if node.ends else None
                rows.append([node.key, node.parent, number, node.order, node.symbol, node.least, node.depth, None, node.convs, node.children, node.leaves, node.saved, None, ends])
                continue
            node.finish()
            sha = hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest() if node.ends else EMPTY
            for i in node.waiting:
                rows[i][7] = node.least
            if above:
                above.add(node)
                if above.key is None:
                    above.waiting.append(len(rows))
            rows.append([None, above.key if above else None, number, None, node.symbol, node.least, node.depth, None, node.convs, node.children, node.leaves, node.saved, sha, None])

    for lcp, seq, conv in stream:
        if path:
            close(lcp + 1)
            onleft, shared = min(onleft, lcp), min(shared, lcp)
        else:
            onleft = -1 if left is None else common(left, seq, 0)
            path.append(Node(0, b"", _state() if onleft >= 0 or shared >= 0 else None))
            counter = 1
        for depth in range(len(path), len(seq) // WIDTH + 1):
            last = seq[(depth - 1) * WIDTH : depth * WIDTH]
            if shared == depth - 1 and right[(depth - 1) * WIDTH : depth * WIDTH] == last:
                shared = depth
            state = None
            if depth <= onleft or depth <= shared:
                state = path[-1].state.copy()
                state.update(last)
            path.append(Node(depth, last, state, path[-1].key, counter))
            counter += 1
        top = path[-1]
        top.ends.append(conv)
        top.convs += 1
        top.least = conv if top.least is None else min(top.least, conv)
    close(0)
    return rows


def _spine(rows, first: bytes | None, last: bytes | None):
    """Merges the border nodes of neighbouring ranges, given as dicts in the order of ranges and places; first and last are the outer borders."""
    outer = _keys(first) | _keys(last)
    path: list[Node] = []
    counter = 0

    def close(upto: int):
        while len(path) > upto:
            node = path.pop()
            done = node.key not in outer
            if done:
                node.finish()
                if path:
                    path[-1].add(node)
            yield [node.key, node.parent, node.waiting[0], node.order, node.symbol, node.least, node.depth, None, node.convs, node.children, node.leaves, node.saved, EMPTY if done else None, None]

    for r in rows:
        depth = r["depth"]
        if len(path) > depth and path[depth].key != r["key"]:
            yield from close(depth)
        if len(path) == depth:
            node = Node(depth, r["symbol"], None, r["parent_key"], counter)
            node.key, node.waiting = r["key"], [r["range"]]
            path.append(node)
            counter += 1
        node = path[depth]
        node.convs += r["n_convs"]
        if r["conv_id"] is not None:
            node.least = r["conv_id"] if node.least is None else min(node.least, r["conv_id"])
        node.children += r["n_children"]
        node.leaves += r["n_leaves"]
        node.saved += r["saved_tokens"]
    yield from close(0)


def _rows(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _chunks(rows, size: int = 4096):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _borders(rows: DataFrame, n: int, count: int) -> list[tuple[bytes, int]]:
    """At most n - 1 (sequence, conv_id) pairs that part the conversations into ranges of about one size."""
    if n < 2:
        return []
    least = min(1 << 20, -(-(SAMPLED * n << 20) // count))
    some = rows.filter(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 20)) < least).withColumn("_one", F.lit(1))
    placed = durable(with_offsets(some, [F.col("seq"), F.col("conv_id")], "_one", "_rank", "border-sample"), "border-ranks")
    step = max(1, placed.count() // n)
    found = placed.filter((F.col("_rank") > 0) & (F.col("_rank") % step == 0)).select("seq", "conv_id").collect()  # n rows
    return sorted((bytes(r["seq"]), r["conv_id"]) for r in found)[: n - 1]


def _runs(rows: DataFrame, shared) -> DataFrame:
    """Sorted runs, cut at the borders and packed: range, ids, lcps, sizes, tails."""
    names = ["range", "ids", "lcps", "sizes", "tails"]

    def cut(items, borders):
        items.sort()
        at, out = 0, []
        while at < len(items):
            r = bisect_right(borders, items[at])
            end = bisect_left(items, borders[r], at) if r < len(borders) else len(items)
            out.append((r, *packed(items[at:end])))
            at = end
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names)

    def run(batches):
        items, held = [], 0
        for conv, seq in _rows(batches):
            items.append((seq, conv))
            held += len(seq) + 64
            if held > RUN_BYTES:
                yield cut(items, shared.value)
                items, held = [], 0
        if items:
            yield cut(items, shared.value)

    return rows.select("conv_id", "seq").mapInArrow(run, "range int, ids binary, lcps binary, sizes binary, tails binary")


def trie(conversations: DataFrame, ranges: int | None = None, fan: int = FAN) -> DataFrame:
    """conversations (conv_id, seq: symbols one after another), one row each, to one row per node of their trie: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, turn (32 digits of its last turn's SHA-256)."""
    spark = ship(conversations.sparkSession)
    rows = durable(conversations.select("conv_id", "seq"), "conversations")
    size = rows.agg(F.count("*").alias("n"), F.sum(F.length("seq") + 16).alias("bytes")).first()
    n = ranges or max(1, -(-(size["bytes"] or 0) // RANGE_BYTES), min(partitions(spark), size["n"] // 256))
    borders = _borders(rows, n, max(size["n"], 1))
    shared = spark.sparkContext.broadcast(borders)

    def merge(batches):
        for number, group in groupby(_rows(batches), key=lambda r: r[0]):
            left, right = (shared.value[i][0] if 0 <= i < len(shared.value) else None for i in (number - 1, number))
            yield from _chunks(nodes_of(number, merged([Run(*r[1:]) for r in group]), left, right))

    dealt = _runs(rows, shared).repartition(len(borders) + 1, "range").sortWithinPartitions("range")
    parts = durable(dealt.mapInArrow(merge, FIELDS), "trie-parts")
    nodes = parts.filter("key IS NULL")
    if borders:
        spine = durable(_joined(parts, shared, len(borders) + 1, fan), "trie-spine")
        nodes = nodes.unionByName(spine)
        up = spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_up"), F.col("n_children").alias("_n"))
        below = nodes.filter("parent_key IS NOT NULL")
        placed = attach(below, up, "parent_key", "_n", below.count(), "inner").withColumn("parent_conv_id", F.col("_up")).drop("_up", "_n")
        nodes = nodes.filter("parent_key IS NULL").unionByName(placed)
    turn = F.when(F.col("depth") > 0, F.lower(F.hex(F.substring("symbol", 1, 16)))).alias("turn")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", turn)


def _joined(parts: DataFrame, shared, ranges: int, fan: int) -> DataFrame:
    """The finished border nodes, ``fan`` ranges a task in each round."""
    spine, finished, span = parts.filter("key IS NOT NULL").drop("ends"), None, 1
    names = [x for x in _NAMES if x != "ends"]
    while span < ranges:
        span *= fan

        def merge(batches, span=span):
            rows = (dict(zip([*names, "_g"], r, strict=True)) for r in _rows(batches))
            for g, group in groupby(rows, key=lambda r: r["_g"]):
                first, last = (shared.value[i][0] if 0 <= i < len(shared.value) else None for i in (g * span - 1, (g + 1) * span - 1))
                yield from _chunks(_spine(group, first, last))

        dealt = spine.select(*names, (F.col("range") / span).cast("int").alias("_g")).repartition("_g").sortWithinPartitions("_g", "range", "place")
        out = durable(dealt.mapInArrow(merge, FIELDS), "trie-round")
        done = out.filter("ends_sha256 IS NOT NULL")
        finished = done if finished is None else finished.unionByName(done)
        spine = out.filter("ends_sha256 IS NULL")

    def digest(batches):
        for key, group in groupby(_rows(batches), key=lambda r: r[0]):
            sha, lead = hashlib.sha256(), ""
            for _, _, block in group:
                sha.update((lead + ",".join(map(str, np.frombuffer(block, "<i8").tolist()))).encode())
                lead = ","
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], ["key", "_sha"])

    ends = parts.filter("ends IS NOT NULL").select("key", "range", "ends").repartition("key").sortWithinPartitions("key", "range").mapInArrow(digest, "key binary, _sha string")
    return finished.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("_sha", "ends_sha256")).select(*_NAMES)


def turns(conversations: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """turn, role, text: what the ``turn`` of a node stands for."""
    rows = conversations.select(F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.select(F.substring(symbol(F.col("role"), F.col("text")), 1, 32).alias("turn"), "role", "text").dropDuplicates(["turn"])


_S = r"substr(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) || printf('%08X', len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))"
ORACLE = rf"""
WITH RECURSIVE bits AS (SELECT b, 0 AS i, b AS v FROM range(256) r(b)
  UNION ALL SELECT b, i + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE i < 8),
step AS MATERIALIZED (SELECT b, v FROM bits WHERE i = 8),
ids AS MATERIALIZED (SELECT DISTINCT conv_id AS c, conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT c, s, 0 AS i, 4294967295 AS v FROM ids UNION ALL SELECT c, s, i + 1, xor(step.v, crc.v >> 8) FROM crc JOIN step ON step.b = xor(crc.v, ascii(substr(s, i + 1, 1))) & 255 WHERE i < length(s)),
h AS (SELECT c, xor(v, 4294967295) % {SHARED} AS h FROM crc WHERE i = length(s)),
t AS MATERIALIZED (SELECT conv_id AS c, list(s ORDER BY turn NULLS FIRST, s) AS l FROM (SELECT conv_id, turn, {_S} AS s FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
r AS MATERIALIZED (SELECT h.c, list_concat(coalesce(b.l[1:h], []), o.l[h + 1:]) AS l FROM h JOIN t o ON o.c = h.c LEFT JOIN t b ON b.c = h.c - h.c % {BLOCK}),
m AS (SELECT c, len(l) AS size, l, unnest(range(0, len(l) + 1)) AS d FROM r),
n AS MATERIALIZED (SELECT d, array_to_string(l[1:d], '') AS p, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = d), '')) AS ends_sha256 FROM m GROUP BY 1, 2),
k AS MATERIALIZED (SELECT n.*, left(p, 40 * (d - 1)::INT) AS up, coalesce(n_children, 0) AS n_children, (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE CAST('0x' || right(p, 8) AS BIGINT) END AS saved
  FROM n LEFT JOIN (SELECT d - 1 AS d, left(p, 40 * (d - 1)::INT) AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2) USING (d, p)),
x AS (SELECT left(p, (40 * a)::INT) AS p, a AS d, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM k)),
y AS (SELECT d, p, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM x GROUP BY 1, 2)
SELECT k.conv_id, k.d AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN y USING (d, p) LEFT JOIN k u ON k.d > 0 AND u.d = k.d - 1 AND u.p = k.up
"""
