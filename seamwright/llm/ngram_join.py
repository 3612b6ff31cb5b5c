"""Near-duplicate documents by a grouped prefix join on word shingles (Jaccard similarity).

1. A document is the set of its distinct n-word shingles (64-bit hashes; A-Z folded).  Rows with equal sets (128-bit
   fingerprint) become one class with a number of its own; everything below works on classes, so rows of one doc_id with
   different texts never meet in one, and doc_ids come back only at the end.
2. Prefix filter: under one global order of shingles, two sets with similarity >= t share a shingle among the first
   n - ceil(t n) + 1 of each.  Any order is right; rare shingles first keeps candidate lists short.  Exact document
   frequencies are counted for the shingles whose hash lies in the lowest ``RANKED`` of all hashes; the order is: those by
   (frequency, hash), then those of them found ``heavy`` by (estimated frequency, hash), then all others by hash.  Heavy shingles - kept out of
   the counting groups so that none can swamp one - come from mergeable frequent-item summaries of ``COUNTERS`` counters
   a task over all documents, at most ``HEAVY`` of them, so their broadcast is bounded.
3. Classes with the same prefix and size form a group; lists of groups are kept by prefix shingle.
4. Lists are read pair by pair.  A pair goes on if its sizes allow the similarity, if the places of the list's shingle
   in both orders do (positional filter: at its first common shingle a pair still has to find all of its intersection),
   and if 1024-bit parity maps of the sets do (they differ in no more bits than the sets in shingles).  Lists of more
   than ``BLOCK`` entries are read as pairs of blocks.
5. Links only matter for reachability, so pairs of one component are left out and the first two rounds take one pair per
   entry: groups first, each member with its group's first one, then all members.  The third round expands everything
   that is still in different components and passes the filters.  Pairs are verified on the full sets and components
   taken after each round, so a group of near copies costs its size and no component is missed.

Defined cases: null, empty or wordless texts have an empty set and link with nothing; with fewer words than a shingle
the whole sequence is the one shingle; repeated rows of one doc_id are copies, and where its rows have different texts
each row has the component of its own text; rows with a null doc_id get a null component and link with nothing; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import BROADCAST_ROWS, attach, durable, partitions, picked
from .components import components, least_ids
from .words import held, set_digest, shingle_hashes, trim

WORDS, PERCENT = 5, 80
#: Share of the hash space whose shingles are ranked by frequency; above the longest prefix share (1 - t) with room.
RANKED = 0.35
COUNTERS, HEAVY, LEAST_HEAVY = 1 << 17, 1 << 18, 256
#: Counted shingles in one group; members in one block of a list.
GROUP, BLOCK = 3_000_000, 2048
#: Least and most shingles in the sets that one cell verifies (a set may be larger by itself), and what a pair costs besides.
LOW, HIGH, PAIR = 1 << 13, 1 << 21, 32
#: Bits of the parity maps.
BITS = 1024
_TOP = np.uint64(int(RANKED * (1 << 64)))
_SHARE = (_TOP >> np.uint64(32)) + np.uint64(1)


def prefix_size(n, percent: int):
    """n - ceil(n * percent / 100) + 1, in whole numbers."""
    return n - -(-n * percent // 100) + 1


class _Frequent:
    """A Misra-Gries summary: merges counts and, over ``size`` items, takes the next largest count from all."""

    def __init__(self, size: int):
        self.size, self.items, self.counts, self.total = size, np.zeros(0, np.uint64), np.zeros(0, np.int64), 0

    def add(self, items: np.ndarray) -> None:
        self.total += len(items)
        new, n = np.unique(items, return_counts=True)
        both, place = np.unique(np.concatenate((self.items, new)), return_inverse=True)
        total = np.bincount(place, np.concatenate((self.counts, n)), len(both)).astype(np.int64)
        if len(both) > self.size:
            total = total - np.partition(total, -self.size - 1)[-self.size - 1]
            both, total = both[total > 0], total[total > 0]
        self.items, self.counts = both, total

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        """Items and counts over one and over the summary's own error, total / size.  So over all tasks an item's count is
        short by no more than 2 * (sum of totals) / size + (number of tasks), and items met once in a task don't move."""
        keep = self.counts > max(1, self.total // self.size)
        return self.items[keep], self.counts[keep]


def _sets(words: int):
    """kind 0: doc_id, key, n, f1, f2 of a row; kind 1: a frequent ranked shingle (f1) and its count in the task (n)."""
    names = ["kind", "doc_id", "key", "n", "f1", "f2"]

    def run(batches):
        held(None)
        often = _Frequent(COUNTERS)
        for batch in batches:
            sets = [shingle_hashes(t, words) if t else np.zeros(0, np.uint64) for t in batch.column(1).to_pylist()]
            n = np.array([len(s) for s in sets], np.int64)
            f = [set_digest(s) for s in sets]
            f1, f2 = (np.array([x[k] for x in f], np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), batch.column(0), batch.column(2), pa.array(n), pa.array(f1), pa.array(f2)], names)
            if sets:
                once = dict(zip(f, sets, strict=True))
                often.add(np.concatenate([s[: np.searchsorted(s, _TOP)] for s in once.values()]))
        trim()
        items, counts = often.found()
        k = len(items)
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(k, np.int32)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(counts), pa.array(items.view(np.int64)), pa.array(np.zeros(k, np.int64))], names)

    return run


def _deal(words: int, percent: int, groups: int, heavy):
    """Ranked shingles that aren't heavy, dealt into groups by hash: one row a group and batch, of (shingle, set's number)
    and the sets' (f1, f2, n, number of such shingles).  Sets whose prefix goes beyond these come once more without any."""

    def run(batches):
        known = heavy.value[0]
        for batch in batches:
            once = {}
            for text in batch.column(0).to_pylist():
                s = shingle_hashes(text, words) if text else None
                if s is not None and len(s):
                    once[set_digest(s)] = s
            if not once:
                continue
            parts = [s[: np.searchsorted(s, _TOP)] for s in once.values()]
            parts = [p[~np.isin(p, known, assume_unique=True)] if len(known) else p for p in parts]
            token = np.concatenate(parts)
            of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            keys = np.array([(a, b, len(s), len(p)) for ((a, b), s), p in zip(once.items(), parts, strict=True)], np.int64)
            beyond = keys[prefix_size(keys[:, 2], percent) > keys[:, 3]]
            if len(beyond):
                yield pa.RecordBatch.from_arrays([pa.array([int(beyond[0, 0]) % groups]), pa.array([b""]), pa.array([b""]), pa.array([beyond.tobytes()])], ["g", "tokens", "places", "sets"])
            order = np.argsort(token)
            token, of = token[order], of[order]
            group = ((token >> np.uint64(32)) * np.uint64(groups) // _SHARE).astype(np.int64)  # ranges of hashes, so they come in order too
            cuts = [*(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)] if len(group) else []
            for a, b in zip([0, *cuts[:-1]], cuts, strict=False):  # without a ranked shingle there is nothing to deal
                docs, place = np.unique(of[a:b], return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array([group[a]]), *(pa.array([x.tobytes()], pa.binary()) for x in (token[a:b], place.astype(np.int32), keys[docs]))], ["g", "tokens", "places", "sets"])
        trim()

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of one group: each (set, shingle) whose shingle more than one set holds, with the number that do; without shingle, sets that came so."""
    tokens, owners, beyond, at = [], [], [np.zeros((0, 4), np.int64)], 0
    sets = []
    for t, p, s in zip(*(table.column(c).to_pylist() for c in ("tokens", "places", "sets")), strict=True):
        keys = np.frombuffer(s, np.int64).reshape(-1, 4)
        if not t:
            beyond.append(keys)
        tokens.append(np.frombuffer(t, np.uint64))
        owners.append(np.frombuffer(p, np.int32).astype(np.int64) + at)
        sets.append(keys)
        at += len(keys)
    keys = np.concatenate(sets)
    uniq, same = np.unique(keys, axis=0, return_inverse=True)
    token, owner = np.concatenate(tokens), same.ravel()[np.concatenate(owners)]
    order = np.lexsort((owner, token))
    token, owner = token[order], owner[order]
    new = np.concatenate(([True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])))[: len(token)]
    token, owner = token[new], owner[new]
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
    df = np.repeat(np.diff(np.append(first, len(token))), np.diff(np.append(first, len(token)))) if len(token) else np.zeros(0, np.int64)
    keep = df > 1
    alone = np.unique(np.concatenate(beyond), axis=0)
    who = np.concatenate((uniq[owner[keep]], alone))
    none = np.arange(len(who)) >= int(keep.sum())
    columns = [np.concatenate((x, np.zeros(len(alone), np.int64))) for x in (token[keep].view(np.int64), df[keep].astype(np.int64))]
    trim(table.nbytes)
    return pa.table({"f1": who[:, 0], "f2": who[:, 1], "n": who[:, 2], "own": who[:, 3], "token": pa.array(columns[0], mask=none), "df": pa.array(columns[1], mask=none)})


def _prefixes(words: int, percent: int, heavy):
    """rep, n, skip (shingles of the prefix that no other set holds, which come first), the rest of the prefix, the parity map, the whole set."""

    def run(batches):
        known, counts = heavy.value
        for batch in batches:
            out = []
            for rep, text, ranked in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                s = shingle_hashes(text or b"", words)
                n = len(s)
                if not n:
                    continue
                left = prefix_size(n, percent)
                low = s[: np.searchsorted(s, _TOP)]
                common = np.isin(low, known, assume_unique=True) if len(known) else np.zeros(len(low), bool)
                shared = sorted(((r["df"], int(np.int64(r["token"]).view(np.uint64))) for r in ranked or []))
                skip = len(low) - int(common.sum()) - len(shared)
                left -= skip
                take = [t for _, t in shared[: max(left, 0)]]
                left -= len(shared)
                if left > 0:
                    often = low[common]
                    take += often[np.lexsort((often, counts[np.searchsorted(known, often)]))][:left].tolist()
                    left -= int(common.sum())
                if left > 0:
                    take += s[len(low) :][:left].tolist()
                if take:
                    bits = np.packbits(np.bincount((s >> np.uint64(24)).astype(np.int64) % BITS, minlength=BITS) & 1)
                    out.append((rep, n, skip, np.array(take, np.uint64).view(np.int64), bits.tobytes(), s.tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], ["rep", "n", "skip", "prefix", "bits", "set"])
        trim()

    return run


def _check(percent: int):
    def run(table: pa.Table) -> pa.Table:
        a, b, sets = (table.column(c).to_pylist() for c in ("a", "b", "set"))
        firsts = {x: np.frombuffer(s, np.uint64) for x, y, s in zip(a, b, sets, strict=True) if y is None}
        hit = []
        for x, y, s in zip(a, b, sets, strict=True):
            if y is not None:
                p, q = firsts[x], np.frombuffer(s, np.uint64)
                both = len(np.intersect1d(p, q, True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    hit.append((x, y))
        del sets, firsts
        trim(table.nbytes)
        return pa.table({"a": pa.array([x for x, _ in hit], pa.int64()), "b": pa.array([y for _, y in hit], pa.int64())})

    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough; n is the size of b's set, so a cell's load is known before any set moves.

    A set that many pairs start from moves once for each share of them; a share is a quarter of what a task would get if
    all loads were dealt evenly, within LOW and HIGH shingles."""
    pairs = durable(pairs.distinct(), "pairs")
    load = F.col("n") + PAIR
    total, loads = pairs.agg(F.count("*"), F.coalesce(F.sum(load), F.lit(0))).first()
    parts = partitions(pairs.sparkSession)
    share = min(max(loads // (4 * parts), LOW), HIGH)
    often = pairs.groupBy("a").agg(F.count("*").alias("c"), F.sum(load).alias("load"))
    salted = attach(pairs, often, "a", "c", total, "inner").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("load") / share)))
    cell = F.pmod(F.xxhash64("a", "salt"), F.lit(max(parts, 2 * loads // share + 1)))
    salted = durable(salted.select("a", "b", cell.alias("cell"), "salt"), "salted")
    members = salted.join(sets.select(F.col("rep").alias("b"), "set"), "b").select("cell", "a", "b", "set")
    firsts = salted.select("cell", "a").distinct().join(sets.select(F.col("rep").alias("a"), "set"), "a").select("cell", "a", F.lit(None).cast("long").alias("b"), "set")
    return durable(members.unionByName(firsts).groupBy("cell").applyInArrow(_check(percent), "a long, b long"), "links")


def _read_lists(percent: int, one_each: bool):
    """Pairs of entries in different components that pass the filters, list by list; one_each: with the first such entry before it only."""

    def run(table: pa.Table) -> pa.Table:
        token, rep, n, at_most, comp, own, i, j = (table.column(c).to_numpy() for c in ("token", "rep", "n", "rest", "comp", "own", "i", "j"))
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(token), BITS // 64)
        order = np.lexsort((rep, token))
        token = token[order]
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        out = [np.zeros((0, 3), np.int64)]
        for s, e in zip(first.tolist(), [*first[1:].tolist(), len(token)], strict=True):
            at = order[s:e]
            left = at[own[at] == i[at]]
            right = left if i[at[0]] == j[at[0]] else at[own[at] == j[at]]
            ok = (comp[left][:, None] != comp[right][None, :]) & (rep[left][:, None] > rep[right][None, :] if right is left else True)
            sizes = n[left][:, None] + n[right][None, :]
            ok &= (100 + percent) * np.minimum(n[left][:, None], n[right][None, :]) >= percent * sizes
            ok &= (100 + percent) * np.minimum(at_most[left][:, None], at_most[right][None, :]) >= percent * sizes
            x, y = np.nonzero(ok)
            for k in range(0, len(x), 1 << 18):  # in slices, as the maps of all pairs may be large
                p, q = x[k : k + (1 << 18)], y[k : k + (1 << 18)]
                apart = np.bitwise_count(bits[left[p]] ^ bits[right[q]]).sum(1, dtype=np.int64)
                total = sizes[p, q]
                good = (100 + percent) * ((total - apart) // 2) >= percent * total
                p, q = p[good], q[good]
                if one_each and len(p):
                    new = np.unique(p, return_index=True)[1]
                    p, q = p[new], q[new]
                x1, x2 = left[p], right[q]
                later = rep[x1] < rep[x2]
                out.append(np.stack((np.minimum(rep[x1], rep[x2]), np.maximum(rep[x1], rep[x2]), np.where(later, n[x2], n[x1])), 1))
        pair = np.unique(np.concatenate(out), axis=0)
        del bits, out
        trim(table.nbytes)
        return pa.table({"a": pair[:, 0], "b": pair[:, 1], "n": pair[:, 2]})

    return run


def _candidates(entries: DataFrame, percent: int, one_each: bool) -> DataFrame:
    """entries: rep, n, skip, prefix, bits, comp.  Lists that hold one component only are dropped before anything moves."""
    n = partitions(entries.sparkSession)
    placed = entries.select(F.posexplode("prefix").alias("at", "token"), "rep", "n", "skip", "comp", "bits")
    # rest: shingles from this one on in the order
    spread = durable(placed.select("token", "rep", "n", (F.col("n") - F.col("skip") - F.col("at")).alias("rest"), "comp", "bits"), "lists")
    mixed = spread.groupBy("token").agg(F.count("*").alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("token", "c")
    size = spread.count()
    cells = attach(spread, mixed, "token", "c", size, "inner").withColumn("k", F.ceil(F.col("c") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
    cells = cells.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumn("i", F.least("own", "o")).withColumn("j", F.greatest("own", "o"))
    cells = cells.withColumn("cell", F.when(F.col("k") == 1, F.pmod(F.xxhash64("token"), F.lit(max(n, size // 50_000 + 1)))).otherwise(F.xxhash64("token", "i", "j")))
    return cells.drop("o", "k", "c").groupBy("cell", "i", "j").applyInArrow(_read_lists(percent, one_each), "a long, b long, n long")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least doc_id it reaches by links, itself included)."""
    return _resolved(docs, words, percent, id_col, text_col).select("doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"))


def distinct_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one document of each group of near duplicates: that of the least doc_id, ties by a digest of the text.

    Rows without doc_id, or without words, stay.  Texts move only where more rows go than may be broadcast."""
    tag = uuid.uuid4().hex[:8]  # for names that no column of docs has
    ids, key = f"_id{tag}", f"_key{tag}"
    found = _resolved(docs, words, percent, "doc_id", "text")
    lost = found.filter((F.col("doc_id") != F.col("least.doc_id")) | (F.col("key") != F.col("least.key"))).select(F.col("doc_id").alias(ids), F.col("key").alias(key)).distinct()
    lost = durable(lost, "lost")
    few = lost.count() <= BROADCAST_ROWS
    same = (docs["doc_id"].cast("long") == F.col(ids)) & (F.unhex(F.md5(docs["text"].cast("binary"))) == F.col(key))
    return docs.join(F.broadcast(lost) if few else lost, same, "left_anti")


def _resolved(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key (digest of the text), n_shingles, least: the least (doc_id, key) of the row's component."""
    spark = ship(docs.sparkSession)
    texts = picked(docs, {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("binary")})
    texts = texts.withColumn("key", F.unhex(F.md5("text")))  # tells rows of one doc_id apart
    both = durable(texts.mapInArrow(_sets(words), "kind int, doc_id long, key binary, n long, f1 long, f2 long"), "sets")
    rows = both.filter("kind = 0").select("doc_id", "key", "n", "f1", "f2")
    linkable = rows.filter("n > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "key")).alias("one"), F.min("n").alias("n"), F.count("*").alias("copies"))
    classes = durable(classes.select("f1", "f2", "n", "copies", "one.doc_id", "one.key", F.monotonically_increasing_id().alias("rep")), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    counted = int(total * RANKED) + 1
    known = both.filter("kind = 1").groupBy("f1").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(LEAST_HEAVY, counted // HEAVY)).toArrow()
    tokens, often = known.column("f1").to_numpy().view(np.uint64), known.column("n").to_numpy()
    order = np.argsort(tokens)
    heavy = spark.sparkContext.broadcast((tokens[order], often[order]))
    groups = max(partitions(spark), -(-counted // GROUP))
    dealt = texts.filter("doc_id IS NOT NULL").select("text").mapInArrow(_deal(words, percent, groups, heavy), "g long, tokens binary, places binary, sets binary")
    shared = durable(dealt.groupBy("g").applyInArrow(_shared, "f1 long, f2 long, n long, own long, token long, df long"), "shared")
    lists = shared.groupBy("f1", "f2", "n", "own").agg(F.count("token").alias("c"), F.collect_list(F.when(F.col("token").isNotNull(), F.struct("df", "token"))).alias("ranked"))
    # own - c ranked shingles that no other set holds come first in the order; a prefix of no more than these links with nothing
    longest = F.col("n") - F.ceil(F.col("n") * percent / 100) + 2
    lists = lists.filter(longest > F.col("own") - F.col("c")).select("f1", "f2", "ranked")
    needs = classes.join(lists, ["f1", "f2"]).select("doc_id", "key", "rep", "ranked")
    once = texts.filter("doc_id IS NOT NULL")
    if not linkable.groupBy("doc_id", "key").count().filter("count > 1").isEmpty():  # repeated rows
        once = once.groupBy("doc_id", "key").agg(F.first("text").alias("text"))
    once = once.join(needs, ["doc_id", "key"]).select("rep", "text", "ranked")
    sets = durable(once.mapInArrow(_prefixes(words, percent, heavy), "rep long, n long, skip long, prefix array<long>, bits binary, set binary"), "prefixes")
    # groups of equal prefix and size, and their lists.  The prefix goes by a digest, so that no long key moves; were two
    # prefixes to share one, their pairs would fail verification and all members are read by their own prefix below
    alike = [F.xxhash64(F.lit(k), "n", "skip", "prefix").alias(f"s{k}") for k in (1, 2)]
    named = sets.select("rep", "n", "skip", "prefix", "bits", *alike)
    grouped = named.groupBy("s1", "s2").agg(F.min("rep").alias("gid"), F.count("*").alias("members"))
    group_of = durable(attach(named, grouped, ["s1", "s2"], "members", sets.count(), "inner").drop("s1", "s2", "members"), "groups")
    firsts = group_of.filter("rep = gid").withColumn("comp", F.col("rep"))
    members = group_of.filter("rep <> gid").select(F.col("gid").alias("a"), F.col("rep").alias("b"), "n")
    links = _verify(_candidates(firsts, percent, True).unionByName(members), sets, percent)
    final = components(links)
    for one_each in (True, False):
        comp = final.withColumnRenamed("node", "rep").withColumnRenamed("component", "comp")
        now = group_of.join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        more = _verify(_candidates(now, percent, one_each), sets, percent)
        if not more.isEmpty():
            links = links.unionByName(more)
            final = components(links)
    own = classes.select("f1", "f2", "copies", "rep", F.struct("doc_id", "key").alias("one"))
    by = durable(least_ids(own, final, "one").select("f1", "f2", "copies", F.col("component_id").alias("least")), "named")
    linked = attach(linkable, by, ["f1", "f2"], "copies", rows.count(), "inner").select("doc_id", "key", F.col("n").alias("n_shingles"), "least")
    alone = rows.filter("n = 0 OR doc_id IS NULL").select("doc_id", "key", F.col("n").alias("n_shingles"), F.struct("doc_id", "key").alias("least"))
    return linked.unionByName(alone)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:least(i + 3, len(w))], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT documents.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN r ON r.a = documents.doc_id GROUP BY documents.doc_id
"""
