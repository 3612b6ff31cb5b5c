"""Near-duplicate embeddings by spherical-cap filters with structured random product codes.

Vectors are normalised and rotated, and their coordinates cut into blocks with one code of random unit directions each.
A filter is a tuple of directions, one per block; its direction is their concatenation.  List decoding gives each vector
every filter whose inner product reaches its cap without walking through all tuples: blocks are taken in turn, directions
best first, and a branch ends where even the best rest can't reach the cap.  A vector's cap is ``cap`` times the inner
product of its best filter: with one cap for all vectors, product codes give some vectors hundreds of filters and others
none (at 51,000 vectors of 64 components 73 a vector for 99 % recall, against 15).  Vectors meet in the filters they share and
are verified there in double precision.  A pair that shares several filters is counted in the lowest one only.

The number of filters follows the number of vectors (about ``BUCKET`` vectors each); ``cap`` is the highest at which at
least ``RECALL`` of random pairs just at the threshold share a filter, measured on ``TRIALS`` such pairs, so pairs in
the data (at or above the threshold) are found at that rate or better.

Exact copies are collapsed first, into classes with numbers of their own.  Filters that differ in the last block only have
one head; a class goes to the heads of its filters, so its vector moves once for several filters, and their buckets are
verified there one by one.  Heads of more than ``HEAD`` classes are dealt by filter instead, and a filter with more than
``BLOCK`` classes as pairs of blocks of them, so no task holds more however large a group of near copies is.  Each task
returns rows per vector (its verified links, and one edge to its least neighbour in the bucket), never all pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do
vectors of different lengths; vectors are scaled by their largest component before anything is squared, so finite
vectors of any size count; -0.0 equals 0.0; repeated rows are copies, and where a vec_id stands on different vectors each
row has the links of its own vector; rows with a null vec_id link with nothing; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import attach, durable, picked
from .components import components, least_ids
from .words import ranges

THRESHOLD, RECALL, TRIALS = 0.9, 0.995, 3000
BUCKET, BLOCK, HEAD = 64, 1024, 32_768
#: Caps below this are never tried.
LEAST_CAP = 0.5
SEED = 20240917


class ProductCode:
    """A rotation and one code per block, the same in every process for one (dimension, size, blocks)."""

    def __init__(self, dim: int, size: int, blocks: int):
        rng = np.random.default_rng([SEED, dim, size, blocks])
        self.size, self.blocks = size, min(blocks, dim)
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cuts = np.array_split(np.arange(dim), self.blocks)
        self.codes = []
        for cut in self.cuts:
            c = rng.standard_normal((size, len(cut)))
            self.codes.append(c / np.linalg.norm(c, axis=1, keepdims=True) / np.sqrt(self.blocks))

    def products(self, unit: np.ndarray) -> list[np.ndarray]:
        turned = unit @ self.rotation
        return [turned[:, cut] @ code.T for cut, code in zip(self.cuts, self.codes, strict=True)]

    def decode(self, unit: np.ndarray, cap: float, shares: bool = False) -> list:
        """For each row the sorted numbers of all filters with an inner product of at least cap times its best one; with
        ``shares`` also these products as shares of the best."""
        products = self.products(unit)
        orders = [np.argsort(-p, axis=1, kind="stable") for p in products]
        tops = [np.take_along_axis(p, o, 1) for p, o in zip(products, orders, strict=True)]
        best = np.cumsum([t[:, 0] for t in tops[::-1]], axis=0)[::-1]  # the best that this block and all later ones can add
        out = []
        for r in range(len(unit)):
            branch_sum, branch_id = np.zeros(1), np.zeros(1, np.int64)
            least = cap * best[0][r] - 1e-12
            for k in range(self.blocks):
                rest = best[k + 1][r] if k + 1 < self.blocks else 0.0
                top, order = tops[k][r], orders[k][r]
                n = np.searchsorted(-top, branch_sum + rest - least, "right")  # directions with sum + top + rest >= least
                total = int(n.sum())
                which = np.repeat(np.arange(len(n)), n)
                inner = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
                branch_id = branch_id[which] * self.size + order[inner]
                branch_sum = branch_sum[which] + top[inner]
            at = np.argsort(branch_id)
            out.append((branch_id[at], branch_sum[at] / best[0][r]) if shares else branch_id[at])
        return out


@lru_cache(64)
def settings(n: int, dim: int, threshold: float = THRESHOLD) -> tuple[int, int, float]:
    """(directions per block, blocks, cap) for n vectors: filters ~ n * (filters per vector, about 16) / BUCKET."""
    filters = max(256.0, n * 16 / BUCKET)
    blocks = 2 if filters <= 1 << 20 else 3 if filters <= 1 << 30 else 4
    blocks = max(1, min(blocks, dim // 4))
    size = max(8, int(np.ceil(filters ** (1 / blocks))))
    code = ProductCode(dim, size, blocks)
    rng = np.random.default_rng([SEED, dim])
    a = rng.standard_normal((TRIALS, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((TRIALS, dim))
    b -= (a * b).sum(1, keepdims=True) * a
    norm = np.linalg.norm(b, axis=1, keepdims=True)
    b = threshold * a + np.sqrt(1 - threshold**2) * b / np.where(norm > 0, norm, 1)
    cap = 0.8  # lists get longer as it falls, so they are made once at a likely value and again only if that is too high
    while True:
        most = []  # for each pair the highest cap at which it shares a filter
        for (fa, sa), (fb, sb) in zip(*(code.decode(x, cap, True) for x in (a, b)), strict=True):
            _, i, j = np.intersect1d(fa, fb, True, True)
            most.append(np.minimum(sa[i], sb[j]).max() if len(i) else 0.0)
        found = float(np.sort(most)[int(TRIALS * (1 - RECALL))])
        if found >= cap or cap <= LEAST_CAP:
            return size, blocks, max(found, LEAST_CAP)
        cap = max(cap - 0.1, LEAST_CAP)


def scaled(m: np.ndarray) -> np.ndarray:
    """Unit rows; the largest component goes first, so that no square over- or underflows."""
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _filters(plans: dict[int, tuple[int, int, float]]):
    """rep, copies, dim, filters and the vector as bytes, in single precision where nothing is lost."""

    def run(batches):
        codes = {d: ProductCode(d, s, b) for d, (s, b, _) in plans.items()}
        for batch in batches:
            by: dict[int, list[int]] = {}
            vectors = batch.column(2).to_pylist()
            for i, v in enumerate(vectors):
                by.setdefault(len(v), []).append(i)
            for dim, at in by.items():
                m = np.array([vectors[i] for i in at], np.float64)
                lists = codes[dim].decode(scaled(m), plans[dim][2])
                with np.errstate(over="ignore"):
                    small = m.astype("<f4")
                images = [(small[i] if e else m[i]).tobytes() for i, e in enumerate((small == m).all(1).tolist())]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
                filters = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *lists])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(np.full(len(at), dim, np.int32)), filters, pa.array(images, pa.binary())],
                    ["rep", "copies", "dim", "filters", "vector"],
                )

    return run


def _forest(linked: np.ndarray) -> np.ndarray:
    """For each node the least index it reaches in a symmetric boolean matrix."""
    n = len(linked)
    label = np.arange(n)
    full = linked | np.eye(n, dtype=bool)
    while True:
        new = np.where(full, label, n).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class _Cell:
    """Classes that met in a task, and what their buckets have shown so far."""

    def __init__(self, table: pa.Table, threshold: float):
        dim = table.column("dim")[0].as_py()
        self.threshold = threshold
        self.ids, self.copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        self.units = scaled(np.array([np.frombuffer(x, "<f4" if len(x) == 4 * dim else "<f8") for x in table.column("vector").to_pylist()], np.float64))
        lists = table.column("filters").combine_chunks()
        self.every, self.size = lists.flatten().to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.out = [(np.zeros(0, np.int64),) * 3]

    def _lower(self, rows: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(row's place in rows, filter) of the rows' filters below a number."""
        every, of = self.every[ranges(self.first[rows], self.size[rows])], np.repeat(np.arange(len(rows)), self.size[rows])
        return of[every < number], every[every < number]

    def add(self, number: int, a: np.ndarray, b: np.ndarray | None = None) -> None:
        """The pairs within a, or between a and b, that are close and share no lower filter, where they count already."""
        close = self.units[a] @ self.units[a if b is None else b].T >= self.threshold
        if b is None:
            np.fill_diagonal(close, False)
        if not close.any():
            return
        both = a if b is None else np.concatenate((a, b))
        of, lower = self._lower(both, number)
        seen, place = np.unique(lower, return_inverse=True)
        has = np.zeros((len(both), len(seen)), np.float32)
        has[of, place] = 1
        close &= has[: len(a)] @ has[0 if b is None else len(a) :].T < 0.5
        links = close @ self.copies[a if b is None else b]
        full = close
        if b is not None:
            links = np.concatenate((links, close.T @ self.copies[a]))
            full = np.zeros((len(both), len(both)), bool)
            full[: len(a), len(a) :] = close
            full |= full.T
        order = np.argsort(self.ids[both], kind="stable")
        root = np.empty(len(both), np.int64)
        root[order] = self.ids[both][order][_forest(full[np.ix_(order, order)])]
        found = np.flatnonzero(links)
        self.out.append((self.ids[both][found], links[found], root[found]))

    def result(self) -> pa.Table:
        return pa.table({k: np.concatenate(x) for k, x in zip(("rep", "links", "root"), zip(*self.out, strict=True), strict=True)})


def _verify(threshold: float):
    """A filter's bucket, or a pair of blocks of it."""

    def run(table: pa.Table) -> pa.Table:
        cell, own = _Cell(table, threshold), table.column("own").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        cell.add(table.column("filter")[0].as_py(), np.flatnonzero(own == i), None if i == j else np.flatnonzero(own == j))
        return cell.result()

    return run


def _verify_head(threshold: float, strides: dict[int, int]):
    """All buckets of a head."""

    def run(table: pa.Table) -> pa.Table:
        cell = _Cell(table, threshold)
        head, stride = table.column("head")[0].as_py(), strides[table.column("dim")[0].as_py()]
        of = np.repeat(np.arange(len(cell.ids)), cell.size)
        here = np.flatnonzero(cell.every // stride == head)
        here = here[np.lexsort((of[here], cell.every[here]))]
        number, of = cell.every[here], of[here]
        cuts = [*(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
        for s, e in zip([0, *cuts[:-1]], cuts, strict=True):
            rows = [of[k : min(k + BLOCK, e)] for k in range(s, e, BLOCK)]
            for x, a in enumerate(rows):
                if len(a) > 1:
                    cell.add(int(number[s]), a)
                for b in rows[:x]:
                    cell.add(int(number[s]), a, b)
        return cell.result()

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    ship(vectors.sparkSession)
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = picked(vectors, {"vec_id": F.col(id_col).cast("long"), "v": F.col(vector_col).cast(kind)})
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    plain = F.transform("v", lambda x: F.when(x == 0, F.lit(0).cast(kind[6:-1])).otherwise(x))  # no -0.0
    keys = [F.xxhash64(F.lit(k), "v").alias(f"h{k}") for k in (1, 2)]
    rows = durable(rows.withColumn("good", good).withColumn("v", F.when(F.col("good"), plain)), "vectors")
    # classes by the vectors themselves; their rows find them by a digest
    classes = rows.filter("good").groupBy("v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = durable(classes.select("v", "first_id", "copies", *keys, F.monotonically_increasing_id().alias("rep")), "classes")
    dims = {r["d"]: r["n"] for r in classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    plans = {d: settings(n, d, threshold) for d, n in dims.items()}
    listed = durable(classes.select("rep", "copies", "v").mapInArrow(_filters(plans), "rep long, copies long, dim int, filters array<long>, vector binary"), "filters")
    # heads of moderate size by themselves, the filters of all others one by one
    strides = {d: size for d, (size, _, _) in plans.items()}
    stride = F.create_map(*[F.lit(x).cast("long") for kv in strides.items() for x in kv])[F.col("dim").cast("long")] if strides else F.lit(1).cast("long")
    headed = listed.withColumn("stride", stride).withColumn("heads", F.expr("array_distinct(transform(filters, f -> f div stride))"))
    spread = headed.select("dim", F.explode("heads").alias("head"), "rep")
    sizes = durable(spread.groupBy("dim", "head").agg(F.count("*").alias("n")).filter("n > 1"), "heads")
    few, many = sizes.filter(F.col("n") <= HEAD), sizes.filter(F.col("n") > HEAD)
    cells = spread.join(few.select("dim", "head"), ["dim", "head"]).select("head", "rep").join(listed, "rep")
    kind = "rep long, links long, root long"
    found = cells.groupBy("dim", "head").applyInArrow(_verify_head(threshold, strides), kind)
    if not many.isEmpty():
        crowded = headed.select("dim", "stride", F.explode("filters").alias("filter"), "rep").withColumn("head", F.expr("filter div stride")).join(many.select("dim", "head"), ["dim", "head"], "left_semi").select("dim", "filter", "rep")
        buckets = durable(crowded.groupBy("dim", "filter").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
        split = attach(crowded, buckets, ["dim", "filter"], "n", buckets.agg(F.sum("n")).first()[0] or 0, "inner")
        split = split.withColumn("k", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int"))
        split = split.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumn("i", F.least("own", "o")).withColumn("j", F.greatest("own", "o"))
        split = split.select("filter", "rep", "own", "i", "j").join(listed, "rep")
        found = found.unionByName(split.groupBy("dim", "filter", "i", "j").applyInArrow(_verify(threshold), kind))
    found = durable(found, "links")
    tree = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = least_ids(classes.select("rep", "first_id", "copies", "h1", "h2").join(per, "rep", "left"), tree, "first_id")
    named = durable(named.select("h1", "h2", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "named")
    linked = attach(rows.filter("good").select("vec_id", *keys), named, ["h1", "h2"], "copies", rows.count(), "inner").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = r"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
g AS (SELECT vec_id, e, sqrt(list_sum([x * x FOR x IN e])) AS n FROM v WHERE len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND list_sum([abs(x) FOR x IN e]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / a.n / b.n >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
