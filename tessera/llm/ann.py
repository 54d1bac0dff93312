"""Nearest neighbours: lists of a coarse quantiser, scanned with an adaptive number of dimensions.

Largest inner product becomes smallest distance by one more dimension, sqrt(M^2 - |x|^2) (0 for a query).
Vectors are rotated by a random orthogonal matrix and laid out in blocks of columns, so a partial
distance over the first d of D columns estimates the whole. Candidates whose partial distance is too
large for the threshold fail a hypothesis test (after Gao and Long 2023) and are abandoned; the rest are
measured exactly on the original vectors. The threshold starts at the k-th best of a broadcast
sample, which bounds the k-th of the probed lists from the start. How many lists are probed is fitted: the least
number that holds RECALL of the true neighbours within the sample. Vectors that are alike are
abandoned together, so a query left with fewer than k scans its lists again without the test.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import Scratch, shared, table

#: The index is fitted on at most so many rows; all rows are indexed.
SAMPLE = 10_000
#: The share of the sample's true neighbours that the probed lists hold, and how many of its rows are asked to find their number.
RECALL, ASKED = 0.96, 500
#: Lists grow with the root of the table; beyond one for so many sampled rows each is split by what is left of a vector after its centre.
ROWS, SPLIT = 40, 32
#: Most vectors, and queries, that meet in one task, about.
VECTORS, QUERIES = 4096, 2048
#: Pairs are measured one by one once a smaller share of a block's is left; so many are measured exactly at once.
DENSE, PAIRS = 1 / 32, 1 << 16
#: e of the hypothesis test.
EPSILON = 3.0


def usable(vec: Column) -> Column:
    """Not null, not empty, finite throughout, not zero."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(good, F.lit(False)) & F.coalesce(F.exists(vec, lambda x: x != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


class Index:
    """Rotation, norms' bound, centroids, and the sample that gives first thresholds."""

    def __init__(self, ids: np.ndarray, sample: np.ndarray, top: float, n: int, k: int):
        dim = sample.shape[1]
        rng = np.random.default_rng(0)
        self.rotation = np.linalg.qr(rng.standard_normal((dim + 1, dim + 1)))[0]
        self.top, self.k, self.ids, self.sample = top, k, ids, sample.astype(np.float32)
        edges = [1, *range(1 + max(4, dim // 8), dim, max(4, dim // 8)), dim + 1]
        self.blocks = [slice(a, b) for a, b in zip([0, *edges[1:-1]], edges[1:], strict=True)]
        x = self.turn(sample)
        wanted = int(max(np.sqrt(n) / 8, 1))
        lists = int(np.clip(wanted, 1, max(len(x) // ROWS, 1)))
        first = self._means(x, lists, rng)
        if wanted > lists:
            split = int(np.clip(-(-wanted // lists), 2, SPLIT))
            rest = self._means(x - first[self.nearest(x)], split, rng)
            self.centres = (first[:, None] + rest[None]).reshape(-1, x.shape[1])
        self.sample_lists = self.nearest(x)
        self.sizes = np.zeros(len(self.centres), np.int64)
        self.many = self._enough(sample)

    def _means(self, x: np.ndarray, lists: int, rng) -> np.ndarray:
        self.centres = x[rng.choice(len(x), lists, replace=False)]
        for _ in range(8):
            near = self.nearest(x)
            count = np.bincount(near, minlength=lists)
            sums = np.zeros_like(self.centres)
            np.add.at(sums, near, x)
            self.centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], self.centres)
        return self.centres

    def _enough(self, sample: np.ndarray) -> int:
        """How many lists, nearest first, hold RECALL of the k nearest within the sample; a table's nearest are nearer still."""
        q = sample[:ASKED]
        product = q @ sample.T
        product[np.arange(len(q)), np.arange(len(q))] = -np.inf
        k = min(self.k, len(sample) - 1)
        if k < 1:
            return len(self.centres)
        best = np.argpartition(-product, k - 1, axis=1)[:, :k]
        order = np.argsort(self.distances(self.turn(q, query=True)), axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
        needed = np.take_along_axis(rank, self.sample_lists[best], axis=1)
        return int(np.quantile(needed, RECALL, method="higher")) + 1

    def turn(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """With the extra dimension, all rotated: no column holds more of a distance than another on average."""
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top**2 - (x * x).sum(1), 0))
        return np.concatenate((extra[:, None], x), axis=1) @ self.rotation

    def distances(self, x: np.ndarray) -> np.ndarray:
        return (x * x).sum(1)[:, None] - 2 * x @ self.centres.T + (self.centres**2).sum(1)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self.distances(x[a : a + 4096]).argmin(1) for a in range(0, len(x), 4096)]) if len(x) else np.empty(0, np.int64)

    def probes(self, q: np.ndarray, many: int | None) -> list[np.ndarray]:
        """Each query's lists, nearest first: as many as fitted, or as given, and enough to hold k vectors besides itself."""
        order = np.argsort(self.distances(self.turn(q, query=True)), axis=1, kind="stable")
        held = np.cumsum(self.sizes[order], axis=1)
        many = self.many if many is None else many
        enough = (held < self.k + 1).sum(1) + 1
        return [o[: max(many, e)] for o, e in zip(order, enough, strict=True)]

    def thresholds(self, ids: np.ndarray, q: np.ndarray, probed: list[np.ndarray]) -> np.ndarray:
        """A bound of each query's k-th distance in its probed lists, from the sample's rows in them.

        It stands a few ranks above k, so that a candidate wrongly abandoned leaves enough others.
        """
        rank = self.k + 12
        if len(self.ids) < rank:
            return np.full(len(q), np.inf)
        product = q @ self.sample.T.astype(np.float64)
        product[ids[:, None] == self.ids[None, :]] = -np.inf
        for i, lists in enumerate(probed):
            product[i, ~np.isin(self.sample_lists, lists)] = -np.inf
        kth = np.partition(product, -rank, axis=1)[:, -rank]
        far = (q * q).sum(1) + self.top**2 - 2 * np.where(np.isfinite(kth), kth, 0)
        return np.where(np.isfinite(kth), far + 1e-6 * (1 + np.abs(far)), np.inf)

    def limit(self, bound, done: int):
        """What a partial distance over done columns may be if the whole is within the bound.

        Under a random rotation the share of a squared length in d of D columns has mean d / D; a share beyond
        (1 + e / sqrt(d))^2 times that is held against the candidate.
        """
        dim = self.blocks[-1].stop
        if done >= dim:
            return bound * (1 + 1e-9) + 1e-9
        return bound * (done / dim) * (1 + EPSILON / np.sqrt(done)) ** 2 + 1e-9

    def scan(self, ids, x, t, asks, q, t_q, bounds) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(queries' positions, vectors' positions, scores) of the best k of one block of vectors for each query.

        x, q: the vectors and queries as they are; t, t_q: turned. A block of columns is measured for all pairs of many
        queries at once while the tests leave a good part of them, at least the first two; the others only for the pairs left.
        """
        # |a - b|^2 as one product of (-2 a, 1, |a|^2) and (b, |b|^2, 1).
        beside = lambda y, *more: np.concatenate((y, *(np.broadcast_to(np.reshape(m, (-1, 1)), (len(y), 1)) for m in more)), axis=1)
        columns = [beside(t[:, b], (t[:, b] ** 2).sum(1), 1.0).T for b in self.blocks]
        for a in range(0, len(asks), 128):
            own, some = t_q[a : a + 128], bounds[a : a + 128]
            alive = ids[None, :] != asks[a : a + 128, None]
            partial, done = np.zeros(alive.shape), 0
            for b, part in zip(self.blocks, columns, strict=True):
                if done >= 2 and np.count_nonzero(alive) < DENSE * alive.size:
                    break
                partial += beside(-2 * own[:, b], 1.0, (own[:, b] ** 2).sum(1)) @ part
                alive &= partial <= self.limit(some, b.stop)[:, None]
                done += 1
            at, left = np.nonzero(alive)
            sums = partial[at, left]
            for b in self.blocks[done:]:
                sums = sums + ((t[left, b] - own[at, b]) ** 2).sum(1)
                stays = sums <= self.limit(some, b.stop)[at]
                at, left, sums = at[stays], left[stays], sums[stays]
            order = np.lexsort((sums, at))
            at, left, sums = at[order], left[order], sums[order]
            first = np.searchsorted(at, np.arange(len(own)))
            many = np.bincount(at, minlength=len(own)) > self.k
            kth = np.full(len(own), np.inf)
            kth[many] = sums[first[many] + self.k - 1]
            stays = sums <= (kth * (1 + 1e-9) + 1e-9)[at]
            at, left = at[stays], left[stays]
            # Copies may leave all pairs, so that a part is measured at once.
            scores = [(x[left[c : c + PAIRS]] * q[a + at[c : c + PAIRS]]).sum(1) for c in range(0, len(at), PAIRS)]
            scores = np.concatenate(scores) if scores else np.empty(0)
            best = np.lexsort((ids[left], -scores, at))
            at = at[best]
            stays = np.arange(len(at)) - np.searchsorted(at, at) < self.k
            yield a + at[stays], left[best][stays], scores[best][stays]


def fit(vectors: DataFrame, k: int, sample: int = SAMPLE) -> Index | None:
    """vectors(id, vec): all usable, of one length."""
    seen = vectors.agg(F.count(F.lit(1)), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()
    if not seen[0]:
        return None
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    return Index(rows.column("id").to_numpy(), _matrix(rows.column("vec")), float(np.sqrt(seen[1])), seen[0], k)


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           probed: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest by inner product among the probed lists (probed: how many, else fitted).

    Queries are the rows of is_query; candidates are all rows but the query's own id. Fewer candidates than k: all
    of them. Equal scores go to the smaller id. Vectors that are null, zero, empty, hold a null or
    non-finite component, have a null id, or another length than most vectors, take no part. Repeated ids are candidates
    each on its own. Extra columns are not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = scratch or Scratch(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.filter(usable(F.col("vec")) & F.col("id").isNotNull())
    usual = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    out = "query_id long, vec_id long, score double"
    if not usual:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vec") == usual[0][0])
    index = fit(rows.select("id", "vec"), k)
    base = shared(spark, index)  # rotation, centres and a sample, all of bounded count

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = base().nearest(base().turn(_matrix(b.column(1)))) if b.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int32))], names=["id", "vec", "asks", "list"])

    schema = T.StructType([*rows.schema.fields, T.StructField("list", T.IntegerType())])
    indexed = scratch.keep(rows.mapInArrow(assign, schema), "indexed")
    for r in indexed.groupBy("list").count().collect():  # a row for each list: SAMPLE / ROWS * SPLIT at most
        index.sizes[r[0]] = r[1]
    whole = shared(spark, index)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                ids, q = part.column(0).to_numpy(), _matrix(part.column(1))
                lists = whole().probes(q, probed)
                bounds = whole().thresholds(ids, q, lists)
                at = np.repeat(np.arange(len(ids)), [len(x) for x in lists])
                chosen = part.select(["id", "vec"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*chosen.columns, pa.array(np.concatenate(lists).astype(np.int32)), pa.array(bounds[at])], names=["id", "vec", "list", "bound"]
                )

    fields = [*rows.schema.fields[:2], T.StructField("list", T.IntegerType()), T.StructField("bound", T.DoubleType())]
    probes = scratch.keep(indexed.filter("asks").select("id", "vec").mapInArrow(probe, T.StructType(fields)), "probes")
    deal = lambda n: F.pmod(F.xxhash64("id", F.lit(11)), F.col(n)).cast("int")
    across = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        got = ([], [], [])
        if a.num_rows and b.num_rows:
            own = base()
            ids, raw = a.column("id").to_numpy(), _matrix(a.column("vec"))
            asks, raw_q, bounds = b.column("id").to_numpy(), _matrix(b.column("vec")), b.column("bound").to_numpy()
            found = own.scan(ids, raw, own.turn(raw), asks, raw_q, own.turn(raw_q, query=True), bounds)
            for at, left, scores in found:
                got[0].append(asks[at])
                got[1].append(ids[left])
                got[2].append(scores)
        arrays = [np.concatenate(g) if g else np.empty(0) for g in got]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(x.astype(k.to_pandas_dtype()), k) for x, k in zip(arrays, kinds, strict=True)], names=["query_id", "vec_id", "score"])

    cells = ["list", "v", "q"]

    def scanned(probes: DataFrame) -> DataFrame:
        asked = {r[0]: r[1] for r in probes.groupBy("list").count().collect()}
        # How many blocks of vectors and of queries a list has, a row for each list: every two of them meet.
        plan = [(i, int(-(-index.sizes[i] // VECTORS)), -(-asked[i] // QUERIES)) for i in sorted(asked) if index.sizes[i]]
        plan = F.broadcast(spark.createDataFrame(plan, "list int, vs int, qs int"))
        left = indexed.join(plan, "list").select("list", deal("vs").alias("v"), across("qs").alias("q"), "id", "vec")
        right = probes.join(plan, "list").select("list", across("vs").alias("v"), deal("qs").alias("q"), "id", "vec", "bound")
        return left.groupBy(cells).cogroup(right.groupBy(cells)).applyInArrow(meet, out)

    found = scratch.keep(scanned(probes), "found")
    # Where no bound was known nothing was abandoned.
    short = probes.filter(F.col("bound") < float("inf")).select(F.col("id").alias("query_id")).distinct()
    short = short.join(found.groupBy("query_id").count(), "query_id", "left").filter(F.coalesce("count", F.lit(0)) < k)
    short = scratch.keep(short.select("query_id"), "short")
    if short.take(1):
        again = probes.join(short.withColumnRenamed("query_id", "id"), "id", "left_semi").select("id", "vec", "list", F.lit(float("inf")).alias("bound"))
        found = found.join(short, "query_id", "left_anti").unionByName(scanned(again))
    # At most k rows for a query and cell come here.
    return (
        found.groupBy("query_id")
        .agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))
        .select("query_id", F.posexplode("best").alias("rank", "b"))
        .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.s")).alias("score"))
    )


def op9_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
