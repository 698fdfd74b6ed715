"""Approximate nearest neighbours by adaptive dimension scan.

Vectors go to the list of their nearest centre. A query probes the lists with the nearest
centres. Within a list, vectors are rotated and scanned in blocks of columns: after a
random rotation, the distance in the first columns, scaled up, estimates the whole one,
and a hypothesis test abandons candidates whose distance is too large with near certainty.
What survives all columns is measured exactly on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from medstrata.llm.common import column, written

SAMPLE = 16_384  #: vectors that the index is fitted on, at most
LISTS = 1024  #: lists of the index, at most, so the centres' size is bounded
BLOCK_ROWS = 8192  #: vectors of a list that a task holds at a time; larger lists are split
COLUMNS = 16  #: columns of a block
EPSILON = 3.0  #: of the test: the higher, the fewer candidates are abandoned wrongly
RECALL = 0.97  #: aimed at on the sample, by the number of lists probed
TRIALS = 256  #: vectors of the sample that act as queries for that
QUERY_ROWS = 64  #: queries that are scanned together


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, vector``: rows that take part; repeated rows count once."""
    vector, infinite = column(embedding), F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return (
        vectors.select(column(vec_id).cast("long").alias("vec_id"), vector.cast("array<double>").alias("vector"), finite.alias("finite"))
        .filter(F.col("vec_id").isNotNull() & F.col("finite") & F.exists("vector", lambda x: x != 0))
        .select("vec_id", "vector")
        .dropDuplicates()
    )


def rotation(size: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _to_centres(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(1) - 2 * x @ centres.T  # less |x|**2, the same for all centres


class Index:
    """Centres of the lists, for each length of vectors, and how many lists a query probes."""

    def __init__(self, sample: list[list[float]], lists: int, recall: float = RECALL, k: int = 10):
        self.centres: dict[int, np.ndarray] = {}
        self.share: dict[int, float] = {}
        by_size: dict[int, list] = {}
        for vector in sample:
            by_size.setdefault(len(vector), []).append(vector)
        for size, vectors in by_size.items():
            x = np.array(vectors, np.float64)
            self.centres[size] = self._fit(x, max(1, min(lists, len(x))))
            self.share[size] = self._share(x, self.centres[size], recall, k)

    @staticmethod
    def _fit(x: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
        centres = x[np.random.default_rng(1).permutation(len(x))[:lists]].copy()
        for _ in range(rounds):
            nearest = _to_centres(x, centres).argmin(1)
            order = np.argsort(nearest, kind="stable")
            used, first = np.unique(nearest[order], return_index=True)
            centres[used] = np.add.reduceat(x[order], first) / np.bincount(nearest)[used, None]
        return centres

    @staticmethod
    def _share(x: np.ndarray, centres: np.ndarray, recall: float, k: int) -> float:
        """The share of lists that hold ``recall`` of the neighbours of trial queries within the sample."""
        trial = x[:TRIALS]
        far = _to_centres(trial, x)
        far[np.arange(len(trial)), np.arange(len(trial))] = np.inf
        near = np.argpartition(far, min(k, len(x) - 1) - 1 if len(x) > 1 else 0, axis=1)[:, : min(k, len(x) - 1)]
        if not near.size:
            return 1.0
        ranks = np.argsort(np.argsort(_to_centres(trial, centres), axis=1), axis=1)
        lists = _to_centres(x, centres).argmin(1)
        place = np.sort(np.take_along_axis(ranks, lists[near], 1).ravel())
        return (place[min(len(place) - 1, math.ceil(recall * len(place)))] + 1) / len(centres)

    def of(self, size: int) -> np.ndarray:
        """Centres for vectors of a length; one list for lengths that the sample has none of."""
        return self.centres.get(size, np.zeros((1, size)))

    def assign(self, vectors: list[np.ndarray]) -> list[int]:
        return [int(_to_centres(v[None], self.of(len(v))).argmin()) for v in vectors]

    def probes(self, vector: np.ndarray, counts: dict[tuple[int, int], int], k: int) -> list[int]:
        """Lists to search, nearest first: the fitted share, and as many as hold k + 1 vectors."""
        size = len(vector)
        order = [i for i in np.argsort(_to_centres(vector[None], self.of(size))[0], kind="stable").tolist() if (size, i) in counts]
        wanted, held, out = math.ceil(self.share.get(size, 1.0) * len(self.of(size))), 0, []
        for i in order:
            if len(out) >= wanted and held > k:
                break
            out.append(i)
            held += counts[size, i]
        return out


class Block:
    """Up to BLOCK_ROWS vectors of a list, rotated and cut into columns."""

    def __init__(self, vectors: list[np.ndarray], ids: list[list[int]]):
        self.original, self.ids = np.array(vectors, np.float64), ids
        size = self.original.shape[1]
        self.turn = rotation(size)
        turned = self.original @ self.turn
        self.cuts = list(range(0, size, COLUMNS)) + [size]
        self.columns = [np.ascontiguousarray(turned[:, a:b]) for a, b in zip(self.cuts, self.cuts[1:])]

    def search(self, queries: np.ndarray, k: int) -> list[tuple[list[int], list[float]]]:
        """For each query the ids and exact distances of its k nearest here, nearest first, ties by id."""
        size, n = queries.shape[1], len(self.ids)
        turned = queries @ self.turn
        first = turned[:, : self.cuts[1]]
        partial = np.maximum((first**2).sum(1)[:, None] + (self.columns[0] ** 2).sum(1) - 2 * first @ self.columns[0].T, 0)
        if n > k:
            seeds = np.argpartition(partial, k - 1, axis=1)[:, :k]
            bound = self._exact(queries, np.repeat(np.arange(len(queries)), k), seeds.ravel()).reshape(-1, k).max(1) ** 2
        else:
            bound = np.full(len(queries), np.inf)
        alive = self._passes(partial, bound[:, None], self.cuts[1], size)
        if n > k:
            alive[np.arange(len(queries))[:, None], seeds] = True
        q, c = np.nonzero(alive)
        far = partial[q, c]
        for j in range(1, len(self.columns)):
            far = far + ((turned[q, self.cuts[j] : self.cuts[j + 1]] - self.columns[j][c]) ** 2).sum(1)
            kept = self._passes(far, bound[q], self.cuts[j + 1], size)
            q, c, far = q[kept], c[kept], far[kept]
        exact = self._exact(queries, q, c)
        out, ends = [], np.searchsorted(q, np.arange(len(queries) + 1))
        for a, b in zip(ends, ends[1:]):
            near = sorted((d, i) for d, row in zip(exact[a:b].tolist(), c[a:b].tolist()) for i in self.ids[row])[:k]
            out.append(([i for _, i in near], [d for d, _ in near]))
        return out

    @staticmethod
    def _passes(partial: np.ndarray, bound: np.ndarray, done: int, size: int) -> np.ndarray:
        """Whether a squared distance may still be within the bound, given that of ``done`` columns.

        At the last column there is nothing left to estimate; a little is allowed for rounding.
        """
        if done == size:
            return partial <= bound * (1 + 1e-9) + 1e-12
        return partial * (size / done) <= bound * (1 + EPSILON / math.sqrt(done)) ** 2

    def _exact(self, queries: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.sqrt(((queries[q] - self.original[c]) ** 2).sum(1))


_ROW = "size int, list int, part int, is_query int, vec_id long, vector array<double>, ids array<long>"
_FOUND = "vec_id long, ids array<long>, scores array<double>"


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of ``vectors`` to each of ``queries``.

    Both are ``vec_id, vector`` as :func:`usable` gives them; a query is not its own
    neighbour. Vectors of another length than the query's are no candidates. Equal vectors
    are searched for and found as one: of each, the k + 1 smallest ids are candidates,
    which no result can exceed, and equal queries share a search. Queries go to the lists
    as rows, in blocks; large lists are split. The driver holds the sample, the centres
    and the lists' sizes, all bounded by SAMPLE and LISTS for each length of vectors.
    """
    spark = vectors.sparkSession
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    distinct = written(
        vectors.withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")),
        "ann-vectors",
    )
    asked = queries.groupBy("vector").agg(F.min("vec_id").alias("vec_id"))
    sample = [list(r[0]) for r in distinct.orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).select("vector").collect()]
    index = Index(sample, min(LISTS, max(1, math.isqrt(distinct.count()) // 2)), recall, k)
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(v, np.float64) for v in batch.column("vector").to_pylist()]
            lists = shared.value.assign(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(v) for v in rows], pa.int32()), pa.array(lists, pa.int32()), *batch.columns], names=["size", "list", *batch.schema.names]
            )

    placed = written(distinct.mapInArrow(assign, "size int, list int, vector array<double>, ids array<long>"), "ann-lists")
    counts = {(r["size"], r["list"]): r["count"] for r in placed.groupBy("size", "list").count().collect()}
    sizes = spark.sparkContext.broadcast(counts)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for number, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
                v = np.array(vector, np.float64)
                for i in shared.value.probes(v, sizes.value, k):
                    for part in range(-(-sizes.value[len(v), i] // BLOCK_ROWS)):
                        out.append((len(v), i, part, 1, number, vector, None))
            columns = list(zip(*out)) or [()] * 7
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=[c.split()[0] for c in _ROW.split(", ")])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by list and part, candidates before queries."""
        key, vectors, ids, block, waiting = None, [], [], None, []

        def answer() -> pa.RecordBatch:
            found = block.search(np.array([v for _, v in waiting]), k + 1)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in waiting], pa.int64()),
                    pa.array([f[0] for f in found], pa.list_(pa.int64())),
                    pa.array([f[1] for f in found], pa.list_(pa.float64())),
                ],
                names=["vec_id", "ids", "scores"],
            )

        for batch in batches:
            for *place, is_query, number, vector, same in zip(*(c.to_pylist() for c in batch.columns)):
                if place != key:
                    if waiting:
                        yield answer()
                    key, vectors, ids, block, waiting = place, [], [], None, []
                if not is_query:
                    vectors.append(np.array(vector, np.float64))
                    ids.append(same)
                elif vectors:
                    block = block or Block(vectors, ids)
                    waiting.append((number, np.array(vector, np.float64)))
                    if len(waiting) == QUERY_ROWS:
                        yield answer()
                        waiting = []
        if waiting:
            yield answer()

    parts = F.create_map(*[F.lit(x) for s, i in counts for x in (f"{s}:{i}", -(-counts[s, i] // BLOCK_ROWS))]) if counts else F.create_map(F.lit(""), F.lit(1))
    part = F.pmod(F.xxhash64("vector"), parts[F.concat_ws(":", "size", "list")]).cast("int")
    candidates = placed.select("size", "list", part.alias("part"), F.lit(0).alias("is_query"), F.lit(None).cast("long").alias("vec_id"), "vector", "ids")
    blocks = sum(-(-c // BLOCK_ROWS) for c in counts.values())
    found = (
        candidates.unionByName(asked.select("vec_id", "vector").mapInArrow(probe, _ROW))
        .repartition(max(1, blocks), "size", "list", "part")
        .sortWithinPartitions("size", "list", "part", "is_query")
        .mapInArrow(scan, _FOUND)
        .select("vec_id", F.explode(F.arrays_zip("scores", "ids")).alias("near"))
        .select("vec_id", F.col("near.scores").alias("score"), F.col("near.ids").alias("found_id"))
    )
    best = Window.partitionBy("vec_id").orderBy("score", "found_id")
    merged = (
        found.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k + 1)
        .groupBy(F.col("vec_id").alias("asked_id"))
        .agg(F.collect_list(F.struct("score", "found_id")).alias("near"))
        .join(asked.withColumnRenamed("vec_id", "asked_id"), "asked_id")
        .select("vector", "near")
    )
    own = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        queries.withColumnRenamed("vec_id", "query_id")
        .join(merged, "vector")
        .select("query_id", F.explode("near").alias("near"))
        .select("query_id", F.col("near.found_id").alias("vec_id"), F.col("near.score").alias("score"))
        .filter(F.col("vec_id") != F.col("query_id"))
        .groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(own))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op2_query(embeddings: DataFrame) -> DataFrame:
    """Neighbours of the rows whose id is divisible by 100, among all rows."""
    vectors = written(usable(embeddings), "ann-usable")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
