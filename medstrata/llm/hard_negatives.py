"""Hard negatives by coordinate pruning in length buckets.

Rows are cut into buckets of one label and similar length, longest first. Within a bucket
every coordinate of the normalised rows has a sorted list. An anchor with a score to beat
skips a bucket whose longest row cannot reach it; otherwise the score bounds the values
that a row may have in each of the anchor's focus coordinates, its largest ones. The rows
in the range of each list are the candidates, and those are scored exactly.

Scores to beat come from a first round over the longest buckets: any k rows found so far
bound the k-th best from below. Anchors travel in groups of one label; Spark joins groups
with slices of buckets, so neither side has to fit in a task, and a label that most rows
share is only more buckets.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from medstrata.llm.common import column, written

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  #: a negative's score is from LOW to HIGH hundredths of the positive's
SCALE = 256
EVERY = 100  #: anchors are the rows whose id is divisible by this
FOCUS = 3  #: coordinates whose lists are intersected
BUCKET_BYTES = 1 << 20  #: of a bucket's vectors
GROUP_BYTES = 1 << 18  #: of the vectors of a group of anchors
SLICE = 8  #: buckets that share a number for the join, on average, and that a task keeps
FIRST = 16  #: buckets that give the first scores to beat among negatives
AT_ONCE = 64  #: anchors that are scored together against a whole bucket
SLACK = 1e-6  #: bounds are computed in floating point, and taken wider by this
EXACT = 2.0**46  #: up to this product of lengths, scores times 100 are exact in doubles
LONG = 2**63 - 1

_PACKED = "number long, label int, top double, size int, dims int, ids binary, vectors binary"
_HIT = "number long, place int, nth int, anchor_id long, positive_id long, positive_score long, other long, score long"
_WANTED = "array<struct<nth:int,id:long,high:long,found:long>>"

_PACKED_TYPES = [pa.int64(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
_HIT_TYPES = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5]


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part, repeated ones as often as they are.

    Rows without id, label or vector, or with a component that is null or not finite, take
    no part, nor do those with a component that is not finite once multiplied.
    """
    vector = column(embedding).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < F.lit(float("inf"))))
    return vectors.select(
        column(vec_id).cast("long").alias("vec_id"), column(label).cast("int").alias("label"),
        vector.alias("vector"), finite.alias("finite"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("finite")).drop("finite")


def _pack(rows: DataFrame, size: int) -> DataFrame:
    """Rows as runs of one label, longest first, each of about ``size`` bytes of vectors.

    Runs are numbered. Rows of a label that share a length are dealt by id, so a vector
    that many rows share does not end in one task.
    """
    total = rows.agg(F.sum(F.size("vector") * 4 + 8)).first()[0] or 0
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda sum_, x: sum_ + x * x))
    order = ["label", F.desc("length"), "vec_id"]
    placed = rows.withColumn("length", length).repartitionByRange(math.ceil(total / (4 * size)) or 1, *order)
    return placed.sortWithinPartitions(*order).select("vec_id", "label", "vector").mapInArrow(_packing(size), _PACKED)


def _packing(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, total, label = TaskContext.get().partitionId() << 32, [], 0, None
        for batch in batches:
            for i, one, v in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if held and (one != label or total >= size):
                    yield _packed(number, label, held)
                    number, held, total = number + 1, [], 0
                label = one
                held.append((i, v))
                total += 4 * len(v) + 8
        if held:
            yield _packed(number, label, held)

    return run


def _packed(number: int, label: int, rows: list[tuple[int, list[float]]]) -> pa.RecordBatch:
    """Rows in order of id, so that of equal scores the first has the smallest; short vectors are filled up with zeros."""
    rows.sort(key=lambda row: row[0])
    dims = max(len(v) for _, v in rows)
    vectors = np.zeros((len(rows), dims))
    for place, (_, v) in enumerate(rows):
        vectors[place, : len(v)] = v
    vectors = np.floor(vectors * SCALE)
    kind = np.float32 if np.abs(vectors).max(initial=0.0) < 1 << 24 else np.float64
    ids = np.array([i for i, _ in rows], np.int64)
    values = [number, label, float(_lengths(vectors).max(initial=0.0)), len(rows), dims, ids.tobytes(), vectors.astype(kind).tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _PACKED_TYPES)], names=_names(_PACKED))


def _lengths(vectors: np.ndarray) -> np.ndarray:
    most = np.abs(vectors).max(axis=1, initial=0.0)  # so that squares stay finite
    return most * np.sqrt(((vectors / np.where(most, most, 1.0)[:, None]) ** 2).sum(1))


class Rows:
    """Ids and vectors of a packed run."""

    def __init__(self, size: int, dims: int, ids: bytes, vectors: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        kind = np.float64 if len(vectors) == 8 * size * dims else np.float32
        self.vectors = np.frombuffer(vectors, kind).reshape(size, dims).astype(np.float64)

    def widened(self, dims: int) -> np.ndarray:
        """The vectors with ``dims`` components: filled up with zeros, or cut where the other side has only zeros."""
        more = dims - self.vectors.shape[1]
        return np.pad(self.vectors, ((0, 0), (0, more))) if more > 0 else self.vectors[:, :dims]


class Bucket(Rows):
    """A run with the sorted lists of its coordinates, each made when an anchor first focuses on it."""

    def __init__(self, top: float, *packed):
        super().__init__(*packed)
        self.top = top
        lengths = _lengths(self.vectors)
        self.unit = self.vectors / np.where(lengths, lengths, 1.0)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """Values of a coordinate in order, and the rows they belong to."""
        if coordinate not in self._lists:
            order = np.argsort(self.unit[:, coordinate], kind="stable").astype(np.int32)
            self._lists[coordinate] = self.unit[order, coordinate].astype(np.float32), order
        return self._lists[coordinate]

    def candidates(self, anchor: np.ndarray, floor: float) -> np.ndarray | None:
        """Rows, in order, that may score ``floor`` or more; None: any row may."""
        length = float(_lengths(anchor[None])[0])
        if floor <= 0:
            return None
        if length * self.top * (1 + SLACK) < floor:
            return np.zeros(0, np.int64)
        angle = math.acos(min(1.0, floor / length / self.top))  # a row's angle with the anchor is at most this
        unit = anchor / length
        found = []
        for coordinate in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            own = math.acos(max(-1.0, min(1.0, unit[coordinate])))
            values, order = self.sorted_list(int(coordinate))
            a = np.searchsorted(values, math.cos(min(math.pi, own + angle)) - SLACK, side="left")
            b = np.searchsorted(values, math.cos(max(0.0, own - angle)) + SLACK, side="right")
            found.append(order[a:b])
        found.sort(key=len)
        if 2 * len(found[0]) > len(self.ids):
            return None
        kept = found[0]
        for other in found[1:]:
            if len(kept) and len(other) < len(self.ids):
                inside = np.zeros(len(self.ids), bool)
                inside[other] = True
                kept = kept[inside[kept]]
        return np.sort(kept)

    def scores(self, anchors: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Exact inner products of anchors (as many columns as the bucket) with some rows or all."""
        vectors = self.vectors if rows is None else self.vectors[rows]
        if float(_lengths(anchors).max(initial=0.0)) * self.top < EXACT:
            return anchors @ vectors.T
        exact = np.array([[int(x) for x in row] for row in vectors], object).reshape(vectors.shape)
        asked = np.array([[int(x) for x in row] for row in anchors], object).reshape(anchors.shape)
        return asked.dot(exact.T) if vectors.shape[1] else np.zeros((len(anchors), len(vectors)))


def _best(scores: np.ndarray, count: int) -> np.ndarray:
    """Places of the highest scores, highest first, ties in order of place."""
    kept = np.arange(len(scores))
    if len(scores) > 8 * count and scores.dtype != object:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - count)[len(scores) - count])
    return kept[np.argsort(-scores[kept], kind="stable")][:count]


def _positive_hits(bucket: Bucket, rows: np.ndarray, scores: np.ndarray, anchor_id: int, asked: dict) -> Iterator[tuple]:
    other = bucket.ids[rows] != anchor_id
    if asked["floor"] > -math.inf:
        other &= (scores >= asked["floor"]).astype(bool)
    rows, scores = rows[other], scores[other]
    for place in _best(scores, POSITIVES):
        yield 0, None, None, int(bucket.ids[rows[place]]), scores[place]


def _least(wanted: dict) -> int:
    """The score from which a negative of one positive counts still."""
    low = -(-LOW * wanted["high"] // HIGH)
    return low if wanted["found"] is None else max(low, wanted["found"])


def _negative_hits(bucket: Bucket, rows: np.ndarray, scores: np.ndarray, anchor_id: int, asked: dict) -> Iterator[tuple]:
    high = max(w["high"] for w in asked["wanted"])
    kept = ((scores <= high) & (scores >= asked["floor"])).astype(bool)
    rows, scores = rows[kept], scores[kept]
    order = np.argsort(-scores, kind="stable")
    rows, scores = rows[order], scores[order]
    for w in asked["wanted"]:
        first = int(np.searchsorted(-scores, -w["high"], side="left"))
        for place in range(first, min(first + NEGATIVES, len(scores))):
            if scores[place] < _least(w):
                break
            yield w["nth"], w["id"], w["high"], int(bucket.ids[rows[place]]), scores[place]


def _measured(pairs: DataFrame, hits: Callable) -> DataFrame:
    """The best rows of each bucket for each anchor of the group that it is joined with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, Bucket] = OrderedDict()
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(i)[at].as_py() for i, name in enumerate(batch.schema.names)}
                bucket = kept.pop(row["b_number"], None)
                if bucket is None:
                    bucket = Bucket(*(row[f"b_{name}"] for name in ("top", "size", "dims", "ids", "vectors")))
                kept[row["b_number"]] = bucket
                if len(kept) > SLICE:
                    kept.popitem(last=False)
                found = list(_of_group(bucket, row, hits))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _HIT_TYPES)], names=_names(_HIT))

    return pairs.mapInArrow(run, _HIT)


def _of_group(bucket: Bucket, row: dict, hits: Callable) -> Iterator[tuple]:
    group = Rows(*(row[name] for name in ("size", "dims", "ids", "vectors")))
    anchors = group.widened(bucket.vectors.shape[1])
    whole, every = [], np.arange(len(bucket.ids))

    def tell(asked: dict, rows: np.ndarray, scores: np.ndarray) -> Iterator[tuple]:
        anchor_id = int(group.ids[asked["place"]])
        for *found, score in hits(bucket, rows, scores, anchor_id, asked):
            nth, positive, positive_score, other = found
            yield row["number"], asked["place"], nth, anchor_id, positive, positive_score, other, max(-LONG, min(LONG, int(score)))

    for asked in row["asked"]:
        if asked["wanted"]:
            asked["floor"] = float(min(map(_least, asked["wanted"])))
        rows = bucket.candidates(anchors[asked["place"]], asked["floor"])
        if rows is None:
            whole.append(asked)
        elif len(rows):
            yield from tell(asked, rows, bucket.scores(anchors[asked["place"]][None], rows)[0])
    for a in range(0, len(whole), AT_ONCE):
        some = whole[a : a + AT_ONCE]
        for asked, scores in zip(some, bucket.scores(anchors[[x["place"] for x in some]])):
            yield from tell(asked, every, scores)


def _asking(groups: DataFrame, anchors: DataFrame) -> DataFrame:
    """Groups with what their anchors ask for (``number, place, floor, wanted``), and the least floor.

    A group has a bounded number of anchors, so what it gathers is bounded too.
    """
    asked = anchors.groupBy("number").agg(
        F.collect_list(F.struct("place", "floor", "wanted")).alias("asked"), F.min("floor").alias("least")
    )
    return groups.join(asked, "number")


def _pairs(groups: DataFrame, buckets: DataFrame, slices: int, same_label: bool) -> DataFrame:
    """Groups beside the buckets that may hold what they ask for: by label, and by length."""
    placed = buckets.select(*[F.col(c).alias(f"b_{c}") for c in buckets.columns], F.pmod(F.xxhash64("number"), F.lit(slices)).alias("b_slice"))
    asking = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    label = F.col("label") == F.col("b_label")
    near = (F.col("least") <= 0) | (F.col("top") * F.col("b_top") * (1 + 2 * SLACK) >= F.col("least"))
    return asking.join(placed, (F.col("slice") == F.col("b_slice")) & (label if same_label else ~label) & near).drop("slice", "b_slice")


def _ranked(hits: DataFrame, keys: list[str], count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def mine(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", anchors: Column | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` tells which rows are anchors, by ``vec_id, label, vector`` (ids divisible by
    ``EVERY``). A row's score is its inner product with the anchor, both multiplied by
    ``SCALE`` and rounded down; the shorter of two vectors counts as filled up with zeros,
    and a score beyond a long as the nearest one. Higher scores come first, ties by smaller
    id. An anchor's positives are its first rows of its label without those of its own id;
    a positive's negatives are the first rows of other labels whose score is within
    ``LOW`` and ``HIGH`` hundredths of its own; positives without any have no rows.
    Repeated rows count as often as they are, repeated anchors too. Empty tables give an
    empty result; other columns take no part.
    """
    rows = usable(vectors, vec_id, embedding, label)
    buckets = written(_pack(rows, BUCKET_BYTES), "lemp-buckets")
    groups = written(_pack(rows.filter(F.col("vec_id") % EVERY == 0 if anchors is None else anchors), GROUP_BYTES), "lemp-anchors")
    slices = math.ceil(buckets.count() / SLICE) or 1
    # The first bucket of a label is its longest.
    leaders = written(buckets.groupBy("label").agg(F.min("number").alias("number"), F.max("top").alias("top")), "lemp-leaders")

    everyone = groups.select("number", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("place"))
    nothing, unbounded = F.lit(None).cast(_WANTED).alias("wanted"), F.lit(float("-inf"))
    asked = everyone.select("*", unbounded.alias("floor"), nothing)
    first = written(_measured(_pairs(_asking(groups, asked), buckets.join(leaders, "number", "left_semi"), 1, True), _positive_hits), "lemp-positives")
    enough = first.groupBy("number", "place").agg(F.when(F.count("*") >= POSITIVES, F.min("score")).cast("double").alias("fifth"))
    asked = everyone.join(enough, ["number", "place"], "left").select("number", "place", F.coalesce("fifth", unbounded).alias("floor"), nothing)
    second = _measured(_pairs(_asking(groups, asked), buckets.join(leaders, "number", "left_anti"), slices, True), _positive_hits)
    positives = written(_ranked(first.unionByName(second), ["number", "place"], POSITIVES), "lemp-positives")

    # Nothing lies between a negative score and a part of it.
    wanted = positives.filter(F.col("score") >= 0).select("number", "place", F.col("rank").alias("nth"), F.col("other").alias("id"), F.col("score").alias("high"))
    of_positive = ["number", "place", "nth"]

    def asking(found: DataFrame) -> DataFrame:
        floor = F.coalesce(F.col("found").cast("double"), F.col("high") * (LOW / HIGH) * (1 - SLACK))
        return _asking(groups, found.groupBy("number", "place").agg(
            F.min(floor).alias("floor"), F.collect_list(F.struct("nth", "id", "high", "found")).alias("wanted")
        ))

    longest = written(leaders.orderBy(F.desc("top"), "number").limit(FIRST).select("number"), "lemp-longest")
    pairs = _pairs(asking(wanted.withColumn("found", F.lit(None).cast("long"))), buckets.join(longest, "number", "left_semi"), FIRST, False)
    first = written(_ranked(_measured(pairs, _negative_hits), of_positive, NEGATIVES).drop("rank"), "lemp-negatives")
    enough = first.groupBy(*of_positive).agg(F.when(F.count("*") >= NEGATIVES, F.min("score")).alias("found"))
    pairs = _pairs(asking(wanted.join(enough, of_positive, "left")), buckets.join(longest, "number", "left_anti"), slices, False)
    return _ranked(first.unionByName(_measured(pairs, _negative_hits)), of_positive, NEGATIVES).select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_query(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth row; labels of every seventh row are wrong."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings.select("vec_id", "embedding", label.alias("label")))


OP12_SQL = f"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.vector, b.vector) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES})
SELECT anchor_id, positive_id, row_number() OVER w AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= {HIGH} * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
