"""Similarity join of documents on word shingles with PartEnum signatures.

Sets whose Jaccard similarity reaches the threshold have sizes in the same band or in
neighbouring ones, and differ in at most k elements, where k depends on the band. The
domain of shingle hashes is cut into partitions: of more than k / 2 of them one has at most
one differing element, so of its two parts one is the same. The signatures of a set are
the contents of every part of every partition (for small k, of larger subsets of the parts
of a single one); sufficiently similar sets share one.

Documents that share a signature are candidates. Candidates are sieved by sketches, a bit
for each element: k differing elements change at most k bits, so no link is lost. Links are
measured on the whole sets of what is left. Only components are wanted, so every set is first measured
against one hub of its group: near copies of one text are linked by that, for a row each.
Groups that are still in more than one component are measured in full, in blocks, and no
pair leaves the task that measures it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from medstrata.llm.common import column, flat, forget, fresh, mixed, pieces, span_hashes, text_bytes, tidied, word_spans, written
from medstrata.llm.components import components

WIDTH, THRESHOLD = 5, (80, 100)
AT_ONCE = 1 << 20  #: bytes of text whose shingles are held together
GROUP_BYTES = 2 << 20  #: bytes of text for one group of signatures
BLOCK_ROWS = 512  #: sets of a group that are measured against as many others at a time
SKETCH_ROWS = 1024  #: sketches of a bucket that are compared with as many others at a time
SENT_ROWS = 1 << 20  #: decisions on rows, of 17 bytes, that are sent to every task; more are joined by exchange
COLUMNS = 4096  #: shingles of a block that are looked at together
SMALL_GROUP = 8  #: candidates; pairs of larger groups are not told one by one
HUB_ROWS = 4096  #: candidates of one hub that are measured by the same task


# ------------------------------------------------------------------ sets of shingles


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z. A text with fewer words than
    ``width`` has its whole sequence as one shingle, a text without words none.
    """
    data, offsets = flat(texts)
    starts, ends, owner = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    bounds = np.searchsorted(owner, np.arange(len(offsets)))
    places = mixed(np.arange(1, width + 1, dtype=np.uint64))
    rows = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for i in range(width):
        rows += words[i : i + len(rows)] * (places[i] | np.uint64(1))
    rows = mixed(rows + np.uint64(width))
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= width:
            out.append(np.unique(rows[a : b - width + 1]))
        elif b > a:
            short = words[a:b] * (places[: b - a] | np.uint64(1))
            out.append(mixed(short.sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(rows[:0])
    return out


def set_hash(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, the same for equal sets; 0 for the empty set."""
    if not len(shingles):
        return 0
    total = np.array([mixed(shingles ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64), np.uint64(len(shingles))])
    return int(mixed(mixed(total)[:1] + total[1:])[0].astype(np.int64)) or 1


# ------------------------------------------------------------------------ signatures


@dataclass(frozen=True)
class Band:
    """How sets of sizes up to ``most`` are cut: ``first`` partitions of ``parts`` parts, any ``parts - apart`` make a signature."""

    number: int
    most: int
    first: int
    parts: int
    apart: int
    spare: int  #: partitions with an empty signature that a set may leave out


class Bands:
    """The bands for a threshold of ``share / whole``, worked out as sizes ask for them."""

    def __init__(self, share: int, whole: int):
        self.share, self.whole = share, whole
        self.tops = [0]  # the largest size of each band
        self.bands: list[Band] = [Band(0, 0, 1, 1, 0, 0)]

    def of(self, size: int) -> int:
        while self.tops[-1] < size:
            top = max(self.tops[-1] + 1, (self.tops[-1] + 1) * self.whole // self.share)
            self.tops.append(top)
            self.bands.append(self._band(len(self.bands), top))
        return int(np.searchsorted(self.tops, size))

    def two(self, size: int) -> list[Band]:
        """A set's own band and the next one, where it meets sets that are larger."""
        number = self.of(size)
        self.of(self.tops[number] + 1)
        return self.bands[number : number + 2]

    def _band(self, number: int, most: int) -> Band:
        # |A| + |B| <= 2 most, and |A & B| >= t |A | B|, leave so many elements in one set only:
        differ = 2 * most * (self.whole - self.share) // (self.whole + self.share)
        if differ <= 4:
            return Band(number, most, 1, differ + 1 + (differ > 0) * (1 + differ // 3), differ, 0)
        first = differ // 2 + 1
        spare = 2 + first // 12
        return Band(number, most, first + spare, 2, 1, spare)


def contents(shingles: np.ndarray, band: Band) -> tuple[np.ndarray, np.ndarray]:
    """A hash of what is in each part of each partition, and how many elements that are."""
    cells = band.first * band.parts
    spread = mixed(shingles)
    cell = (mixed(spread + np.uint64(band.number)) % np.uint64(cells)).astype(np.int64)
    count = np.bincount(cell, minlength=cells).reshape(band.first, band.parts)
    halves = [
        np.bincount(cell, weights=half.astype(np.float64), minlength=cells).astype(np.uint64)
        for half in (spread & np.uint64(0xFFFFFFFF), spread >> np.uint64(32))
    ]
    return mixed(halves[0] + mixed(halves[1])).reshape(band.first, band.parts), count


def sketch(shingles: np.ndarray, band: Band) -> bytes:
    """A bit for each of about ``most`` cells: whether the number of elements in it is odd.

    An element that only one of two sets has changes one bit, so sets of the band differ in
    as many bits as elements at most.
    """
    cells = 64 * -(-max(band.most, 1) // 64)
    cell = (mixed(shingles + np.uint64((2 * band.number + 1) * 0x632BE59BD9B4E019 % 2**64)) % np.uint64(cells)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=cells) & 1).astype(np.uint8)).tobytes()


def signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """The signatures of one set, in its own band and in the next.

    At least ``spare + 1`` partitions have at most ``apart`` differing elements, so a set
    with no more than ``spare`` partitions where a signature would be empty shares one that
    is not, and leaves the empty ones out.
    """
    out = []
    for band in bands.two(len(shingles)):
        if band.first * band.parts == 1:
            continue  # only equal sets are similar enough
        content, count = contents(shingles, band)
        chosen = np.array(list(combinations(range(band.parts), band.parts - band.apart)))
        seats = mixed(np.arange(band.first * len(chosen), dtype=np.uint64).reshape(band.first, len(chosen)) + np.uint64(band.number << 40))
        found = np.zeros_like(seats)
        filled = np.zeros(seats.shape, np.int64)
        for i in range(chosen.shape[1]):
            found = mixed(found + content[:, chosen[:, i]])
            filled += count[:, chosen[:, i]]
        found = mixed(found + seats)
        empty = filled == 0
        out.append(found[~empty] if band.first > 1 and empty.any(axis=1).sum() <= band.spare else found.ravel())
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


# ----------------------------------------------------------------------------- the join


def _sets(docs: DataFrame, build, schema: str, *keep: str) -> DataFrame:
    """``mapInArrow`` over texts: ``build`` gets kept columns and the shingle sets of some rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch, "text", AT_ONCE):
                made = build([some.column(k) for k in keep], some.column("text"))
                if made is not None:
                    yield made

    return docs.mapInArrow(tidied(run), schema)


_NAMED = "n_shingles long, node long, band int, own binary, next binary"


def _named(docs: DataFrame, width: int, threshold: tuple[int, int], *keep: str) -> DataFrame:
    """``keep`` (longs), then size and name of each set, the number of its band, and its sketches there and in the next."""
    types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())

    def build(kept, texts):
        bands, made = Bands(*threshold), []
        for shingles in shingle_sets(texts, width):
            own, following = bands.two(len(shingles))
            made.append((len(shingles), set_hash(shingles), own.number, sketch(shingles, own), sketch(shingles, following)))
        columns = [pa.array([m[i] for m in made], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([*kept, *columns], names=[*keep, *(c.split()[0] for c in _NAMED.split(", "))])

    return _sets(docs, build, ", ".join([*(f"{c} long" for c in keep), _NAMED]), *keep)


def _buckets(docs: DataFrame, width: int, share: int, whole: int, groups: int) -> DataFrame:
    """``bucket, node``: the different sets that share a signature, each bucket of sets once.

    Signatures are dealt out by themselves, and a task sorts all of its group at once as
    an array. Copies within a run of texts are sent once.
    """

    def send(_, texts):
        bands = Bands(share, whole)
        nodes, found, seen = [], [], set()
        for shingles in shingle_sets(texts, width):
            node = set_hash(shingles)
            if node and node not in seen:
                seen.add(node)
                nodes.append(node)
                found.append(np.unique(signatures(shingles, bands)))
        node = np.repeat(np.array(nodes, np.int64), [len(f) for f in found])
        signature = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(signature)], names=["node", "signature"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(batch.column("node").to_numpy(), batch.column("signature").to_numpy()) for batch in batches]
        if not parts:
            return
        node, signature = (np.concatenate(p) for p in zip(*parts))
        order = np.lexsort((node, signature))
        node, signature = node[order], signature[order]
        new = np.ones(len(node), bool)
        new[1:] = (signature[1:] != signature[:-1]) | (node[1:] != node[:-1])
        node, signature = node[new], signature[new]
        starts = np.flatnonzero(np.append(True, signature[1:] != signature[:-1])) if len(node) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(node)))
        starts, sizes = starts[sizes > 1], sizes[sizes > 1]
        name = [mixed(node[a : a + n].view(np.uint64)).sum(dtype=np.uint64) for a, n in zip(starts, sizes)]
        _, first = np.unique(np.array(name, np.uint64), return_index=True)
        for i in range(0, len(first), 1000):
            some = first[i : i + 1000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array(name, np.uint64)[some].view(np.int64), sizes[some])),
                    pa.array(np.concatenate([node[starts[j] : starts[j] + sizes[j]] for j in some])),
                ],
                names=["bucket", "node"],
            )

    sent = _sets(docs, send, "node long, signature long")
    return sent.repartition(groups, "signature").mapInArrow(tidied(meet), "bucket long, node long").distinct()


class Candidates:
    """Some sets with their sketches: which pairs may link. Pairs asked for have sketches of one band."""

    def __init__(self, sizes: list[int], sketches: list[bytes], share: int, whole: int):
        self.sizes, self.lengths = np.array(sizes, np.int64), np.array([len(x) for x in sketches])
        self.share, self.whole = share, whole
        self.place = np.empty(len(sizes), np.int64)
        self.tables: dict[int, np.ndarray] = {}  # of each length all sketches
        for length in np.unique(self.lengths):
            here = np.flatnonzero(self.lengths == length)
            self.place[here] = np.arange(len(here))
            self.tables[int(length)] = np.frombuffer(b"".join([sketches[i] for i in here]), np.uint64).reshape(len(here), -1)

    def _near(self, a: np.ndarray, b: np.ndarray, differ: np.ndarray) -> np.ndarray:
        return (differ <= (a + b) * (self.whole - self.share) // (self.whole + self.share)) & (np.minimum(a, b) * self.whole >= self.share * np.maximum(a, b))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of places whether it may link."""
        out = np.zeros(len(left), bool)
        for length, table in self.tables.items():
            here = np.flatnonzero(self.lengths[left] == length)
            step = AT_ONCE // length + 1
            for some in (here[i : i + step] for i in range(0, len(here), step)):
                a, b = left[some], right[some]
                differ = np.bitwise_count(table[self.place[a]] ^ table[self.place[b]]).sum(axis=1, dtype=np.int64)
                out[some] = self._near(self.sizes[a], self.sizes[b], differ)
        return out

    def connected(self, first: int, last: int) -> np.ndarray:
        """For each set from ``first`` up to ``last`` the first of them that it is connected with."""
        sizes, table = self.sizes[first:last], self.tables[int(self.lengths[first])][self.place[first:last]]
        linked = np.empty((last - first, last - first), bool)
        for i in range(0, last - first, 64):  # so that tables of numbers stay small
            differ = np.zeros((len(sizes[i : i + 64]), len(sizes)), np.int32)
            for word in table.T:
                differ += np.bitwise_count(word[i : i + 64, None] ^ word)
            linked[i : i + 64] = self._near(sizes[i : i + 64, None], sizes, differ)
        np.fill_diagonal(linked, True)
        return _first_reached(linked)


def sieved(groups: list[int], candidates: Candidates) -> tuple[np.ndarray, np.ndarray]:
    """Connections, as places, between sets of groups of these sizes that may link: all pairs of a small group looked at, of a larger one a tree."""
    sizes = np.array(groups)
    starts = np.cumsum(sizes) - sizes
    left, right = [], []
    for size in range(2, SMALL_GROUP + 1):
        first = starts[sizes == size]
        a, b = np.triu_indices(size, 1)
        left.append((first[:, None] + a).ravel())
        right.append((first[:, None] + b).ravel())
    left, right = np.concatenate(left), np.concatenate(right)
    passed = candidates.pairs(left, right)
    found = [(left[passed], right[passed])]
    for start, size in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP]):
        label = candidates.connected(int(start), int(start + size))
        own = np.flatnonzero(label != np.arange(size))
        found.append((start + own, start + label[own]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _first_reached(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the first row that it is connected with."""
    label = np.arange(len(linked), dtype=np.int32)
    while True:
        least = np.where(linked, label, np.int32(len(linked))).min(axis=1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def _may_link(seated: DataFrame, share: int, whole: int) -> DataFrame:
    """``a, b``: connections over pairs that the sieve lets pass, within every two blocks.

    ``seated``: ``hub, low, high, node, n_shingles, sketch``, sketches of a hub of one band.
    """
    names = ("hub", "low", "high", "node", "n_shingles", "sketch")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, groups, held, weight = None, [], [], 0

        def done() -> pa.RecordBatch:
            node, *rest = (list(x) for x in zip(*held))
            a, b = sieved(groups, Candidates(*rest, share, whole))
            node = np.array(node)
            return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

        for batch in batches:
            for *place, node, size, bits in zip(*(batch.column(c).to_pylist() for c in names)):
                if place != key:
                    if weight > AT_ONCE:
                        yield done()
                        groups, held, weight = [], [], 0
                    key = place
                    groups.append(0)
                groups[-1] += 1
                held.append((node, size, bits))
                weight += len(bits)
        if held:
            yield done()

    return seated.select(*names).repartition("hub", "low", "high").sortWithinPartitions("hub", "low", "high", "node").mapInArrow(tidied(measure), "a long, b long")


def _texts_of(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, text`` for each of ``keys``; copies leave a task once."""
    once = Window.partitionBy("key").orderBy(F.lit(1))
    texts = rows.select("key", "text").withColumn("place", F.row_number().over(once)).filter("place = 1").drop("place")
    return texts.join(keys.select("key"), "key", "left_semi")


def _short(shingles: np.ndarray) -> np.ndarray:
    """Four bytes of each shingle's hash, sorted."""
    return np.unique(shingles.astype(np.uint32))


def _surely_linked(size: int, short: np.ndarray, other_size: int, other: np.ndarray, share: int, whole: int) -> bool:
    """Whether two sets link even if some of their short hashes agree by chance.

    So many chance agreements are as unlikely as two long hashes that are the same.
    """
    common = int((other[np.minimum(np.searchsorted(other, short), len(other) - 1)] == short).sum())
    common -= 2 + math.ceil(16 * size * other_size / 2**32)
    return common > 0 and common * whole >= share * (size + other_size - common)


def _links_to_hubs(texts: DataFrame, seats: DataFrame, width: int, share: int, whole: int) -> DataFrame:
    """``a, b``: hubs and those of their candidates that surely link with them.

    ``seats``: ``key, hub, node``, a row for each candidate and one for each hub itself. Rows
    of a hub are dealt over tasks by the node's hash; each of them gets the hub's set.
    """
    sizes = seats.groupBy("hub").agg(F.ceil(F.count("*") / HUB_ROWS).cast("int").alias("turns"))
    dealt = seats.join(sizes, "hub").withColumn("leads", F.col("hub") == F.col("node"))
    turn = F.when(F.col("leads"), F.sequence(F.lit(0), F.col("turns") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("turns")).cast("int")))
    dealt = dealt.select("key", "hub", "node", "leads", F.explode(turn).alias("turn"))
    kept = ("hub", "turn", "leads", "node")

    def build(columns, texts):
        sets = shingle_sets(texts, width)
        made = [pa.array([len(s) for s in sets], pa.int32()), pa.array([_short(s).tobytes() for s in sets], pa.binary())]
        return pa.RecordBatch.from_arrays([*columns, *made], names=[*kept, "size", "short"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = size = hub = None
        for batch in batches:
            found = []
            for *place, leads, node, n, short in zip(*(batch.column(c).to_pylist() for c in ("hub", "turn", "leads", "node", "size", "short"))):
                short = np.frombuffer(short, np.uint32)
                if leads:
                    key, size, hub = place, n, short
                elif place == key and _surely_linked(n, short, size, hub, share, whole):
                    found.append((node, place[0]))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    sets = _sets(texts.join(dealt, "key"), build, "hub long, turn int, leads boolean, node long, size int, short binary", *kept)
    return sets.repartition("hub", "turn").sortWithinPartitions("hub", "turn", F.desc("leads")).mapInArrow(tidied(measure), "a long, b long")


def _paired(buckets: DataFrame, described: DataFrame) -> DataFrame:
    """``hub, low, high, node, n_shingles, sketch``: buckets cut into blocks, and every two blocks of a bucket brought together.

    Sets of a bucket are in one band or in two neighbouring ones, so all have a sketch in the
    band of the largest: that one is sent.
    """
    banded = buckets.join(described.select("node", "band"), "node")
    sizes = banded.groupBy("bucket").agg(F.ceil(F.count("*") / SKETCH_ROWS).cast("int").alias("blocks"), F.max("band").alias("top"))
    placed = banded.join(sizes, "bucket").withColumn("at", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.col("bucket").alias("hub"), F.least("at", "other").alias("low"), F.greatest("at", "other").alias("high"), "node", (F.col("band") < F.col("top")).alias("below")
    )
    bits = F.when(F.col("below"), F.col("next")).otherwise(F.col("own")).alias("sketch")
    return met.join(described, "node").select("hub", "low", "high", "node", "n_shingles", bits)


def _seated(members: DataFrame) -> DataFrame:
    """``hub, low, high, node``: groups cut into blocks, and two blocks of a group brought together.

    ``members``: ``hub, node, label``. Large components of a group have blocks of their own,
    small ones share some, and blocks of one component only are not brought together.
    """
    rows = BLOCK_ROWS
    sizes = members.groupBy("hub", "label").agg(F.count("*").alias("n")).withColumn("own", F.col("n") * 4 >= rows)
    small = sizes.groupBy("hub").agg(F.ceil(F.coalesce(F.sum(F.when(~F.col("own"), F.col("n"))), F.lit(0)) / rows).cast("int").alias("shared"))
    dealt = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / rows).cast("int"))
    block = F.when(F.col("own"), F.xxhash64("label", dealt)).otherwise(F.xxhash64(F.pmod(F.xxhash64("label"), F.col("shared"))))
    placed = members.join(sizes, ["hub", "label"]).join(small, "hub").select("hub", "node", block.alias("block"), F.when(F.col("own"), F.col("label")).alias("only"))
    blocks = placed.groupBy("hub", "block").agg(F.first("only").alias("only"))
    low, high = (blocks.select("hub", F.col("block").alias(side), F.col("only").alias(f"{side}_only")) for side in ("low", "high"))
    met = low.join(high, "hub").filter((F.col("low") <= F.col("high")) & (F.col("low_only").isNull() | F.col("high_only").isNull() | (F.col("low_only") != F.col("high_only"))))
    seats = met.select("hub", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    return placed.select("hub", "node", "block").join(seats, ["hub", "block"]).select("hub", "low", "high", "node")


def similar_groups(sets: list[np.ndarray], share: int, whole: int) -> np.ndarray:
    """For each set the first set it is connected with over links, all pairs measured.

    Shingles of one set only cannot be common; the others make a matrix of sets by
    shingles, whose product with itself has all sizes of intersections.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, shingle, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, shingle = owner[seen[shingle] > 1], shingle[seen[shingle] > 1]
    names, shingle = np.unique(shingle, return_inverse=True)
    order = np.argsort(shingle, kind="stable")
    owner, shingle = owner[order], shingle[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for i in range(0, len(names), COLUMNS):
        a, b = np.searchsorted(shingle, (i, i + COLUMNS))
        part = np.zeros((len(sets), min(COLUMNS, len(names) - i)), np.float32)
        part[owner[a:b], shingle[a:b] - i] = 1
        common += part @ part.T
    both = common.astype(np.int64)
    linked = both * whole >= share * (sizes[:, None] + sizes - both)
    np.fill_diagonal(linked, True)
    return _first_reached(linked)


def _links(texts: DataFrame, seated: DataFrame, width: int, share: int, whole: int) -> DataFrame:
    """``a, b``: connections within every two blocks, one for each set that is linked.

    ``seated``: ``key, hub, low, high, node``.
    """
    kept = ("hub", "low", "high", "node")

    def build(columns, texts):
        sets = [s.view(np.int64) for s in shingle_sets(texts, width)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.list_(pa.int64()))], names=[*kept, "shingles"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets = None, [], []

        def done() -> pa.RecordBatch:
            label = similar_groups(sets, share, whole)
            own, first = np.array(nodes), np.array(nodes)[label]
            return pa.RecordBatch.from_arrays([pa.array(own[own != first]), pa.array(first[own != first])], names=["a", "b"])

        for batch in batches:
            shingles = batch.column("shingles")
            for i, (*place, node) in enumerate(zip(*(batch.column(c).to_pylist() for c in kept))):
                if place != key:
                    if len(nodes) > 1:
                        yield done()
                    key, nodes, sets = place, [], []
                nodes.append(node)
                sets.append(shingles[i].values.to_numpy())
        if len(nodes) > 1:
            yield done()

    sets = _sets(texts.join(seated, "key"), build, "hub long, low long, high long, node long, shingles array<long>", *kept)
    return sets.repartition("hub", "low", "high").sortWithinPartitions("hub", "low", "high", "node").mapInArrow(tidied(measure), "a long, b long")


def linked_sets(rows: DataFrame, named: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """``node, label``: sets that have a link, and the smallest set name in their component.

    ``rows``: ``key, text``, a key for each different text; ``named``: what :func:`_named`
    gives for them. The sketches of a bucket are compared in blocks of bounded size; a large
    block gives at most one connection for each of its sets. What is connected so is a
    group, and a set is in one only. Its hub is the set that meets most others, among copies
    the text they were made from. Groups that links to their hub leave in one component need
    no more; in the others pairs from different components are measured, in blocks again.
    """
    share, whole = threshold
    spark = rows.sparkSession
    groups = max(1, -(-text_bytes(rows) * 5 * (whole - share) // (whole * GROUP_BYTES)))
    buckets = written(_buckets(rows, width, share, whole, groups), "join-buckets")
    forget(spark)
    meets = buckets.join(buckets.groupBy("bucket").agg(F.count("*").alias("n")), "bucket").groupBy("node").agg(F.sum("n").alias("meets"))
    meets = written(meets, "join-meets")
    rank = F.struct("meets", "node")
    each = F.first(F.struct("n_shingles", "band", "own", "next"))
    described = named.join(meets, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"), each.alias("set"))
    described = written(described.select("node", "key", "set.*"), "join-described")
    forget(spark)
    passed = written(_may_link(_paired(buckets, described), share, whole).distinct(), "join-passed")
    forget(spark, buckets)
    groups_ = written(components(passed).select("node", F.col("label").alias("group")), "join-groups")
    forget(spark, passed)

    hubs = groups_.join(meets, "node").groupBy("group").agg(F.max(rank)["node"].alias("hub"))
    members = written(groups_.join(hubs, "group").select("hub", "node").join(described.select("node", "key"), "node"), "join-members")
    forget(spark, groups_, meets, described)
    texts = written(_texts_of(rows, members), "join-texts")
    forget(spark)
    first = written(_links_to_hubs(texts, members, width, share, whole), "join-links")
    forget(spark)
    placed = members.join(components(first), "node", "left").withColumn("label", F.coalesce("label", "node"))
    undecided = placed.groupBy("hub").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most").select("hub")
    placed = written(placed.join(undecided, "hub", "left_semi"), "join-undecided")
    seated = _seated(placed.drop("key")).join(placed.select("node", "key"), "node")
    links = written(_links(texts, seated, width, share, whole), "join-links")
    forget(spark, members, placed, texts)
    return components(first.unionByName(links))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), F.coalesce(column(text), F.lit("")).alias("text"))
    return rows.withColumn("key", F.xxhash64("text"))


def join(docs: DataFrame, *, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    ``component_id`` is the smallest id that can be reached over links; a document without
    links, words or text has its own. Two documents link when the whole of their distinct
    shingles has a share of ``threshold`` in common. Equal sets are one node throughout,
    so exact copies cost a row each and no pair. Rows with null ids are joined as others
    and take part in links; alone, their component is null. Other columns are ignored; an
    empty table gives an empty one. Memory of a task: one group's signatures, of which
    there are about as many for any size of input.
    """
    rows = _keyed(docs, doc_id, text)
    named = written(_named(rows, width, threshold, "doc_id", "key"), "join-named")
    labels = linked_sets(rows.select("key", "text"), named.drop("doc_id").filter("node <> 0"), width, threshold)
    nodes = named.filter("node <> 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    labelled = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    reached = labelled.groupBy("label").agg(F.min("least").alias("component"))
    of_node = labelled.join(reached, "label").select("node", "component")
    return named.join(of_node, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("node") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id")
    )


def without_copies(docs: DataFrame, *, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that of smallest id, then of smallest text hash.

    Rows are decided each, so an id that repeats with different texts loses only those texts
    that another row stands for. Of rows with the same id and text one stays, by the hash of
    the other columns. A row without an id stays only if no row of its group has one.
    Documents without words are like no other and all stay.
    """
    number, key, stays, own, hashed, turn = fresh(docs, "its_id", "its_key", "stays", "own_id", "own_key", "turn")
    rows = _keyed(docs, doc_id, text)
    named = written(_named(rows, width, threshold, "doc_id", "key"), "join-named").filter("node <> 0")
    labels = linked_sets(rows.select("key", "text"), named.drop("doc_id"), width, threshold)
    named = named.groupBy("doc_id", "key", "node").agg(F.count("*").alias("n"))
    row = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "key")
    labelled = named.join(labels, "node", "left").select(F.coalesce("label", "node").alias("label"), row.alias("row"), "n")
    least = labelled.groupBy("label").agg(F.min("row").alias("least"))
    judged = labelled.join(least, "label").withColumn("stays", F.col("row").eqNullSafe(F.col("least"))).filter("not stays or n > 1")
    judged = written(judged.select(F.col("row.doc_id").alias(number), F.col("row.key").alias(key), F.col("stays").alias(stays)), "join-gone")
    few = judged.count() <= SENT_ROWS

    # Only rows that repeat as a whole are brought together to choose one; other texts stay where they are.
    keyed = docs.withColumns({own: column(doc_id).cast("long"), hashed: F.xxhash64(F.coalesce(column(text), F.lit("")))})
    same = F.col(own).eqNullSafe(F.col(number)) & (F.col(hashed) == F.col(key))
    hashable = [column(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    once = Window.partitionBy(own, hashed).orderBy(F.xxhash64(*hashable))
    sent = F.broadcast if few else lambda table: table
    repeated = keyed.join(sent(judged.filter(F.col(stays))), same, "left_semi").withColumn(turn, F.row_number().over(once)).filter(F.col(turn) == 1)
    single = keyed.join(sent(judged), same, "left_anti")
    return single.select(*map(column, docs.columns)).unionByName(repeated.select(*map(column, docs.columns)))


def op4_query(documents: DataFrame) -> DataFrame:
    return join(documents.select("doc_id", "text"), width=3, threshold=(90, 100))
