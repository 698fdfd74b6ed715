"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds the hash of every prefix, modulo 2**31 - 1 and for two bases.
From two entries follows the hash of any span, so equality of spans takes constant time
and the longest common extension of two places takes a binary search. A fingerprint is
the hash of the whole text with, for each of 128 slots, the least hash among the spans of
eight code points that fall into the slot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from medstrata.llm.common import column, mixed, text_bytes, written

P = (1 << 31) - 1
BASES = (1_000_003, 998_244_353)
SPAN = 8  #: code points of the spans that are compared
SLOTS = 128
BUCKET = 8 << 20  #: bytes of text in one range of ids
GROUP = 1 << 20  #: code points that are hashed together


def _mod(x: np.ndarray) -> np.ndarray:
    p, shift = np.uint64(P), np.uint64(31)
    x = (x & p) + (x >> shift)
    x = (x & p) + (x >> shift)
    return np.where(x >= p, x - p, x)


_TABLES: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    """Powers of ``base`` modulo P; kept by the worker and made longer by doubling."""
    table = _TABLES.get(base, np.ones(1, np.uint64))
    while len(table) < count:
        table = np.append(table, _mod(table * np.uint64(pow(base, len(table), P))))
    _TABLES[base] = table
    return table[:count]


class PrefixHashes:
    """Prefix arrays of a sequence of code points (of one text, or of several in a row)."""

    def __init__(self, codes: np.ndarray):
        codes = codes.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for base in BASES:
            terms = _mod(codes * _powers(base, len(codes)))
            self.sums.append(_mod(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])))

    def span(self, start: np.ndarray, stop: np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of spans, whatever place they begin at."""
        sums = self.sums[which]
        back = _powers(pow(BASES[which], P - 2, P), len(sums))
        return _mod(_mod(sums[stop] + np.uint64(P) - sums[start]) * back[start])

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the spans of ``length`` at ``a`` and at ``b`` are the same."""
        return np.logical_and.reduce([self.span(a, a + length, w) == self.span(b, b + length, w) for w in (0, 1)])

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Longest common extension from ``a`` and ``b``, ``most`` at most: a binary search."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            half = (low + high + 1) // 2
            same = self.equal(a, b, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low


def sketch(hashes: PrefixHashes, offsets: np.ndarray) -> np.ndarray:
    """Slots of the texts between ``offsets``: 0 for an empty slot, else 1 to 255.

    A text shorter than a span counts as one span.
    """
    lengths = np.diff(offsets)
    count = np.where(lengths >= SPAN, lengths - SPAN + 1, np.minimum(lengths, 1))
    text = np.repeat(np.arange(len(lengths)), count)
    starts = np.arange(int(count.sum())) + np.repeat(offsets[:-1] - (np.cumsum(count) - count), count)
    value = mixed(hashes.span(starts, np.minimum(starts + SPAN, offsets[text + 1])) + np.uint64(0x1F3D5B79))
    least = np.full(len(lengths) * SLOTS, np.uint64(2**64 - 1))
    slot = (value >> np.uint64(57)).astype(np.int64)  # 7 bits: SLOTS
    np.minimum.at(least, text * SLOTS + slot, value)
    slots = (least % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    slots[least == np.uint64(2**64 - 1)] = 0
    return slots.reshape(len(lengths), SLOTS)


def likeness(a: np.ndarray, b: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Share of common spans, estimated from slots; 1 where fingerprints are the ``same``.

    Two different values meet in one of 255 cases; that much is taken off.
    """
    used = ((a > 0) | (b > 0)).sum(axis=1)
    meet = ((a == b) & (a > 0)).sum(axis=1) / np.maximum(used, 1)
    return np.where(same, 1.0, np.clip((meet - 1 / 255) / (1 - 1 / 255), 0.0, 1.0))


def fingerprints(texts: list[str]) -> tuple[list[str], np.ndarray, PrefixHashes, np.ndarray]:
    """Fingerprints as text, their slots, and prefix arrays and places of all texts."""
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    hashes = PrefixHashes(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32))
    slots = sketch(hashes, offsets)
    whole = [hashes.span(offsets[:-1], offsets[1:], w) for w in (0, 1)]
    names = [f"{n:x}-{x:08x}{y:08x}-{s.tobytes().hex()}" for n, x, y, s in zip(np.diff(offsets), *whole, slots)]
    return names, slots, hashes, offsets


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, kept_chars long"
)
_NAMES = [c.split()[0] for c in OUT.split(", ")]


def _compared(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Rows for all texts but the last, each against the one after it."""
    edited = [t[: len(t) - len(t) // 3] + after[: len(t) // 3] for t, after in zip(texts, texts[1:])]
    names, slots, hashes, offsets = fingerprints(texts + edited)
    n, m = len(texts), len(edited)
    own, theirs = np.array(names[:m], object), np.array(names[n:], object)
    starts, lengths = offsets[:-1], np.diff(offsets)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array(lengths[:m]),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array(names[:m]),
            pa.array(names[n:]),
            pa.array(likeness(slots[:m], slots[n:], own == theirs)),
            pa.array(likeness(slots[:m], slots[1 : m + 1], own == np.array(names[1 : m + 1], object))),
            pa.array(hashes.common(starts[:m], starts[n:], np.minimum(lengths[:m], lengths[n:]))),
        ],
        names=_NAMES,
    )


def in_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents in descending id order over many partitions, each range of ids followed by the next one's first.

    Columns ``bucket, extra, doc_id, text``. Ranges hold about BUCKET bytes; their bounds
    are quantiles of the ids. ``extra`` is 1 for the row that only says what follows. One
    row a range is looked up; no window runs over the documents. Ties of ids go by text,
    null ids come last, null texts are empty.
    """
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), F.coalesce(column(text), F.lit("")).alias("text"))
    order = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    count = -(-text_bytes(rows) // BUCKET)
    shares = [i / count for i in range(1, count)]
    bounds = np.unique(np.array(rows.approxQuantile("doc_id", shares, 0.2 / count), np.float64)) if shares else np.zeros(0)

    @F.pandas_udf("long")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy().astype(np.float64), side="left"))

    numbered = rows.withColumn("bucket", bucket_of(order) if len(bounds) else F.lit(0).cast("long"))
    heads = written(numbered.groupBy("bucket").agg(F.max("doc_id").alias("head")), "fingerprint-heads")
    around = Window.orderBy("bucket")
    first = F.first("head").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follows = heads.select("bucket", F.when(F.lead("bucket").over(around).isNull(), first).otherwise(F.lead("head").over(around)).alias("head"))
    extra = (
        follows.join(rows, F.col("head").eqNullSafe(F.col("doc_id")))
        .groupBy("bucket", "doc_id")
        .agg(F.min("text").alias("text"))
        .select("bucket", F.lit(1).alias("extra"), "doc_id", "text")
    )
    both = numbered.select("bucket", F.lit(0).alias("extra"), "doc_id", "text").unionByName(extra)
    return both.repartition(max(count, 1), "bucket").sortWithinPartitions("bucket", "extra", F.col("doc_id").desc_nulls_last(), "text")


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and likeness to the next text.

    The edited text has its last third of code points replaced by the first as many of the
    next document's, in descending id order; the last is followed by the first, and a
    single document by itself. ``kept_chars`` is the longest common extension of text and
    edited text from their beginnings. Empty texts have an empty sketch; equal texts have
    equal fingerprints and likeness 1; an empty table gives an empty one; other columns
    are ignored. Texts are hashed in groups, so memory does not grow with a range.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        held = 0
        for batch in batches:
            for bucket, extra, identity, body in zip(*(c.to_pylist() for c in batch.columns)):
                texts.append(body)
                held += len(body)
                if extra or held > GROUP and len(texts) > 1:
                    yield _compared(ids, texts)
                    ids, texts, held = [], [] if extra else [body], 0 if extra else len(body)
                if not extra:
                    ids.append(identity)

    return in_order(docs, doc_id, text).mapInArrow(compare, OUT)


def op5_query(documents: DataFrame) -> DataFrame:
    return compare_with_next(documents.select("doc_id", "text"))
