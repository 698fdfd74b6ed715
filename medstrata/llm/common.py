"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

import medstrata
from medstrata.session import work_dir
from medstrata.sources import folders

#: A word, for every operator that counts words: no white space of ASCII inside.
WORD = r"[^\x20\x09-\x0D]+"

_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def ready(spark: SparkSession) -> None:
    """Python workers that share the driver's files find this package from here on.

    On a cluster without shared code the package is installed or sent with the job. The
    session's batches for Python become small, since a row is a whole text.
    """
    spark.sparkContext.environment.setdefault(
        "PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(medstrata.__file__)))
    )
    for key, value in _BATCHES.items():
        spark.conf.set(key, value)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the folder."""
    ready(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def written(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder: read twice, computed once, lineage cut."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def forget(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove tables of :func:`written` that nothing reads any more, and shuffle files of finished steps.

    Spark removes the latter once the driver's garbage is collected, which it otherwise
    does when memory is short, not when disks are.
    """
    for table in tables:
        folders.remove(spark, table.written_to)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def tidied(run):
    """``run`` over batches; the worker, which waits for further tasks, gives memory back when it has ended."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library that Linux has mostly
            if trim:
                trim(0)

    return inner


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` bears, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def column(name: str):
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: what sizes of blocks are derived from."""
    return df.agg(F.sum(F.octet_length(column(text)))).first()[0] or 0


def pieces(batch: pa.RecordBatch, text: str, budget: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``budget`` bytes of text (one row at least)."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths, dtype=np.int64) // budget
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def gathered(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text, over the ends of batches."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        for some in pieces(batch, text, size):
            more = pc.sum(pc.binary_length(some.column(text))).as_py() or 0
            if held and total + more > size * 5 // 4:
                yield pa.concat_batches(held)
                held, total = [], 0
            held.append(some)
            total += more
    if held:
        yield pa.concat_batches(held)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in a row, and where each text begins (and the end)."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finishes 64-bit hashes: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes(seed: int, lower: bool) -> np.ndarray:
    """A 64-bit code for each byte value; with ``lower``, A-Z share those of a-z."""
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * _GOLDEN + np.uint64(seed))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


RUN = 1 << 20  #: bytes that are hashed together
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; the worker keeps as many as a run has bytes."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < count:
        kept = np.full(max(count, RUN + 1), base, np.uint64)
        kept[0] = 1
        kept = np.cumprod(kept, dtype=np.uint64)
        if count <= RUN + 1:
            _POWERS[base] = kept
    return kept[:count]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; a word ends where its text does."""
    inside = ~_SPACE[data]
    begins = np.ones(len(data) + 1, bool)  # the place after a blank, or a text's first byte
    begins[1:] = ~np.append(inside[:-1], False) if len(data) else True
    begins[offsets] = True
    starts = np.flatnonzero(inside & begins[:-1])
    stops = np.ones(len(data) + 1, bool)
    stops[:-1] = ~inside
    stops[offsets] = True
    ends = np.flatnonzero(inside & stops[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span of ``data``; spans do not overlap and are not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    out = np.empty(len(starts), np.uint64)
    codes, base, done = byte_codes(seed, lower), 0x5851F42D4C957F2D + 2 * seed, 0
    while done < len(starts):  # a run of spans at a time, so that arrays of bytes stay small
        last = max(done + 1, int(np.searchsorted(ends, starts[done] + RUN, side="right")))
        a, b = starts[done], ends[last - 1]
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(codes[data[a:b]] * powers(base, b - a), out=sums[1:])
        s, e = starts[done:last] - a, ends[done:last] - a
        out[done:last] = (sums[e] - sums[s]) * powers(pow(base, -1, 1 << 64), b - a)[s]
        done = last
    return mixed(out + (ends - starts).astype(np.uint64) * _GOLDEN)
