"""Scoring of texts with a model that mixes contexts, learned from part of the documents.

A text is a sequence of units: characters up to and with a white space or the text's end.
Texts are read for their letters, then once more: each block of texts becomes one row, of
the units it holds and their sequence in its texts. All units of the training texts make the
model. Units are dealt to parts by their word; a block sends each part the units it holds in
one row, and gets one back, after the context mix has spelled each different unit once.

A unit is predicted from the one before it: from exact counts of all pairs of neighbours
in the training texts, less a discount whose mass goes to the exact counts of units by
themselves, and of these a discount to the spelling. Pairs are counted in parts by hash;
their number, as that of the units, grows with the input.

Within a text the model adapts in the order of its units: the next unit is one of the units
so far in proportion to how often they came, or a new draw from the model with the weight of
ADAPT units; and, with PAIR_ADAPT, one of those that followed the unit before it so far.
A text belongs to a kind, found from its pairs of letters, whose units it is predicted from;
the kind is coded first. The kinds' centres are means over all training texts, moved in a few
rounds of aggregation. The score is the log10 probability of the kind and all units.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from medstrata.llm import context_mix
from medstrata.llm.common import column, flat, forget, gathered, mixed, pieces, span_hashes, text_bytes, written

BLOCK = 8 << 20  #: bytes of text in a block
KINDS = 8  #: kinds of texts
KIND_ROUNDS = 5  #: in which their centres move
KIND_CELLS = 256  #: classes of pairs of letters that tell kinds apart, half of them at a unit's begin, half at its end
ADAPT = 1000.0  #: units' worth of the model against the text's own units
PAIR_ADAPT = 8.0  #: units' worth of all that against what followed the unit before within the text
PART_BYTES = 24 << 20  #: bytes of text for one part of the units, and of the pairs
BEGIN = 0x1D8AF066  #: stands for the unit before a text's first
COUNT_UNITS = 1_000_000  #: units that one task counts
ROUNDS = 4  #: in which texts are scored at most, so that one round's exchanges are on disk at a time
ROUND_BYTES = 64 << 20  #: bytes of text for a round, at least
LEAD = 2  #: bytes in front of a unit: the text's kind, and how the unit before ended
END = 0xFF  #: stands for the text's end; no byte of a text is like it

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E), END]] = True
_LETTER = np.zeros(256, np.uint32)
_LETTER[97:123] = _LETTER[65:91] = np.arange(1, 27)
_LETTER[128:255] = np.arange(27, 154)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def is_held(doc_id: Column) -> Column:
    """Whether a document is kept from training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


# ------------------------------------------------------------------------------ kinds


def letters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` texts which two letters its units begin and end with: a vector of length 1, in bytes of 1/255."""
    found = np.zeros(count * KIND_CELLS)
    half = KIND_CELLS // 2
    for side, (a, b) in enumerate(((starts, np.minimum(starts + 1, ends)), (np.maximum(ends - 2, starts), np.maximum(ends - 1, starts)))):
        cell = ((_LETTER[data[a]] * np.uint32(155) + _LETTER[data[b]]) * np.uint32(2654435761)) >> np.uint32(34 - KIND_CELLS.bit_length())
        found += np.bincount(owner * KIND_CELLS + side * half + cell.astype(np.int64), minlength=count * KIND_CELLS)
    found = np.sqrt(found.reshape(count, KIND_CELLS))
    return np.rint(found * (255 / np.maximum(np.sqrt((found**2).sum(1)), 1e-9)[:, None])).astype(np.uint8)


def _apart(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of every row of ``x`` from every centre."""
    x = x.astype(np.float64)
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1), 0)


def kinds_of(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return _apart(x, centres).argmin(1)


def fit_kinds(described: DataFrame) -> np.ndarray:
    """Centres of the kinds of all rows ``key, letters``: begun at rows drawn far from each other, then moved.

    Every round is an aggregation that brings one row, or the sums of each kind, to the driver.
    """

    def rows(batch: pa.RecordBatch) -> np.ndarray:
        return flat(batch.column("letters"))[0].reshape(-1, KIND_CELLS)

    def drawn(centres: np.ndarray) -> bytes | None:
        def race(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = (math.inf, None)
            for batch in batches:
                if not batch.num_rows:
                    continue
                chance = mixed(batch.column("key").to_numpy().view(np.uint64) + np.uint64(len(centres) + 1)) / 2.0**64
                far = _apart(rows(batch), centres).min(1) if len(centres) else np.ones(batch.num_rows)
                with np.errstate(divide="ignore"):
                    time = np.where(far > 0.5, -np.log1p(-chance) / far, math.inf)
                i = int(time.argmin())
                best = min(best, (float(time[i]), batch.column("letters")[i].as_py()), key=lambda b: b[0])
            if best[0] < math.inf:
                yield pa.RecordBatch.from_arrays([pa.array([best[0]]), pa.array([best[1]], pa.binary())], names=["time", "letters"])

        return described.mapInArrow(race, "time double, letters binary").agg(F.min_by("letters", "time")).first()[0]

    def moved(centres: np.ndarray) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(centres), KIND_CELLS + 1), np.int64)
            for batch in batches:
                if batch.num_rows:
                    x = rows(batch)
                    nearest = kinds_of(x, centres)
                    for k in np.unique(nearest):
                        sums[k, :-1] += x[nearest == k].sum(0, dtype=np.int64)
                        sums[k, -1] += (nearest == k).sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size, dtype=np.int32)), pa.array(sums.ravel())], names=["i", "v"])

        total = np.zeros((len(centres), KIND_CELLS + 1))
        for row in described.mapInArrow(add, "i int, v long").groupBy("i").agg(F.sum("v").alias("v")).toLocalIterator():
            total.ravel()[row["i"]] = row["v"]
        return np.where(total[:, -1:] > 0, total[:, :-1] / np.maximum(total[:, -1:], 1), centres)

    centres = np.zeros((0, KIND_CELLS))
    while len(centres) < KINDS and (found := drawn(centres)) is not None:
        centres = np.vstack([centres, np.frombuffer(bytes(found), np.uint8)])
    if not len(centres):
        return np.zeros((1, KIND_CELLS))
    for _ in range(KIND_ROUNDS if len(centres) > 1 else 0):
        centres = moved(centres)
    return centres


# ------------------------------------------------------------------------------ blocks


def with_ends(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each with END behind it, and where each begins."""
    closed = pc.binary_join_element_wise(pc.fill_null(texts, "").cast(pa.binary()), pa.scalar(bytes([END])), b"")
    return flat(closed)


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of each unit's begin and of its ending byte, and its text's number."""
    ends = np.flatnonzero(_BLANK[data])
    starts = np.concatenate([[0], ends[:-1] + 1])
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(ends, offsets)))


def units_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts; of each unit the place of its begin and of its ending byte, its text's number, and a hash."""
    data, offsets = with_ends(texts)
    starts, ends, owner = _spans(data, offsets)
    return data, starts, ends, owner, span_hashes(data, starts, ends + 1, lower=False)


def _before(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """1 to 7: how the unit before each unit ended; ``ends`` is the place of the ending byte."""
    last, line = ends[:-1], np.isin(data[ends[:-1]], (0x0A, 0x0D))
    empty = last == starts[:-1]
    letter, other = data[np.maximum(last - 1, 0)], data[np.maximum(last - 2, 0)]
    stop = np.isin(letter, np.frombuffer(b".!?", np.uint8)) & ~empty
    loud = _UPPER[letter] & _UPPER[other] & (last - starts[:-1] > 1)
    out = np.select([data[last] == END, empty & line, empty, stop & ~line, stop, line, loud], [1, 2, 3, 4, 5, 2, 6], 7)
    return np.concatenate([[1], out]).astype(np.int64)


BLOCKS = (
    "block long, doc_ids array<long>, held array<boolean>, kinds array<int>, sizes array<long>, uses array<int>, "
    "different int, leads binary, lengths binary, words binary, times binary, sequence binary"
)
_BLOCK_LISTS = {"doc_ids": pa.int64(), "held": pa.bool_(), "kinds": pa.int32(), "sizes": pa.int64(), "uses": pa.int32()}
PAIR_BYTES = 5  #: bytes of a pair's hash that, with the context, tell it from others; the rest deals it to a part
PART_BITS = 24  #: the first bits of a unit's name are those of its word in lower case, and deal it to a part


def packed(numbers: np.ndarray, kind: str = "<i4") -> bytes:
    """Numbers, of which small ones are the most frequent, as compressed bytes: all first bytes, then all second ones, and so on."""
    return pa.compress(np.ascontiguousarray(numbers.astype(kind).view(np.uint8).reshape(len(numbers), -1).T), codec="zstd", asbytes=True) if len(numbers) else b""


def unpacked(data: bytes, count: int, kind: str = "<i4") -> np.ndarray:
    """The ``count`` numbers that :func:`packed` got."""
    width = np.dtype(kind).itemsize
    if not count:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(data, width * count, codec="zstd", asbytes=True), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _some(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of some spans, one after the other."""
    ends = np.cumsum(lengths)
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]


def plain_hashes(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each unit's word in lower case, whatever ends it."""
    ends = np.cumsum(lengths)
    words = words.copy()
    words[ends - 1] = 0
    return span_hashes(words, ends - lengths, ends)


def names_of(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each unit; its first PART_BITS are those of its word in lower case."""
    ends, low = np.cumsum(lengths), np.uint64((1 << (64 - PART_BITS)) - 1)
    return ((plain_hashes(words, lengths) & ~low) | (span_hashes(words, ends - lengths, ends, lower=False) & low)).view(np.int64)


def _spelling(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The different units of a row, one after the other, and how long each is."""
    return np.frombuffer(row["words"], np.uint8), unpacked(row["lengths"], row["different"]).astype(np.int64)


def parts_of(names: np.ndarray, parts: int) -> np.ndarray:
    """The part that each unit belongs to; all spellings and endings of a word are in one."""
    return ((names.view(np.uint64) >> np.uint64(64 - PART_BITS)) % np.uint64(parts)).astype(np.int64)


def by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, list[slice]]:
    """An order by part, and the places of each part in it."""
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    return order, [slice(a, b) for a, b in zip(bounds, bounds[1:])]


def _first(which: np.ndarray, count: int) -> np.ndarray:
    """Where each of ``count`` numbers comes first."""
    first = np.empty(count, np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    return first


def _keys(names: np.ndarray, leads: np.ndarray) -> np.ndarray:
    """What tells units under their leads apart."""
    return names.view(np.uint64) + leads.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def block_row(number: int, ids: pa.Array, texts: pa.Array, held: np.ndarray, centres: np.ndarray) -> pa.RecordBatch:
    """One block: its different units, how often training texts hold them, and the sequence of units of each text."""
    data, starts, ends, owner, names = units_of(texts)
    kinds = np.concatenate([kinds_of(letters(data, starts[slice(*r)], ends[slice(*r)], owner[slice(*r)] - a, b - a), centres) for a, b, r in _texts(owner, len(ids))])
    lead = (kinds[owner] * 8 + _before(data, starts, ends)).astype(np.uint8)
    unit, different = pd.factorize(_keys(names, lead))
    turn = np.empty(len(different), np.int64)  # numbers by frequency
    turn[np.argsort(-np.bincount(unit, minlength=len(different)), kind="stable")] = np.arange(len(different))
    unit = turn[unit]
    first = _first(unit, len(different))
    times = np.bincount(unit, weights=~held[owner], minlength=len(first)).astype(np.int64)
    lengths = ends[first] + 1 - starts[first]
    words = _some(data, starts[first], lengths)
    lists = {
        "doc_ids": ids,
        "held": pa.array(held),
        "kinds": pa.array(kinds),
        "sizes": pa.array(np.bincount(owner, weights=ends + 1 - starts, minlength=len(ids)).astype(np.int64) - 1),
        "uses": pa.array(np.bincount(owner, minlength=len(ids))),
    }
    arrays = [pa.array([number], pa.int64())]
    arrays += [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), lists[n].cast(t)) for n, t in _BLOCK_LISTS.items()]
    arrays.append(pa.array([len(first)], pa.int32()))
    arrays += [pa.array([v], pa.binary()) for v in (lead[first].tobytes(), packed(lengths), words.tobytes(), packed(times), packed(unit))]
    return pa.RecordBatch.from_arrays(arrays, names=_names(BLOCKS))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _texts(owner: np.ndarray, count: int, size: int = 1000) -> list[tuple[int, int, np.ndarray]]:
    """Runs of ``size`` texts and the range of their units."""
    bounds = [(i, min(i + size, count)) for i in range(0, count, size)]
    return [(a, b, np.searchsorted(owner, (a, b))) for a, b in bounds]


# ---------------------------------------------------------------- pairs of neighbours


def pairs_of(names: np.ndarray, uses: np.ndarray, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each unit in a sequence of texts its text, the unit before it (-1 at a text's begin), and hashes of what came before and of both."""
    text = np.repeat(np.arange(len(uses)), uses)
    before = np.append(-1, sequence[:-1]) if len(sequence) else sequence
    before[np.append(True, text[1:] != text[:-1])[: len(text)]] = -1
    context = np.append(names, BEGIN).view(np.uint64)[before]
    pair = mixed(context * np.uint64(0x9E3779B97F4A7C15) + names.view(np.uint64)[sequence])
    return text, before, context, pair


def _parted(context: np.ndarray, pair: np.ndarray, parts: int) -> tuple[np.ndarray, list[slice], np.ndarray]:
    """The first place of each different pair, by part and context; the places of each part; and which of them every pair is."""
    which, different = pd.factorize(pair)
    first = _first(which, len(different))
    part = (different >> np.uint64(8 * PAIR_BYTES)) % np.uint64(parts)
    bits = parts.bit_length()
    key = (part << np.uint64(64 - bits)) | (context[first] >> np.uint64(bits))  # few contexts share the bits that are left
    order = np.argsort(key, kind="stable")
    turn = np.empty(len(order), np.int64)
    turn[order] = np.arange(len(order))
    bounds = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
    return first[order], [slice(a, b) for a, b in zip(bounds, bounds[1:])], turn[which]


def _run_lengths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of equal values, and how long it is."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return values[starts], np.diff(np.append(starts, len(values))).astype(np.int32)


PAIR_COUNTS = "block long, part int, counts binary, of int, names binary, followers binary, begin long, ones long, twos long"


def pair_counts(blocks: DataFrame, parts: int) -> DataFrame:
    """How often training texts hold each pair of a block; and from each part, for each part of the units, the number of pairs with each context.

    A pair costs a few bytes for each block it is in, and a part gets it once from each.
    """

    sent_names = ["contexts", "lengths", "different", "pairs", "times"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                uses, held = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("uses", "held"))
                names = names_of(*_spelling({c: batch.column(c)[i].as_py() for c in ("different", "lengths", "words")}))
                sequence = unpacked(batch.column("sequence")[i].as_py(), int(uses.sum()))
                text, _, context, pair = pairs_of(names, uses, sequence)
                first, some, which = _parted(context, pair, parts)
                times = np.bincount(which, weights=~held[text], minlength=len(first)).astype(np.int32)
                runs = [_run_lengths(context[first[s]]) for s in some]
                columns = [
                    [packed(r[0].view(np.int32).reshape(-1, 2).T.ravel()) for r in runs],
                    [packed(r[1]) for r in runs],
                    [len(r[1]) for r in runs],
                    [pair[first[s]].view(np.uint8).reshape(-1, 8)[:, :PAIR_BYTES].tobytes() for s in some],
                    [packed(times[s]) for s in some],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("block")[i].as_py()] * parts, pa.int64()), pa.array(range(parts), pa.int32()), *(pa.array(c, pa.int32() if n == "different" else pa.binary()) for n, c in zip(sent_names, columns))],
                    names=["block", "part", *sent_names],
                )

    def add(rows: pa.Table) -> pa.Table:
        got = {n: rows[n].to_pylist() for n in sent_names}
        counts = [len(p) // PAIR_BYTES for p in got["pairs"]]
        pair = np.zeros((sum(counts), 8), np.uint8)
        pair[:, :PAIR_BYTES] = np.frombuffer(b"".join(got["pairs"]), np.uint8).reshape(-1, PAIR_BYTES)
        names = [unpacked(v, 2 * n).reshape(2, -1).T.copy().view(np.int64).ravel() for v, n in zip(got["contexts"], got["different"])]
        every = np.concatenate([np.repeat(c, unpacked(v, n)) for c, v, n in zip(names, got["lengths"], got["different"])])
        which, different = pd.factorize(every.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + pair.view(np.uint64).ravel())
        times = np.concatenate([unpacked(v, n) for v, n in zip(got["times"], counts)])
        count = np.bincount(which, weights=times, minlength=len(different)).astype(np.int64)
        context = np.empty(len(different), np.int64)
        context[which] = every
        place, contexts = pd.factorize(context[count > 0])
        followers = np.bincount(place, minlength=len(contexts))
        cuts = np.cumsum(counts)
        back = [c.astype(np.int32).tobytes() for c in np.split(count[which], cuts[:-1])]
        sums = int(followers[contexts == BEGIN].sum()), int((count == 1).sum()), int((count == 2).sum())
        order, some = by_part(parts_of(contexts, parts), parts)
        n = rows.num_rows  # counts of the blocks, and a row more for each part of the units
        return pa.table(
            [
                pa.array([*rows["block"].to_pylist(), *[None] * parts], pa.int64()),
                pa.array([rows["part"][0].as_py()] * (n + parts), pa.int32()),
                pa.array([*back, *[None] * parts], pa.binary()),
                pa.array([*[None] * n, *range(parts)], pa.int32()),
                pa.array([*[None] * n, *(contexts[order[s]].tobytes() for s in some)], pa.binary()),
                pa.array([*[None] * n, *(packed(followers[order[s]]) for s in some)], pa.binary()),
                *(pa.array([None] * n + [v] + [0] * (parts - 1), pa.int64()) for v in sums),
            ],
            names=_names(PAIR_COUNTS),
        )

    sent = blocks.select("block", "held", "uses", "different", "lengths", "words", "sequence").mapInArrow(send, "block long, part int, contexts binary, lengths binary, different int, pairs binary, times binary")
    return sent.groupBy("part").applyInArrow(add, PAIR_COUNTS)


def discount(ones: int, twos: int) -> float:
    """What is taken from every count, from how many are 1 and 2."""
    return min(max(ones / (ones + 2 * twos), 0.05), 0.95) if ones + twos else 0.5


def _earlier(keys: np.ndarray) -> np.ndarray:
    """How many equal keys came before each."""
    return _grouped(keys)[0]


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many equal keys came before each, and a number for each different key."""
    order = np.argsort(keys, kind="stable")
    places = np.arange(len(keys))
    begins = np.append(True, keys[order][1:] != keys[order][:-1])[: len(keys)]
    out, number = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    out[order] = places - np.maximum.accumulate(np.where(begins, places, 0))
    number[order] = np.cumsum(begins) - 1
    return out, number


# ---------------------------------------------------------------------------- the model


UNIT_COUNTS = (
    "part int, block long, which binary, different int, leads binary, lengths binary, words binary, exact binary, c binary, "
    "tokens long, vocabulary long, ones long, twos long, by_lead array<long>"
)


def unit_counts(blocks: DataFrame, parts: int) -> DataFrame:
    """A row for the units of each part: how often training texts hold each, and its word; and one for each block that names those it holds.

    A unit costs some bytes for each block it is in, and a part gets it once from each.
    """

    sent_names = ["leads", "lengths", "words", "times"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, lengths = _spelling({c: batch.column(c)[i].as_py() for c in ("different", "lengths", "words")})
                leads, times = np.frombuffer(batch.column("leads")[i].as_py(), np.uint8), unpacked(batch.column("times")[i].as_py(), len(lengths))
                order, some = by_part(parts_of(names_of(words, lengths), parts), parts)
                words = _some(words, (np.cumsum(lengths) - lengths)[order], lengths[order])
                leads, lengths, times = (v[order] for v in (leads, lengths, times))
                place = np.append(0, np.cumsum(lengths))
                columns = [
                    [leads[s].tobytes() for s in some],
                    [packed(lengths[s]) for s in some],
                    [words[place[s.start] : place[s.stop]].tobytes() for s in some],
                    [packed(times[s]) for s in some],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("block")[i].as_py()] * parts, pa.int64()), pa.array(range(parts), pa.int32()), *(pa.array(c, pa.binary()) for c in columns)],
                    names=["block", "part", *sent_names],
                )

    def add(rows: pa.Table) -> pa.Table:
        got = {n: rows[n].to_pylist() for n in sent_names}
        counts = [len(v) for v in got["leads"]]
        leads, words = (np.frombuffer(b"".join(got[n]), np.uint8) for n in ("leads", "words"))
        lengths, times = (np.concatenate([unpacked(v, n) for v, n in zip(got[c], counts)]) for c in ("lengths", "times"))
        names = names_of(words, lengths)
        which, different = pd.factorize(_keys(names, leads))
        turn = np.empty(len(different), np.int64)  # the same whatever row comes first, and by chance
        turn[np.argsort(different)] = np.arange(len(different))
        which = turn[which]
        exact = np.bincount(which, weights=times, minlength=len(different)).astype(np.int64)
        back = [packed(w) for w in np.split(which, np.cumsum(counts)[:-1])]
        first = _first(which, len(different))
        words = _some(words, (np.cumsum(lengths, dtype=np.int64) - lengths)[first], lengths[first])
        leads, lengths = leads[first], lengths[first]
        word, plain = lengths > 1, pd.factorize(plain_hashes(words, lengths))[0]
        c = np.where(word, np.bincount(plain, weights=exact).astype(np.int64)[plain], -1) if len(plain) else exact
        by_lead = [np.bincount(leads, weights=exact, minlength=KINDS * 8).astype(np.int64), np.bincount(leads[exact > 0], minlength=KINDS * 8)]
        sums = [exact[word].sum(), len(np.unique(plain[c > 0])), (exact == 1).sum(), (exact == 2).sum()]
        n = rows.num_rows  # one row more for the part
        units = [leads.tobytes(), packed(lengths), words.tobytes(), packed(exact, "<i8"), packed(c, "<i8")]
        return pa.table(
            [
                pa.array([rows["part"][0].as_py()] * (n + 1), pa.int32()),
                pa.array([*rows["block"].to_pylist(), None], pa.int64()),
                pa.array([*back, None], pa.binary()),
                pa.array([*counts, len(exact)], pa.int32()),
                *(pa.array([None] * n + [v], pa.binary()) for v in units),
                *(pa.array([None] * n + [int(v)], pa.int64()) for v in sums),
                pa.array([None] * n + [np.concatenate(by_lead).tolist()], pa.list_(pa.int64())),
            ],
            names=_names(UNIT_COUNTS),
        )

    sent = blocks.select("block", "different", "leads", "lengths", "words", "times").mapInArrow(send, "block long, part int, leads binary, lengths binary, words binary, times binary")
    return sent.groupBy("part").applyInArrow(add, UNIT_COUNTS)


def _spelled(words: np.ndarray, lengths: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of units, each behind its lead, and where each begins."""
    starts = np.cumsum(lengths) - lengths + LEAD * np.arange(len(lengths))
    data = np.empty(len(words) + LEAD * len(lengths), np.uint8)
    place = np.ones(len(data), bool)
    place[starts] = place[starts + 1] = False
    data[place] = words
    data[starts], data[starts + 1] = 128 + (leads >> 3), leads & 7
    return data, starts


def _units(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the units of a part the words, one after the other, their lengths, leads and counts."""
    return *_spelling(row), np.frombuffer(row["leads"], np.uint8), unpacked(row["exact"], row["different"], "<i8")


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part the bytes of its training units, where each begins, and how often it comes."""
    for batch in batches:
        for row in batch.to_pylist():
            words, lengths, leads, exact = _units(row)
            some = np.flatnonzero(exact)
            words = _some(words, (np.cumsum(lengths) - lengths)[some], lengths[some])
            yield *_spelled(words, lengths[some], leads[some]), exact[some]


TABLE_ROWS = 1 << 16


def _counted(units: DataFrame) -> list[np.ndarray]:
    """The tables of counts over all units: added up in every task, then over the tasks piece by piece."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = context_mix.empty_counts()
        for data, starts, times in _training(batches):
            context_mix.count(data, starts, times, tables, LEAD)
        for k, table in enumerate(tables):
            for i in range(0, len(table), TABLE_ROWS):
                part = table[i : i + TABLE_ROWS].astype(np.float32)
                used = np.flatnonzero(part).astype(np.uint16)
                if len(used) * 6 < len(part) * 4:  # else all counts take less room
                    yield _piece(k, i, used.tobytes(), part[used].tobytes())
                else:
                    yield _piece(k, i, None, part.tobytes())

    def _piece(k: int, at: int, used: bytes | None, part: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([at], pa.int32()), pa.array([used], pa.binary()), pa.array([part], pa.binary())], names=["k", "at", "used", "part"])

    def add(pieces_: pa.Table) -> pa.Table:
        total = np.zeros(TABLE_ROWS)
        for used, part in zip(pieces_["used"].to_pylist(), pieces_["part"].to_pylist()):
            at = slice(None) if used is None else np.frombuffer(used, np.uint16)
            total[at] += np.frombuffer(part, np.float32)
        return pa.Table.from_batches([_piece(pieces_["k"][0].as_py(), pieces_["at"][0].as_py(), None, total.astype(np.float32).tobytes())])

    schema = "k int, at int, used binary, part binary"
    tables = [t.astype(np.float32) for t in context_mix.empty_counts()]
    for row in units.mapInArrow(count, schema).groupBy("k", "at").applyInArrow(add, schema).toLocalIterator():
        part = np.frombuffer(row["part"], np.float32)
        tables[row["k"]][row["at"] : row["at"] + len(part)] = part
    return tables


def _learned(units: DataFrame, tables) -> context_mix.Learned:
    """Weights of an online pass over each part, averaged by what they learned from."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = 0
        for data, starts, times in _training(batches):
            learned = context_mix.Learned.begin()
            learned.learn(data, starts, times, tables.value, LEAD)
            values = values + np.concatenate([(learned.weights * learned.mass[:, None]).ravel(), learned.mass, learned.ones, learned.all])
        if np.any(values):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["i", "v"])

    out = context_mix.Learned.begin()
    total = np.zeros(out.weights.size + len(out.mass) + 2 * len(out.all))
    for row in units.mapInArrow(learn, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toLocalIterator():
        total[row["i"]] = row["v"]
    weights, mass, ones, every = np.split(total, np.cumsum([out.weights.size, len(out.mass), len(out.all)]))
    seen = mass > 0
    out.weights[seen] = weights.reshape(out.weights.shape)[seen] / mass[seen, None]
    out.mass, out.ones, out.all = mass, ones, every
    return out


# ----------------------------------------------------------------------------- scoring

SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
    "kind int, n_bytes long, bits_per_byte double"
)
RATED = "block long, part int, log binary, c binary, total binary, followers binary"
_RATED = [("block", pa.int64()), ("part", pa.int32()), *((n, pa.binary()) for n in ("log", "c", "total", "followers"))]


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held: Column | None = None) -> DataFrame:
    """A row for every document: base score, score, and total bits per byte of the text.

    Rows with ``held`` (default :func:`is_held`) are not learned from. Null and empty
    texts are the end alone, with no bits per byte; null ids count as empty text where
    training is decided; repeated rows are learned from and scored each; an empty table
    gives an empty one; other columns are ignored. Units and their counts grow with the
    input and stay in tables, as do pairs of neighbours and theirs; what every task holds is
    the hashed counts for spelling (BITS) and the weights, of a size that does not depend on
    the input, and one block, or one part of the units or pairs, of which there are more for more text.
    """
    spark = docs.sparkSession
    held = is_held(column(doc_id)) if held is None else held
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"), F.coalesce(held, F.lit(False)).alias("held"))

    train = rows.filter(~F.col("held") & (F.octet_length("text") > 0))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch, "text"):
                data, offsets = with_ends(some.column("text"))
                starts, ends, owner = _spans(data, offsets)
                vectors = letters(data, starts, ends, owner, some.num_rows)
                yield pa.RecordBatch.from_arrays([some.column("key"), pa.array([v.tobytes() for v in vectors], pa.binary())], names=["key", "letters"])

    described = written(train.select(F.xxhash64("text").alias("key"), "text").mapInArrow(describe, "key long, letters binary"), "lm-letters")
    centres = fit_kinds(described)
    forget(spark, described)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for some in gathered(batches, "text", BLOCK):
            is_out = some.column("held").to_numpy(zero_copy_only=False)
            yield block_row(number, some.column("doc_id"), some.column("text"), is_out, centres)
            number += 1

    blocks = written(rows.mapInArrow(block, BLOCKS), "lm-blocks", "zstd")
    size = text_bytes(rows)
    parts = max(1, -(-size // PART_BYTES))
    pairs = written(pair_counts(blocks, parts), "lm-pairs", "zstd")
    forget(spark)
    units = written(unit_counts(blocks, parts), "lm-units", "zstd")
    forget(spark)
    of_parts = units.filter("words is not null")
    tokens, vocabulary, ones, twos = of_parts.agg(*(F.coalesce(F.sum(n), F.lit(0)) for n in ("tokens", "vocabulary", "ones", "twos"))).first()
    unit_less = discount(ones, twos)
    leads = np.zeros((2, KINDS * 8))  # under each lead the training units, and how many are different
    for r in of_parts.select(F.posexplode("by_lead").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect():
        leads.ravel()[r["i"]] = r["n"]
    texts = blocks.select(F.explode(F.arrays_zip("held", "kinds")).alias("d")).filter("not d.held")
    kinds = {r["kind"]: r["n"] for r in texts.groupBy(F.col("d.kinds").alias("kind")).agg(F.count("*").alias("n")).collect()}
    trained = sum(kinds.values())
    tokens, vocabulary = tokens + trained, vocabulary + (trained > 0)
    seen = pairs.agg(*(F.coalesce(F.sum(n), F.lit(0)) for n in ("ones", "twos", "begin"))).first()
    pair_less, begin = discount(*seen[:2]), (trained, seen[2])  # a training text has one unit that begins it

    training = of_parts.select("different", "words", "lengths", "leads", "exact")
    tables = spark.sparkContext.broadcast(_counted(training.coalesce(max(1, -(-int(leads[1].sum()) // COUNT_UNITS)))))
    model = spark.sparkContext.broadcast(_learned(training, tables))
    forget(spark)

    def rate(rows: pa.Table) -> pa.Table:
        rows = rows.to_pylist()
        part = next((r for r in rows if r["words"] is not None), None)
        if part is None:
            return pa.schema(_RATED).empty_table()
        words, lengths, lead, exact = _units(part)
        data, starts = _spelled(words, lengths, lead)
        all_units, different = leads[:, lead]
        spelled = 10.0 ** context_mix.Model(tables.value, model.value).score(data, starts, LEAD)
        p = np.where(all_units > 0, (np.maximum(exact - unit_less, 0) + unit_less * different * spelled) / np.maximum(all_units, 1), spelled)
        log = np.log10(np.maximum(p, 1e-300)).astype(np.float32)
        contexts = [(np.frombuffer(r["names"], np.int64), r["followers"]) for r in rows if r["followers"] is not None]
        name = pd.factorize(np.concatenate([names_of(words, lengths), *(n for n, _ in contexts)]))[0]
        count, name, context = name.max() + 1, name[: len(log)], name[len(log) :]
        total = np.bincount(name, weights=np.where(words[np.cumsum(lengths) - 1] != END, exact, 0), minlength=count).astype(np.int64)[name]  # all but a text's last have one behind them
        followers = np.bincount(context, weights=np.concatenate([np.zeros(0), *(unpacked(f, len(n)) for n, f in contexts)]), minlength=count).astype(np.int64)[name]
        c = unpacked(part["c"], len(log), "<i8")
        back = [r for r in rows if r["which"] is not None]
        which = [unpacked(r["which"], r["different"]) for r in back]
        columns = [[log[w].tobytes() for w in which], *([packed(v[w], "<i8") for w in which] for v in (c, total, followers))]
        return pa.table([pa.array([r["block"] for r in back], pa.int64()), pa.array([r["part"] for r in back], pa.int32()), *(pa.array(v, pa.binary()) for v in columns)], schema=pa.schema(_RATED))

    followed = units.select("part", "block", "which", "different", "leads", "lengths", "words", "exact", "c")
    followed = followed.unionByName(pairs.filter("names is not null").select(F.col("of").alias("part"), "names", "followers"), allowMissingColumns=True)
    rated = written(followed.groupBy("part").applyInArrow(rate, RATED), "lm-rated", "zstd")
    forget(spark, units)
    prior = np.log10(np.array([kinds.get(k, 0) + 1 for k in range(KINDS)]) / (trained + KINDS))
    whole = tokens + vocabulary + 1

    def put_together(rows: pa.Table) -> pa.Table:
        left = rows.filter(pc.is_valid(rows["sequence"]))
        counts, rates = (sorted(rows.filter(pc.is_valid(rows[n])).select(["part", *more]).to_pylist(), key=lambda r: r["part"]) for n, more in (("counts", ["counts"]), ("log", ["log", "c", "total", "followers"])))
        row = {n: left[n].combine_chunks()[0].values.to_numpy(zero_copy_only=False) for n in ("held", "kinds", "sizes", "uses")}
        uses, names = row["uses"], names_of(*_spelling(left.select(["different", "lengths", "words"]).to_pylist()[0]))
        order, some = by_part(parts_of(names, parts), parts)
        log, c, total, followers = (np.empty(len(names), t) for t in (np.float64, np.int64, np.int64, np.int64))
        for r in rates:
            at = order[some[r["part"]]]
            log[at] = np.frombuffer(r["log"], np.float32)
            for v, n in ((c, "c"), (total, "total"), (followers, "followers")):
                v[at] = unpacked(r[n], len(at), "<i8")
        unit = unpacked(left["sequence"][0].as_py(), int(uses.sum())).astype(np.int64)
        text, before, context, pair = pairs_of(names, uses, unit)
        _, _, which = _parted(context, pair, parts)
        count = np.concatenate([np.frombuffer(r["counts"], np.int32) for r in counts])[which]
        add = lambda v: np.bincount(text, weights=v, minlength=len(uses))
        base = add(np.where(c >= 0, np.log10((np.maximum(c, 0) + 1) / whole), 0)[unit]) + math.log10((trained + 1) / whole)
        of_all, different = np.append(total, begin[0])[before], np.append(followers, begin[1])[before]
        p = (10.0**log)[unit]
        p = np.where(of_all > 0, (np.maximum(count - pair_less, 0) + pair_less * different * p) / np.maximum(of_all, 1), p)
        place = np.arange(len(unit)) - (np.cumsum(uses) - uses)[text]
        so_far, of_text = _grouped(text * len(c) + unit)  # within a text: a unit, then the one before and it
        p = (ADAPT * p + so_far) / (ADAPT + place)
        begins = place == 0
        leading = np.where(begins, len(unit) + text, np.append(0, of_text[:-1])[: len(unit)])
        follows = _earlier(leading * np.int64(len(unit) + 1) + of_text)
        p = (PAIR_ADAPT * p + follows) / (PAIR_ADAPT + np.where(begins, 0, np.append(0, so_far[:-1])[: len(unit)]))
        score = prior[row["kinds"]] + add(np.log10(p))
        tokens_of = add((c >= 0)[unit]).astype(np.int64) + 1
        known_of = add((c > 0)[unit]).astype(np.int64) + (trained > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            bits = np.where(row["sizes"] > 0, -score / math.log10(2) / row["sizes"], np.nan)
        columns = [left["doc_ids"].combine_chunks()[0].values, row["held"], tokens_of, known_of, np.full(len(uses), tokens), base, score, row["kinds"], row["sizes"], pa.array(bits, from_pandas=True)]
        return pa.table([pa.array(v) if not isinstance(v, pa.Array) else v for v in columns], names=_names(SCORES)).cast(_none().schema)

    rounds = max(1, min(ROUNDS, size // ROUND_BYTES))
    tasks = ((blocks.agg(F.max("block")).first()[0] or 0) >> 32) + 1  # that wrote blocks; those of one are scored in one round
    scored = []
    for i in range(rounds):
        ours = lambda name: F.col(name).between((tasks * i // rounds) << 32, ((tasks * (i + 1) // rounds) << 32) - 1)  # noqa: E731, B023
        texts = blocks.filter(ours("block")).select("block", "doc_ids", "held", "kinds", "sizes", "uses", "different", "lengths", "words", "sequence")
        back = [pairs.filter(ours("block")).select("block", "part", "counts"), rated.filter(ours("block"))]
        scores = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), back, texts).groupBy("block").applyInArrow(put_together, SCORES)
        scored.append(written(scores, "lm-scores"))
        forget(spark)
    forget(spark, blocks, pairs, rated)
    return reduce(DataFrame.unionByName, scored)


def _none() -> pa.Table:
    types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "int": pa.int32()}
    return pa.schema([(c.split()[0], types[c.split()[1]]) for c in SCORES.split(", ")]).empty_table()


def op1_query(documents: DataFrame) -> DataFrame:
    return score(documents.select("doc_id", "text"))
