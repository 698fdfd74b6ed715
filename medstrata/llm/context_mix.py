"""Logistic context mixing over the bytes of a unit (a word with what ends it).

Every bit is predicted by several counters, found by hashing the bits of the byte so far
with the last one, two, three or four bytes or with the unit so far. A longer context's
prediction leans on the shorter one's until it has counts of its own. Predictions meet in
the logistic domain with weights that a gate chooses by the bit's place and by how often
the two longest contexts were seen. The weights learn online from the coding error, and a
last stage refines the probability by what came true of like predictions.

A unit begins with ``lead`` bytes that are known beforehand: they are context, not coded.
Bytes that follow the same beginning of several units are counted, learned and scored once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd

from medstrata.llm.common import powers

#: Bits of the hash of each context's table: 1, 2, 3, 4 bytes, and the unit so far.
BITS = (17, 18, 20, 21, 21)
INPUTS = len(BITS) + 1  # and a constant
DEEP = 12  #: bytes that a unit so far is known by
BACKOFF = 1.0  #: bits' worth of the shorter context's prediction in that of the longer
SURE = np.float32(1e-6)  #: a prediction keeps off 0 and 1
CONFIDENT = 6  #: classes of how often a context was seen
CLASSES = CONFIDENT * CONFIDENT
GATES = 8 * CLASSES
RATE = 0.05  #: of learning
BATCH = 8_192  #: places whose like bits make one step of learning
STEPS = 48  #: classes of probabilities that the last stage refines
REFINE_PRIOR = 16.0
CHUNK = 1 << 19  #: bytes whose like places are put together
SLICE = 1 << 14  #: places that are looked at together

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_NODE, _LAST = np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)
_BASE = 0x2545F4914F6CDD1D


@dataclass
class Chunk:
    """Some whole units, of whose coded bytes like ones are put together.

    Bytes are alike if they and what they are predicted from are: the first bytes of units
    that begin alike, mostly. ``unit`` and ``which`` name every coded byte's unit and place;
    ``data`` and ``hashes`` are the value and the hash of each context of every place.
    """

    first: int
    last: int
    unit: np.ndarray
    which: np.ndarray
    data: np.ndarray
    hashes: list[np.ndarray]

    def slices(self, size: int) -> Iterator[slice]:
        for i in range(0, len(self.data), size):
            yield slice(i, i + size)

    def bits(self, part: slice | np.ndarray) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
        """For each of the eight bits of some places: its number, its values, and where each table counts it.

        The slots for four bits in turn, of one context, lie side by side.
        """
        data = self.data[part]
        for j in range(8):
            if j % 4 == 0:
                turn = (data >> 4).astype(np.uint64) * _NODE + _NODE if j else np.uint64(0)
                begin = [(((h[part] ^ turn) * _LAST) >> np.uint64(64 - b)).view(np.int64) for h, b in zip(self.hashes, BITS)]
                node = np.ones(len(data), np.int64)  # a leading 1, then the bits so far
            bit = (data >> (7 - j)) & 1
            yield j, bit, [s ^ node for s in begin]
            node = node * 2 + bit


def chunks(data: np.ndarray, starts: np.ndarray, lead: int) -> Iterator[Chunk]:
    """Runs of whole units of about CHUNK bytes."""
    ends = np.append(starts[1:], len(data))
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + CHUNK, side="right")))
        yield _chunk(a, b, data[starts[a] : ends[b - 1]], starts[a:b] - starts[a], lead)
        a = b


def _chunk(first: int, last: int, data: np.ndarray, starts: np.ndarray, lead: int) -> Chunk:
    unit = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(data))))
    at = np.flatnonzero(np.arange(len(data)) - starts[unit] >= lead)
    unit = unit[at]
    codes = data.astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes * powers(pow(_BASE, -1, 1 << 64), len(data)), out=sums[1:])
    seen = (sums[at] - sums[np.maximum(starts[unit], at - DEEP)]) * powers(_BASE, len(data))[at]
    which, different = pd.factorize(seen * _ODD[0] + data[at])
    alike = np.empty(len(different), np.int64)
    alike[which] = np.arange(len(which))
    at, place, seen = at[alike], at[alike] - starts[unit[alike]], seen[alike]
    near, hashes = np.zeros(len(at), np.uint64), []
    for d in range(1, 5):
        near = near * np.uint64(257) + np.where(place >= d, codes[np.maximum(at - d, 0)], np.uint64(0))
        hashes.append((near + np.uint64(1)) * _ODD[d - 1])
    hashes.append((seen + np.uint64(1)) * _ODD[4])
    return Chunk(first, last, unit, which, data[at], [h ^ (h >> np.uint64(29)) for h in hashes])


def empty_counts() -> list[np.ndarray]:
    """Counts of 0 and 1 bits, in turn, for each table."""
    return [np.zeros(2 << b) for b in BITS]


def count(data: np.ndarray, starts: np.ndarray, times: np.ndarray, tables: list[np.ndarray], lead: int = 0) -> None:
    """Adds the bits of units, each ``times`` over, to the tables."""
    for some in chunks(data, starts, lead):
        weight = _weights(some, times)
        for part in some.slices(SLICE):
            for _, bit, slots in some.bits(part):
                for table, slot in zip(tables, slots):
                    np.add.at(table, 2 * slot + bit, weight[part])


def _weights(some: Chunk, times: np.ndarray) -> np.ndarray:
    """How often units hold each place."""
    return np.bincount(some.which, weights=times[some.first : some.last][some.unit], minlength=len(some.data))


def _inputs(tables: list[np.ndarray], slots: list[np.ndarray], own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Predictions in the logistic domain, and the gate of those for this bit; ``own`` is the bit to leave out once."""
    x = np.empty((INPUTS, len(slots[0])), np.float32)
    seen, p = [], np.float32(0.5)
    for k, (table, slot) in enumerate(zip(tables, slots)):
        pair = table.view(np.complex64 if table.dtype == np.float32 else np.complex128).take(slot)  # both counts at once
        zeros, ones = pair.real.astype(np.float32), pair.imag.astype(np.float32)
        if own is not None:
            zeros, ones = np.maximum(zeros - (own == 0), 0), np.maximum(ones - own, 0)
        total = zeros + ones + np.float32(1)
        p = np.minimum(np.maximum((ones + np.float32(BACKOFF) * p) / (total + np.float32(BACKOFF - 1)), SURE), 1 - SURE)
        np.log(p / (1 - p), out=x[k])
        if k >= len(BITS) - 2:
            seen.append(np.minimum((((total.view(np.int32) >> 23) + 1) >> 1) - 64, CONFIDENT - 1))  # half the logarithm, by the exponent
    x[-1] = 0.3
    return x, (seen[0] * CONFIDENT + seen[1]).astype(np.int64)


def _together(x: np.ndarray, weights: np.ndarray, gate: np.ndarray) -> np.ndarray:
    """Sum of the predictions by the weights of each gate; ``weights`` has a row for each prediction."""
    out = x[0] * weights[0].take(gate, mode="clip")
    for k in range(1, INPUTS):
        out += x[k] * weights[k].take(gate, mode="clip")
    return out


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.minimum(np.maximum(x, -14), 14)))


def _step(mixed: np.ndarray) -> np.ndarray:
    """The class of a probability that its refinement is looked up by."""
    return np.minimum(np.maximum((mixed + 12) * (STEPS / 24), 0), STEPS - 1).astype(np.int64)


@dataclass
class Learned:
    """Weights of every gate, how many bits they learned from, and how like predictions came out."""

    weights: np.ndarray
    mass: np.ndarray
    ones: np.ndarray
    all: np.ndarray

    @classmethod
    def begin(cls) -> "Learned":
        weights = np.zeros((GATES, INPUTS))
        weights[:, -2] = 1.0  # the longest context's prediction, which holds the others
        return cls(weights, np.zeros(GATES), np.zeros(GATES * STEPS), np.zeros(GATES * STEPS))

    def learn(self, data: np.ndarray, starts: np.ndarray, times: np.ndarray, tables: list[np.ndarray], lead: int = 0) -> None:
        """One online pass: every bit is predicted from all counts but its own, coded, and learned from."""
        for some in chunks(data, starts, lead):
            weight = _weights(some, times)
            order = np.argsort((some.hashes[-1] ^ some.data) * _ODD[1], kind="stable")  # frequent places come first otherwise
            for part in (order[part] for part in some.slices(BATCH)):
                for j, bit, slots in some.bits(part):
                    x, gate = _inputs(tables, slots, bit)
                    self._learn(j, x, gate, bit, weight[part])

    def _learn(self, j: int, x: np.ndarray, gate: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        ours = slice(j * CLASSES, (j + 1) * CLASSES)
        mixed = _together(x, np.ascontiguousarray(self.weights[ours].T.astype(np.float32)), gate)
        error = (bit - _squash(mixed)) * weight
        seen = np.bincount(gate, weights=weight, minlength=CLASSES)
        for k in range(INPUTS):
            slope = np.bincount(gate, weights=error * x[k], minlength=CLASSES)
            self.weights[ours, k] += RATE * slope / np.maximum(seen, 1e-9)
        self.mass[ours] += seen
        cells = slice(j * CLASSES * STEPS, (j + 1) * CLASSES * STEPS)
        cell = gate * STEPS + _step(mixed)
        self.all[cells] += np.bincount(cell, weights=weight, minlength=CLASSES * STEPS)
        self.ones[cells] += np.bincount(cell, weights=weight * bit, minlength=CLASSES * STEPS)


class Model:
    """A finished model: log10 probabilities of units."""

    def __init__(self, tables: list[np.ndarray], learned: Learned):
        self.tables, self.weights = tables, np.ascontiguousarray(learned.weights.T.astype(np.float32).reshape(INPUTS, 8, CLASSES).swapaxes(0, 1))
        middle = _squash((np.arange(STEPS) + 0.5) * (24 / STEPS) - 12)
        refined = (learned.ones.reshape(GATES, STEPS) + REFINE_PRIOR * middle) / (learned.all.reshape(GATES, STEPS) + REFINE_PRIOR)
        self.refined = np.stack([1 - refined, refined], axis=-1).astype(np.float32).reshape(8, -1)  # of a 0 and a 1

    def score(self, data: np.ndarray, starts: np.ndarray, lead: int = 0) -> np.ndarray:
        out = np.zeros(len(starts))
        for some in chunks(data, starts, lead):
            total = np.empty(len(some.data))
            for part in some.slices(SLICE):
                p = 1.0
                for j, bit, slots in some.bits(part):
                    x, gate = _inputs(self.tables, slots, None)
                    mixed = _together(x, self.weights[j], gate)
                    refined = self.refined[j].take((gate * STEPS + _step(mixed)) * 2 + bit)
                    p = p * (0.5 * (_squash(np.where(bit == 1, mixed, -mixed)) + refined)).astype(np.float64)
                total[part] = np.log10(p)
            out[some.first : some.last] = np.bincount(some.unit, weights=total[some.which], minlength=some.last - some.first)
        return out
