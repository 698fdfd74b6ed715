"""Fill-in-the-middle documents, cut at token boundaries by a Roaring-style set.

The places where a text's tokens end form a set of integers. It is kept as Roaring sets
are: places with the same upper 16 bits share a container, which is an array of lower
halves, a bitmap, or a list of runs, whichever is smallest, and the containers' running
cardinalities stand beside them. The k-th boundary is then a binary search for its
container and a select inside it, so both cuts come without walking over the tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from medstrata.llm.common import column, flat, fresh, pieces

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  #: of 100: documents from here on stay plain
SPM_BELOW = 20  #: of 100: of the others, those below put the suffix first
SEED = "1"

CONTAINER = 1 << 16  #: places of a container
_BITMAP_BYTES = CONTAINER // 8

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


class ArrayContainer:
    """Lower halves in order: for few places."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def __len__(self) -> int:
        return len(self.low)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """A bit for each place, and the running number of bits before each word: for many places."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(CONTAINER, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        left = int(self.words[word])
        for _ in range(k - int(self.before[word])):
            left &= left - 1  # without its lowest bit
        return 64 * word + (left & -left).bit_length() - 1


class RunContainer:
    """First places of runs and the running number of places before each: for long runs."""

    def __init__(self, low: np.ndarray, breaks: np.ndarray):
        first = np.concatenate([[0], breaks])
        self.first = low[first].astype(np.uint16)
        self.before = np.append(first, len(low)).astype(np.int32)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


Container = ArrayContainer | BitmapContainer | RunContainer


def container(low: np.ndarray) -> Container:
    """The smallest container for places below ``CONTAINER``, in order and different."""
    breaks = np.flatnonzero(np.diff(low) != 1) + 1
    sizes = {RunContainer: 4 * (len(breaks) + 1), ArrayContainer: 2 * len(low), BitmapContainer: _BITMAP_BYTES}
    kind = min(sizes, key=sizes.__getitem__)
    return RunContainer(low, breaks) if kind is RunContainer else kind(low)


class BoundarySet:
    """A set of integers from 0 on, with select by rank."""

    def __init__(self, places: np.ndarray):
        """``places``: different, in order."""
        upper = places >> 16
        starts = np.flatnonzero(np.diff(upper, prepend=-1)) if len(places) else np.zeros(0, np.int64)
        self.upper = upper[starts]
        self.containers = [container(part & (CONTAINER - 1)) for part in np.split(places, starts[1:])] if len(places) else []
        self.before = np.concatenate([[0], np.cumsum([len(c) for c in self.containers], dtype=np.int64)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The place with ``k`` places before it."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        number = int(np.searchsorted(self.before, k, side="right")) - 1
        return (int(self.upper[number]) << 16) + self.containers[number].select(k - int(self.before[number]))

    def end_of(self, units: int) -> int:
        """Where the first ``units`` units end."""
        return self.select(units - 1) if units else 0


def boundaries(data: np.ndarray) -> tuple[BoundarySet, np.ndarray]:
    """Ends of the tokens ``[A-Za-z]+|[^A-Za-z]`` of a text's bytes, and each code point's first byte.

    Ends count code points; the second array has the number of bytes as its last value.
    """
    first = np.flatnonzero(data & 0xC0 != 0x80)
    letter = _LETTER[data[first]]
    inside = np.zeros(len(first), bool)  # a letter that another one follows ends nothing
    inside[:-1] = letter[:-1] & letter[1:]
    return BoundarySet(np.flatnonzero(~inside) + 1), np.append(first, len(data))


def draws(identity: Column, seed: str) -> list[Column]:
    """Four numbers below 2**32 that depend on the id and the seed alone (null id: as an empty one)."""
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(identity.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _formed(text: bytes, draw: list[int]) -> tuple[int, str, int | None, int | None, bytes]:
    """Number of units, form, code points of prefix and middle, output."""
    ends, first = boundaries(np.frombuffer(text, np.uint8))
    n = len(ends)
    if not n or any(mark.encode() in text for mark in (PREFIX, SUFFIX, MIDDLE)) or draw[2] % 100 >= PLAIN_FROM:
        return n, "plain", None, None, text
    a, b = sorted(ends.end_of(d % (n + 1)) for d in draw[:2])
    prefix, middle, suffix = text[: first[a]], text[first[a] : first[b]], text[first[b] :]
    if draw[3] % 100 < SPM_BELOW:
        form, parts = "spm", (SUFFIX.encode(), suffix, PREFIX.encode(), prefix, MIDDLE.encode(), middle)
    else:
        form, parts = "psm", (PREFIX.encode(), prefix, SUFFIX.encode(), suffix, MIDDLE.encode(), middle)
    return n, form, a, b - a, b"".join(parts)


def transform(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", seed: str = SEED) -> tuple[DataFrame, list[str]]:
    """``docs`` with five more columns, and their names: units, form, code points of prefix and middle, output.

    The names are ``n, form, prefix_chars, middle_chars, output`` unless ``docs`` has such
    columns. A null or empty text is plain, its output empty; so is a text that holds a mark
    already, whole. Rows with one id and text, or no id, are cut alike. Rows stay where
    they are: nothing is exchanged, and a task holds a few megabytes of text, or one text.
    """
    names = fresh(docs, "n", "form", "prefix_chars", "middle_chars", "output")
    (drawn,) = fresh(docs, "drawn")
    asked = docs.select("*", F.array(*draws(column(doc_id), seed)).alias(drawn))
    kinds = ("long", "string", "long", "long", "string")
    schema = docs.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in zip(names, kinds)]).schema
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    given = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in pieces(batch, text):
                data, offsets = flat(rows.column(text))
                data = data.tobytes()
                draw = rows.column(drawn).to_pylist()
                made = list(zip(*(_formed(data[a:b], d) for a, b, d in zip(offsets, offsets[1:], draw))))
                made[4] = pa.array(made[4], pa.binary()).cast(pa.string())
                kept = [c for c, name in zip(rows.columns, rows.schema.names) if name != drawn]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, made, types)], names=given)

    return asked.mapInArrow(run, schema), names


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from output and form.

    Each mark occurs once: texts with marks stay plain, and a part that ends in the
    beginning of a mark cannot complete one, as only a mark's first character is ``<``.
    """

    def between(value: Column, mark: str) -> tuple[Column, Column]:
        return F.substring_index(value, mark, 1), F.substring_index(value, mark, -1)

    def after_mark(value: Column) -> Column:
        return F.substr(value, F.lit(len(PREFIX) + 1))

    prefix, rest = between(output, SUFFIX)
    suffix, middle = between(rest, MIDDLE)
    psm = F.concat(after_mark(prefix), middle, suffix)
    suffix, rest = between(output, PREFIX)
    prefix, middle = between(rest, MIDDLE)
    spm = F.concat(prefix, middle, after_mark(suffix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13_query(documents: DataFrame) -> DataFrame:
    """Cuts, form and digests of every document."""
    out, (n, form, prefix_chars, middle_chars, output) = transform(documents.select("doc_id", "text"))
    return out.select(
        "doc_id", n, form, prefix_chars, middle_chars,
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(restored(F.col(output), F.col(form)), 256).alias("restored_sha256"),
    )


OP13_SQL = rf"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 8) AS BIGINT)) AS h
  FROM documents),
placed AS (
  SELECT *, len(units) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a, greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h[3] % 100 >= {PLAIN_FROM} THEN 'plain'
      WHEN h[4] % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix
  FROM placed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
    ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
