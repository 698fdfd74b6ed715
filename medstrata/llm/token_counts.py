"""Exact token counts of every prefix by dynamic programming.

In a BPE vocabulary whose merges go by score, an encoding is right exactly if every two
neighbouring tokens are what merging gives for their joint text. So the encoding of a
prefix ends in the only token that ends there and may follow the last token of the prefix
in front of it, and has one token more. One pass over a text gives the count at every
prefix; how many tokens a cut text has and where a budget ends are look-ups.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from medstrata.llm.bpe import tokenizer_file
from medstrata.llm.common import column, fresh

SPACE = "▁"  #: what the vocabulary writes for a space (a fixed value)
LIMIT = 4096
CACHE = 600_000  #: units, and pairs of pieces, that a worker keeps
LONG_UNIT = 64  #: longer units are counted but not kept
NOTHING = -1  #: stands for the begin of a unit and for a character that becomes bytes


class _Kept(dict):
    """Values that are worked out when first asked for; begins anew when it is full."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, key):
        if len(self) >= CACHE:
            self.clear()
        self[key] = value = self.work(key)
        return value


class PrefixCounter:
    """Prefix counts for a sentencepiece BPE vocabulary with byte fallback.

    A unit is a run of spaces with the characters up to the next space or line end: no
    piece of the vocabulary has a space after another character or holds a line end
    (checked when it is loaded), so tokens stay within units, and counts of units add up.
    """

    _loaded: dict[str, "PrefixCounter"] = {}

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        with open(path, "rb") as f:
            model = sentencepiece.SentencePieceProcessor(model_proto=f.read())
        count = model.get_piece_size()
        normal = [i for i in range(count) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.count_of_pieces = count
        self.pieces = {model.id_to_piece(i): i for i in normal}
        if any(SPACE in piece.lstrip(SPACE) or "\n" in piece for piece in self.pieces):
            raise ValueError("pieces of this vocabulary reach over spaces or line ends")
        self.text = {i: piece for piece, i in self.pieces.items()}
        self.rank = {i: -model.get_score(i) for i in normal}
        self.parts = {i: self._last_merge(piece) for piece, i in self.pieces.items()}
        self.found = ahocorasick.Automaton()
        for piece, i in self.pieces.items():
            if len(piece) == 1 or self.parts[i]:  # others are never the result of merging
                self.found.add_word(piece, (i, len(piece)))
        self.found.make_automaton()
        self.may_follow = _Kept(self._may_follow)
        self.unit_count = _Kept(lambda unit: self.unit_prefixes(unit)[-1])
        self._find = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n").findall

    @classmethod
    def of(cls, path: str) -> "PrefixCounter":
        """One counter for each worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def units(self, text: str) -> list[str]:
        """The text as the vocabulary sees it, with a space in front, in units."""
        return self._find(SPACE + text.replace(" ", SPACE)) if text else []

    def count(self, text: str) -> int:
        """Number of tokens of a text."""
        units = self.units(text)
        if max(map(len, units), default=0) <= LONG_UNIT:
            return sum(map(self.unit_count.__getitem__, units))
        return sum(self.unit_count[u] if len(u) <= LONG_UNIT else self.unit_prefixes(u)[-1] for u in units)

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of every prefix of ``text``, by its length in code points (0 to all)."""
        if not text:
            return np.zeros(1, np.int64)
        parts, total = [], 0
        for unit in self.units(text):
            counts = np.array(self.unit_prefixes(unit)[1:], np.int64) + total
            parts.append(counts)
            total = int(counts[-1])
        out = np.concatenate(parts)
        out[0] = 0  # the place after the space in front: the empty prefix, which has no tokens
        return out

    def within(self, text: str, budget: int) -> str:
        """The longest prefix of ``text`` that has ``budget`` tokens or fewer."""
        return text[: int(np.flatnonzero(self.prefixes(text) <= budget)[-1])] if budget >= 0 else ""

    def unit_prefixes(self, unit: str) -> list[int]:
        """Tokens of every prefix of a unit: the dynamic programme."""
        counts, last = [0] * (len(unit) + 1), [NOTHING] * (len(unit) + 1)
        may_follow, of, done = self.may_follow, self.count_of_pieces, 0
        for end, (piece, length) in self.found.iter(unit):
            while done < end:  # no piece ended there: a character that becomes bytes
                done += 1
                if not counts[done]:
                    counts[done] = counts[done - 1] + len(unit[done - 1].encode())
            end += 1
            if not counts[end] and may_follow[(last[end - length] + 1) * of + piece]:
                counts[end], last[end] = counts[end - length] + 1, piece
        while done < len(unit):
            done += 1
            if not counts[done]:
                counts[done] = counts[done - 1] + len(unit[done - 1].encode())
        return counts

    def _may_follow(self, pair: int) -> bool:
        """Whether merging the text of two pieces gives just these two.

        Only symbols at the seam can merge over it: those on the right edge of the first
        piece's merge tree with those on the left edge of the second's. Two of them meet
        if the pair's rank comes before the merges that use them up; at equal rank the
        left merge goes first. The walk goes down the edge whose symbol is made later.
        """
        first, second = divmod(pair, self.count_of_pieces)
        if not first:
            return True
        a, b = first - 1, second
        used_a = used_b = float("inf")  # rank of the merge that uses the symbol up
        while True:
            joint = self.pieces.get(self.text[a] + self.text[b])
            if joint is not None and self.rank[joint] < used_a and self.rank[joint] <= used_b:
                return False
            low_a, low_b = self.parts[a], self.parts[b]
            if low_a and (not low_b or self.rank[a] > self.rank[b]):
                used_a, a = self.rank[a], low_a[1]
            elif low_b:
                used_b, b = self.rank[b], low_b[0]
            else:
                return True

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """The two pieces that merging a piece's text puts together last; None if it does not lead to the piece."""
        parts = list(piece)
        while len(parts) > 2:
            best = min(((self.rank[i], at) for at in range(len(parts) - 1) if (i := self.pieces.get(parts[at] + parts[at + 1])) is not None), default=None)
            if best is None:
                return None
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        if len(parts) < 2 or any(p not in self.pieces for p in parts):
            return None
        return self.pieces[parts[0]], self.pieces[parts[1]]


OUT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def count_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text.

    Null and empty texts have no tokens; repeated rows are counted each; an empty table
    gives an empty one; other columns are ignored. Rows are counted where they are:
    nothing is exchanged. A worker keeps counts of CACHE units, whatever it reads.
    """
    rows = docs.select(column(doc_id).cast("long").alias("doc_id"), column(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter.of(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(run, OUT)


def truncate(docs: DataFrame, path: str, budget: int, text: str = "text") -> DataFrame:
    """``docs`` with every text cut to its longest prefix within ``budget`` tokens; null stays null."""
    out = docs.withColumn(text, column(text).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter.of(path)
        for batch in batches:
            place = batch.schema.names.index(text)
            cut = [t if t is None else counter.within(t, budget) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(cut, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return out.mapInArrow(run, out.schema)


def prefix_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``prefix_tokens array<int>``: tokens of each prefix, by its length from 0.

    A null text counts as empty. Where ``docs`` has a column of that name, it stays and the
    new, last one gets underscores in front.
    """
    (name,) = fresh(docs, "prefix_tokens")
    schema = docs.select("*", F.array().cast("array<int>").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter.of(path)
        for batch in batches:
            tables = [counter.prefixes(t or "").astype(np.int32) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tables, pa.list_(pa.int32()))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def op7_query(documents: DataFrame, path: str | None = None) -> DataFrame:
    return count_tokens(documents, path or tokenizer_file("piece_bpe_32k.model"))
