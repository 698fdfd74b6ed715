"""Byte-level BPE by tree concatenation, and decoding.

A long text is cut into halves, the halves into halves, and so on down to leaves that are
encoded independently of each other. Going up, two encodings are put together by encoding
a window around their join anew. The window begins at a token's start on the left and ends
at a token's end on the right and grows until the new tokens agree with the old ones on
both sides. Whether two tokens may follow each other depends on those two alone, so from
there on the tokens of the halves are those of the whole, and the result is exact.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from medstrata.llm.common import column, fresh, pieces, tidied

LEAF = 4096  #: code points that are encoded at once
WINDOW = 32  #: bytes on either side of a join, at first
AT_ONCE = 1 << 20  #: bytes of text that are encoded at a time (one text at least)
AGREE = 4  #: tokens that must be the same on either side


def tokenizer_file(name: str) -> str:
    """Where the installed public vocabulary files are; any other path serves as well."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabulary files write bytes with.

    Visible Latin-1 characters stand for themselves, the others for code points from 256.
    """
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


#: How byte-level BPE splits text before merging (a fixed value of the vocabulary).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Encodes and decodes with a vocabulary file of the tokenizers library."""

    _kept: dict[tuple, "Encoder"] = {}

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        special = {t["content"]: t["id"] for t in file["added_tokens"] if t["special"]}
        letters, vocab = _byte_letters(), file["model"]["vocab"]
        self.bytes = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, number in vocab.items():
            if token not in special:
                self.bytes[number] = bytes(letters[c] for c in token)
        ranks = {b: i for i, b in enumerate(self.bytes) if b}
        self._leaves = tiktoken.Encoding("leaves", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        for token, number in special.items():
            self.bytes[number] = token.encode()
        self.special, self.leaf, self.window = special, leaf, window

    @classmethod
    def of(cls, path: str, leaf: int = LEAF, window: int = WINDOW) -> "Encoder":
        """One encoder for each worker."""
        key = (path, leaf, window)
        if key not in cls._kept:
            cls._kept[key] = cls(path, leaf, window)
        return cls._kept[key]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text; strings of special tokens become those tokens."""
        plan: list[list] = []  # for each text: special ids, and (first leaf, last leaf, data) of what lies between
        leaves: list[str] = []
        for text in texts:
            parts = []
            for part in self._around_special(text):
                if isinstance(part, int):
                    parts.append(part)
                elif part:
                    first = len(leaves)
                    leaves += self._halves(part)
                    parts.append((first, len(leaves)))
            plan.append(parts)
        encoded = self._leaves.encode_ordinary_batch(leaves, num_threads=1)
        out = []
        for parts in plan:
            ids: list[int] = []
            for part in parts:
                ids += [part] if isinstance(part, int) else self._tree(leaves, encoded, *part)[0]
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", errors="replace")

    def _around_special(self, text: str) -> Iterator[str | int]:
        if not any(s in text for s in self.special):
            yield text
            return
        at = 0
        while found := min(((i, -len(s), s) for s in self.special if (i := text.find(s, at)) >= 0), default=None):
            yield text[at : found[0]]
            yield self.special[found[2]]
            at = found[0] + len(found[2])
        yield text[at:]

    def _halves(self, text: str) -> list[str]:
        if len(text) <= self.leaf:
            return [text]
        middle = len(text) // 2
        return self._halves(text[:middle]) + self._halves(text[middle:])

    def _tree(self, leaves: list[str], encoded: list[list[int]], first: int, last: int) -> tuple[list[int], bytes]:
        """Ids and bytes of the leaves from ``first`` up to ``last``."""
        if last - first == 1:
            return encoded[first], leaves[first].encode()
        middle = (first + last) // 2
        left, left_bytes = self._tree(leaves, encoded, first, middle)
        right, right_bytes = self._tree(leaves, encoded, middle, last)
        return self.joined(left, left_bytes, right, right_bytes), left_bytes + right_bytes

    def joined(self, left: list[int], left_bytes: bytes, right: list[int], right_bytes: bytes) -> list[int]:
        """The encoding of both texts in a row, from the encodings of each."""
        size = self.window
        while True:
            a, back = self._reach(reversed(left), left_bytes, size, -1)
            b, ahead = self._reach(iter(right), right_bytes, size, 1)
            window = left_bytes[len(left_bytes) - back :] + right_bytes[:ahead]
            new = self._leaves.encode_ordinary(window.decode())
            whole_left, whole_right = a == len(left), b == len(right)
            kept_left, kept_right = left[len(left) - a :], right[:b]
            if (whole_left or new[:AGREE] == kept_left[:AGREE]) and (whole_right or new[-AGREE:] == kept_right[-AGREE:]):
                return left[: len(left) - a] + new + right[b:]
            size *= 2

    def _reach(self, tokens: Iterator[int], data: bytes, size: int, step: int) -> tuple[int, int]:
        """How many tokens, and bytes, from a join on: ``size`` bytes at least, whole characters, enough tokens to agree."""
        count = total = 0
        for token in tokens:
            count += 1
            total += len(self.bytes[token])
            place = len(data) - total if step < 0 else total
            if total >= size and count > 2 * AGREE and (place == len(data) or data[place] & 0xC0 != 0x80):
                return count, total
        return count, len(data)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids array<int>``: the text's token ids.

    A null text counts as empty and has no ids; ties and repeated rows are encoded alike;
    other columns stay, one named ``ids`` makes the new one ``_ids``. Rows are encoded
    where they are: nothing is exchanged.
    """
    (name,) = fresh(docs, "ids")
    schema = docs.select("*", F.array().cast("array<int>").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            for rows in pieces(batch, text, AT_ONCE):  # Python's integers take 10 times the bytes of a text
                ids = encoder.encode([t or "" for t in rows.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*rows.schema.names, name])

    return docs.mapInArrow(tidied(run), schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded string``: the text of the ids (null: empty)."""
    (name,) = fresh(encoded, "decoded")
    schema = encoded.select("*", F.lit("").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            texts = [encoder.decode(x.as_py() or []) for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name])

    return encoded.mapInArrow(tidied(run), schema)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``ids`` as :func:`encode` and ``decoded`` as :func:`decode` give them.

    One worker of a task does both, so a core holds the vocabulary once.
    """
    kept = docs.drop(column(text))
    ids, decoded = fresh(kept, "ids", "decoded")
    schema = kept.select("*", F.array().cast("array<int>").alias(ids), F.lit("").alias(decoded)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in batches:
            for rows in pieces(batch, text, AT_ONCE):
                found = encoder.encode([t or "" for t in rows.column(text).to_pylist()])
                others = [c for i, c in enumerate(rows.columns) if rows.schema.names[i] != text]
                made = [pa.array(found, pa.list_(pa.int32())), pa.array(map(encoder.decode, found), pa.string())]
                yield pa.RecordBatch.from_arrays([*others, *made], names=schema.names)

    return docs.mapInArrow(tidied(run), schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of documents."""
    return round_trip(docs.select("doc_id", "text"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_query(documents: DataFrame, path: str | None = None) -> DataFrame:
    return digests(documents, path or tokenizer_file("byte_bpe_50k.json"))
