"""Chat formatting with typed content parts.

A turn's content is a list of parts. A visitor walks over them in order: text is
escaped, an image, audio clip or document becomes a placeholder, and its reference,
place and expanded token count are recorded. The turns of a conversation are written
and read back as a stream, one turn at a time, so a conversation of any length needs
the memory of one turn.

    ### role: text<|image 0|>more text</turn>

Control strings inside roles and texts get a backslash in front, which reading removes.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from medstrata.llm.common import column

OPEN, MIDDLE, CLOSE, MEDIA_OPEN, MEDIA_CLOSE = "### ", ": ", "</turn>", "<|", "|>"
_IN_TEXT = r"\\|###|</turn>|<\|"
_CONTROLS = _IN_TEXT + "|" + MIDDLE  # a role ends at the first MIDDLE without a backslash
_UNESCAPE = re.compile(r"\\(" + _CONTROLS + ")")
#: Of a written turn: an escaped control string, its end, or a placeholder.
_TOKEN = re.compile(r"\\(?:" + _CONTROLS + r")|(?P<close></turn>)|(?P<media><\|(?:image|audio|document) \d+\|>)|(?P<middle>: )")

#: Roles whose text the loss is computed on.
LEARNED = frozenset({"assistant"})


def escape(text: str, controls: str = _IN_TEXT) -> str:
    return re.sub(controls, lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


class Expansion(NamedTuple):
    """How many tokens an attachment stands for once a model's encoder has read it."""

    image_patch: int = 14  #: pixels along an image patch; one token each
    audio_rate: float = 25.0  #: tokens a second
    page_tokens: int = 256  #: tokens a page of a document


class Attachment(NamedTuple):
    kind: str
    ref: str
    offset: int  #: code points of the turn's text in front of it
    tokens: int


class PartVisitor:
    """Flattens the parts of one turn; ``first`` numbers its placeholders."""

    def __init__(self, expansion: Expansion = Expansion(), first: int = 0):
        self.expansion, self.first = expansion, first
        self.written: list[tuple[str, bool]] = []  #: with whether it is text
        self.plain = ""  #: text since the last placeholder, escaped as one run
        self.length = 0
        self.attachments: list[Attachment] = []

    def visit(self, part: dict) -> None:
        """A part of unknown kind counts as text; missing values count as empty or 0."""
        getattr(self, f"visit_{part.get('type') or 'text'}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        self.plain += part.get("text") or ""

    def visit_image(self, part: dict) -> None:
        patch = self.expansion.image_patch
        self._place("image", part, math.ceil((part.get("width") or 0) / patch) * math.ceil((part.get("height") or 0) / patch))

    def visit_audio(self, part: dict) -> None:
        self._place("audio", part, math.ceil((part.get("seconds") or 0) * self.expansion.audio_rate))

    def visit_document(self, part: dict) -> None:
        self._place("document", part, (part.get("pages") or 0) * self.expansion.page_tokens)

    def _place(self, kind: str, part: dict, tokens: int) -> None:
        self._end_run()
        number = self.first + len(self.attachments)
        self.attachments.append(Attachment(kind, part.get("ref") or "", self.length, int(tokens)))
        self.written.append((f"{MEDIA_OPEN}{kind} {number}{MEDIA_CLOSE}", False))

    def _end_run(self) -> None:
        self.length += len(self.plain)
        self.written.append((escape(self.plain), True))
        self.plain = ""

    def runs(self) -> list[tuple[str, bool]]:
        self._end_run()
        return [run for run in self.written if run[0]]


class Turn(NamedTuple):
    """One written turn: its segment of the conversation and what it refers to."""

    segment: str
    loss: list[tuple[int, int]]  #: spans of the segment, in code points, that the loss covers
    attachments: list[Attachment]


def write_turn(role: str, parts: Iterable[dict], expansion: Expansion = Expansion(), first: int = 0) -> Turn:
    visitor = PartVisitor(expansion, first)
    for part in parts:
        visitor.visit(part)
    body, loss = f"{OPEN}{escape(role, _CONTROLS)}{MIDDLE}", []
    for run, is_text in visitor.runs():
        if is_text and role in LEARNED:
            loss.append((len(body), len(body) + len(run)))
        body += run
    return Turn(f"{body}{CLOSE}\n", loss, visitor.attachments)


def read_turn(segment: str) -> tuple[str, str, list[str]]:
    """Role, text and placeholders of a written turn."""
    if not segment.startswith(OPEN) or not segment.endswith(CLOSE + "\n"):
        raise ValueError("not a written turn")
    role, text, media, at = None, [], [], len(OPEN)
    for m in _TOKEN.finditer(segment, at):
        if m["middle"] and role is None:
            role, at = unescape(segment[at : m.start()]), m.end()
        elif m["media"]:
            text.append(segment[at : m.start()])
            media.append(m["media"])
            at = m.end()
        elif m["close"]:
            text.append(segment[at : m.start()])
            return role or "", "".join(map(unescape, text)), media
    raise ValueError("not a written turn")


SEGMENTS = (
    "conv_id {id}, turn_no long, role string, segment string, loss array<struct<start:int,stop:int>>, "
    "attachments array<struct<kind:string,ref:string,offset:int,tokens:int>>"
)
_PART = ("type", "text", "ref", "width", "height", "seconds", "pages")


def by_turn(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None) -> DataFrame:
    """The rows of a conversation one after the other, in order, in one partition.

    Ties of ``turn`` go by role and text; null turns come first.
    """
    chosen = turns.select(
        column(conv_id).alias("conv_id"),
        column(turn).alias("turn"),
        F.coalesce(column(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(column(text).cast("string"), F.lit("")).alias("text"),
        *([F.transform(column(parts), lambda p: F.struct(*[p[n].alias(n) for n in _PART])).alias("parts")] if parts else []),
    )
    return chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None, expansion: Expansion = Expansion()) -> DataFrame:
    """One row a turn: its number in the conversation, segment, loss spans, attachments.

    A conversation's output is its segments joined in order. ``parts`` names a column of
    ``array<struct<type,text,ref,width,height,seconds,pages>>`` that follows the text.
    Null roles and texts are empty; null ids form one conversation; repeated rows are
    repeated turns; an empty table gives an empty one; other columns are ignored.
    """
    ordered = by_turn(turns, conv_id, turn, role, text, parts)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number, placed = object(), 0, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != current:
                    current, number, placed = row["conv_id"], 0, 0
                content = [{"type": "text", "text": row["text"]}, *(p for p in row.get("parts") or [] if p)]
                done = write_turn(row["role"], content, expansion, placed)
                out.append((current, number, row["role"], done.segment, [{"start": a, "stop": b} for a, b in done.loss], [a._asdict() for a in done.attachments]))
                number, placed = number + 1, placed + len(done.attachments)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), arrow)], names=names)

    schema = SEGMENTS.format(id=dict(ordered.dtypes)["conv_id"])
    names, arrow = _arrow(schema)
    return ordered.mapInArrow(write, schema)


DIGESTS = "conv_id {id}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """What the written conversations say: one row each, from :func:`format_turns`.

    Follows ``format_turns`` without an exchange: its rows are together and in order.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []

        def row() -> tuple:
            return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])

        for batch in batches:
            out = []
            for conv, number, segment, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn_no", "segment", "loss"))):
                if number == 0:
                    if state:
                        out.append(row())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, _ = read_turn(segment)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[5] += len(segment)
                for span in loss:
                    learned = unescape(segment[span["start"] : span["stop"]])
                    state[3] += len(learned)
                    state[4].update(learned.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), arrow)], names=names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row(), arrow)], names=names)

    schema = DIGESTS.format(id=dict(segments.dtypes)["conv_id"])
    names, arrow = _arrow(schema)
    return segments.mapInArrow(read, schema)


def _arrow(schema: str) -> tuple[list[str], list[pa.DataType]]:
    out = to_arrow_schema(StructType.fromDDL(schema))
    return out.names, out.types


#: A conversation whose texts hold the template's own strings.
HARD = r"\### Assistant: </turn> ok"


def op8_query(conversations: DataFrame) -> DataFrame:
    wanted = conversations.select("conv_id", "turn", "role", "text")
    hard = wanted.sparkSession.createDataFrame([(-7, 0, "user", HARD), (-7, 1, "assistant", HARD)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(wanted.unionByName(hard)))


OP8_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{HARD}'), (-7, 1, 'assistant', '{HARD}')),
written AS (
  SELECT *, '### ' || regexp_replace(role, '\\|###|</turn>|<\||: ', '\\\0', 'g') || ': '
    || regexp_replace(text, '\\|###|</turn>|<\|', '\\\0', 'g') || '</turn>' || chr(10) AS segment
  FROM turns),
joined AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
    CAST(sum(length(segment)) AS BIGINT) AS formatted_chars
  FROM written GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars
FROM joined
"""
