"""Personal data in texts, in native expressions only.

Regular expressions propose spans, checks confirm them (Luhn's sum for cards, mod 97 for
bank account numbers, the range of an address's parts, numbers of digits), and words of
the text around a span raise its score. Everything happens in the row of the text:
nothing is exchanged, and no text leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from medstrata.llm.common import column, fresh

THRESHOLD = 0.5  #: spans of the added kinds count from this score on
CONTEXT = 40  #: code points before and after a span that are searched for its words
CONTEXT_BONUS = 0.4  #: what one of those words adds to a score, at most up to 1
RUN = 256  #: lengths that are added up at a time for places in texts with many spans

_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

Check = Callable[[Column], Column]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _number_of_digits(least: int, most: int) -> Check:
    return lambda value: F.length(_digits(value)).between(least, most)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass Luhn's check; other characters are left out."""

    def passes(digits: Column) -> Column:
        def added(total: Column, place: Column) -> Column:
            digit = F.substr(digits, -place, F.lit(1)).cast("int") * F.when(place % 2 == 0, 2).otherwise(1)
            return total + F.when(digit > 9, digit - 9).otherwise(digit)

        return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), added) % 10 == 0

    return _bound(_digits(value), passes)


def mod_97(value: Column) -> Column:
    """Whether an account number passes: letters as numbers from 10, the first four characters last."""

    def remainder(moved: Column) -> Column:
        def step(left: Column, place: Column) -> Column:
            code = F.ascii(F.substr(moved, place, F.lit(1)))
            number = F.when(code < 58, code - 48).otherwise(code - 55)
            return (left * F.when(number > 9, 100).otherwise(10) + number) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1

    return _bound(F.regexp_replace(value, " ", ""), lambda v: _bound(F.concat(F.substr(v, F.lit(5)), F.substring(v, 1, 4)), remainder))


@dataclass(frozen=True)
class Kind:
    """One kind of span: how it is proposed, confirmed, and what its score is.

    ``must`` is a character that every span of the kind has, if there is one: texts
    without it are not searched.
    """

    name: str
    pattern: str
    check: Check | None
    score: float
    words: str  # pattern of words that raise the score, in lower case
    must: str | None = None
    base: bool = True


# Possessive repetitions and the look-behinds change no match of the plain patterns
#   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+),
#   [0-9]([ -]?[0-9])+ with 12 to 19 digits, \+[0-9][ ().0-9-]+[0-9]
# but keep the search linear: a span begins where its run of characters does, or where the
# span before it ended, and repetitions are never taken back. The last one is the plain one.
BASE = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, 0.9, "mail|contact|courriel|correo", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), 0.6, "address|server|host|client|ip", "."),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])", luhn, 0.8, "card|visa|credit|payment|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", _number_of_digits(9, 15), 0.7, "phone|call|tel|fax|mobile|whatsapp", "+"),
)

# Added: account numbers, whose check leaves hardly a doubt, and numbers that only the
# words beside them tell from other numbers. They end no word and no number, and neither
# do words or numbers follow them at once.
ADDED = (
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4})(?: [0-9]{4}){1,6}(?: [0-9]{1,3})?)", mod_97, 0.9, "iban|account|konto|compte|cuenta", base=False),
    Kind("ssn", r"(?<![0-9])[0-9]++(?:-[0-9]++)++", lambda v: v.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$") & ~v.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, "ssn|social security", "-", base=False),
    Kind("local_phone", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", None, 0.3, "phone|call|tel|fax|mobile|whatsapp", base=False),
)

KINDS = (*BASE, *ADDED)

SPAN = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"


def _total(lengths: Column, first: Column, count: Column) -> Column:
    return F.aggregate(F.slice(lengths, first, count), F.lit(0), lambda a, b: a + b)


def _with_starts(lengths: Column, use: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``use`` of a function that gives the sum of the first ``i`` lengths.

    Sums of runs are kept, so texts with very many spans do not add all lengths for each.
    """
    number = F.floor(F.size(lengths) / RUN).cast("int")
    runs = F.transform(F.sequence(F.lit(0), number), lambda r: _total(lengths, r * RUN + 1, F.lit(RUN)))

    def start_of(sums: Column) -> Callable[[Column], Column]:
        run = lambda i: F.floor(i / RUN).cast("int")
        return lambda i: _total(sums, F.lit(1), run(i)) + _total(lengths, run(i) * RUN + 1, i % RUN)

    return _bound(runs, lambda sums: use(start_of(sums)))


def _near(kind: Kind, before: Column, after: Column) -> Column:
    """Whether one of the kind's words stands beside a span."""
    beside = F.concat(F.right(before, F.lit(CONTEXT)), F.lit(" "), F.left(after, F.lit(CONTEXT)))
    return F.lower(beside).rlike(rf"(?:^|[^a-z])(?:{kind.words})")


def spans_of(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind in a text that is not null, in order.

    The pieces between matches and the matches give each span's place: code points before
    it are those of the pieces up to it and of the matches before it.
    """

    def found(pieces: Column, matches: Column) -> Column:
        def spans(start_of: Callable[[Column], Column]) -> Column:
            def one(match: Column, i: Column) -> Column:
                near = F.when(_near(kind, pieces[i], pieces[i + 1]), CONTEXT_BONUS).otherwise(0.0)
                score = F.least(F.lit(1.0), F.lit(kind.score) + near)
                made = _bound(start_of(i) + F.length(pieces[i]), lambda start: F.struct(
                    F.lit(kind.name).alias("kind"), start.alias("start"), (start + F.length(match)).alias("end"),
                    score.alias("score"), F.lit(kind.base).alias("base"),
                ))
                tests = [kind.check(match)] if kind.check else []
                if not kind.base:
                    beside = F.concat(F.right(pieces[i], F.lit(1)), F.left(pieces[i + 1], F.lit(1)))
                    stuck = ((i > 0) & (pieces[i] == "")) | ((i < F.size(matches) - 1) & (pieces[i + 1] == ""))
                    tests += [~beside.rlike("[A-Za-z0-9]") & ~stuck, score >= THRESHOLD]
                return F.when(reduce(Column.__and__, tests), made) if tests else made

            return F.filter(F.transform(matches, one), lambda s: s.isNotNull())

        lengths = F.transform(matches, lambda m, i: F.length(pieces[i]) + F.length(m))
        return _bound(lengths, lambda known: _with_starts(known, spans))

    none = F.lit(None).cast(SPAN)
    searched = _bound(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)),
        lambda matches: F.when(F.size(matches) > 0, _bound(F.split(text, kind.pattern, -1), lambda pieces: found(pieces, matches))).otherwise(none),
    )
    searched = searched.cast(SPAN)
    return F.when(F.contains(text, F.lit(kind.must)), searched).otherwise(none) if kind.must else searched


def find(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> tuple[DataFrame, str]:
    """``docs`` with one more column, an array of spans, and its name.

    The name is ``spans`` unless ``docs`` has such a column. A span has its kind, start
    and end in code points (end exclusive), score, and whether its kind is a base kind:
    those spans count whatever their score, others from ``THRESHOLD`` on, and only where
    they do not lie within a base span. Spans are in order of start, then of kind as listed.
    Null and empty texts have an empty array. Rows are judged one by one, so repeated
    rows, ties and null ids need no rule.
    """
    (name,) = fresh(docs, "spans")
    value = F.coalesce(column(text), F.lit(""))
    names = F.array(*[F.lit(k.name) for k in kinds])

    def together(parts: Column) -> Column:
        base, added = F.filter(parts, lambda s: s["base"]), F.filter(parts, lambda s: ~s["base"])
        free = _bound(base, lambda b: F.concat(b, F.filter(added, lambda a: ~F.exists(b, lambda x: (x["start"] <= a["start"]) & (a["end"] <= x["end"])))))
        keyed = F.transform(free, lambda s: F.struct(s["start"], F.array_position(names, s["kind"]).alias("listed"), s.alias("span")))
        return F.transform(F.array_sort(keyed), lambda s: s["span"])

    each = [F.coalesce(spans_of(value, kind), F.array().cast(SPAN)) for kind in kinds]
    return docs.withColumn(name, _bound(F.concat(*each), together)), name


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kind(name: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == name


def op11_query(documents: DataFrame) -> DataFrame:
    """Base spans counted and digested, and all spans, of every document."""
    found, spans = find(documents.select("doc_id", "text"))
    found = found.select("doc_id", spans)
    base = F.filter(F.col(spans), lambda s: s["base"])
    counts = [F.size(F.filter(F.col(spans), _of_kind(k.name))).cast("long").alias(f"n_{k.name}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col(spans)).alias("spans"))


def _sql() -> str:
    """The same rows in SQL: places from plain patterns, pieces between matches, checks on lists."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "card": r"[0-9](?:[ -]?[0-9])+",
        "ssn": r"[0-9]+(?:-[0-9]+)+",
    }
    rows = ",\n  ".join(
        f"({i}, '{k.name}', '{plain.get(k.name, k.pattern)}', CAST({k.score} AS DOUBLE), '(?:^|[^a-z])(?:{k.words})', {k.base})" for i, k in enumerate(KINDS, 1)
    )
    counts = ",\n  ".join(f"CAST(count(*) FILTER (WHERE kind = '{k.name}') AS BIGINT) AS n_{k.name}" for k in BASE)
    number = "regexp_replace(match, '[^0-9]', '', 'g')"
    return rf"""
WITH kinds(listed, kind, pattern, score, words, base) AS (VALUES
  {rows}),
texts AS (SELECT row_number() OVER () AS line, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT line, listed, kind, score, words, base, regexp_extract_all(text, pattern) AS found, string_split_regex(text, pattern) AS pieces
  FROM texts, kinds),
proposed AS (
  SELECT *, found[i] AS match, pieces[i] AS before, pieces[i + 1] AS after,
    coalesce(list_sum(list_transform(pieces[1:i], lambda p: length(p))), 0) + coalesce(list_sum(list_transform(found[1:i - 1], lambda m: length(m))), 0) AS s
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM cut)),
checked AS (
  SELECT *, {number} AS digits,
    list_transform(string_split(substr(replace(match, ' ', ''), 5) || substr(replace(match, ' ', ''), 1, 4), ''), lambda c: CASE WHEN ascii(c) < 58 THEN ascii(c) - 48 ELSE ascii(c) - 55 END) AS account,
    least(1.0, score + CASE WHEN regexp_matches(lower(right(before, {CONTEXT}) || ' ' || left(after, {CONTEXT})), words) THEN {CONTEXT_BONUS} ELSE 0 END) AS total
  FROM proposed),
confirmed AS (
  SELECT line, listed, kind, base, s, s + length(match) AS e FROM checked
  WHERE CASE kind
      WHEN 'ip' THEN len(list_filter(string_split(match, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || right(p, 3) AS INTEGER) > 255)) = 0
      WHEN 'card' THEN length(digits) BETWEEN 12 AND 19
        AND list_sum(list_transform(range(1, length(digits) + 1), lambda p: CASE WHEN p % 2 = 0 THEN [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][CAST(digits[length(digits) + 1 - p] AS INTEGER) + 1] ELSE CAST(digits[length(digits) + 1 - p] AS INTEGER) END)) % 10 = 0
      WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
      WHEN 'iban' THEN list_reduce(list_prepend(0, account), lambda a, d: (a * CASE WHEN d > 9 THEN 100 ELSE 10 END + d) % 97) = 1
      WHEN 'ssn' THEN regexp_matches(match, '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$') AND NOT regexp_matches(match, '^(?:000|666|9)|-00-|-0000$')
      ELSE true END
    AND (base OR (total >= {THRESHOLD} AND NOT regexp_matches(right(before, 1) || left(after, 1), '[A-Za-z0-9]')
      AND (before <> '' OR i = 1) AND (after <> '' OR i = len(found))))),
kept AS (
  SELECT * FROM confirmed c
  WHERE base OR NOT EXISTS (SELECT 1 FROM confirmed b WHERE b.base AND b.line = c.line AND b.s <= c.s AND c.e <= b.e)),
summed AS (
  SELECT line,
  {counts},
  coalesce(string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, listed) FILTER (WHERE base), '') AS base_spans,
  coalesce(string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, listed), '') AS spans
  FROM kept GROUP BY line)
SELECT doc_id, {", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in BASE)}, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN summed USING (line)
"""


OP11_SQL = _sql()
