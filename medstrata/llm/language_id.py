"""Language identification by fusing evidence with Bayes' rule.

Four kinds of evidence on a text are multiplied: how likely its letters are in a language,
how likely its declared language is, and how common the language is on its host. The prior
of a host is smoothed with that of its domain, which is smoothed with that of the address
suffix, and that with the whole table's. All counts come from grouped aggregations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from medstrata.llm.common import column, flat, fresh, pieces, tidied, written

SAMPLE = 20_000  #: labelled rows that letters are counted in, about; chosen by a hash of the row
AT_ONCE = 1 << 20  #: bytes of text that are scored at a time
CELLS = 1 << 16  #: of the table of letter triples
EVIDENCE = 300  #: letter triples that a text counts for at most, as neighbours depend on each other
STRENGTH = 20.0  #: rows' worth of smoothing between two levels of the host prior
TRUST = 20.0  #: rows' worth of smoothing of declared languages
OTHER = 0.01  #: prior of none of the languages
ACCEPT = 0.5  #: posterior from which a language is accepted

#: Letters a-z, bytes of other letters, and one code for all else.
_CODES = np.zeros(256, np.uint32)
_CODES[97:123] = _CODES[65:91] = np.arange(1, 27)
_CODES[128:] = np.arange(27, 155)


def triples(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all triples of bytes that hold a letter, and where each text's begin (and the end)."""
    data, offsets = flat(pc.binary_join_element_wise(pc.fill_null(texts, ""), "  ", ""))
    codes = _CODES[data]
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    fits = (a | b | c) > 0
    last = offsets[1:]
    fits[last[:-1] - 1] = fits[last[:-1] - 2] = False  # begin in the two blanks behind a text
    cells = ((a * np.uint32(2654435761) + b * np.uint32(40503) * np.uint32(155) + c * np.uint32(97)) >> np.uint32(7)) % np.uint32(CELLS)
    before = np.concatenate([[0], np.cumsum(fits)])
    return cells[fits].astype(np.int64), before[np.minimum(offsets, len(fits))]


@dataclass(frozen=True)
class Letters:
    """Log likelihoods of letter triples: a row for each cell, a column for each language and the last for none of them."""

    languages: tuple[str, ...]
    table: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        """Log likelihoods of texts, each counted as EVIDENCE triples at most; 0 for a text without letters."""
        cells, bounds = triples(texts)
        count = np.diff(bounds)
        sums = np.zeros((len(count), self.table.shape[1]))
        if len(cells):
            full = count > 0
            sums[full] = np.add.reduceat(self.table[cells], bounds[:-1][full], axis=0, dtype=np.float64)
        return sums * (np.minimum(count, EVIDENCE) / np.maximum(count, 1))[:, None]


def fit(docs: DataFrame, text: str = "text", label: str = "lang", sample: int = SAMPLE) -> Letters:
    """Counts letter triples by label in about ``sample`` labelled rows.

    The table that reaches the driver has CELLS rows for each language, whatever the input.
    """
    labelled = docs.filter(column(label).isNotNull() & column(text).isNotNull())
    rows = labelled.count()
    if rows > sample:
        kept = int(sample / rows * 2**32)
        labelled = labelled.filter(F.pmod(F.xxhash64(*[column(c) for c in docs.columns]), F.lit(2**32)) < kept)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for some in pieces(batch, "text", AT_ONCE):
                cells, bounds = triples(some.column("text"))
                languages = np.array(some.column("label").to_pylist(), object)
                owner = np.repeat(np.arange(len(languages)), np.diff(bounds))
                for language in set(languages):
                    hits = np.bincount(cells[(languages == language)[owner]], minlength=CELLS)
                    found[language] = found.get(language, 0) + hits
        for language, hits in found.items():
            cell = np.flatnonzero(hits)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(cell), pa.string()), pa.array(cell), pa.array(hits[cell].astype(np.int64))], names=["label", "cell", "n"])

    counted = labelled.select(column(label).cast("string").alias("label"), column(text).alias("text")).mapInArrow(tidied(count), "label string, cell long, n long")
    found = counted.groupBy("label", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(set(found["label"])))
    table = np.full((CELLS, len(languages) + 1), 0.5)
    for i, language in enumerate(languages):
        own = found[found["label"] == language]
        table[own["cell"].to_numpy(), i] += own["n"].to_numpy()
    return Letters(languages, np.log(table / table.sum(0)).astype(np.float32))


def host_of(address: Column) -> Column:
    """The host of an address, or the whole of what is no address; empty for null."""
    host = F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(F.when(F.contains(address, F.lit("://")), host).otherwise(address), F.lit("")))


def _domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def _suffix(host: Column) -> Column:
    return F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1)).otherwise(F.lit(""))


def with_likelihoods(docs: DataFrame, letters: Letters, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with an array of log likelihoods, and the name of that column; nothing is exchanged."""
    (name,) = fresh(docs, "likelihoods")
    schema = docs.select("*", F.array().cast("array<double>").alias(name)).schema
    shared = docs.sparkSession.sparkContext.broadcast(letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch, text, AT_ONCE):
                scores = shared.value.score(some.column(text))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(scores.ravel()), scores.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*some.columns, lists], names=[*some.schema.names, name])

    return docs.mapInArrow(tidied(run), schema), name


def fuse(scored: DataFrame, languages: tuple[str, ...], likelihoods: str, declared: str | None, address: str | None) -> tuple[DataFrame, list[str]]:
    """``scored`` with language, posterior and whether the language is accepted; the new columns' names.

    A first guess from the text alone is counted by host and by declared language. A row
    is left out of the counts that judge it. Null, unknown or missing declarations and
    addresses are values of their own. Texts without letters are not accepted, nor is a
    language with a posterior under ACCEPT. Counts by host are written, so the planner
    knows whether they are small enough to broadcast; if not, hot hosts are split.
    """
    n = len(languages)
    lang, posterior, accepted, guess, host, said, host_n, said_n, of_host, of_said = fresh(
        scored, "detected_lang", "posterior", "accepted", "guess", "host", "said", "host_counts", "said_counts", "of_host", "of_said"
    )
    by_all, by_suffix, by_domain, by_host, by_said, logs_of, top, whole = fresh(scored, "_all", "_suffix", "_domain", "_host", "_said", "_logs", "_top", "_sum")
    own = F.col(likelihoods)
    best = F.when(F.exists(own, lambda x: x != 0), F.array_position(F.slice(own, 1, n), F.array_max(F.slice(own, 1, n))).cast("int"))
    rows = (
        scored.withColumn(guess, best if n else F.lit(None).cast("int"))
        .withColumn(host, host_of(column(address)) if address else F.lit(""))
        .withColumn(said, F.lower(F.substring_index(F.coalesce(column(declared), F.lit("")), "-", 1)) if declared else F.lit(""))
    )
    if not n:
        out = rows.select(*scored.columns, F.lit(None).cast("string").alias(lang), F.lit(0.0).alias(posterior), F.lit(False).alias(accepted))
        return out, [lang, posterior, accepted]

    def added(counts) -> Column:
        return F.array(*[counts(i) for i in range(n)])

    guesses = written(rows.groupBy(host, said, guess).agg(F.count("*").alias("rows")), "language-counts")
    by = lambda *keys: guesses.groupBy(*keys).agg(added(lambda i: F.sum(F.when(F.col(guess) == i + 1, F.col("rows")).otherwise(0))).alias("counts"))
    hosts = by(host).withColumn("domain", _domain(F.col(host))).withColumn("suffix", _suffix(F.col(host)))
    level = lambda table, key, name: table.groupBy(key).agg(added(lambda i: F.sum(F.col("counts")[i])).alias(name))
    hosts = hosts.join(level(hosts, "domain", "in_domain"), "domain").join(level(hosts, "suffix", "in_suffix"), "suffix")
    everything = by(said)  # one row for each declared language
    total = everything.agg(added(lambda i: F.sum(F.col("counts")[i])).alias("t")).first()
    totals = F.array(*[F.lit(int(x or 0)) for x in (total["t"] if total else [0] * n)])
    prior = written(hosts.select(F.col(host).alias(of_host), F.struct("counts", "in_domain", "in_suffix").alias(host_n)), "language-hosts")
    voices = written(everything.select(F.col(said).alias(of_said), F.col("counts").alias(said_n)), "language-declared")

    def smoothed(counts: Column, below: Column | None) -> Column:
        """Shares of languages among the other rows, with STRENGTH rows of the level below."""
        others = F.transform(counts, lambda x, i: F.greatest(x - (F.coalesce(F.col(guess), F.lit(0)) == i + 1).cast("int"), F.lit(0)))
        size = F.aggregate(others, F.lit(0.0), lambda s, x: s + x)
        if below is None:
            return F.transform(others, lambda x: (x + 1.0) / (size + n))
        return F.zip_with(others, below, lambda x, p: (x + STRENGTH * p) / (size + STRENGTH))

    joined = rows.join(prior, F.col(host) == F.col(of_host), "left").join(voices, F.col(said) == F.col(of_said), "left")
    ready = joined.withColumn(by_all, smoothed(totals, None))
    for name, counts, below in ((by_suffix, "in_suffix", by_all), (by_domain, "in_domain", by_suffix), (by_host, "counts", by_domain)):
        ready = ready.withColumn(name, smoothed(F.col(host_n)[counts], F.col(below)))
    # P(declared | language): from counts, with TRUST rows that mostly declare the language itself.
    names = F.array(*[F.lit(x.lower()) for x in languages])
    usual = F.transform(names, lambda x: F.when(F.col(said) == "", 1.0).when(F.col(said) == x, 0.9).when(F.array_contains(names, F.col(said)), 0.1 / max(n - 1, 1)).otherwise(0.1))
    fewer = F.transform(F.arrays_zip(F.col(said_n).alias("c"), totals.alias("t"), usual.alias("u")), lambda z, i: _share(z, F.coalesce(F.col(guess), F.lit(0)) == i + 1))
    ready = ready.withColumn(by_said, fewer)
    logs = F.zip_with(F.zip_with(by_host, by_said, lambda p, d: F.log(p * d * (1 - OTHER))), F.slice(own, 1, n), lambda a, b: a + b)
    other = F.log(F.lit(OTHER)) + F.element_at(own, n + 1) + F.log(F.aggregate(F.zip_with(by_host, by_said, lambda p, d: p * d), F.lit(0.0), lambda s, x: s + x))
    ready = ready.withColumn(logs_of, F.concat(logs, F.array(other))).withColumn(top, F.array_max(logs_of))
    ready = ready.withColumn(whole, F.aggregate(logs_of, F.lit(0.0), lambda s, x: s + F.exp(x - F.col(top))))
    place = F.array_position(F.slice(logs_of, 1, n), F.array_max(F.slice(logs_of, 1, n))).cast("int")
    share = F.exp(F.element_at(F.col(logs_of), place) - F.col(top)) / F.col(whole)
    out = ready.select(
        *[column(c) for c in scored.columns],
        F.element_at(F.array(*map(F.lit, languages)), place).alias(lang),
        share.alias(posterior),
        (F.col(guess).isNotNull() & (share >= ACCEPT)).alias(accepted),
    )
    return out, [lang, posterior, accepted]


def _share(z: Column, own: Column) -> Column:
    gone = own.cast("int")
    return (F.greatest(z["c"] - gone, F.lit(0)) + TRUST * z["u"]) / (F.greatest(z["t"] - gone, F.lit(0)) + TRUST)


def identify(docs: DataFrame, *, text: str = "text", declared: str | None = "lang", address: str | None = "source", letters: Letters | None = None) -> tuple[DataFrame, list[str]]:
    """``docs`` with detected language, posterior and acceptance, and the names of these columns.

    ``letters`` defaults to a fit on the declared languages of ``docs`` itself. Null and
    empty texts have no letters: they get the language that declaration and host make most
    likely and are not accepted. Repeated rows are judged each; an empty table gives an
    empty one; a table without any label accepts nothing.
    """
    letters = letters or fit(docs, text, declared)
    scored, likelihoods = with_likelihoods(docs, letters, text)
    out, names = fuse(scored, letters.languages, likelihoods, declared, address)
    return out.drop(likelihoods), names


def op9_query(documents: DataFrame) -> DataFrame:
    """Language of every document: text, declared language, and source as host."""
    rows = documents.select("doc_id", "text", "lang", "source")
    letters = fit(rows)
    scored, likelihoods = with_likelihoods(rows, letters)
    narrow = written(scored.drop("text"), "language-scores")
    out, (lang, posterior, accepted) = fuse(narrow, letters.languages, likelihoods, "lang", "source")
    return out.select("doc_id", F.col("lang").alias("declared_lang"), F.col(lang).alias("lang"), posterior, F.col(accepted).alias("kept"))


def pages_query(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """Language of every page: visible text, the language its markup declares, and its address.

    The letters are learned from the documents.
    """
    from medstrata.llm.html_extract import extract

    letters = fit(documents.select("doc_id", "text", "lang", "source"))
    declared = F.nullif(F.regexp_extract("html", r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z-]+)", 1), F.lit(""))
    rows = extract(pages.select("page_id", "url", "html").withColumn("declared", declared), keep=("page_id", "url", "declared"))
    scored, likelihoods = with_likelihoods(rows, letters)
    narrow = written(scored.drop("text"), "language-pages")
    out, (lang, posterior, accepted) = fuse(narrow, letters.languages, likelihoods, "declared", "url")
    return out.select("page_id", "declared", F.col(lang).alias("lang"), posterior, F.col(accepted).alias("kept"))
