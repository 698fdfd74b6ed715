"""From documents to token ids: language, near duplicates, mixing, encoding.

Each stage takes what its predecessor kept, as a Parquet table in the shared folder. All
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from medstrata.llm import bpe, language_id, ngram_join, source_mix
from medstrata.llm.common import column, read, ready, written

VOCABULARY = "byte_bpe_50k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is accepted from text, declared language and source."""
    ready(spark)
    judged, (_, _, accepted) = language_id.identify(docs)
    return judged.filter(F.col(accepted)).select(*map(column, docs.columns))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles, similarity 0.8 or more, the smallest id."""
    ready(spark)
    return ngram_join.without_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    mixed, (size, source_size, target, copies) = source_mix.mix(docs)
    return source_mix.repeated(mixed.drop(size, source_size, target), copies).select(*map(column, docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document given out, and digests of the ids and of the text they decode to."""
    ready(spark)
    return bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), bpe.tokenizer_file(VOCABULARY)).select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("ngram_join", keep_one_of_each),
    ("source_mix", mix_sources),
    ("bpe", encode),
]

#: Language evidence, signature joins and BPE have no SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
