"""One query for each operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from medstrata.llm import ann, bpe, chat, fill_in_middle, fingerprints, hard_negatives, html_extract, language_id, lm_scoring, ngram_join, pii, source_mix, token_counts
from medstrata.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(read(spark, folder, table))


QUERIES: dict[str, Query] = {
    "op6_bpe": _over("documents", bpe.op6_query),
    "op1_lm_scoring": _over("documents", lm_scoring.op1_query),
    "op2_ann": _over("embeddings", ann.op2_query),
    "op3_html_extract": _over("pages", html_extract.op3_query),
    "op4_ngram_join": _over("documents", ngram_join.op4_query),
    "op5_fingerprints": _over("documents", fingerprints.op5_query),
    "op7_token_counts": _over("documents", token_counts.op7_query),
    "op8_chat_format": _over("conversations", chat.op8_query),
    "op9_language_id": _over("documents", language_id.op9_query),
    "page_language_id": lambda spark, folder: language_id.pages_query(read(spark, folder, "documents"), read(spark, folder, "pages")),
    "op10_source_mix": _over("documents", source_mix.op10_query),
    "op11_pii": _over("documents", pii.op11_query),
    "op12_hard_negatives": _over("embeddings", hard_negatives.op12_query),
    "op13_fill_in_middle": _over("documents", fill_in_middle.op13_query),
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op8_chat_format": chat.OP8_SQL,
    "op10_source_mix": source_mix.OP10_SQL,
    "op11_pii": pii.OP11_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
    "op13_fill_in_middle": fill_in_middle.OP13_SQL,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
