import hashlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from medstrata.llm.bpe import tokenizer_file
from medstrata.llm.source_mix import OP10_SQL
from tests.llm.helpers import documents, empty
from tests.llm.test_language_id import corpus
from tests.llm.test_ngram_join import brute, edited


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_join", "source_mix", "bpe"]


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(i, t * 3, lang, f"s{i % 4}") for i, t, lang, _ in corpus()]
    rows += [(5000 + i, rows[i][1], "en", "s1") for i in range(10)]
    rows += [(6000 + i, edited(rows[200][1], 0.005 * i, i), "fr", "s2") for i in range(10)]
    rows += [(7000, "", "en", "s0"), (7001, None, None, None), (7002, "12 34", "en", "s0"), (7003, " ".join(rows[1][1].split() * 200), "en", None)]
    documents(spark, rows).selectExpr("*", "cast(length(text) as long) as n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path), rows


def test_rows_by_hand(spark, folder):
    from tokenizers import Tokenizer

    path, rows = folder
    rows = [r for r in rows if r[0] not in (7000, 7001, 7002)]  # no letters, so no language
    kept = {n for n, _, c in brute([r[:2] for r in rows], 5, 80, 100) if n == c}
    rows = [r for r in rows if r[0] in kept]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    copies = {n: taken // size for n, size, _, _, taken in con.execute(OP10_SQL).fetchall()}
    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    expected = Counter()
    for n, text, lang, source in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        expected[n, lang, source, len(ids), tuple(ids), hashlib.sha256(text.encode()).hexdigest()] += copies[n]
    found = corpus_pipeline.run(spark, path)
    assert Counter((r["doc_id"], r["lang"], r["source"], r["n_tokens"], tuple(r["ids"]), r["decoded_sha256"]) for r in found.collect()) == +expected
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert all(r["ids_sha256"] == digest(r["ids"]) for r in found.limit(20).collect())


def test_stages_keep_the_columns(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("copies", F.lit("own"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and out.count() > 0, name


def test_empty_table(spark, tmp_path):
    empty(spark).selectExpr("*", "0L as n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
