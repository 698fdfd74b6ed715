import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from medstrata.llm.bpe import Encoder, decode, digests, encode, round_trip, tokenizer_file
from tests.helpers import plan
from tests.llm.helpers import HARD_TEXTS, documents, empty, prose, with_clashes

PATH = tokenizer_file("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


tokens = st.lists(st.sampled_from(["a", "the", " the", "'s", "'", "'ll", " ", "  ", "\n", "\t", "1", "23", "!", "...", "é", "中", "😀", "́", "\xa0", "<|endoftext|>", "A", "\r\n"]), max_size=60).map("".join)


@settings(deadline=None, max_examples=300)
@given(tokens, st.sampled_from([(3, 1), (5, 2), (16, 4), (4096, 32)]))
def test_halves_join_exactly(library, text, sizes):
    encoder = Encoder.of(PATH, *sizes)
    (ids,) = encoder.encode([text])
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("unit", ["a", "ab", "中", " ", "\n", "7", "!", "aA1", "'s"])
def test_long_unsplit_texts(library, unit):
    text = unit * 9000
    assert Encoder.of(PATH).encode([text])[0] == library.encode(text, add_special_tokens=False).ids


def test_random_letters(library):
    chance = random.Random(5)
    text = "".join(chance.choice("ACGT") for _ in range(40_000))
    assert Encoder.of(PATH, 64, 8).encode([text])[0] == library.encode(text, add_special_tokens=False).ids


def test_tables(spark, library):
    texts = [*HARD_TEXTS, prose(1, 3000), prose(1, 3000)]
    docs = with_clashes(documents(spark, list(enumerate(texts))), "ids", "decoded")
    rows = decode(encode(docs, PATH), PATH, "_ids").orderBy("doc_id").collect()
    assert [r["_decoded"] for r in rows] == [t or "" for t in texts] and rows[0]["ids"] == "own"
    for r, d in zip(rows, digests(docs, PATH).orderBy("doc_id").collect()):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert list(r["_ids"]) == ids and d["n_tokens"] == len(ids)
        assert d["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert d["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert digests(empty(spark), PATH).count() == 0


def test_one_vocabulary_a_core(spark, tmp_path):
    docs = with_clashes(documents(spark, [(1, "a b"), (2, None)]), "ids", "decoded")
    rows = round_trip(docs, PATH).orderBy("doc_id").collect()
    assert [r["_decoded"] for r in rows] == ["a b", ""] and rows[0]["ids"] == "own" and "text" not in rows[0]
    docs.write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    stages = dict(corpus_pipeline.STAGES)
    for made in (digests(stored, PATH), stages["bpe"](spark, stored, "")):
        assert len(re.findall(r"\bMapInArrow\b", plan(made))) == 1
