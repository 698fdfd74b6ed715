import pytest
from hypothesis import given, settings, strategies as st

from medstrata.llm.bpe import tokenizer_file
from medstrata.llm.token_counts import PrefixCounter, count_tokens, prefix_counts, truncate
from tests.llm.helpers import HARD_TEXTS, documents, empty, prose, with_clashes

PATH = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


tokens = st.lists(st.sampled_from(["a", "b", "er", "the", "tion", " ", "  ", "\n", "\t", "1", "23", "!", "..", "é", "中", "😀", "́", "\xa0", "▁", "<s>", "<0x0A>", "\x00", "A"]), max_size=30).map("".join)


@settings(deadline=None, max_examples=300)
@given(tokens)
def test_every_prefix(library, text):
    assert PrefixCounter.of(PATH).prefixes(text).tolist() == [len(library.encode(text[:i])) for i in range(len(text) + 1)]


@settings(deadline=None, max_examples=100)
@given(tokens, st.integers(0, 12))
def test_budget(library, text, budget):
    kept = PrefixCounter.of(PATH).within(text, budget)
    assert kept == text[: max(i for i in range(len(text) + 1) if len(library.encode(text[:i])) <= budget)]


def test_tables(spark, library):
    texts = [*HARD_TEXTS, prose(2, 9000), prose(2, 9000), "ab" * 5000]
    docs = with_clashes(documents(spark, list(enumerate(texts))), "n_tokens", "prefix")
    for r in count_tokens(docs, PATH).collect():
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 4096)
    cut = {r["doc_id"]: r["text"] for r in truncate(docs, PATH, 7).collect()}
    assert cut[0] is None and all(len(library.encode(t)) <= 7 for t in cut.values() if t is not None)
    assert all(len(r["prefix_tokens"]) == len(r["text"] or "") + 1 for r in prefix_counts(docs, PATH).collect())
    assert count_tokens(empty(spark), PATH).count() == 0


def test_columns_that_bear_the_results_name_stay(spark):
    docs = with_clashes(documents(spark, [(1, "ab cd"), (2, None)]), "prefix_tokens")
    found = {r["doc_id"]: r for r in prefix_counts(docs, PATH).collect()}
    assert [found[i]["prefix_tokens"] for i in (1, 2)] == ["own", "own"]
    assert [len(found[i]["_prefix_tokens"]) for i in (1, 2)] == [6, 1]
