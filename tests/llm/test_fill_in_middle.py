import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from medstrata.llm.fill_in_middle import (
    ArrayContainer, BitmapContainer, BoundarySet, RunContainer, boundaries, container, op13_query, restored, transform,
)
from tests.llm.helpers import HARD_TEXTS, documents, empty, prose, with_clashes

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.DOTALL)


def by_hand(doc_id, text):
    """Units, form, code points of prefix and middle, output."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("low, kind", [
    (np.arange(0, 9000, 9), ArrayContainer), (np.arange(0, 65536, 5), BitmapContainer),
    (np.arange(65536), RunContainer), (np.r_[5:3000, 4000:65536], RunContainer), (np.array([65535]), ArrayContainer),
])
def test_containers(low, kind):
    made = container(low)
    assert type(made) is kind and len(made) == len(low)
    for k in {0, len(low) - 1, *range(0, len(low), 997)}:
        assert made.select(k) == low[k]


@settings(deadline=None, max_examples=50)
@given(st.lists(st.tuples(st.integers(0, 400_000), st.integers(1, 3000)), max_size=8), st.integers(1, 7))
def test_select_of_any_set(ranges, step):
    places = np.unique(np.concatenate([np.zeros(0, np.int64), *[np.arange(a, a + size * step, step) for a, size in ranges]]))
    found = BoundarySet(places)
    assert len(found) == len(places)
    for k in range(0, len(places), max(1, len(places) // 50)):
        assert found.select(k) == places[k]
    for k in (-1, len(places)):
        with pytest.raises(IndexError):
            found.select(k)


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="aZb 1<>PS.é中😀\n\x00", max_size=60))
def test_boundaries_are_ends_of_units(text):
    ends, _ = boundaries(np.frombuffer(text.encode(), np.uint8))
    expected = [m.end() for m in UNIT.finditer(text)]
    assert [ends.select(k) for k in range(len(ends))] == expected and ends.end_of(0) == 0


def test_rows_equal_brute_force(spark):
    texts = [*HARD_TEXTS, prose(1, 30000), "中文" * 50000, "ab " * 60000, "x" * 200_000, *(prose(i, 40 + i) for i in range(120)),
             "tail <", "<S", "a<P>b", "<M>", "x <<S y", *("é<" * i for i in range(1, 30))]
    docs = documents(spark, [*enumerate(texts), (7, texts[20]), (None, "no id here"), (None, None)])
    out, names = transform(with_clashes(docs, "n", "Form", "output", "drawn"))
    rows = out.select("doc_id", "text", *[F.col(f"`{c}`") for c in names], restored(F.col(names[4]), F.col(names[1])).alias("back")).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        assert tuple(r[c] for c in names) == by_hand(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert {r[names[1]] for r in rows} == {"plain", "psm", "spm"}
    assert transform(empty(spark))[0].count() == 0


def test_query_digests(spark):
    docs = documents(spark, [(i, prose(i, 30)) for i in range(50)] + [(50, None)])
    for r in op13_query(docs).collect():
        n, form, p, m, output = by_hand(r["doc_id"], prose(r["doc_id"], 30) if r["doc_id"] < 50 else None)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, p, m)
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        text = prose(r["doc_id"], 30) if r["doc_id"] < 50 else ""
        assert r["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()
