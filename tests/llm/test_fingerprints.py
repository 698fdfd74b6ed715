import hashlib
import random

import numpy as np
import pytest

from medstrata.llm import fingerprints as fp
from tests.llm.helpers import HARD_TEXTS, documents, empty, prose, with_clashes


def test_span_equality_and_common_extension():
    chance = random.Random(3)
    text = "".join(chance.choice("ab") for _ in range(400)) * 2 + "😀é"
    h = fp.PrefixHashes(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    a = np.array([chance.randrange(len(text)) for _ in range(500)])
    b = np.array([chance.randrange(len(text)) for _ in range(500)])
    most = len(text) - np.maximum(a, b)
    found = h.common(a, b, most)
    for i, j, m, n in zip(a, b, most, found):
        k = 0
        while k < m and text[i + k] == text[j + k]:
            k += 1
        assert k == n
    length = np.minimum(most, 3)
    assert h.equal(a, b, length).tolist() == [text[i : i + n] == text[j : j + n] for i, j, n in zip(a, b, length)]


def by_hand(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (number, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        out.append((number, text, text[: len(text) - third] + after[:third]))
    return out


@pytest.mark.parametrize("bucket", [8 << 20, 2000])
def test_rows(spark, monkeypatch, bucket):
    monkeypatch.setattr(fp, "BUCKET", bucket)
    rows = [(i * 3, t) for i, t in enumerate(HARD_TEXTS)] + [(100 + i, prose(i // 2, 60)) for i in range(60)] + [(100, "tie"), (None, "no id"), (-5, "below")]
    found = fp.compare_with_next(with_clashes(documents(spark, rows), "fingerprint", "bucket")).collect()
    assert len(found) == len(rows)
    expected = sorted((str(n), len(t), hashlib.sha256(e.encode()).hexdigest()) for n, t, e in by_hand(rows))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in found) == expected
    names = {}
    for r, (n, t, e) in zip(sorted(found, key=lambda r: (str(r["doc_id"]), r["edited_sha256"])), sorted(by_hand(rows), key=lambda x: (str(x[0]), hashlib.sha256(x[2].encode()).hexdigest()))):
        assert names.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (t == e) == (r["near_edited"] == 1.0 and r["fingerprint"] == r["edited_fingerprint"])
    assert len(set(names.values())) == len(names)


def test_likeness_follows_the_edit(spark):
    rows = [(i, prose(i, 400)) for i in range(30)]
    for r in fp.compare_with_next(documents(spark, rows)).collect():
        assert 0.25 < r["near_edited"] < 0.95 and r["near_next"] < r["near_edited"]


def test_empty_and_single(spark):
    assert fp.compare_with_next(empty(spark)).count() == 0
    (one,) = fp.compare_with_next(documents(spark, [(1, "abcdef")])).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
