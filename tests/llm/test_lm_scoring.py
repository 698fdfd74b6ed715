import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from medstrata.llm import context_mix as cm, lm_scoring as lm
from medstrata.session import shared_dir
from medstrata.sources import folders
from tests.llm.helpers import HARD_TEXTS, documents, empty, prose, with_clashes


def trained(units, times):
    data = np.frombuffer(b"".join(units), np.uint8)
    starts = np.cumsum([0, *map(len, units)])[:-1]
    tables = cm.empty_counts()
    cm.count(data, starts, np.array(times), tables, 1)
    learned = cm.Learned.begin()
    learned.learn(data, starts, np.array(times), tables, 1)
    return cm.Model(tables, learned)


def scores(model, units):
    return model.score(np.frombuffer(b"".join(units), np.uint8), np.cumsum([0, *map(len, units)])[:-1], 1)


def test_bytes_are_a_distribution():
    units = [b"\x01" + w.encode() + b" " for w in prose(1, 400).split()]
    model = trained(units, [1] * len(units))
    for known in (b"\x01", b"\x01t", b"\x01the", b"\x02zz", b"\x01" + b"q" * 40):
        whole = 10 ** scores(model, [known])[0]
        parts = 10 ** scores(model, [known + bytes([b]) for b in range(256)])
        assert parts.sum() == pytest.approx(whole, rel=1e-5)


def test_counts_add_up_in_any_order():
    units = [b"\x01" + w.encode() + b" " for w in prose(2, 200).split()]
    a, b, c = cm.empty_counts(), cm.empty_counts(), cm.empty_counts()
    join = lambda u: (np.frombuffer(b"".join(u), np.uint8), np.cumsum([0, *map(len, u)])[:-1])
    cm.count(*join(units), np.ones(len(units)), a, 1)
    cm.count(*join(units[100:]), np.ones(100), b, 1)
    cm.count(*join(units[:100]), np.ones(100), b, 1)
    cm.count(*join(sorted(set(units))), np.array([units.count(u) for u in sorted(set(units))]), c, 1)
    assert all((x == y).all() and (x == z).all() for x, y, z in zip(a, b, c))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\x00end"]


def is_held(number):
    return zlib.crc32(("" if number is None else str(number)).encode()) % 7 == 2


def by_hand(rows):
    seen = Counter(w for n, t in rows if not is_held(n) for w in words(t))
    tokens = sum(seen.values())
    whole = tokens + len(seen) + 1
    return [(n, is_held(n), len(words(t)), sum(seen[w] > 0 for w in words(t)), tokens, sum(math.log10((seen[w] + 1) / whole) for w in words(t))) for n, t in rows]


def corpus():
    rows = [(i, prose(i % 5, 80 + i % 40, 60)) for i in range(250)]
    return rows + [(1000 + i, t) for i, t in enumerate(HARD_TEXTS)] + [(None, "Two  words\n"), (7, rows[7][1]), (7, rows[7][1])]


@pytest.mark.parametrize("block", [8 << 20, 4000])
def test_base_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK", block)
    rows = corpus()
    found = lm.score(with_clashes(documents(spark, rows), "score", "block", "n")).collect()
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    for ours, theirs in zip(sorted(map(tuple, found), key=key), sorted(by_hand(rows), key=key), strict=True):
        assert ours[:5] == theirs[:5] and ours[5] == pytest.approx(theirs[5], rel=1e-9)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)
    assert len({round(r["score"], 6) for r in found if r["doc_id"] == 7}) == 1
    assert {r["bits_per_byte"] for r in found if not r["n_bytes"]} == {None}
    held = [r for r in found if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 250]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert sum(r["score"] for r in held) > -sum(r["n_bytes"] for r in held) * math.log10(256) / 2


def test_held_out_texts_are_not_learned(spark):
    rows = corpus()
    changed = [(n, "entirely other words " * 30 if is_held(n) else t) for n, t in rows]
    one, two = ({(r["doc_id"], r["n_bytes"]): (r["score"], r["base_score"], r["train_tokens"]) for r in lm.score(documents(spark, x)).collect() if not r["held_out"]} for x in (rows, changed))
    assert one.keys() == two.keys()
    for k in one:
        assert one[k] == pytest.approx(two[k], rel=1e-6)


def test_likely_texts_score_higher(spark):
    held = [n for n in range(10_000, 10_200) if is_held(n)][:2]
    rows = [*corpus(), (held[0], prose(1, 100, 60)), (held[1], " ".join(reversed(prose(1, 100, 60)[::-1].upper().split())))]
    found = {r["doc_id"]: r["bits_per_byte"] for r in lm.score(documents(spark, rows)).collect()}
    assert found[held[0]] < found[held[1]] / 2


def test_edges(spark):
    assert lm.score(empty(spark)).count() == 0
    only_held = [n for n in range(100) if is_held(n)][:3]
    found = lm.score(documents(spark, [(n, "a b") for n in only_held])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found] == [(3, 0, 0, 0.0)] * 3
    blank = lm.score(documents(spark, [(n, None) for n in range(3) if not is_held(n)])).collect()
    assert all(r["n_tokens"] == r["n_known"] == 1 and math.isfinite(r["score"]) for r in blank)


def test_order_of_words_counts(spark):
    """Words of a text in another order, within its only line, make it less likely; so does breaking up a passage that it repeats."""
    chance = random.Random(3)
    follows = {w: chance.choices(range(60), k=3) for w in range(60)}

    def ordered(count):
        at, out = chance.randrange(60), []
        for _ in range(count):
            out.append(f"w{at}")
            at = chance.choice(follows[at])
        return out

    def mixed(some):
        return chance.sample(some[:-1], len(some) - 1) + some[-1:]

    held = [n for n in range(10_000, 10_200) if is_held(n)][:12]
    straight = [ordered(120) for _ in range(4)]
    fresh = [f"n{chance.randrange(10**6)}" for _ in range(30)]
    texts = [*straight, *map(mixed, straight), fresh * 4, sum((mixed(fresh + ["n"])[:30] for _ in range(4)), [])]
    rows = [(i, " ".join(ordered(100))) for i in range(300)] + [(n, " ".join(t)) for n, t in zip(held, texts)]
    found = {r["doc_id"]: r["score"] for r in lm.score(documents(spark, rows)).collect()}
    for a, b in zip(held[:4], held[4:8]):
        assert found[a] > found[b] + 20
    assert found[held[8]] > found[held[9]] + 10


def test_units_after_a_unit_are_a_distribution():
    """What pairs are given and what is left for units by themselves add up to 1."""
    counts = np.array([1, 1, 2, 5])
    less = lm.discount(2, 1)
    assert (np.maximum(counts - less, 0).sum() + less * len(counts)) / counts.sum() == pytest.approx(1)
    assert (lm._earlier(np.array([3, 1, 3, 3, 1])) == [0, 0, 1, 2, 1]).all()


def test_rounds_and_what_stays_on_disk(spark, monkeypatch):
    docs = documents(spark, [(i, prose(i, 300)) for i in range(40)]).repartition(6, "doc_id")
    there = lambda: set(folders.matching(spark, f"{shared_dir(spark)}/lm-*"))
    before, columns = there(), ["doc_id", "n_tokens", "n_known", "base_score", "score"]
    once = [tuple(r) for r in lm.score(docs).select(columns).orderBy("doc_id").collect()]
    monkeypatch.setattr(lm, "ROUND_BYTES", 1)
    made = lm.score(docs).select(columns).orderBy("doc_id")
    left = {f.rpartition("/")[2].rpartition("-")[0] for f in there() - before}
    assert left <= {"lm-scores"}  # no working table is kept beside the result
    assert [tuple(r) for r in made.collect()] == [tuple(pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for v in r) for r in once]


def test_packed_sequences():
    numbers = np.random.default_rng(1).zipf(1.5, 20_000).clip(0, 1 << 30).astype(np.int64)
    for some in (numbers, numbers[:1], numbers[:0]):
        assert (lm.unpacked(lm.packed(some), len(some)) == some).all()
    assert len(lm.packed(numbers)) < 1.5 * len(numbers)


def test_like_places_are_looked_at_once():
    units = [b"\x81\x02" + w + e for w in (b"", b"there", b"therefore", b"The", b"x" * 40) for e in (b" ", b"\n", b"\xff")]
    join = lambda u: (np.frombuffer(b"".join(u), np.uint8), np.cumsum([0, *map(len, u)])[:-1])
    (some,) = cm.chunks(*join(units * 3), 2)
    deep = {(u[max(0, i - cm.DEEP) : i], i < cm.DEEP, u[i]) for u in units for i in range(2, len(u))}
    assert len(some.data) == len(deep) < len(some.unit) == 3 * sum(len(u) - 2 for u in units)
    tables, learned = cm.empty_counts(), cm.Learned.begin()
    cm.count(*join(units), np.arange(1, len(units) + 1), tables, 2)
    learned.learn(*join(units), np.arange(1, len(units) + 1), tables, 2)
    model = cm.Model(tables, learned)
    assert model.score(*join(units * 3), 2) == pytest.approx([model.score(*join([u]), 2)[0] for u in units] * 3, rel=1e-5)


def test_parts_of_units(spark, monkeypatch):
    """Units go to parts and back in a row for each block and part; spellings of a word meet in one part."""
    spelled = [b"word ", b"Word\n", b"WORD\xff", b" ", b"\n", b"\xff"]
    names = lm.names_of(np.frombuffer(b"".join(spelled), np.uint8), np.array([len(u) for u in spelled]))
    assert len(set(names.tolist())) == 6
    assert all(len(set(some.tolist())) == 1 for some in np.split(lm.parts_of(names, 1009), 2))
    sent, unit_counts = [], lm.unit_counts
    monkeypatch.setattr(lm, "unit_counts", lambda blocks, parts: sent.append((blocks.count(), parts, unit_counts(blocks, parts).count())) or unit_counts(blocks, parts))
    rows, columns = corpus(), ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    monkeypatch.setattr(lm, "BLOCK", 20_000)
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    once = sorted(map(tuple, lm.score(documents(spark, rows)).select(columns).collect()), key=key)
    monkeypatch.setattr(lm, "PART_BYTES", 15_000)
    many = sorted(map(tuple, lm.score(documents(spark, rows)).select(columns).collect()), key=key)
    assert sent[0][1] == 1 < sent[1][1] and all(n == blocks * parts + parts for blocks, parts, n in sent)
    assert [r[:5] for r in many] == [r[:5] for r in once]
    assert [r[5] for r in many] == pytest.approx([r[5] for r in once], rel=1e-9)
    assert [r[6] for r in many] == pytest.approx([r[6] for r in once], rel=0.05)  # weights are averaged over parts
