import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from medstrata.llm import ngram_join as nj
from medstrata.llm.components import components
from tests.llm.helpers import HARD_TEXTS, documents, empty, prose, with_clashes


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 0))} or ({tuple(words)} if words else set())


def brute(rows, width, share, whole):
    """Size of each set, and the smallest id that links lead to."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and both * whole >= share * (len(sets[i]) + len(sets[j]) - both):
            parent[top(i)] = top(j)
    least = {}
    for i, (number, _) in enumerate(rows):
        if number is not None:
            least[top(i)] = min(number, least.get(top(i), number))
    return sorted(((n, len(s), least.get(top(i))) for i, ((n, _), s) in enumerate(zip(rows, sets))), key=repr)


def edited(text, share, seed):
    chance, words = random.Random(seed), text.split()
    return " ".join(w if chance.random() > share else f"new{chance.randrange(10**6)}" for w in words)


def family(seed, words, copies):
    """A text, near copies of growing distance, and copies of copies."""
    base = prose(seed, words)
    out = [base]
    for i in range(copies):
        out.append(edited(random.Random(i).choice(out) if i % 3 == 0 else base, i / copies * 0.12, seed * 1000 + i))
    return out


@pytest.mark.parametrize("width, threshold", [(3, (90, 100)), (5, (80, 100)), (2, (1, 2))])
def test_against_all_pairs(spark, monkeypatch, width, threshold):
    monkeypatch.setattr(nj, "BLOCK_ROWS", 8)  # groups are cut into blocks
    texts = [t for seed, size in enumerate((4, 9, 15, 30, 60, 200, 700)) for t in family(seed, size, 25)]
    texts += [*HARD_TEXTS, "A b", "a B", prose(0, 4).upper(), "one two", "Two", "two"]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, texts[3]), (None, "alone with no id at all"), (5000, texts[40]), (5000, texts[40])]
    docs = with_clashes(documents(spark, rows), "node", "component_id", "n_shingles")
    found = sorted(map(tuple, nj.join(docs, width=width, threshold=threshold).collect()), key=repr)
    assert found == brute(rows, width, *threshold)


def test_similar_sets_share_a_signature():
    chance = np.random.default_rng(4)
    for share, whole in ((90, 100), (80, 100), (1, 2)):
        bands = nj.Bands(share, whole)
        for size in [*range(1, 60), 100, 333, 1000]:
            for _ in range(8):
                a = chance.choice(2**60, size, replace=False).astype(np.uint64)
                for gone in range(0, size):  # the farthest set that is still similar
                    if (size - gone - 1) * whole < share * size:
                        break
                kept = a[: size - gone]
                added = 0
                while len(kept) * whole >= share * (size + added + 1) and chance.random() < 0.7:
                    added += 1
                b = np.unique(np.append(kept, chance.choice(2**60, added).astype(np.uint64)))
                if len(b) and set(a.tolist()) != set(b.tolist()):
                    assert np.intersect1d(nj.signatures(np.unique(a), bands), nj.signatures(b, bands)).size


def test_one_of_each_stays(spark):
    base = prose(9, 80, 10_000)
    rows = [(4, base), (2, base.replace(base.split()[40], "changed", 1)), (9, base), (1, prose(10, 80)), (None, base), (3, ""), (5, None), (6, "")]
    kept = nj.without_copies(documents(spark, rows)).collect()
    assert sorted((str(r["doc_id"]) for r in kept)) == ["1", "2", "3", "5", "6"]
    assert nj.without_copies(empty(spark)).count() == 0 and nj.join(empty(spark)).count() == 0


def test_rows_are_decided_each(spark):
    one, other, third, bare = (prose(seed, 80, 10_000) for seed in (21, 22, 23, 24))
    near = lambda t: t.replace(t.split()[40], "changed", 1)
    rows = [(5, one), (5, near(other)), (2, other), (9, near(one)), (7, third, "en", "a"), (7, third, "en", "b"), (7, third, "en", "a"), (None, bare), (None, bare), (None, near(bare)), (3, ""), (3, ""), (4, None)]
    docs = with_clashes(documents(spark, rows), "its_id", "turn", "stays", "node")
    kept = nj.without_copies(docs)
    assert kept.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    texts = [t for n, t in found if n is None]
    assert len(texts) == 1 and texts[0] in (bare, near(bare))
    assert [r for r in found if r[0] is not None] == sorted([(5, one), (2, other), (7, third), (3, ""), (3, ""), (4, None)], key=repr)


def test_no_rows_for_pairs_in_a_large_group(spark):
    """A group of many near copies gives a row for each member, not for each pair."""
    base = prose(11, 120)
    docs = documents(spark, [(i, edited(base, 0.1, i)) for i in range(400)])
    share, whole = 80, 100
    sets = [nj.shingle_sets(pa.array([r["text"]]), 5)[0] for r in docs.collect()]
    label = nj.similar_groups(sets, share, whole)
    assert len(label) == 400
    found = {r["doc_id"]: r["component_id"] for r in nj.join(docs).collect()}
    assert found == {i: int(label[i]) for i in range(400)}


def test_components(spark):
    chance = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 140)] + [(chance.randrange(60), chance.randrange(60)) for _ in range(40)] + [(500, 500 + i) for i in range(1, 50)]
    links = spark.createDataFrame(edges, "a long, b long")
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    found = {r["node"]: r["label"] for r in components(links).collect()}
    assert found == {x: top(x) for a, b in edges if a != b for x in (a, b)}
    assert components(links.limit(0)).count() == 0


def test_the_sieve_lets_every_link_pass():
    chance = np.random.default_rng(8)
    for share, whole in ((90, 100), (80, 100), (1, 2)):
        bands, sets = nj.Bands(share, whole), []
        for size in (3, 8, 20, 60, 300, 301):
            base = chance.choice(2**60, size, replace=False).astype(np.uint64)
            for gone in (0, 1, 2, size // 20, size // 10, size // 5, size // 2):
                sets.append(np.unique(np.append(base[gone:], chance.choice(2**60, gone // 2).astype(np.uint64))))
        band = bands.bands[bands.of(max(map(len, sets)))]  # any band tells as many bits at most
        made = nj.Candidates([len(x) for x in sets], [nj.sketch(x, band) for x in sets], share, whole)
        left, right = np.triu_indices(len(sets), 1)
        may = made.pairs(left, right)
        linked = np.array([(both := np.intersect1d(sets[i], sets[j]).size) * whole >= share * (len(sets[i]) + len(sets[j]) - both) and both > 0 for i, j in zip(left, right)])
        assert may[linked].all() and linked.sum() > 10 and may.sum() < 3 * linked.sum() + 30
        label = made.connected(0, len(sets))
        assert (label[left[may]] == label[right[may]]).all()
        a, b = nj.sieved([len(sets)], made)
        assert len(a) == len(sets) - len(set(label.tolist()))


def test_work_on_near_copies_follows_their_number(spark, monkeypatch):
    """Copies that link to their hub are sent to no block: a row for each, whatever the group's size."""
    seated = []
    real = nj._seated
    monkeypatch.setattr(nj, "_seated", lambda members: seated.append(members.count()) or real(members))
    base = prose(12, 150, 10_000)
    words = base.split()
    near = lambda i: " ".join([*words[: i % 150], f"new{i}", *words[i % 150 + 1 :]])
    found = nj.join(documents(spark, [(i, near(i)) for i in range(1, 3000)] + [(0, base)])).collect()
    assert {r["component_id"] for r in found} == {0} and seated == [0]
