import math
import random

import numpy as np
import pytest

from medstrata.llm import hard_negatives
from medstrata.llm.hard_negatives import Bucket, mine, op12_query
from tests.helpers import plan
from tests.llm.helpers import with_clashes

VECTORS = "vec_id long, embedding array<double>, label int"


def by_hand(rows, every=100):
    kept = [
        (i, [math.floor(256 * x) for x in v], l) for i, v, l in rows
        if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v)
    ]
    out = []
    for i, v, l in kept:
        if i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in kept if j != i))
        for p, j, _ in [s for s in scored if s[2] == l][:5]:
            negatives = [(n, k) for n, k, m in scored if m != l and 80 * -p <= 100 * -n <= 100 * -p][:5]
            out += [(i, j, rank, k, -p, -n) for rank, (n, k) in enumerate(negatives, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, VECTORS)


def mined(spark, rows):
    return sorted(map(tuple, mine(table(spark, rows)).collect()))


def clustered(seed, count, dims, labels, spread=0.3, scale=1.0):
    chance = np.random.default_rng(seed)
    centres = chance.standard_normal((6, dims))
    out = []
    for i in range(count):
        v = centres[chance.integers(6)] + spread * chance.standard_normal(dims)
        out.append((i, [float(x) for x in v * scale * chance.uniform(0.2, 3)], int(chance.integers(labels))))
    return out


@pytest.mark.parametrize("rows", [clustered(1, 1500, 12, 3), clustered(2, 900, 5, 1) + [(5000 + i, [1.0] * 5, 1) for i in range(300)], clustered(3, 700, 3, 200)])
def test_equals_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(hard_negatives, "BUCKET_BYTES", 4096)
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", 256)
    found = mined(spark, rows)
    assert found == by_hand(rows) and found


def test_candidates_leave_no_row_out():
    chance = np.random.default_rng(5)
    vectors = np.floor(chance.standard_normal((800, 16)) * chance.uniform(1, 90, (800, 1)) * (np.arange(16) < 4))
    ids = np.arange(800)
    bucket = Bucket(float(np.sqrt((vectors**2).sum(1)).max()), 800, 16, ids.tobytes(), vectors.astype(np.float32).tobytes())
    pruned = 0
    for anchor in vectors[::13]:
        scores = vectors @ anchor
        for floor in np.quantile(scores, [0.5, 0.9, 0.99, 1.0]):
            rows = bucket.candidates(anchor, float(floor))
            if rows is not None:
                assert set(np.flatnonzero(scores >= floor)) <= set(rows.tolist())
                pruned += len(rows) < 400
    assert pruned > 20
    assert len(bucket.candidates(vectors[0], 1e12)) == 0


def test_edge_cases(spark):
    chance = random.Random(4)
    some = lambda dims: [chance.uniform(-1, 1) for _ in range(dims)]
    rows = [(i, some(4), i % 3) for i in range(60)] + [
        (100, some(4), 0), (100, some(4), 1), (200, None, 1), (300, some(4), None), (None, some(4), 1), (400, [0.1, None, 0.2, 0.3], 1),
        (500, [float("nan")] * 4, 1), (600, [float("inf")] * 4, 1), (700, [], 2), (800, [0.0] * 4, 2), (900, some(7), 0), (901, some(2), 0),
        (1000, [1e300] * 4, 0), (1001, [1e308, 1.0, 1.0, 1.0], 0), (7, some(4), 2), (7, some(4), 0),
    ]
    rows += [rows[3]] * 7  # repeated rows
    expected = [(a, p, r, n, *(max(-(2**63) + 1, min(2**63 - 1, s)) for s in scores)) for a, p, r, n, *scores in by_hand(rows) if a != 1000]
    found = mine(with_clashes(table(spark, rows), "top", "ids", "other", "number", "rank"))
    assert sorted(r for r in map(tuple, found.collect()) if r[0] != 1000) == sorted(expected)
    assert mined(spark, []) == [] and mined(spark, [(0, [1.0], 1)]) == []


def test_exact_beyond_doubles(spark):
    rows = [(0, [float(2**40 + 1), 3.0], 0), (1, [float(2**40 + 3), 1.0], 0), (2, [float(2**40 + 3), 1.0 - 2**-7], 1), (3, [float(2**40 - 5), 9.0], 1)]
    rows = [(i, [x / 256 / 2**14 for x in v], l) for i, v, l in rows] + [(4, [2.0**23 + 1, 1.0], 1), (5, [2.0**23 + 3, 2.0], 0), (100, [2.0**23 - 1, 5.0], 0)]
    assert mined(spark, rows) == by_hand(rows)


def test_query_flips_labels(spark):
    rows = clustered(8, 420, 6, 10)
    flipped = [(i, v, (l + 1) % 10 if i % 7 == 0 else l) for i, v, l in rows]
    found = op12_query(table(spark, rows))
    assert sorted(map(tuple, found.collect())) == by_hand(flipped)
    assert "CartesianProduct" not in plan(found) and "BroadcastNestedLoopJoin" not in plan(found)
