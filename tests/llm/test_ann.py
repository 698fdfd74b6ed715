import numpy as np
import pytest

from medstrata.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, x, ids=None):
    return spark.createDataFrame([(int(i), [None if c is None else float(c) for c in v] if v is not None else None, 0) for i, v in zip(ids if ids is not None else range(len(x)), x)], SCHEMA)


def brute(x, ids, q, k=10):
    """Ids and distances of the k nearest, ties by id; the query's own id is left out."""
    x = np.array(x, np.float32).astype(float)
    d = np.sqrt(((x - x[list(ids).index(q)]) ** 2).sum(1))
    return [(int(ids[i]), d[i]) for i in np.lexsort((ids, d)) if ids[i] != q][:k]


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("spread", [0.1, 1.0])
def test_recall_and_exact_scores(spark, spread, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 40)  # lists are split
    chance = np.random.default_rng(2)
    x = chance.standard_normal((30, 48))[chance.integers(0, 30, 3000)] + spread * chance.standard_normal((3000, 48))
    found = by_query(ann.op2_query(table(spark, x)))
    assert sorted(found) == list(range(0, 3000, 100))
    hits = 0
    for q, near in found.items():
        truth = brute(x, np.arange(3000), q)
        assert len(near) == 10 and near == sorted(near, key=lambda n: (n[1], n[0]))
        every = dict(brute(x, np.arange(3000), q, 3000))
        assert all(s == pytest.approx(every[i], abs=1e-12) for i, s in near)
        hits += len({i for i, _ in truth} & {i for i, _ in near})
    assert hits / (10 * len(found)) >= 0.9


def test_few_rows_and_ties(spark):
    x = [[1.0, 0.0]] * 40 + [[0.0, 1.0]] * 3
    ids = [*range(100, 140), 0, 200, 300]
    found = by_query(ann.op2_query(table(spark, x, ids)))
    assert [i for i, _ in found[100]] == list(range(101, 111)) and {s for _, s in found[100]} == {0.0}
    assert [i for i, _ in found[0]] == [200, 300, *range(100, 108)]
    few = by_query(ann.op2_query(table(spark, [[1.0, 2.0], [3.0, 4.0], [1.0, 2.0]], [0, 5, 7])))
    assert [i for i, _ in few[0]] == [7, 5]


def test_unusable_rows(spark):
    x = [[1.0, 2.0], None, [0.0, 0.0], [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0], [], [2.0, 2.0], [1.0, 2.0, 3.0], [1.0, 1.0]]
    found = by_query(ann.op2_query(table(spark, x, [0, 100, 200, 300, 400, 500, 600, 7, 800, 9]).unionByName(table(spark, [[2.0, 2.0]], [7]))))
    assert {q: [i for i, _ in near] for q, near in found.items()} == {0: [7, 9]}
    assert ann.op2_query(table(spark, [])).count() == 0
    assert ann.op2_query(table(spark, [[0.0]], [0])).count() == 0
