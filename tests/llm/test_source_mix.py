from collections import defaultdict

import pytest

from medstrata.llm.source_mix import mix, repeated, targets
from tests.llm.helpers import HARD_TEXTS, documents, empty, with_clashes


def level_by_hand(sizes, most=3):
    """Targets by handing the excess on until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, capped = {}, set()
    left = sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        share = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if share * weight[s] > most * sizes[s]]
        if not over:
            return target | {s: share * weight[s] for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            capped.add(s)


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10, "d": 1000, None: 1}, {"a": 1}, {"a": 0, "b": 5}, {"a": 0}, {"é": 3, "z": 4, "Z": 5, "中": 900, None: 7},
    {f"s{i}": (i * 37) % 101 for i in range(40)},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in targets(df).collect()}
    assert found == pytest.approx(level_by_hand(sizes))
    assert all(found[s] <= 3 * sizes[s] + 1e-9 for s in sizes)


def test_copies_follow_rate_and_repeat(spark):
    docs = documents(spark, [(i, "w " * (1 + i % 7), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(3000)])
    out, (size, source_size, target, copies) = mix(docs)
    rows = out.collect()
    assert len(rows) == 3000
    taken, wanted = defaultdict(int), {}
    for r in rows:
        assert r[copies] in (int(r[target] / r[source_size]), int(r[target] / r[source_size]) + 1) and r[copies] <= 3
        taken[r["source"]] += r[size] * r[copies]
        wanted[r["source"]] = r[target]
    for source, t in wanted.items():
        assert taken[source] == pytest.approx(t, rel=0.15)
    assert sorted(map(tuple, mix(docs)[0].collect())) == sorted(map(tuple, rows))
    given = repeated(out, copies)
    assert given.count() == sum(r[copies] for r in rows) and copies not in given.columns


def test_edge_cases(spark):
    docs = documents(spark, [(None, t, None, None) for t in HARD_TEXTS] + [(1, "a b", "en", "s"), (1, "a b", "en", "s")])
    out, (size, _, target, copies) = mix(with_clashes(docs, "size", "Copies", "target", "mix_source"))
    rows = out.collect()
    assert len(rows) == len(HARD_TEXTS) + 2 and {"size", "Copies", "target"} <= set(out.columns)
    assert [r[size] for r in rows if r["text"] in (None, "", " ", "\n\t ")] == [0] * 4
    assert len({r[copies] for r in rows if r["doc_id"] == 1}) == 1
    assert mix(empty(spark))[0].count() == 0
    blank, (_, _, target, copies) = mix(documents(spark, [(1, "", "en", "a"), (2, None, "en", "b")]))
    assert [(r[target], r[copies]) for r in blank.collect()] == [(0.0, 0), (0.0, 0)]
