"""Versions as of an event: both forms against a scan by hand."""

import datetime as dt
import random

import pytest

from medstrata.operators.history import attributes_as_of
from tests.helpers import plan, rows

T = dt.datetime(2024, 1, 1)
EVENTS = "id int, k string, at timestamp"
HISTORY = "k string, color string, eff_start_ts timestamp, eff_end_ts timestamp"


def day(n):
    return None if n is None else T + dt.timedelta(days=n)


def by_hand(events, history):
    out = []
    for i, k, at in events:
        started = [h for h in history if h[0] == k and k is not None and at is not None and h[2] is not None and h[2] <= at]
        held = max(started, key=lambda h: (h[2], h[3] is None, h[3] or T, h[1] is not None, h[1] or ""), default=None)
        ok = held is not None and (held[3] is None or at < held[3])
        out.append((i, held[1] if ok else None, not ok))
    return sorted(out, key=repr)


def found(spark, events, history, **more):
    got = attributes_as_of(
        spark.createDataFrame(events, EVENTS), spark.createDataFrame(history, HISTORY), "k", "at", ["color"],
        missing_flag="missing", **more,
    )
    assert got.columns == ["id", "k", "at", "color", "missing"]
    return sorted(map(tuple, got.select("id", "color", "missing").collect()), key=repr)


@pytest.mark.parametrize("per", [None, "month", "day", "year"])
def test_open_ends_gaps_and_ties(spark, per):
    history = [
        ("a", "red", day(0), day(10)), ("a", "blue", day(10), day(20)), ("a", "green", day(30), None),  # a gap from 20 to 30
        ("b", "one", day(5), None), ("b", "two", day(5), day(9)),  # start together: the open one holds
        ("c", "x", day(1), day(1)), ("c", "y", day(1), day(1)),  # hold never
        ("d", "old", day(1), day(50)), ("d", "new", day(3), day(5)),  # overlap: the last start counts
        (None, "nobody", day(0), None), ("e", "never", None, None), ("f", None, day(0), None),
    ]
    events = [(i, k, day(n)) for i, (k, n) in enumerate(
        (k, n) for k in ("a", "b", "c", "d", "e", "f", "z", None) for n in (None, -1, 0, 1, 4, 5, 9, 10, 19, 20, 29, 30, 31, 400)
    )]
    assert found(spark, events, history, per=per) == by_hand(events, history)


@pytest.mark.parametrize("per", [None, "month", "week"])
def test_random_histories(spark, per):
    chance = random.Random(7)
    history = []
    for k in range(12):
        at = chance.randint(0, 40)
        for v in range(chance.randint(1, 30)):
            end = at + chance.randint(1, 30)
            history.append((f"k{k}", f"c{v}", day(at), day(end) if chance.random() < 0.8 else None))
            at = end + chance.choice((0, 0, 5))
    events = [(i, "k1" if i % 3 == 0 else f"k{chance.randint(0, 14)}", day(chance.randint(-5, 500))) for i in range(800)]
    assert found(spark, events, history, per=per) == by_hand(events, history)


def test_no_end_column_and_empty_sides(spark):
    history = spark.createDataFrame([("a", "red", day(0)), ("a", "blue", day(3))], "k2 string, color string, since timestamp")
    events = spark.createDataFrame([(1, "a", day(2)), (2, "a", day(9)), (2, "a", day(9))], EVENTS)
    for per in (None, "day"):
        asked = {"history_key": "k2", "start": "since", "end": None, "per": per}
        got = attributes_as_of(events, history, "k", "at", ["color"], **asked)
        assert rows(got, "id", "color") == {(1, "red"): 1, (2, "blue"): 2}
        assert rows(attributes_as_of(events, history.limit(0), "k", "at", ["color"], **asked), "id", "color") == {(1, None): 1, (2, None): 2}
        assert attributes_as_of(events.limit(0), history, "k", "at", ["color"], **asked).count() == 0


def test_plans(spark):
    events = spark.createDataFrame([(1, "a", day(2))], EVENTS)
    history = spark.createDataFrame([("a", "red", day(0), None)], HISTORY)
    text = plan(attributes_as_of(events, history, "k", "at", ["color"], per="day"))
    assert "Join" not in text  # one sort for both sides
    assert "NestedLoop" not in plan(attributes_as_of(events, history, "k", "at", ["color"]))
