"""Parsing, masking, predicates and arithmetic on awkward values."""

import datetime as dt

from pyspark.sql import functions as F

from medstrata.functions.masking import birth_year, masked
from medstrata.functions.measures import exact_sum, mean, ratio, rounded, unfit
from medstrata.functions.parsing import date_of, instant_of, local_time, text_map, zone_provenance
from medstrata.functions.predicates import differs, not_blank, or_unknown


def values(spark, texts, *columns):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_dates_that_cannot_be_read_are_null(spark):
    texts = ["2025-02-28", "2025-02-30", "", "nope", None]
    got = values(spark, texts, date_of("x"), date_of("x", "yyyy-MM-dd"))
    day = dt.date(2025, 2, 28)
    assert got == [(day, day)] + [(None, None)] * 4


def test_instants_honour_the_written_offset(spark):
    texts = ["2025-07-01T10:00:00Z", "2025-07-01T10:00:00-04:00", "2025-07-01T10:00:00+0400",
             "2025-07-01T10:00:00", "2025-07-01", "abc", None]
    got = [r[0] for r in values(spark, texts, instant_of("x").cast("string"))]
    assert got == ["2025-07-01 10:00:00", "2025-07-01 14:00:00", "2025-07-01 06:00:00",
                   "2025-07-01 10:00:00", "2025-07-01 00:00:00", None, None]


def test_instant_with_pattern(spark):
    got = [r[0] for r in values(spark, ["2025-07-01", "01.07.2025"],
                                instant_of("x", "yyyy-MM-dd").cast("string"))]
    assert got == ["2025-07-01 00:00:00", None]


def test_zone_provenance(spark):
    texts = ["2025-07-01T10:00:00Z", "2025-07-01T10:00:00.5-04:00", "2025-07-01T10:00:00+04",
             "2025-07-01T10:00+0400", "2025-07-01T10:00:00", "2025-07-01", None]
    got = values(spark, texts, zone_provenance("x"))
    assert [g[0] for g in got] == ["offset"] * 4 + ["naive"] * 3


def test_local_time_follows_daylight_saving(spark):
    texts = ["2025-01-01T12:00:00Z", "2025-07-01T12:00:00Z"]
    got = values(spark, texts, local_time(instant_of("x"), "America/New_York").cast("string"))
    assert got == [("2025-01-01 07:00:00",), ("2025-07-01 08:00:00",)]


def test_text_map(spark):
    got = values(spark, ['{"a": 1, "b": {"c": "d"}}', "{}", "not json", None], text_map("x"))
    assert got[0][0] == {"a": "1", "b": '{"c":"d"}'}
    assert got[1][0] == {} and got[3][0] is None
    assert not got[2][0]


def test_masking_keeps_names_and_drops_values(spark):
    df = spark.createDataFrame([("Ann", "1980-02-03"), ("Bob", "x")], "FIRST string, BORN string")
    got = df.select(*masked(["FIRST"]), birth_year("BORN").alias("year"))
    assert got.columns == ["first", "year"]
    assert dict(got.dtypes)["first"] == "string"
    assert [tuple(r) for r in got.collect()] == [(None, 1980), (None, None)]


def test_predicates(spark):
    got = values(spark, [" ", "", None, "a"], not_blank("x"), or_unknown("x"))
    assert got == [(False, " "), (False, ""), (False, "Unknown"), (True, "a")]
    df = spark.createDataFrame(
        [("a", "a"), ("a", "b"), (None, None), (None, "a"), ("a", None)], "l string, r string"
    )
    changed = df.select(differs([F.col("l")], [F.col("r")])).collect()
    assert [r[0] for r in changed] == [False, True, False, True, True]


def test_money_is_added_exactly_in_any_order(spark):
    amounts = [0.1] * 10 + [1e10, -1e10]
    for order in (amounts, amounts[::-1]):
        df = spark.createDataFrame([(a,) for a in order], "a double").repartition(4)
        assert df.agg(exact_sum("a")).first()[0] == 1.0


def test_ratio_and_rounding(spark):
    df = spark.createDataFrame([(1, 0), (1, 8), (None, 2)], "a int, b int")
    got = df.select(ratio(F.col("a"), F.col("b")), rounded(ratio(F.col("a"), F.col("b")), 2)).collect()
    assert [tuple(r) for r in got] == [(None, None), (0.125, 0.13), (None, None)]
    assert spark.range(0).agg(mean(F.sum("id"), F.count("id"), 2)).first()[0] is None


def test_money_keeps_fractions_of_a_cent_and_survives_huge_amounts(spark):
    df = spark.createDataFrame([(0.004,)] * 1000 + [(1e25,), (None,)], "a double")
    assert tuple(df.agg(exact_sum("a"), unfit("a")).first()) == (4.0, 1)
    assert spark.createDataFrame([(1e17,), (0.5,)], "a double").agg(exact_sum("a")).first()[0] == 1e17 + 0.5
