"""Rates, shares, averages, rolling totals and top-k, by column name.

Every grouped aggregate here has a partial step in the map tasks, so a group that
holds a large share of the rows costs one partial row per task.  The two windows
run over already aggregated rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from medstrata.functions.measures import (
    exact_sum, mean, money, money_mean, ratio, rounded,
)

Groups = Mapping[str, Column]


def _grouped(df: DataFrame, groups: Groups):
    return df.groupBy(*[column.alias(name) for name, column in groups.items()])


def with_rate(counted: DataFrame, hits: str, total: str, rate: str, digits: int = 4) -> DataFrame:
    """Add the ratio of two counts."""
    return counted.withColumn(rate, F.round(ratio(F.col(hits), F.col(total)), digits))


def with_share(
    counted: DataFrame, outer: Sequence[str], count: str, share: str, digits: int = 4
) -> DataFrame:
    """Add the share of each counted group in its outer group.

    The window runs over counted groups: a partition holds one row per inner value,
    not one per input row.
    """
    whole = F.sum(count).over(Window.partitionBy(*outer))
    return counted.withColumn(share, F.round(ratio(F.col(count), whole), digits))


def mean_by(
    df: DataFrame, groups: Groups, value: str, count: str, average: str, digits: int = 2
) -> DataFrame:
    """Rows per group and the rounded mean of the values that are present."""
    return _grouped(df, groups).agg(
        F.count(F.lit(1)).alias(count),
        mean(F.sum(value), F.count(value), digits).alias(average),
    )


def money_mean_by(
    df: DataFrame, groups: Groups, amount: str, count: str, average: str, digits: int = 2
) -> DataFrame:
    """:func:`mean_by` for an amount, added exactly."""
    return _grouped(df, groups).agg(
        F.count(F.lit(1)).alias(count),
        money_mean(F.sum(money(amount)), F.count(amount), digits).alias(average),
    )


def daily_total(
    df: DataFrame, key: str, date: str, amount: str, day: str, total: str
) -> DataFrame:
    """Sum of ``amount`` per key and calendar day."""
    return _grouped(df, {key: F.col(key), day: F.col(date).cast("date")}).agg(
        exact_sum(amount).alias(total)
    )


def rolling_total(
    daily: DataFrame, key: str, day: str, amount: str, total: str, average: str, days: int = 7
) -> DataFrame:
    """Calendar rolling sum, and mean over the days that have a row.

    ``daily`` has one row per key and day, so a window partition holds at most as
    many rows as the calendar has days, however many facts its key has.
    """
    frame = (
        Window.partitionBy(key).orderBy(F.unix_date(day)).rangeBetween(1 - days, Window.currentRow)
    )
    exact = money(amount)
    summed = F.sum(exact).over(frame)
    return daily.select(
        "*",
        summed.cast("double").alias(total),
        money_mean(summed, F.count(exact).over(frame)).alias(average),
    )


def activity_span(
    df: DataFrame, key: str, instant: str, as_of: Column | None = None
) -> DataFrame:
    """First and last visit, count, span, class, mean gap and recency per key."""
    day = as_of if as_of is not None else F.current_date()
    bounds = df.groupBy(key).agg(
        F.min(instant).alias("first_visit_ts"),
        F.max(instant).alias("last_visit_ts"),
        F.count(F.lit(1)).alias("visit_count"),
    )
    span = F.datediff("last_visit_ts", "first_visit_ts")
    several = F.col("visit_count") > 1
    return bounds.select(
        key,
        "first_visit_ts",
        "last_visit_ts",
        span.alias("lifetime_days"),
        "visit_count",
        F.when(F.col("visit_count") == 1, "new").otherwise("returning").alias("classification"),
        F.when(several, F.round(ratio(span, F.col("visit_count") - 1), 2)).alias(
            "avg_days_between_visits"
        ),
        F.datediff(day, F.col("last_visit_ts").cast("date")).alias("days_since_last_visit"),
    )


def top_rows(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows by ``order``, which should end in a unique column."""
    return df.orderBy(*order).limit(k)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded(ratio(part * F.lit(100), whole), digits)


def side_by_side(**single_rows: DataFrame) -> DataFrame:
    """One row from several one-row, one-number results, without a cross join."""
    frames = [
        df.select(F.lit(name).alias("_name"), F.col(df.columns[0]).cast("long").alias("_value"))
        for name, df in single_rows.items()
    ]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame)
    return merged.agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_value"))).alias(name) for name in single_rows]
    )
