"""Left-join enrichment with missing-reference flags, and orphan counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def left_enrich(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    add: Sequence[str],
    missing_flag: str | None = None,
) -> DataFrame:
    """Keep every fact row, add ``add`` from the dimension row with the same key.

    The dimension must be unique by key.  The planner broadcasts it when its
    measured size is below ``spark.sql.autoBroadcastJoinThreshold``; beyond that it
    is a shuffled join whose oversized fact partitions are split at run time (a
    left join may split its left side), so a hot key does not end in one task.
    """
    marker = "_dimension_key"
    side = dimension.select(F.col(dimension_key).alias(marker), *add)
    joined = fact.join(side, fact[fact_key] == side[marker], "left")
    if missing_flag:
        joined = joined.withColumn(missing_flag, F.col(marker).isNull())
    return joined.drop(marker)


def measure_by_key(
    fact: DataFrame,
    keys: Sequence[str | Column],
    measures: Mapping[str, Column],
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    add: Sequence[str],
    missing_flag: str | None = None,
) -> DataFrame:
    """Aggregate facts per key first, then add the dimension columns to the groups.

    For reports over enriched facts: the join sees one row per key instead of one
    per fact, so it is small and has no hot key.  ``keys`` must contain
    ``fact_key``; a second aggregation over the added columns completes the report.
    """
    grouped = fact.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])
    return left_enrich(grouped, dimension, fact_key, dimension_key, add, missing_flag)


def join_coverage(
    fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str
) -> DataFrame:
    """One row: size of the left join of two raw tables, and how much of it matched.

    Raw tables may repeat a key on both sides, so the join is sized from the number
    of rows per key; no pairs are produced.
    """
    left = fact.groupBy(F.col(fact_key).alias("_fact_key")).agg(F.count(F.lit(1)).alias("_facts"))
    right = dimension.groupBy(F.col(dimension_key).alias("_dimension_key")).agg(
        F.count(F.lit(1)).alias("_matches")
    )
    pairs = left.join(right, left["_fact_key"] == right["_dimension_key"], "left")
    return pairs.agg(
        F.sum(F.col("_facts") * F.coalesce("_matches", F.lit(1))).alias("joined_rows"),
        F.sum(F.col("_facts") * F.coalesce("_matches", F.lit(0))).alias("matched_rows"),
    )


def count_orphans(
    fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, name: str
) -> DataFrame:
    """One row: how many fact rows have no dimension row (NULL keys included).

    Facts are counted per key first, with partial counts in the map tasks, so the
    anti join exchanges one row per key and a hot key weighs nothing.
    """
    keys = dimension.select(F.col(dimension_key).alias("_dimension_key"))
    counted = fact.groupBy(F.col(fact_key).alias("_fact_key")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    orphans = counted.join(keys, counted["_fact_key"] == keys["_dimension_key"], "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias(name))


def count_missing(
    fact: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]
) -> DataFrame:
    """One row of orphan counts: output name -> (fact key, dimension, dimension key)."""
    counts = [
        count_orphans(fact, dimension, fact_key, dimension_key, "_rows").select(
            F.lit(name).alias("_name"), "_rows"
        )
        for name, (fact_key, dimension, dimension_key) in references.items()
    ]
    return reduce(DataFrame.unionByName, counts).agg(
        *[
            F.sum(F.when(F.col("_name") == name, F.col("_rows"))).alias(name)
            for name in references
        ]
    )


def refresh_missing(
    enriched: DataFrame,
    dimension: DataFrame,
    key: str,
    dimension_key: str,
    add: Sequence[str],
    missing_flag: str,
) -> DataFrame:
    """Rows flagged missing whose dimension row has arrived since, re-enriched."""
    waiting = enriched.filter(F.col(missing_flag)).drop(*add, missing_flag)
    found = left_enrich(waiting, dimension, key, dimension_key, add, missing_flag)
    return found.filter(~F.col(missing_flag)).select(*enriched.columns)
