"""Mixing sources to target weights, in native expressions only.

Words are added up per source, a source's repetition rate is its target over its size,
and a document is given out floor(rate) times, plus once more with a probability equal
to the fraction, decided by a seeded hash of its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from medstrata.llm.common import WORD, column, fresh, written

MOST = 3  #: A source is repeated at most so many times.
WEIGHTS = 3  #: Sources weigh 1, 2, 3, repeating.
SEED = "mix-1"


def size_of(text: Column) -> Column:
    """Number of words; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chance(identity: Column, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(identity.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, most: float = MOST, weights: int = WEIGHTS) -> DataFrame:
    """``source, source_size`` with each source's ``target``.

    Sources in code point order, null last, weigh 1 up to ``weights``, repeating, and
    share the sum of all sizes. A target stops at ``most`` times its source's size and
    the excess goes to the others by weight until none is above: all targets are then
    the smaller of cap and weight times one common level. With the sources in order of
    cap per weight, the level follows from running sums, without iteration. The windows
    run over one row for each source, not over documents.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("cap_per_weight", F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    ranked = (
        sizes.withColumn("weight", (F.row_number().over(in_order) - 1) % weights + 1)
        .withColumn("cap", F.col("source_size") * F.lit(most))
        .withColumn("cap_per_weight", F.col("cap") / F.col("weight"))
        .withColumn("level", level)
    )
    reached = F.min(F.when(F.col("level") <= F.col("cap_per_weight"), F.struct("cap_per_weight", "level"))).over(everything)
    return ranked.withColumn("reached", reached["level"]).select(
        "source",
        "source_size",
        F.least(F.coalesce(F.col("reached") * F.col("weight"), F.col("cap")), F.col("cap")).cast("double").alias("target"),
    )


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    most: float = MOST,
    weights: int = WEIGHTS,
    seed: str = SEED,
) -> tuple[DataFrame, list[str]]:
    """``docs`` with four more columns, and their names: size, source's size, target, copies.

    The names are ``size, source_size, target, copies`` unless ``docs`` has such columns.
    Null texts have size 0; a null source is a source of its own, the last; a source
    without words has target 0 and no copies; rows with one id, or none, are decided alike;
    an empty table gives an empty one. The table of sources is written, so the planner knows its
    size: it broadcasts it if small and otherwise splits hot sources in a join.
    """
    size, source_size, target, copies, key = fresh(docs, "size", "source_size", "target", "copies", "mix_source")
    sizes = docs.groupBy(column(source).alias("source")).agg(F.sum(size_of(column(text))).alias("source_size"))
    plan = written(targets(written(sizes, "mix-sizes"), most, weights), "mix-targets").select(
        F.col("source").alias(key), F.col("source_size").alias(source_size), F.col("target").alias(target)
    )
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(F.lit(0.0))
    drawn = F.floor(rate) + F.when(chance(column(doc_id), seed) < rate - F.floor(rate), 1).otherwise(0)
    out = (
        docs.withColumn(size, size_of(column(text)))
        .join(plan, column(source).eqNullSafe(F.col(key)), "left")
        .withColumn(copies, drawn.cast("long"))
        .drop(key)
    )
    return out, [size, source_size, target, copies]


def repeated(docs: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its column ``copies`` says, without that column."""
    (number,) = fresh(docs, "copy_number")
    kept = docs.filter(F.col(copies) > 0)
    return kept.withColumn(number, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop(number, copies)


def op10_query(docs: DataFrame) -> DataFrame:
    """What the mix takes of every document."""
    wanted = docs.select("doc_id", "text", "source")
    out, (size, source_size, target, copies) = mix(wanted)
    return out.select("doc_id", size, source_size, target, (F.col(size) * F.col(copies)).alias("taken"))


OP10_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {WEIGHTS} + 1 AS weight, source_size * {MOST} AS cap
  FROM sizes),
ranked AS (
  SELECT *, cap / weight AS ratio,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS lvl
  FROM weighed
  WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shared AS (
  SELECT source, source_size, CAST(least((SELECT lvl FROM ranked WHERE lvl <= ratio ORDER BY ratio, lvl LIMIT 1) * weight, cap) AS DOUBLE) AS target
  FROM ranked),
drawn AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM sized JOIN shared ON sized.source IS NOT DISTINCT FROM shared.source)
SELECT doc_id, size, source_size, target,
  size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM drawn
"""
