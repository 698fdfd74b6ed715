"""Connected components of links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from medstrata.llm.common import forget, written


def components(links: DataFrame) -> DataFrame:
    """``node, label``: for every node of ``links`` (a, b) the smallest node it is linked with.

    Alternates two star operations until nothing changes: every node hands its smallest
    neighbour first to its larger neighbours, then to its smaller ones, so chains get
    shorter by half each round and a node's links do not pile up. Smallest neighbours are
    pre-aggregated before the exchange. The driver sees a count and a sum a round.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges, seen = _step(edges)
    while True:
        before, (edges, now) = edges, _step(_small_star(_large_star(edges)))
        forget(links.sparkSession, before)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )


def _step(edges: DataFrame) -> tuple[DataFrame, tuple]:
    table = written(edges, "links")
    return table, tuple(table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
