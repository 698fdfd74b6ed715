"""One key with a third of the rows: results stay whole, and no task gets them all."""

import contextlib

import pytest
from pyspark.sql import functions as F

from medstrata.operators.dedupe import latest_per_key
from medstrata.operators.enrich import count_orphans, left_enrich, measure_by_key
from tests.helpers import plan, same

ROWS = 120_000


@contextlib.contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skew") / "fact")
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string"))
    spark.range(ROWS).select(
        "id", key.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        (F.col("id") % 100 / 4).alias("amount"),
    ).repartition(16).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def dim(spark):
    keys = spark.range(900).select(F.col("id").cast("string").alias("key"))
    return keys.unionByName(spark.range(1).select(F.lit("hot").alias("key"))).withColumn(
        "color", F.concat(F.lit("c"), F.col("key"))
    )


def shuffled(spark):
    """Settings under which a dimension is too large to broadcast and skew shows early."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="256k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="256k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__shuffle__partitions=16,
    )


def test_enrichment_splits_the_hot_partition(spark, fact, dim):
    with shuffled(spark):
        enriched = left_enrich(fact, dim, "key", "key", ["color"], "missing")
        got = enriched.groupBy("missing").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("d"))
        enriched.write.format("noop").mode("overwrite").save()
        rows = enriched.collect()
        assert "skew=true" in plan(enriched)
    assert len(rows) == ROWS and len({r.id for r in rows}) == ROWS
    small = left_enrich(fact, dim, "key", "key", ["color"], "missing")
    same(got, small.groupBy("missing").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("d")))


def shuffle_rows(df):
    """Rows each exchange of the executed plan wrote."""
    df.collect()
    found, pending = [], [df._jdf.queryExecution().executedPlan()]
    while pending:
        node = pending.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            pending.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            pending.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        pending += [children.apply(i) for i in range(children.size())]
    return found


def test_dedupe_sends_one_row_per_key_and_task(spark, fact):
    with settings(spark, spark__sql__shuffle__partitions=4):
        latest = latest_per_key(fact, ["key"], ["id"])
        sent = shuffle_rows(latest)
    assert len(sent) == 1
    tasks = fact.rdd.getNumPartitions()
    assert sent[0] <= tasks * 998 < ROWS


def test_reports_send_partial_groups_only(spark, fact, dim):
    with shuffled(spark):
        report = measure_by_key(
            fact, ["key"], {"n": F.count(F.lit(1))}, dim, "key", "key", ["color"]
        ).groupBy("color").agg(F.sum("n").alias("n"))
        sent = shuffle_rows(report)
        orphans = count_orphans(fact, dim, "key", "key", "n")
        sent += shuffle_rows(orphans)
    tasks = fact.rdd.getNumPartitions()
    assert max(sent) <= tasks * 998
    expected = fact.filter("key <> 'hot' AND cast(key as int) >= 900").count()
    assert orphans.first().n == expected
