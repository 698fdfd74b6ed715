"""Reports kept by a stream: counts live in the state store and follow every change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from medstrata.operators.enrich import left_enrich
from medstrata.sources.tables import KEPT_VERSIONS, publish
from medstrata.streaming.runs import trigger_of


def sign(change_type: str = "_change_type") -> Column:
    """1 for a row's new state, -1 for the state it leaves, 0 for other kinds."""
    kind = F.col(change_type)
    return (
        F.when(kind.isin("insert", "update_postimage"), 1)
        .when(kind.isin("update_preimage", "delete"), -1)
        .otherwise(0)
    )


def monthly_encounters(changes: DataFrame, patients: DataFrame, since: Column) -> DataFrame:
    """Encounters per month, gender and birth year, from changes with both images.

    ``changes`` may be a stream.  A changed encounter leaves its old group and enters its
    new one, so the counts are those of the table's present state.  Groups without a
    known gender and birth year are left to the unmatched report.
    """
    recent = changes.filter(F.col("START_TS") >= since).select("patient_id", "START_TS", sign().alias("_sign"))
    known = left_enrich(recent, patients, "patient_id", "id", ("gender", "birth_year")).filter(
        F.col("gender").isNotNull() & F.col("birth_year").isNotNull()
    )
    month = F.date_trunc("month", "START_TS").cast("date").alias("month")
    return known.groupBy(month, "gender", "birth_year").agg(F.sum("_sign").alias("encounter_count"))


def keep_report(
    report: DataFrame, count: str, target: str, checkpoint: str, mode: str = "batch", kept_versions: int = KEPT_VERSIONS
) -> StreamingQuery:
    """Publish a streaming aggregate in complete mode; groups that became empty are left out.

    The state is as large as the report.  A micro-batch that is repeated publishes the same
    rows again.
    """

    def write(rows: DataFrame, _: int) -> None:
        publish(rows.filter(F.col(count) > 0), target, kept_versions)

    query = (
        report.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_of(mode))
        .start()
    )
    if mode == "batch":
        query.awaitTermination()
    return query
