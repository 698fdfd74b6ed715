"""The whole pipeline over a lake folder: raw files to checked report tables."""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Callable, Mapping
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from medstrata.config import PipelineConfig
from medstrata.operators.aggregates import top_rows
from medstrata.operators.changes import commit_history
from medstrata.operators.constraints import gate, violation_results
from medstrata.functions.measures import unfit
from medstrata.operators.quality import (
    Check, check_none, check_observed_nulls, layer_checks, null_counts, run_checks,
)
from medstrata.plans import healthcare, ingest_specs, kpis
from medstrata.session import pin_session, together
from medstrata.sources import changelog, leases
from medstrata.sources.tables import publish, read_bucketed, read_buckets_of, read_table
from medstrata.streaming.ingest import IngestSpec, ingest
from medstrata.streaming.upserts import (
    UpsertSpec, append_new, enrich_pending, enrich_stream, merge_history, read_cleaned, upsert_stream,
)

RESULTS = "smoke_results"

# What encounters are enriched with, by patient.
PATIENT_ATTRIBUTES = StructType(
    [StructField("id", StringType()), StructField("gender", StringType()), StructField("birth_year", IntegerType())]
)

# Cleaned tables that are upserted from the change log of their raw table.
UPSERTED = {
    "claims": (healthcare.claim_rows, "claim_id", healthcare.CLAIM_TIE_BREAK),
    "patients": (healthcare.patient_rows, "id", healthcare.PATIENT_TIE_BREAK),
    "encounters": (healthcare.encounter_rows, "encounter_id", healthcare.ENCOUNTER_TIE_BREAK),
}


class Medallion:
    """One lake folder, its tables and the jobs that refresh them.

    :meth:`run` refreshes all tables once; :meth:`stream_encounters` keeps the
    encounter tables up to date until its queries are stopped.
    """

    def __init__(
        self,
        spark: SparkSession,
        config: PipelineConfig,
        specs: Mapping[str, IngestSpec] | None = None,
        constraints: Mapping[str, Mapping[str, Column]] | None = None,
    ):
        """``constraints``: by table, by name, what rows of published tables must meet.

        Rows that break one are set aside beside the table and counted in the result log.
        """
        self.spark = pin_session(spark)
        self.config = config
        self.specs = dict(specs or ingest_specs.specs())
        self.constraints = dict(constraints or {})
        self._nulls: dict[str, Observation] = {}
        self._noted: dict[str, list[tuple]] = {}

    # ---- tables -------------------------------------------------------------

    def load(self, name: str) -> DataFrame:
        """A table by name, such as ``silver_claims``."""
        layer, dataset = name.split("_", 1)
        path = self.config.paths(layer, dataset).table
        if layer == "bronze":
            return changelog.read_log(self.spark, path)
        if name in ("silver_claims_enriched", "silver_feedback_enriched") or layer == "gold":
            return read_table(self.spark, path)
        if name == "silver_feedback":
            return changelog.read_log(self.spark, path).drop(changelog.VERSION)
        if name == "silver_providers":
            return read_bucketed(self.spark, path)
        return read_cleaned(self.spark, path)

    def results(self) -> DataFrame:
        return self.spark.read.parquet(self.config.paths("validation", RESULTS).table)

    def history(self, dataset: str, newest: int = 5) -> DataFrame:
        """The newest commits of a raw table; only their folders are read."""
        path = self.config.paths("bronze", dataset).table
        numbers = changelog.newest_numbers(self.spark, path, newest)
        return commit_history(changelog.read_log(self.spark, path, min(numbers, default=0)), newest)

    def preview(self, name: str, rows: int = 5) -> DataFrame:
        """The most recently loaded rows of a table."""
        table = self.load(name)
        return top_rows(table, [F.col("_ingest_ts").desc_nulls_last(), table.columns[0]], rows)

    # ---- jobs ---------------------------------------------------------------

    def ingest(self, dataset: str, mode: str = "batch"):
        paths = self.config.paths("bronze", dataset)
        return ingest(self.spark, self.specs[dataset], paths, mode)

    def upsert(self, dataset: str, mode: str = "batch"):
        """Raw change log -> cleaned table, latest row per key."""
        prepare, key, tie_break = UPSERTED[dataset]
        silver = self.config.paths("silver", dataset)
        spec = UpsertSpec(
            prepare, [key], tie_break, self.config.buckets_of(dataset),
            # Only encounters have a reader of their changes.
            changes_to=f"{silver.table}_changes" if dataset == "encounters" else None,
            kept_versions=self.config.kept_versions,
        )
        source = self._changes(self.config.paths("bronze", dataset).table, mode)
        return upsert_stream(source, silver.table, spec, silver.checkpoint_for(mode), mode)

    def _changes(self, path: str, mode: str) -> DataFrame:
        """A log as a stream; a bounded run takes its backlog at once and merges it once."""
        return changelog.stream_log(self.spark, path, max_files=None if mode == "batch" else 1000)

    def _unread(self, dataset: str) -> tuple[changelog.Position, DataFrame | None, int]:
        """Rows of a raw table that its cleaned table has not taken in yet."""
        note = f"{self.config.paths('silver', dataset).checkpoint}/position"
        position = changelog.Position(self.spark, self.config.paths("bronze", dataset).table, note)
        return position, *position.unread()

    def merge_providers(self) -> None:
        """Merge the snapshot of new commits only; providers that are not in them stay as they are."""
        position, rows, newest = self._unread("providers")
        if rows is None:
            return
        merge_history(
            healthcare.provider_snapshot(rows), self.config.paths("silver", "providers").table,
            "provider_id", healthcare.TRACKED, self.config.buckets_of("providers"), self.config.kept_versions,
        )
        position.advance(newest)

    def insert_feedback(self) -> None:
        """Insert new keys from new commits only; a run that is repeated replaces its own commit."""
        position, rows, newest = self._unread("feedback")
        if rows is None:
            return
        append_new(
            healthcare.feedback(rows), self.config.paths("silver", "feedback").table, ["feedback_id"],
            f"after-{position.read()}",
        )
        position.advance(newest)

    def enrich_encounters(self, mode: str = "batch"):
        """Changes of cleaned encounters, joined with patients, upserted."""
        enriched = self.config.paths("silver", "encounters_enriched")
        source = self.config.paths("silver", "encounters").table + "_changes"
        return enrich_stream(
            self._changes(source, mode), lambda: self.load("silver_patients"),
            "patient_id", "id", ("gender", "birth_year"), "patient_missing", enriched.table,
            ["encounter_id"], enriched.checkpoint_for(mode), mode,
            self.config.buckets_of("encounters_enriched"), self.config.kept_versions, f"{enriched.table}_pending",
        )

    def refresh_encounters(self) -> None:
        """Enrich encounters again whose patient arrived after they were processed."""
        target = self.config.paths("silver", "encounters_enriched").table
        patients = self.config.paths("silver", "patients").table

        def asked_patients(ids: DataFrame) -> DataFrame:
            return read_buckets_of(self.spark, patients, ids, PATIENT_ATTRIBUTES)

        enrich_pending(
            self.spark, f"{target}_pending", asked_patients, "patient_id", "id", ("gender", "birth_year"),
            "patient_missing", target, ["encounter_id"], self.config.buckets_of("encounters_enriched"),
            self.config.kept_versions,
        )

    def enrich_encounters_and_refresh(self) -> None:
        """New encounters, then earlier ones whose patient has arrived by now."""
        self.enrich_encounters()
        self.refresh_encounters()

    def publish(self, name: str, rows: DataFrame) -> None:
        """Replace a table; its checks take their figures from the rows as they are written."""
        layer, dataset = name.split("_", 1)
        path = self.config.paths(layer, dataset).table

        def write(table: DataFrame, to: str) -> None:
            if to == path and name in healthcare.NOT_NULL:
                self._nulls[name] = Observation()
                table = table.observe(self._nulls[name], *null_counts(healthcare.NOT_NULL[name]))
            publish(table, to, self.config.kept_versions)

        if name in self.constraints:
            found = gate(rows, self.constraints[name], write, path)
            self._noted[name] = violation_results(layer.upper(), name, found)
        else:
            write(rows, path)

    def rejected(self, name: str) -> DataFrame:
        """Rows of a published table that were set aside last, with the constraints they break."""
        layer, dataset = name.split("_", 1)
        return read_table(self.spark, f"{self.config.paths(layer, dataset).table}_rejected")

    def enrich_claims(self) -> None:
        claims, history = self.load("silver_claims"), self.load("silver_providers")
        self.publish("silver_claims_enriched", healthcare.claims_enriched(claims, history))

    def enrich_feedback(self) -> None:
        enriched = healthcare.feedback_enriched(
            self.load("silver_feedback"), self.load("silver_providers"),
            self.load("silver_encounters"),
        )
        self.publish("silver_feedback_enriched", enriched)

    def reports(self, as_of: dt.date | None = None) -> list[Callable[[], None]]:
        """One job per report table; each rebuilds its table as a new snapshot."""
        claims, feedback = self.load("silver_claims"), self.load("silver_feedback")
        encounters = self.load("silver_encounters")
        providers = healthcare.current_providers(self.load("silver_providers"))
        today = F.lit(as_of) if as_of is not None else None
        tables = {
            "gold_claim_approval_by_specialty": kpis.approval_by_specialty(claims, providers),
            "gold_claim_denial_breakdown": kpis.denial_breakdown(claims, providers),
            "gold_high_cost_procedures": kpis.high_cost_procedures(claims),
            "gold_feedback_satisfaction": kpis.feedback_satisfaction(feedback, providers),
            "gold_feedback_tag_analysis": kpis.feedback_tags(feedback),
            "gold_feedback_encounter_match": kpis.feedback_encounter_match(feedback, encounters),
            "gold_patient_lifecycle": kpis.patient_lifecycle(encounters, today),
        }

        def spend() -> None:
            # The rolling table is built from the daily one just written.
            self.publish("gold_provider_daily_spend", kpis.provider_daily_spend(claims))
            daily = self.load("gold_provider_daily_spend")
            self.publish("gold_provider_7d_spend", kpis.provider_7d_spend(daily))

        return [spend, *[partial(self.publish, name, rows) for name, rows in tables.items()]]

    def validate(self, run_ts: dt.datetime) -> int:
        """Check all layers and append the results; 0 when every check passed.

        Report tables that this object has written are not scanned again.
        """

        def from_write(name: str) -> DataFrame:
            return check_observed_nulls(self.spark, self._nulls[name].get, name, healthcare.NOT_NULL[name])

        checks = layer_checks(
            self.load, healthcare.RAW_KEYS, healthcare.CONTRACTS, healthcare.NOT_NULL,
            healthcare.DUPLICATES_RESOLVED_IN, {name: partial(from_write, name) for name in self._nulls},
        )
        # Amounts that no sum can hold count as missing in the reports.
        checks.append(Check("SILVER", "silver_claims", lambda: check_none(
            self.load("silver_claims"), "SILVER", "silver_claims", "unfit[claim_amount]", unfit("claim_amount")
        )))
        noted = [result for results in self._noted.values() for result in results]
        code, _ = run_checks(
            self.spark, checks, run_ts, self.config.paths("validation", RESULTS).table, noted
        )
        self._nulls.clear()
        self._noted.clear()
        return code

    def run(self, run_ts: dt.datetime, as_of: dt.date | None = None) -> int:
        """Refresh everything once; returns the exit code of the checks.

        While a stream keeps the encounter tables, they are left to it.
        Cleaned tables are complete before anything that joins them starts; jobs of
        one step are independent and run side by side.
        """
        streamed = ["encounters"] if leases.is_held(self.spark, self._streaming) else []
        together(self.spark, *[partial(self.ingest, dataset) for dataset in self.specs if dataset not in streamed])
        together(
            self.spark,
            self.merge_providers,
            *[partial(self.upsert, dataset) for dataset in UPSERTED if dataset not in streamed],
            self.insert_feedback,
        )
        together(
            self.spark,
            *([] if streamed else [self.enrich_encounters_and_refresh]),
            self.enrich_claims,
            self.enrich_feedback,
            *self.reports(as_of),
        )
        return self.validate(run_ts)

    @property
    def _streaming(self) -> str:
        """Lease of whoever keeps the encounter tables by a stream."""
        return f"{self.config.paths('silver', 'encounters').checkpoint}/streaming"

    def stream_encounters(self) -> list[StreamingQuery]:
        """Start the continuous encounter flow: ingest, upsert, enrich.

        The tables count as streamed until all three queries have ended.
        """
        lease = leases.acquire(self.spark, self._streaming)
        queries: list[StreamingQuery] = []
        try:
            for start in (self.ingest, self.upsert):
                queries.append(start("encounters", "stream"))
            queries.append(self.enrich_encounters("stream"))
        except BaseException:
            for query in queries:
                query.stop()
            lease.release()
            raise

        def until_all_have_ended() -> None:
            while any(query.isActive for query in queries):
                time.sleep(1)
            lease.release()

        threading.Thread(target=until_all_have_ended, daemon=True).start()
        return queries
