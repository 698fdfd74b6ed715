"""Every cleaned, enriched and report table over the stand-in inputs, by name."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from medstrata.operators.upsert import apply_history
from medstrata.plans import healthcare, kpis, stand_ins
from medstrata.plans.stand_ins import Tables

# Day that "today" stands for in recency figures.
AS_OF = "2001-09-30"


class Lake:
    """Lazily built tables; a table used twice is one plan, not one computation."""

    def __init__(self, t: Tables):
        self.t = t

    @property
    def as_of(self):
        return F.lit(AS_OF).cast("date")

    # raw layer
    @cached_property
    def bronze_claims(self) -> DataFrame:
        return stand_ins.claim_feed(self.t)

    @cached_property
    def bronze_providers(self) -> DataFrame:
        return stand_ins.provider_rows(self.t)

    @cached_property
    def bronze_patients(self) -> DataFrame:
        return stand_ins.patient_feed(self.t)

    @cached_property
    def bronze_encounters(self) -> DataFrame:
        return stand_ins.encounter_feed(self.t)

    @cached_property
    def bronze_feedback(self) -> DataFrame:
        return stand_ins.feedback_rows(self.t)

    # cleaned layer
    @cached_property
    def silver_claims(self) -> DataFrame:
        return healthcare.claims(self.bronze_claims)

    @cached_property
    def silver_providers(self) -> DataFrame:
        """Type-2 history after the first and the second load."""
        loaded_first = F.col("_ingest_ts") == F.lit(stand_ins.FIRST_LOAD).cast("timestamp")
        history = healthcare.provider_snapshot(self.bronze_providers.filter(loaded_first))
        return apply_history(
            history, healthcare.provider_snapshot(self.bronze_providers),
            "provider_id", healthcare.TRACKED,
        )

    @cached_property
    def provider_attributes(self) -> DataFrame:
        """Current attributes per provider.

        The current rows of the history hold the tracked values of the latest raw
        rows, which are cheaper to read when the intervals are not needed.
        """
        return healthcare.provider_snapshot(self.bronze_providers).select(
            "provider_id", *healthcare.TRACKED
        )

    @cached_property
    def silver_patients(self) -> DataFrame:
        return healthcare.patients(self.bronze_patients)

    @cached_property
    def silver_encounters(self) -> DataFrame:
        return healthcare.encounters(self.bronze_encounters)

    @cached_property
    def silver_feedback(self) -> DataFrame:
        return healthcare.feedback(self.bronze_feedback)

    @cached_property
    def silver_claims_enriched(self) -> DataFrame:
        return healthcare.claims_enriched(self.silver_claims, self.silver_providers)

    @cached_property
    def silver_feedback_enriched(self) -> DataFrame:
        return healthcare.feedback_enriched(
            self.silver_feedback, self.silver_providers, self.silver_encounters
        )

    @cached_property
    def silver_encounters_enriched(self) -> DataFrame:
        return healthcare.encounters_enriched(self.silver_encounters, self.silver_patients)

    # report layer
    @cached_property
    def gold_claim_approval_by_specialty(self) -> DataFrame:
        return kpis.approval_by_specialty(self.silver_claims, self.provider_attributes)

    @cached_property
    def gold_claim_denial_breakdown(self) -> DataFrame:
        return kpis.denial_breakdown(self.silver_claims, self.provider_attributes)

    @cached_property
    def gold_high_cost_procedures(self) -> DataFrame:
        return kpis.high_cost_procedures(self.silver_claims)

    @cached_property
    def gold_feedback_satisfaction(self) -> DataFrame:
        return kpis.feedback_satisfaction(self.silver_feedback, self.provider_attributes)

    @cached_property
    def gold_feedback_tag_analysis(self) -> DataFrame:
        return kpis.feedback_tags(self.silver_feedback)

    @cached_property
    def gold_feedback_encounter_match(self) -> DataFrame:
        return kpis.feedback_encounter_match(self.silver_feedback, self.silver_encounters)

    @cached_property
    def gold_provider_daily_spend(self) -> DataFrame:
        return kpis.provider_daily_spend(self.silver_claims)

    @cached_property
    def gold_provider_7d_spend(self) -> DataFrame:
        return kpis.provider_7d_spend(self.gold_provider_daily_spend)

    @cached_property
    def gold_patient_lifecycle(self) -> DataFrame:
        return kpis.patient_lifecycle(self.silver_encounters, self.as_of)

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
