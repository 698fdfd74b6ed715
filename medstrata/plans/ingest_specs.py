"""How the five raw datasets are ingested."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType, ArrayType

from medstrata.config import AUDIT_COLUMNS
from medstrata.streaming.ingest import IngestSpec

# --- fixed values: columns of the raw files -----------------------------------
PATIENT_COLUMNS = (
    "ID", "BIRTHDATE", "DEATHDATE", "SSN", "DRIVERS", "PASSPORT", "PREFIX", "FIRST",
    "LAST", "SUFFIX", "MAIDEN", "MARITAL", "RACE", "ETHNICITY", "GENDER",
    "BIRTHPLACE", "ADDRESS",
)
PROVIDER_COLUMNS = ("ProviderID", "ProviderSpecialty", "ProviderLocation")
FEEDBACK_COLUMNS = (
    "feedback_id", "provider_id", "timestamp", "visit_id", "satisfaction_score",
    "comments", "source", "tags", "metadata",
)
# ------------------------------------------------------------------------------


def text_schema(columns) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def _feedback_schema() -> StructType:
    """All text but the tags: a nested object is read as its JSON text."""
    types = {"tags": ArrayType(StringType())}
    return StructType([StructField(c, types.get(c, StringType())) for c in FEEDBACK_COLUMNS])


def feedback_projection(rows: DataFrame) -> DataFrame:
    """The stable raw-layer columns of feedback; unexpected fields are not kept."""
    kept = [c for c in FEEDBACK_COLUMNS if c not in ("satisfaction_score", "metadata")]
    return rows.select(
        *kept,
        F.col("satisfaction_score").try_cast("int").alias("satisfaction_score"),
        # Compact JSON text, as to_json writes it.
        F.coalesce(F.to_json(F.try_parse_json("metadata")), "metadata").alias("metadata_json"),
        *AUDIT_COLUMNS,
    )


def specs(encounter_format: str = "avro") -> dict[str, IngestSpec]:
    """Ingest of each dataset; encounters may arrive as Parquet where Avro is absent."""
    return {
        "claims": IngestSpec("parquet", ["ClaimID"]),
        "patients": IngestSpec("csv", ["ID"], schema=text_schema(PATIENT_COLUMNS)),
        "encounters": IngestSpec(encounter_format, ["ID"]),
        "providers": IngestSpec(
            "tsv", ["ProviderID"], schema=text_schema(PROVIDER_COLUMNS),
            rescue_into=text_schema(PROVIDER_COLUMNS),
        ),
        "feedback": IngestSpec(
            "json", ["feedback_id"], schema=_feedback_schema(), project=feedback_projection
        ),
    }
