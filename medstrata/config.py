"""Names, folders and fixed values of a medallion pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# --- fixed values -----------------------------------------------------------
# Change rows that describe the new state of a record.
KEPT_CHANGE_TYPES = ("insert", "update_postimage")

# Patient columns that leave the raw layer only as NULL.
PHI_COLUMNS = (
    "DEATHDATE", "SSN", "DRIVERS", "PASSPORT", "FIRST", "LAST",
    "BIRTHPLACE", "ADDRESS", "MAIDEN", "PREFIX", "SUFFIX",
)

AUDIT_COLUMNS = ("_ingest_ts", "_source_file", "_batch_id")

# Label of missing dimension values in reports.
UNKNOWN = "Unknown"

MANUAL_BATCH = "manual"

STREAM_INTERVAL = "30 seconds"

RUN_MODES = ("batch", "stream")
# ----------------------------------------------------------------------------

# Session key from which the run id of the audit columns is taken.
BATCH_ID_KEY = "spark.medstrata.batchId"


# Name prefixes of the tables, from raw to checked.
LAYERS = ("bronze", "silver", "gold", "validation")


@dataclass(frozen=True)
class DatasetPaths:
    """Where one table of a dataset lies, and what is kept for it.

    What is kept beside tables (columns seen, progress, what was set aside) lies in one
    folder for each dataset, so that it can be looked at and moved together.
    """

    root: str
    layer: str
    dataset: str
    raw: str

    @property
    def table(self) -> str:
        return f"{self.root}/{self.layer}/{self.layer}_{self.dataset}"

    @property
    def kept(self) -> str:
        return f"{self.root}/_kept/{self.dataset}"

    @property
    def schema(self) -> str:
        return f"{self.kept}/columns"

    @property
    def quarantine(self) -> str:
        return f"{self.kept}/set_aside"

    @property
    def checkpoint(self) -> str:
        return f"{self.kept}/progress/{self.layer}_{self.dataset}"

    def checkpoint_for(self, mode: str) -> str:
        """Batch and continuous runs keep separate progress."""
        return f"{self.checkpoint}/{check_mode(mode)}"


@dataclass(frozen=True)
class PipelineConfig:
    """A lake root: raw files arrive by dataset in one folder, tables live by layer."""

    root: str
    incoming: str = "source"
    buckets: dict[str, int] = field(default_factory=dict)
    default_buckets: int = 16
    kept_versions: int = 10  # of each table, for readers that started on them

    def paths(self, layer: str, dataset: str) -> DatasetPaths:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return DatasetPaths(self.root, layer, dataset, f"{self.root}/{self.incoming}/{dataset}")

    def buckets_of(self, dataset: str) -> int:
        return self.buckets.get(dataset, self.default_buckets)


def check_mode(mode: str) -> str:
    if mode not in RUN_MODES:
        raise ValueError(f"mode must be one of {RUN_MODES}, not {mode!r}")
    return mode


def batch_id_of(spark: SparkSession) -> str:
    """Run id for the audit columns; a hand-started run is ``manual``."""
    return spark.conf.get(BATCH_ID_KEY, MANUAL_BATCH)
