"""Ingest and streaming queries.

Raw files are written from the driver's tables into the shared folder, then loaded
by the checkpointed streams; the two Parquet ingests read the tables in place.
"""

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from medstrata.config import PipelineConfig
from medstrata.plans import healthcare, ingest_specs, stand_ins
from medstrata.plans.tables import Lake
from medstrata.registry.catalog import query
from medstrata.session import work_dir
from medstrata.sources import changelog, files
from medstrata.streaming.ingest import IngestSpec, ingest
from medstrata.streaming.upserts import (
    UpsertSpec, enrich_stream, read_cleaned, upsert_stream,
)
from medstrata.streaming.runs import run_stream


def _config(lake: Lake) -> PipelineConfig:
    return PipelineConfig(root=work_dir(lake.t.spark, "lake"), default_buckets=8)


def _in_place(lake: Lake, name: str, key: str):
    """Ingest of a driver table from where it lies: a folder, or one file in a folder."""
    paths = _config(lake).paths("bronze", name)
    if files.folders.is_directory(lake.t.spark, lake.t.path(name)):
        return IngestSpec("parquet", [key]), replace(paths, raw=lake.t.path(name))
    only = {"pathGlobFilter": f"{name}.parquet"}
    return IngestSpec("parquet", [key], options=only), replace(paths, raw=lake.t.folder)


def _ingested(lake: Lake, spec: IngestSpec, paths):
    ingest(lake.t.spark, spec, paths)
    return changelog.read_log(lake.t.spark, paths.table)


@query(
    "ingest_parquet_stream",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  CAST(l_shipdate AS VARCHAR) AS l_shipdate, 'insert' AS _change_type, 1 AS _commit_version,
  'manual' AS _batch_id, 'lineitem.parquet' AS source_file
FROM lineitem""",
)
def ingest_parquet_stream(lake: Lake):
    """Checkpointed load of Parquet files with their own, remembered schema."""
    loaded = _ingested(lake, *_in_place(lake, "lineitem", "l_orderkey"))
    return loaded.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
        "_change_type", "_commit_version", "_batch_id",
        F.regexp_extract("_source_file", r"/([^/]+\.parquet)", 1).alias("source_file"),
    )


@query(
    "ingest_events_stream",
    """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderstatus,
  o_orderpriority, 'insert' AS _change_type
FROM orders""",
)
def ingest_events_stream(lake: Lake):
    """The encounter flow, whose format is an argument, over the order table."""
    loaded = _ingested(lake, *_in_place(lake, "orders", "o_orderkey"))
    return loaded.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "_change_type"
    )


@query(
    "ingest_csv",
    """
SELECT id, birthdate, c_name AS first, race, gender, 'Town, ' || c_nationkey AS birthplace,
  c_custkey || ' Main Street, Springfield' AS address, marital
FROM patient_feed WHERE _change_type = 'insert' AND id IS NOT NULL""",
)
def ingest_csv(lake: Lake):
    """Patient CSV with header and quoted commas."""
    paths = _config(lake).paths("bronze", "patients")
    inserted = lake.bronze_patients.filter(F.col("_change_type") == "insert")
    inserted.select(*ingest_specs.PATIENT_COLUMNS).write.option("header", True).csv(paths.raw)
    loaded = _ingested(lake, ingest_specs.specs()["patients"], paths)
    return loaded.select(
        *[F.col(c).alias(c.lower()) for c in
          ("ID", "BIRTHDATE", "FIRST", "RACE", "GENDER", "BIRTHPLACE", "ADDRESS", "MARITAL")]
    )


@query(
    "ingest_tsv",
    """
SELECT provider_id, provider_specialty, provider_location, CAST(NULL AS VARCHAR) AS _rescued_data
FROM provider_rows WHERE provider_id IS NOT NULL""",
)
def ingest_tsv(lake: Lake):
    """Provider TSV with a declared schema and rescued values."""
    paths = _config(lake).paths("bronze", "providers")
    raw = lake.bronze_providers.select(*ingest_specs.PROVIDER_COLUMNS)
    raw.write.option("header", True).option("delimiter", "\t").csv(paths.raw)
    loaded = _ingested(lake, ingest_specs.specs()["providers"], paths)
    return loaded.select(
        F.col("ProviderID").alias("provider_id"),
        F.col("ProviderSpecialty").alias("provider_specialty"),
        F.col("ProviderLocation").alias("provider_location"),
        "_rescued_data",
    )


@query(
    "copy_into_jsonl",
    """
SELECT feedback_id, provider_id, visit_id,
  CAST(satisfaction_score AS VARCHAR) AS satisfaction_score, comments, source, tags,
  json_extract(props, '$') AS metadata_json
FROM feedback_rows""",
)
def copy_into_jsonl(lake: Lake):
    """JSON lines loaded once per file, projected, the nested object kept as text."""
    paths = _config(lake).paths("bronze", "feedback")
    raw = lake.bronze_feedback.withColumn(
        "metadata", F.from_json("metadata_json", "k int")
    ).select(*ingest_specs.FEEDBACK_COLUMNS)
    raw.write.json(paths.raw)
    loaded = _ingested(lake, ingest_specs.specs()["feedback"], paths)
    return loaded.select(
        "feedback_id", "provider_id", "visit_id", "satisfaction_score", "comments", "source",
        "tags", "metadata_json",
    )


@query(
    "quarantine_split",
    """
SELECT CASE WHEN c_nationkey = 3 THEN 'quarantine' ELSE 'table' END AS destination,
  CASE WHEN c_nationkey = 3 THEN '{"id":"' || c_custkey || '","name":' ELSE CAST(c_custkey AS VARCHAR)
  END AS content
FROM customer""",
)
def quarantine_split(lake: Lake):
    """Customers of one nation arrive as broken JSON: they are set aside, the rest loads."""
    spark = lake.t.spark
    paths = _config(lake).paths("bronze", "customers")
    start = F.concat(F.lit('{"id":"'), F.col("c_custkey").cast("string"), F.lit('","name":'))
    whole = F.concat(start, F.lit('"'), F.col("c_name"), F.lit('"}'))
    lines = F.when(F.col("c_nationkey") == 3, start).otherwise(whole)
    lake.t.read("customer").select(lines.alias("value")).write.text(paths.raw)
    spec = IngestSpec("json", ["id"], schema=ingest_specs.text_schema(["id", "name"]))
    loaded = _ingested(lake, spec, paths).select(
        F.lit("table").alias("destination"), F.col("id").alias("content")
    )
    if not files.folders.exists(spark, paths.quarantine):
        return loaded
    bad = changelog.read_log(spark, paths.quarantine)
    return loaded.unionByName(
        bad.select(F.lit("quarantine").alias("destination"), F.col(files.CORRUPT).alias("content"))
    )


@query(
    "rescue_columns",
    """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
  CASE WHEN o_orderstatus = 'P' THEN '{"price":"n/a","priority":"' || o_orderpriority || '"}'
       ELSE '{"priority":"' || o_orderpriority || '"}' END AS _rescued_data
FROM orders""",
)
def rescue_columns(lake: Lake):
    """Values that do not fit their type and unexpected columns are kept as JSON text."""
    status = F.col("o_orderstatus")
    raw = lake.t.read("orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(status == "P", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderpriority").alias("priority"),
    )
    return files.rescue(
        raw, StructType([StructField("id", LongType()), StructField("price", DoubleType())])
    )


@query(
    "schema_evolve_append",
    """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END
  AS o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS _commit_version
FROM orders""",
)
def schema_evolve_append(lake: Lake):
    """A second load brings a new column; rows of the first load have NULL there."""
    paths = _config(lake).paths("bronze", "orders")
    spec = IngestSpec("parquet", ["o_orderkey"])
    orders = lake.t.read("orders")
    finished = F.col("o_orderstatus") == "F"
    orders.filter(finished).select("o_orderkey", "o_orderstatus").write.parquet(paths.raw)
    ingest(lake.t.spark, spec, paths)
    orders.filter(~finished).select("o_orderkey", "o_orderstatus", "o_orderpriority").write.mode(
        "append"
    ).parquet(paths.raw)
    loaded = _ingested(lake, spec, paths)
    return loaded.select("o_orderkey", "o_orderstatus", "o_orderpriority", "_commit_version")


def _encounter_log(lake: Lake, path: str) -> None:
    """Encounter changes as a log: commit 0 creates the table, 1 inserts, 2 updates."""
    feed = lake.bronze_encounters
    for version in (0, 1, 2):
        changelog.write_commit(feed.filter(F.col("_commit_version") == version), path, version)


@query(
    "change_feed_read",
    """
SELECT encounter_id, code, _change_type, _commit_version FROM encounter_feed""",
)
def change_feed_read(lake: Lake):
    """A change log read as a stream from commit 1 on, and written through."""
    spark = lake.t.spark
    source, copy = work_dir(spark, "log"), work_dir(spark, "copy")
    _encounter_log(lake, source)
    stream = changelog.stream_log(spark, source).withColumn("read_version", F.col("_commit_version"))
    run_stream(
        stream,
        lambda batch, number: changelog.append_commit(batch, copy, f"batch-{number}") and None,
        work_dir(spark, "checkpoint"),
    )
    return changelog.read_log(spark, copy).select(
        F.col("ID").alias("encounter_id"), F.col("CODE").alias("code"), "_change_type",
        F.col("read_version").alias("_commit_version"),
    )


@query(
    "stream_scd1_claims",
    "SELECT * REPLACE (CAST(claim_date AS VARCHAR) AS claim_date) FROM claims",
)
def stream_scd1_claims(lake: Lake):
    """Claim changes streamed into a bucketed table in two runs of one checkpoint."""
    spark = lake.t.spark
    config = _config(lake)
    paths = config.paths("silver", "claims")
    log = config.paths("bronze", "claims").table
    spec = UpsertSpec(
        healthcare.claim_rows, ["claim_id"], healthcare.CLAIM_TIE_BREAK,
        config.buckets_of("claims"),
    )
    # The feed numbers its commits by day; the log keeps that number inside its rows.
    feed = lake.bronze_claims.withColumn("feed_version", F.col("_commit_version"))
    earlier = F.col("_commit_version") <= stand_ins.CLAIM_CUT
    for version, part in ((1, feed.filter(earlier)), (2, feed.filter(~earlier))):
        changelog.write_commit(part, log, version)
        changes = changelog.stream_log(spark, log).withColumn("_commit_version", F.col("feed_version"))
        upsert_stream(changes, paths.table, spec, paths.checkpoint_for("batch"))
    return read_cleaned(spark, paths.table)


@query(
    "stream_static_enrich",
    """
SELECT * REPLACE (CAST(start_ts AS VARCHAR) AS start_ts, CAST(birth_year AS VARCHAR) AS birth_year)
FROM encounters_enriched""",
)
def stream_static_enrich(lake: Lake):
    """Change log -> cleaned encounters -> their change log -> join with patients."""
    spark = lake.t.spark
    config = _config(lake)
    silver = config.paths("silver", "encounters")
    enriched = config.paths("silver", "encounters_enriched")
    log, applied = config.paths("bronze", "encounters").table, f"{silver.table}_changes"
    _encounter_log(lake, log)
    spec = UpsertSpec(
        healthcare.encounter_rows, ["encounter_id"],
        buckets=config.buckets_of("encounters"), changes_to=applied,
    )
    upsert_stream(
        changelog.stream_log(spark, log), silver.table, spec, silver.checkpoint_for("batch")
    )
    enrich_stream(
        changelog.stream_log(spark, applied), lambda: lake.silver_patients,
        "patient_id", "id", ("gender", "birth_year"), "patient_missing",
        enriched.table, ["encounter_id"], enriched.checkpoint_for("batch"),
        buckets=config.buckets_of("encounters_enriched"),
    )
    return read_cleaned(spark, enriched.table).drop("_source_file", "_batch_id")
