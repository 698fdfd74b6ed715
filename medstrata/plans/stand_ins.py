"""The healthcare inputs expressed over the generic star-schema tables.

Nothing is sampled or filtered: each function reads its whole table, and gaps such
as missing keys, unreadable dates or unknown references come from column values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from medstrata.session import pin_session

FIRST_LOAD, SECOND_LOAD = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
MANUAL = "manual"

# Commits up to this number are the first load of claims; days since 1995-01-01.
CLAIM_CUT = 1200
# Feedback that happened before this instant was in the first load.
FEEDBACK_CUT = "2024-01-10 00:00:00"


class Tables:
    """The driver's Parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = pin_session(spark)
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _day_text(column: str | Column) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.cast("date").cast("string")


def _audit(ingest: Column, source: str) -> list[Column]:
    return [
        ingest.cast("timestamp").alias("_ingest_ts"),
        F.lit(source).alias("_source_file"),
        F.lit(MANUAL).alias("_batch_id"),
    ]


def _choice(column: str, **values: str) -> Column:
    chosen = None
    for value, label in values.items():
        condition = F.col(column) == value
        chosen = F.when(condition, label) if chosen is None else chosen.when(condition, label)
    return chosen


def _all(*changes: DataFrame) -> DataFrame:
    """Changes of several kinds in one feed.

    A union keeps pruning possible: only the needed columns of each kind are read,
    and kinds or loads that a query does not ask for are not read at all.
    """
    return reduce(DataFrame.unionByName, changes)


def claim_feed(t: Tables) -> DataFrame:
    """Change rows of raw claims, one per line item."""
    line = t.read("lineitem")
    cents = F.round(F.col("l_discount") * 100).cast("int")
    return line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ClaimID"),
        F.when(F.col("l_discount") < 0.095, _text("l_partkey")).alias("PatientID"),
        _text("l_suppkey").alias("ProviderID"),
        F.col("l_extendedprice").alias("ClaimAmount"),
        _day_text("l_shipdate").alias("ClaimDate"),
        F.when(cents > 0, F.concat(F.lit("dx"), cents.cast("string"))).alias("DiagnosisCode"),
        F.concat(F.lit("pr"), F.col("l_quantity").cast("int").cast("string")).alias("ProcedureCode"),
        _choice("l_returnflag", A="Approved", R="Denied", N="Pending").alias("ClaimStatus"),
        _choice("l_linestatus", F="Inpatient", O="Outpatient").alias("ClaimType"),
        F.when(F.col("l_linenumber") <= 3, "Online")
        .when(F.col("l_linenumber") <= 5, "Paper")
        .otherwise("Phone")
        .alias("ClaimSubmissionMethod"),
        *_audit(F.col("l_shipdate"), "lineitem"),
        F.when(F.col("l_tax") < 0.005, "delete")
        .when(F.col("l_tax") > 0.075, "update_preimage")
        .when(F.col("l_tax") < 0.035, "insert")
        .otherwise("update_postimage")
        .alias("_change_type"),
        F.datediff("l_shipdate", F.lit("1995-01-01")).cast("long").alias("_commit_version"),
        F.col("l_shipdate").cast("timestamp").alias("_commit_timestamp"),
    )


def provider_rows(t: Tables) -> DataFrame:
    """Raw provider rows of both loads: two rows per supplier."""
    nation = t.read("nation").select("n_nationkey", "n_name", "n_regionkey")
    region = t.read("region").select("r_regionkey", "r_name")
    supplier = (
        t.read("supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    balance = F.col("s_acctbal")

    def load(ts: str, least: int, specialty: Column, location: Column) -> DataFrame:
        return supplier.select(
            F.when(balance >= least, _text("s_suppkey")).alias("ProviderID"),
            specialty.alias("ProviderSpecialty"),
            location.alias("ProviderLocation"),
            *_audit(F.lit(ts), "supplier"),
        )

    first = load(FIRST_LOAD, 1000, F.col("n_name"), F.col("r_name"))
    second = load(
        SECOND_LOAD,
        0,
        F.when(balance >= 8000, F.concat(F.lit("SENIOR "), "n_name"))
        .when(balance >= 7000, F.lit(None))
        .otherwise(F.col("n_name")),
        F.when((balance >= 6000) & (balance < 6500), "REMOTE").otherwise(F.col("r_name")),
    )
    return _all(first, second)


def patient_feed(t: Tables) -> DataFrame:
    """Change rows of raw patients: insert, some updates, some deletes."""
    customer = t.read("customer")
    balance = F.col("c_acctbal")
    born = F.date_add(
        F.lit("1940-01-01").cast("date"), ((F.col("c_custkey") * 20) % 25000).cast("int")
    )

    def change(kind: str, version: int, marital: Column, least: float | None = None) -> DataFrame:
        changed = customer if least is None else customer.filter(balance >= least)
        return changed.select(
            F.when(balance >= 0, _text("c_custkey")).alias("ID"),
            F.when(F.col("c_nationkey") == 0, "unknown").otherwise(born.cast("string")).alias("BIRTHDATE"),
            F.lit(None).cast("string").alias("DEATHDATE"),
            F.concat(F.lit("999-"), _text("c_custkey")).alias("SSN"),
            F.concat(F.lit("S"), _text("c_custkey")).alias("DRIVERS"),
            F.concat(F.lit("X"), _text("c_custkey")).alias("PASSPORT"),
            F.lit("Mx.").alias("PREFIX"),
            F.col("c_name").alias("FIRST"),
            F.col("c_name").alias("LAST"),
            F.lit(None).cast("string").alias("SUFFIX"),
            F.lit(None).cast("string").alias("MAIDEN"),
            marital.alias("MARITAL"),
            F.concat(F.lit("race_"), _text("c_nationkey")).alias("RACE"),
            F.col("c_mktsegment").alias("ETHNICITY"),
            _choice("c_mktsegment", BUILDING="F", HOUSEHOLD="F", MACHINERY="M", AUTOMOBILE="M",
                    FURNITURE="U").alias("GENDER"),
            F.concat(F.lit("Town, "), _text("c_nationkey")).alias("BIRTHPLACE"),
            F.concat(_text("c_custkey"), F.lit(" Main Street, Springfield")).alias("ADDRESS"),
            *_audit(F.lit(FIRST_LOAD), "customer"),
            F.lit(kind).alias("_change_type"),
            F.lit(version).cast("long").alias("_commit_version"),
            F.lit(FIRST_LOAD).cast("timestamp").alias("_commit_timestamp"),
        )

    married = F.when(F.col("c_nationkey") < 12, "M").otherwise("S")
    return _all(
        change("insert", 1, married),
        change("update_preimage", 2, married, least=5000),
        change("update_postimage", 2, F.lit("W"), least=5000),
        change("delete", 3, F.lit("W"), least=9500),
    )


def encounter_feed(t: Tables) -> DataFrame:
    """Change rows of raw encounters: one insert per order, an update for dear ones."""
    orders = t.read("orders")
    price = F.col("o_totalprice")
    follow_up = F.col("o_orderstatus") == "F"
    unscheduled = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "4-NOT SPECIFIED")

    def change(rows: DataFrame, kind: str, version: int, code: Column) -> DataFrame:
        return rows.select(
            _text("o_orderkey").alias("ID"),
            F.when(unscheduled, "unscheduled").otherwise(_day_text("o_orderdate")).alias("DATE"),
            F.when(price >= 20000, _text("o_custkey")).alias("PATIENT"),
            code.alias("CODE"),
            F.col("o_orderpriority").alias("DESCRIPTION"),
            F.when(follow_up, "410429000").alias("REASONCODE"),
            F.when(follow_up, "Follow-up").alias("REASONDESCRIPTION"),
            *_audit(F.col("o_orderdate"), "orders"),
            F.lit(kind).alias("_change_type"),
            F.lit(version).cast("long").alias("_commit_version"),
            F.col("o_orderdate").cast("timestamp").alias("_commit_timestamp"),
        )

    return _all(
        change(orders, "insert", 1, F.col("o_orderstatus")),
        change(orders.filter(price >= 300000), "update_postimage", 2, F.lit("X")),
    )


def feedback_rows(t: Tables) -> DataFrame:
    """Raw feedback: two rows per feedback id, times with and without offset."""
    kind = F.col("event_type")
    written = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    score = (F.floor("value") % 5 + 1).cast("int")
    return t.read("events").select(
        F.expr("event_id div 2").cast("string").alias("feedback_id"),
        _text("user_id").alias("provider_id"),
        F.when(kind == "view", F.concat(written, F.lit("Z")))
        .when(kind == "click", F.concat(written, F.lit("-04:00")))
        .when(kind == "purchase", F.concat(written, F.lit("+0530")))
        .when(kind == "signup", written)
        .otherwise("not a time")
        .alias("timestamp"),
        F.when(kind == "error", F.lit(" ")).otherwise(
            (F.col("event_id") * 2).cast("string")
        ).alias("visit_id"),
        F.when(F.col("value") >= 1, score).alias("satisfaction_score"),
        F.concat(F.lit("comment on "), kind).alias("comments"),
        _choice("event_type", view="web_portal", click="mobile_app", purchase="in_clinic",
                signup="in_clinic").alias("source"),
        F.when(kind == "view", F.array(F.lit("staff")))
        .when(kind == "click", F.array(F.lit("parking"), F.lit("staff")))
        .when(kind == "signup", F.array(F.lit("wait_time"), F.lit("wait_time")))
        .when(kind == "purchase", F.array().cast("array<string>"))
        .alias("tags"),
        F.col("props").alias("metadata_json"),
        *_audit(F.col("ts"), "events"),
    )


def check_results(t: Tables) -> DataFrame:
    """Check results of many runs: one row per event, one run per day."""
    kind = F.col("event_type")
    return t.read("events").select(
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("run_ts"),
        F.when(kind.isin("view", "click"), "BRONZE")
        .when(kind == "purchase", "SILVER")
        .when(kind == "signup", "GOLD")
        .otherwise("OTHER")
        .alias("layer"),
        F.concat(F.lit("table_"), _text("user_id")).alias("table_name"),
        F.lit("row_count").alias("metric"),
        F.floor("value").cast("string").alias("value"),
        F.when((kind == "signup") | (F.col("value") >= 5), "PASS")
        .when(F.col("value") >= 1, "FAIL")
        .otherwise("ERROR")
        .alias("status"),
        F.lit(None).cast("string").alias("message"),
    )
