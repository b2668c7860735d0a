"""The engine's inputs, derived from the given tables.

Keys of the given tables are unique and their values clean, so the derived
exports repeat call ids and carry empty cells, NULL texts, broken numbers and
broken durations on whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callflow.functions.records import TRACKING_EXTRA_FIELDS
from callflow.operators.normalize import as_table, normalize_brokers
from callflow.sources.exports import ORDER


# Extra members of the call-tracking feed that no column of ``orders`` stands for; half of the records have each.
MADE_FIELDS = [f for f in TRACKING_EXTRA_FIELDS if f not in ("campaign", "lead_status", "person_id")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(column) -> F.Column:
    return column.cast("string")


def call_export(events: DataFrame) -> DataFrame:
    """``events`` as rows of a dialer's call history, all cells text."""
    event, user = F.col("event_id"), F.col("user_id")
    cell, minute = event % 50, event % 40
    lead = (
        F.when(cell == 0, "").when(cell == 1, "NULL").when(cell == 2, "abc").when(cell == 3, "12.5")
    ).otherwise(_text(user))
    duration = (
        F.when(minute == 0, "")
        .when(minute == 1, "1:2")
        .when(minute == 2, "0:00:00")
        .when(minute == 3, "x:y:z")
        .when(minute == 4, "1:2:3:4")
        .otherwise(F.concat_ws(":", _text(event % 3), _text(event % 60), _text(user % 60)))
    )
    recording = (
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("https://rec.example/"), _text(event)))
        .when(F.col("event_type") == "error", "")
        .otherwise(F.concat(F.lit("pending "), _text(event)))
    )
    return events.select(
        F.when(event % 97 == 0, "").otherwise(_text(event % 4000)).alias("Call Id"),
        lead.alias("Lead Id"),
        F.col("event_type").alias("Origin"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Time"),
        duration.alias("Call Duration (hrs:min:sec)"),
        recording.alias("Recording"),
        event.alias(ORDER),
    )


def broker_of_call(lead_text: str = "Lead Id") -> F.Column:
    """The broker of an exported call, by the lead; not every lead has one."""
    lead = F.coalesce(F.col(f"`{lead_text}`"), F.lit(""))  # a file gives back '' as NULL
    return F.md5(F.concat(F.lit("Supplier#"), F.lpad(lead, 9, "0")))


def roster(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """``supplier`` as the broker roster."""
    key = F.col("s_suppkey")
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("+1555"), F.lpad(_text(key), 7, "0")).alias("phoneNumber"),
        F.concat(F.lit("broker"), _text(key), F.lit("@example.com")).alias("email"),
        _text(key % 200).alias("extension"),
        F.col("n_name").alias("state"),
        F.when(F.col("s_acctbal") > 5000, "Sr").otherwise("Jr").alias("role"),
        key.alias(ORDER),
    )


def brokers(spark: SparkSession, folder: str) -> DataFrame:
    return normalize_brokers(roster(table(spark, folder, "supplier"), table(spark, folder, "nation")))


def transcript_rows(conversations: DataFrame) -> DataFrame:
    """What is said, turn by turn; the last turn of a call is its transcript."""
    return conversations.select(
        _text(F.col("conv_id")).alias("call_id"), F.col("text").alias("transcript"), F.col("turn").alias(ORDER)
    )


def customer_leads(customer: DataFrame) -> DataFrame:
    """``customer`` as the stored lead table."""
    return as_table(
        customer.select(F.col("c_custkey").alias("lead_id"), F.col("c_mktsegment").alias("source")), "lead"
    )


def supplier_leads(supplier: DataFrame) -> DataFrame:
    """``supplier`` as a stored lead table that lacks some of the called leads."""
    return as_table(supplier.select(F.col("s_suppkey").alias("lead_id"), F.col("s_name").alias("source")), "lead")


def lead_export(events: DataFrame) -> DataFrame:
    """``events`` as rows of a lead export; leads repeat."""
    return events.select(
        _text(F.col("user_id")).alias("Id"),
        F.col("event_type").alias("Lead Source"),
        F.when(F.col("value") > 20, "NULL").otherwise("Open").alias("Status"),
        _text(F.floor("value").cast("bigint")).alias("Lead Score #"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Date Added"),
        F.col("event_id").alias(ORDER),
    )


def telephony_pages(events: DataFrame, size: int = 100) -> DataFrame:
    """``events`` as landed pages of at most ``size`` records: ``number, text``."""
    record = F.struct(
        F.col("event_id").alias("place"),
        _text(F.col("event_id") % 4000).alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("startTime"),
        F.when(F.col("event_type") == "purchase", F.struct(F.col("props").alias("contentUri"))).alias("recording"),
    )
    pages = events.groupBy(F.floor(F.col("event_id") / size).alias("number")).agg(
        F.array_sort(F.collect_list(record)).alias("records")
    )
    next_page = F.struct(F.struct(_text(F.col("number") + 1).alias("uri")).alias("nextPage"))
    return pages.select("number", F.to_json(F.struct("records", next_page.alias("navigation"))).alias("text"))


def tracking_pages(orders: DataFrame, size: int = 100) -> DataFrame:
    """``orders`` as landed pages of a call-tracking feed: ``number, text``, from page 1."""
    record = F.struct(
        F.col("o_orderkey").alias("place"),
        _text(F.col("o_orderkey")).alias("id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_time"),
        F.when(F.col("o_orderstatus") == "F", F.lit("https://rec.example/")).alias("recording"),
        F.col("o_orderpriority").alias("campaign"),
        F.col("o_orderstatus").alias("lead_status"),
        F.col("o_custkey").alias("person_id"),
        *[
            F.when(F.col("o_orderkey") % 2 == k % 2, F.concat(F.lit(f"{name} "), _text(F.col("o_orderkey")))).alias(name)
            for k, name in enumerate(MADE_FIELDS)
        ],
    )
    pages = orders.groupBy((F.floor(F.col("o_orderkey") / size) + 1).alias("number")).agg(
        F.array_sort(F.collect_list(record)).alias("calls")
    )
    return pages.select("number", F.to_json(F.struct("calls")).alias("text"))


def landed_files(events: DataFrame) -> DataFrame:
    """``events`` as landed JSON values, some of them broken or no objects: ``event_id, text``."""
    kind, props = F.col("event_type"), F.col("props")
    text = (
        F.when(kind == "error", F.concat(props, F.lit("}")))
        .when(kind == "signup", F.concat(F.lit("["), props, F.lit("]")))
        .otherwise(props)
    )
    return events.select("event_id", text.alias("text"))
