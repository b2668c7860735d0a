"""Joins of a large side with a side that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unique(rows: DataFrame, unique: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``rows`` joined with ``unique`` by ``left`` or ``left_anti``.

    A plain join: Catalyst broadcasts a small ``unique``, and beyond that adaptive
    execution splits the tasks of a key, or of NULL, that many rows share. Where
    ``unique`` holds a key twice, its rows all meet, however common the key is.
    """
    if how not in ("left", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    return rows.join(unique.select(key) if how == "left_anti" else unique, key, how)


def call_report(calls: DataFrame, brokers: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Each call with its broker and transcript, NULL where there is none.

    Calls and transcripts are both unique by call. Tenure is not recorded for any
    broker and is NULL.
    """
    spoken = transcripts.filter(F.col("call_id").isNotNull()).select("call_id", "transcript")
    joined = join_unique(calls, brokers, "broker_id").join(spoken, "call_id", "left")
    # The columns of the report in order.
    return joined.select(
        "call_id",
        "call_platform",
        "broker_id",
        "lead_id",
        "call_type",
        "call_forwarded",
        "date_time",
        "talk_time",
        "outcome",
        "transcript",
        "broker_name",
        "phonenumber",
        "email",
        "extension",
        "state",
        "role",
        F.lit(None).cast("string").alias("broker_tenure"),
    )
