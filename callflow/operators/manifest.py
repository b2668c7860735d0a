"""Recordings that are wanted and those still to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callflow.functions import records, text
from callflow.operators.filters import has_recording, has_web_recording
from callflow.operators.merge import lacking, last_per_key
from callflow.sources.exports import ORDER


def _manifest(rows: DataFrame, order: str) -> DataFrame:
    """One row per call, its last address, with the key the recording is stored under."""
    return last_per_key(rows, "call_id", order).withColumn("target_key", text.recording_key(F.col("call_id")))


def wanted_of_export(rows: DataFrame, order: str = ORDER, keep: str | None = None) -> DataFrame:
    """``call_id, url, target_key`` from export rows with a web address.

    Rows without a call id have no key to store under and are left to the load's
    rejects, unless the export has no such header at all: then all share one name.
    ``keep`` names a column to carry where each row stood.
    """
    call_id = text.field(rows, "Call Id") if "Call Id" in rows.columns else F.lit(text.UNKNOWN_CALL)
    url = text.field(rows, "Recording")
    kept = [F.col(order).alias(keep)] if keep else []
    listed = rows.select(call_id.alias("call_id"), url.alias("url"), order, *kept)
    return _manifest(listed.filter(has_web_recording(F.col("url")) & F.col("call_id").isNotNull()), order)


def wanted_of_records(
    landed: DataFrame, path: str = records.TELEPHONY_RECORDING, order: str = "position"
) -> DataFrame:
    """``call_id, url, target_key`` from landed records with an address."""
    record: Column = F.col("record")
    listed = landed.select(
        records.member(record, records.RECORD_ID).alias("call_id"), records.member(record, path).alias("url"), order
    )
    return _manifest(listed.filter(has_recording(F.col("url")) & F.col("call_id").isNotNull()), order)


def pending(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Wanted recordings that are not among the ``call_id`` values of ``stored``, evaluated once."""
    return lacking(wanted, stored, "call_id")
