"""Roster and transcript batches in JSON or CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callflow.functions.text import CSV_SUFFIX
from callflow.sources.exports import ORDER, position, read_export, text_schema

# Members of a roster entry and of a transcript.
ROSTER_FIELDS = ("name", "phoneNumber", "email", "extension", "state", "role")
TRANSCRIPT_FIELDS = ("call_id", "transcript")


def _read(spark: SparkSession, path: str, fields: tuple[str, ...], one_value: bool, multi_line: bool) -> DataFrame:
    if path.lower().endswith(CSV_SUFFIX):
        return read_export(spark, path, fields, multi_line)
    reader = spark.read.schema(text_schema(fields)).option("multiLine", one_value)
    return reader.json(path).withColumn(ORDER, position())


def read_roster(spark: SparkSession, path: str, one_value: bool = False, multi_line: bool = False) -> DataFrame:
    """Roster entries from CSV or JSON lines, which many tasks can read.

    ``one_value`` reads each JSON file as one array, ``multi_line`` CSV cells with line
    breaks; both need a task per file.
    """
    return _read(spark, path, ROSTER_FIELDS, one_value, multi_line)


def read_transcripts(spark: SparkSession, path: str, one_value: bool = False, multi_line: bool = False) -> DataFrame:
    """Transcripts from CSV or JSON lines, see :func:`read_roster`."""
    return _read(spark, path, TRANSCRIPT_FIELDS, one_value, multi_line)
