"""JSON landing zone: single records and pages of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callflow.functions import records
from callflow.functions.text import RECORD_SUFFIX, stable_id
from callflow.operators.merge import last_per_key
from callflow.sources.exports import ORDER, position

PAGE_SIZE = 100  # fixed value: records per full page


def read_json(
    spark: SparkSession, path: str | list[str], one_per_file: bool = True, suffix: str = RECORD_SUFFIX
) -> DataFrame:
    """``path, position, record, raw`` of every JSON value; ``record`` NULL if malformed.

    ``one_per_file`` reads a file as one value. Otherwise each line is a value,
    the layout :func:`callflow.operators.export.land_records` writes, which large
    inputs should use: its files can be split.
    """
    reader = spark.read.option("recursiveFileLookup", one_per_file)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    lines = reader.text(path, wholetext=one_per_file).select(
        F.col("_metadata.file_path").alias("path"), position().alias("position"), F.col("value").alias("raw")
    )
    return records.with_record(lines, F.col("raw"))


def split_objects(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(objects, malformed)``; valid values that are no objects are in neither."""
    objects = F.col("record").isNotNull() & records.is_object_text(F.col("raw"))
    return values.filter(objects).drop("raw"), values.filter(F.col("record").isNull()).select("path", "raw")


def latest_objects(objects: DataFrame) -> DataFrame:
    """One object per id, the last landed; all of those without an id.

    Needed where several fetches are read together: each lands what it got.
    """
    keyed = objects.withColumn("_id", F.nullif(records.member(F.col("record"), records.RECORD_ID), F.lit("")))
    last = keyed.filter(F.col("_id").isNotNull()).withColumn(ORDER, F.col("position"))
    nameless = keyed.filter(F.col("_id").isNull())
    return last_per_key(last, "_id").unionByName(nameless).drop("_id")


def page_records(pages: DataFrame, member: str = records.TELEPHONY_RECORDS) -> DataFrame:
    """One row per record of each page: ``path, position, place, record``.

    ``pages`` holds the page as VARIANT in ``record``. Pages without records,
    or whose member is no array, give no rows.
    """
    listed = records.member(F.col("record"), member, "array<variant>")
    return pages.select("path", "position", F.posexplode(listed).alias("place", "record"))


def record_id(record: Column, *natural_key: Column) -> Column:
    """The record's id. A record without one gets a stable id of where it stood."""
    given = F.nullif(records.member(record, records.RECORD_ID), F.lit(""))
    return F.coalesce(given, stable_id(*natural_key))


def open_cursor(pages: DataFrame, order: str = "position") -> DataFrame:
    """The cursor on the last landed page, if it has one: the fetch is incomplete."""
    cursor = F.nullif(records.member(F.col("record"), records.TELEPHONY_NEXT_PAGE), F.lit(""))
    last = pages.agg(F.max_by(F.struct(cursor.alias("cursor")), F.col(order)).alias("last"))
    return last.select("last.cursor").filter(F.col("cursor").isNotNull())


def numbered_pages_complete(pages: DataFrame, number: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """``last_page, complete``: whether the highest page is short, so the feed ended."""
    size = F.coalesce(F.size(records.member(F.col("record"), records.TRACKING_RECORDS, "array<variant>")), F.lit(0))
    return pages.agg(
        F.max(number).alias("last_page"), F.max_by(size < page_size, F.col(number)).alias("complete")
    )


def select_extra_fields(record: Column) -> list[Column]:
    """The additional call-tracking members as text columns."""
    return [records.member(record, f"$.{name}").alias(name) for name in records.TRACKING_EXTRA_FIELDS]
