"""Landed API pages as a stream: their records, the cursor where the fetch stands, and snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callflow.functions import records
from callflow.functions.text import RECORD_SUFFIX
from callflow.operators import export
from callflow.operators.merge import last_per_key
from callflow.session import work_cleaned, written
from callflow.sources import landing
from callflow.sources.exports import FILES_PER_BATCH, ORDER, POSITION
from callflow.sources.storage import literal
from callflow.streaming import commits
from callflow.streaming.commits import LOAD
from callflow.streaming.loads import load_arrivals

RECORDS, CURSORS, MALFORMED, SNAPSHOT = "records", "cursors", "malformed", "snapshot"
PLACE = "place"
LANDED = f"id string, json string, day string, {PLACE} struct<page: {POSITION}, place: int>"


def land_arrived_pages(
    spark: SparkSession,
    arrivals: str,
    root: str,
    checkpoint: str,
    member: str = records.TELEPHONY_RECORDS,
    time_member: str = records.TELEPHONY_START,
    max_files: int = FILES_PER_BATCH,
    suffix: str = RECORD_SUFFIX,
    one_per_file: bool = True,
) -> None:
    """Land the records of every page file that has not been landed, see :func:`load_arrivals`.

    A load holds the last record of each id in its pages, with where it stood, the pages' cursors, and
    values that are no JSON. It reads nothing that was landed before. ``one_per_file`` as for ``read_json``.
    """

    def write(load: str, files: list[tuple[str, int]]) -> list[str]:
        with work_cleaned():
            values = landing.read_json(spark, [literal(path) for path, _ in files], one_per_file, suffix="")
            pages, malformed = landing.split_objects(values)
            listed = landing.page_records(pages, member)
            placed = F.struct(F.col("position").alias("page"), F.col("place"))
            latest = written(export.latest_records(listed, placed, keep=PLACE), "records")
            day = F.substring(F.get_json_object("json", time_member), 1, 10)
            latest.select("id", "json", day.alias("day"), PLACE).write.parquet(f"{root}/{RECORDS}/{LOAD}={load}")
        cursor = F.nullif(records.member(F.col("record"), records.TELEPHONY_NEXT_PAGE), F.lit(""))
        pages.select("position", cursor.alias("cursor")).write.parquet(f"{root}/{CURSORS}/{LOAD}={load}")
        malformed.write.parquet(f"{root}/{MALFORMED}/{LOAD}={load}")
        return [RECORDS, CURSORS, MALFORMED]

    load_arrivals(spark, arrivals, root, checkpoint, write, max_files, suffix)


def open_cursor(spark: SparkSession, root: str) -> DataFrame:
    """The cursor on the last page landed so far, if it has one: the fetch goes on there."""
    rows = commits.outputs_of(spark, root, CURSORS, f"position {POSITION}, cursor string")
    last = rows.agg(F.max_by(F.struct("cursor"), "position").alias("last"))
    return last.select("last.cursor").filter("cursor IS NOT NULL")


def malformed(spark: SparkSession, root: str) -> DataFrame:
    """``path, raw`` of landed values that are no JSON."""
    return commits.outputs_of(spark, root, MALFORMED, "path string, raw string").select("path", "raw")


def _last(rows: DataFrame) -> DataFrame:
    return last_per_key(rows.withColumn(ORDER, F.col(PLACE)), "id")


def current_records(spark: SparkSession, root: str) -> DataFrame:
    """``id, json, day, place``: of each id the record that stands last in the pages landed so far.

    Loads that the last snapshot holds are not read again: records of later loads are ranked with
    the snapshot's records of the same ids, and its other records stay where they lie.
    """
    state = commits.committed(spark, root).filter(F.array_contains("outputs", SNAPSHOT))
    last = state.agg(F.max_by(F.struct(LOAD, "merged"), LOAD).alias("last")).first()["last"]
    rows = commits.outputs_of(spark, root, RECORDS, LANDED)
    if last is None:
        return _last(rows.select("id", "json", "day", PLACE))
    held = commits.committed(spark, root).filter(F.col(LOAD) == last[LOAD]).select(F.explode("merged").alias(LOAD))
    later = written(rows.join(held, LOAD, "left_anti").select("id", "json", "day", PLACE), "later")
    base = spark.read.parquet(f"{root}/{SNAPSHOT}/{LOAD}={last[LOAD]}").select("id", "json", "day", PLACE)
    ids = later.select("id").distinct()
    touched = _last(base.join(ids, "id", "left_semi").select(*later.columns).unionByName(later))
    return base.join(ids, "id", "left_anti").select(*later.columns).unionByName(touched)


def compact(spark: SparkSession, root: str) -> None:
    """Write :func:`current_records` as a snapshot, whose commit row names the loads it holds.

    Reading then ranks later loads only. Loads stay, so a snapshot that was killed costs nothing.
    """
    held = commits.loads_of(spark, root, RECORDS)
    load = commits.new_load(spark, root)
    current_records(spark, root).write.parquet(f"{root}/{SNAPSHOT}/{LOAD}={load}")
    commits.commit(spark, root, load, [SNAPSHOT], [], held)
