"""Loads of exports as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from callflow.functions.text import EXPORT_TIME_FORMATS
from callflow.operators.manifest import wanted_of_export
from callflow.operators.merge import first_per_key, insert_absent, last_per_key, upsert
from callflow.operators.normalize import (
    leads_of_calls,
    normalize_calls,
    normalize_leads,
    split_rejects,
)
from callflow.schemas import TABLES
from callflow.session import work_cleaned, written
from callflow.sources.exports import FILES_PER_BATCH, ORDER, read_export
from callflow.sources.lines import read_by_line
from callflow.streaming import commits
from callflow.streaming.commits import LOAD
from callflow.streaming.loads import bad_files, load_arrivals

__all__ = [
    "bad_files", "changes", "current_calls", "current_leads", "leads_with_calls", "load_arrived_calls", "load_arrived_leads",
    "loads", "rejects", "wanted_recordings",
]

PLACE = "place"

REJECTS = StructType([StructField(name, StringType()) for name in ("reason", "raw")])
RECORDINGS = StructType([StructField(name, StringType()) for name in ("call_id", "url", "target_key")])


def _call_outputs(normalized: DataFrame, headers: Sequence[str]) -> dict[str, DataFrame]:
    good, rejects = split_rejects(normalized)
    place = F.col(ORDER).alias(PLACE)
    named = normalized.withColumnsRenamed({"call_id": "Call Id", "recording": "Recording"})
    if "Call Id" not in headers:  # in none of the files: their recordings share one name
        named = named.drop("Call Id")
    return {
        "calls": last_per_key(good.drop("recording", "names_lead").select("*", place), "call_id"),
        "new_leads": first_per_key(leads_of_calls(normalized).select("*", place), "lead_id"),
        "recordings": wanted_of_export(named, keep=PLACE),
        "rejects": rejects.drop(ORDER),
    }


def _lead_outputs(normalized: DataFrame, headers: Sequence[str]) -> dict[str, DataFrame]:
    good, rejects = split_rejects(normalized)
    placed = good.select("*", F.col(ORDER).alias(PLACE))
    return {"leads": last_per_key(placed, "lead_id"), "rejects": rejects.drop(ORDER)}


def _run(
    spark: SparkSession,
    arrivals: str,
    root: str,
    checkpoint: str,
    headers: Sequence[str] | None,
    normalized: Callable[[DataFrame], DataFrame],
    outputs: Callable[[DataFrame, Sequence[str]], dict[str, DataFrame]],
    row_order: Column | None,
    max_files: int,
    suffix: str,
) -> None:
    def write(load: str, files: list[tuple[str, int]]) -> list[str]:
        exports = read_export(spark, [path for path, _ in files], headers, by_line=read_by_line(spark, files))
        if row_order is not None:
            exports = exports.withColumn(ORDER, row_order)
        # parsed once, into a file that all outputs read
        with work_cleaned():
            rows = written(normalized(exports), "normalized")
            found = outputs(rows, exports.columns)
            for name, output in found.items():
                output.write.parquet(f"{root}/{name}/{LOAD}={load}")
        return list(found)

    load_arrivals(spark, arrivals, root, checkpoint, write, max_files, suffix)


def load_arrived_calls(
    spark: SparkSession,
    arrivals: str,
    root: str,
    checkpoint: str,
    broker_id: Column | str | None = None,
    headers: Sequence[str] | None = None,
    time_formats: Sequence[str] = EXPORT_TIME_FORMATS,
    row_order: Column | None = None,
    max_files: int = FILES_PER_BATCH,
    suffix: str = "",
) -> None:
    """Load every call export not loaded before; one arrival feeds all four outputs.

    Files of any age and, without ``suffix``, any name load, those of folders below too, and again when
    put again. Cells go by the header of their file; without ``Call Id`` its rows are rejects. A run with
    nothing new changes nothing. ``row_order`` replaces the order of files and rows
    where the export itself carries one. Each batch adds its own rows only: the
    tables are merged when read, see :func:`current_calls`.

    A load writes its outputs to folders of its own name and then one commit row that names them and
    its files; readers take committed loads only, so one that was killed shows nothing, and a file is
    loaded once as of each time and size. A file that cannot be read to its end is listed in
    :func:`bad_files` and loads when put again; the others of its batch load. A large file whose lines
    are its rows is read by many tasks, one with line breaks inside cells by one.
    """

    def normalized(rows: DataFrame) -> DataFrame:
        return normalize_calls(rows, broker_id, time_formats)

    _run(spark, arrivals, root, checkpoint, headers, normalized, _call_outputs, row_order, max_files, suffix)


def load_arrived_leads(
    spark: SparkSession,
    arrivals: str,
    root: str,
    checkpoint: str,
    headers: Sequence[str] | None = None,
    time_formats: Sequence[str] = EXPORT_TIME_FORMATS,
    row_order: Column | None = None,
    max_files: int = FILES_PER_BATCH,
    suffix: str = "",
) -> None:
    """Load every lead export not loaded before, see :func:`load_arrived_calls`."""

    def normalized(rows: DataFrame) -> DataFrame:
        return normalize_leads(rows, time_formats)

    _run(spark, arrivals, root, checkpoint, headers, normalized, _lead_outputs, row_order, max_files, suffix)


def _stored(spark: SparkSession, root: str, output: str, schema: StructType) -> DataFrame:
    """Rows of an output in all committed loads, with their load."""
    found = commits.outputs_of(spark, root, output, schema)
    return found if PLACE in found.columns else found.withColumn(PLACE, F.lit(0))


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows that stand in files and, of a file loaded twice as of one time, in loads."""
    return rows.withColumn(PLACE, F.struct(PLACE, LOAD)).drop(LOAD)


def changes(
    spark: SparkSession, root: str, output: str, table: str, done: Sequence[str] = ()
) -> DataFrame:
    """Stored rows of an output with their ``load`` and ``place``, without the loads in ``done``."""
    rows = _stored(spark, root, output, TABLES[table])
    return rows.filter(~F.col(LOAD).isin(*done)) if done else rows


def loads(spark: SparkSession, root: str, output: str) -> list[str]:
    """The names of the loads committed so far, one per batch."""
    return commits.loads_of(spark, root, output)


def current_calls(
    spark: SparkSession, root: str, base: DataFrame | None = None, done: Sequence[str] = ()
) -> DataFrame:
    """The call table after all loads: of a call, the row that stands last counts.

    Files stand by their time, whatever order they were loaded in. ``base`` is a snapshot
    that holds the loads in ``done``. Writing this result now and then as the next
    snapshot keeps the part to merge small.
    """
    later = _in_order(changes(spark, root, "calls", "call", done))
    return last_per_key(later, "call_id", PLACE) if base is None else upsert(base, later, "call_id", PLACE, False)


def current_leads(
    spark: SparkSession, root: str, base: DataFrame | None = None, done: Sequence[str] = ()
) -> DataFrame:
    """The lead table after all lead loads, see :func:`current_calls`."""
    later = _in_order(changes(spark, root, "leads", "lead", done))
    return last_per_key(later, "lead_id", PLACE) if base is None else upsert(base, later, "lead_id", PLACE, False)


def leads_with_calls(spark: SparkSession, calls_root: str, leads: DataFrame, done: Sequence[str] = ()) -> DataFrame:
    """``leads`` plus those that only calls name, as the first call named them."""
    return insert_absent(leads, _in_order(changes(spark, calls_root, "new_leads", "lead", done)), "lead_id", PLACE)


def rejects(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, root, "rejects", REJECTS).select(*REJECTS.names)


def wanted_recordings(spark: SparkSession, root: str) -> DataFrame:
    """``call_id, url, target_key`` of all loads, the last address of each call."""
    return last_per_key(_in_order(_stored(spark, root, "recordings", RECORDINGS)), "call_id", PLACE)

