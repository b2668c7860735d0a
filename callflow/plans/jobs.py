"""Whole jobs: inputs to new table snapshots, exports and lists.

A job reads tables under ``tables`` and writes the ones it changes under ``out``,
a folder of its own, because files can not be replaced while they are read.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from callflow.functions.text import RECORD_SUFFIX, RECORDING_SUFFIX
from callflow.operators import export, joins, manifest, merge, normalize, quality, retention
from callflow.schemas import BOUNDED_TEXT, FOREIGN_KEYS, LOAD_KEYS, PRIMARY_KEYS
from callflow.session import written
from callflow.sources import batches, landing, listing
from callflow.sources.exports import ORDER, read_export
from callflow.sources.tables import read_table


def _write(df: DataFrame, out: str, name: str) -> None:
    df.write.parquet(f"{out}/{name}")


def _stored_once(normalized: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Parsed rows as a table that all outputs read, and how many there are.

    The text is parsed once; each output then reads the columns it needs.
    """
    counts = Observation("load")
    rejected = F.count(F.col(normalize.REASON)) if normalize.REASON in normalized.columns else F.lit(0)
    observed = normalized.observe(counts, F.count(F.lit(1)).alias("rows"), rejected.alias("rejects"))
    return written(observed, "normalized"), counts.get


def load_calls(
    spark: SparkSession, exports: str | list[str], tables: str, out: str, broker_id: Column | str | None = None
) -> dict[str, int]:
    """Call exports into ``call``, the leads they name into ``lead``, plus rejects and recordings."""
    export_rows = read_export(spark, exports)
    rows, counts = _stored_once(normalize.normalize_calls(export_rows, broker_id))
    good, rejects = normalize.split_rejects(rows)
    latest = written(merge.last_per_key(good.drop("recording", "names_lead"), "call_id"), "latest")
    _write(_replaced(read_table(spark, tables, "call"), latest, "call_id"), out, "call")
    leads = read_table(spark, tables, "lead")
    _write(merge.insert_absent(leads, normalize.leads_of_calls(rows), "lead_id"), out, "lead")
    _write(rejects.drop(ORDER), out, "rejects")
    named = rows.withColumnsRenamed({"call_id": "Call Id", "recording": "Recording"})
    if "Call Id" not in export_rows.columns:
        named = named.drop("Call Id")
    _write(manifest.wanted_of_export(named), out, "recordings")
    return counts


def load_leads(spark: SparkSession, exports: str | list[str], tables: str, out: str) -> dict[str, int]:
    rows, counts = _stored_once(normalize.normalize_leads(read_export(spark, exports)))
    good, rejects = normalize.split_rejects(rows)
    latest = written(merge.last_per_key(good, "lead_id"), "latest")
    _write(_replaced(read_table(spark, tables, "lead"), latest, "lead_id"), out, "lead")
    _write(rejects.drop(ORDER), out, "rejects")
    return counts


def load_brokers(
    spark: SparkSession, roster: str, tables: str, out: str, one_value: bool = False
) -> dict[str, int]:
    """Roster entries into ``broker``, replaced by name, or by id where there is no name."""
    rows, counts = _stored_once(normalize.normalize_brokers(batches.read_roster(spark, roster, one_value)))
    stored = read_table(spark, tables, "broker")
    _write(merge.upsert_brokers(stored, rows), out, "broker")
    return counts


def load_transcripts(
    spark: SparkSession, transcripts: str, tables: str, out: str, one_value: bool = False
) -> dict[str, int]:
    read = batches.read_transcripts(spark, transcripts, one_value)
    rows, counts = _stored_once(normalize.normalize_transcripts(read))
    _write(merge.upsert(read_table(spark, tables, "transcript"), rows, LOAD_KEYS["transcript"]), out, "transcript")
    return counts


def call_report(spark: SparkSession, tables: str, out: str) -> None:
    """Every call with its broker and transcript."""
    stored = [read_table(spark, tables, name) for name in ("call", "broker", "transcript")]
    joins.call_report(*stored).write.parquet(out)


def _replaced(target: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``latest``, which has one row per key."""
    kept = target.join(latest.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(latest, allowMissingColumns=True)


def _read_json(spark: SparkSession, path: str, one_per_file: bool) -> DataFrame:
    return landing.read_json(spark, path, one_per_file, RECORD_SUFFIX if one_per_file else "")


def land_pages(
    spark: SparkSession, pages: str, out: str, member: str, time_member: str, one_per_file: bool = True
) -> dict[str, str | None]:
    """Records of landed API pages as JSON lines by day; tells an unfinished fetch by its cursor.

    Each run lands in ``fetch=<id>`` of its own, so what was landed before stays.
    """
    fetch = f"fetch={uuid.uuid4().hex}"
    fetched, malformed = landing.split_objects(_read_json(spark, pages, one_per_file))
    order = F.struct(F.col("position"), F.col("place"))
    latest = written(export.latest_records(landing.page_records(fetched, member), order), "records")
    start = F.get_json_object("json", time_member)
    export.land_records(latest, f"{out}/records/{fetch}", F.substring(start, 1, 10))
    _write(malformed, out, f"malformed/{fetch}")
    cursor = landing.open_cursor(fetched).first()
    return {"cursor": cursor["cursor"] if cursor else None}


def export_records(
    spark: SparkSession,
    landed: str,
    out: str,
    time_member: str,
    only_recorded: bool = False,
    one_per_file: bool = True,
    strict: bool = False,
    files: int | None = None,
) -> None:
    """``id`` and start time of landed records as CSV. ``strict`` fails on malformed files.

    Lines may hold an id several times, once per fetch; the last one counts.
    """
    objects, malformed = landing.split_objects(_read_json(spark, landed, one_per_file))
    objects = objects if one_per_file else landing.latest_objects(objects)
    if strict and not malformed.isEmpty():
        raise ValueError("malformed records in the landing zone")
    export.write_projection(export.project_records(objects, time_member, only_recorded), out, files)


def pending_recordings(
    spark: SparkSession, landed: str, store: str, out: str, member: str, one_per_file: bool = True
) -> None:
    """Recordings that landed records name and the store lacks."""
    objects, _ = landing.split_objects(_read_json(spark, landed, one_per_file))
    stored = listing.stored_recordings(listing.list_objects(spark, store, RECORDING_SUFFIX))
    manifest.pending(manifest.wanted_of_records(objects, member), stored).write.parquet(out)


def split_export(
    spark: SparkSession, source: str, out: str, size: int = export.ROWS_PER_CHUNK, multi_line: bool = True
) -> None:
    """An export as files of at most ``size`` rows; without ``multi_line`` many tasks read a file."""
    export.write_chunks(read_export(spark, source, multi_line=multi_line), out, size)


def list_expired(spark: SparkSession, store: str, out: str, as_of: datetime) -> None:
    """Objects past retention, for a storage job to delete."""
    retention.split_by_age(listing.list_objects(spark, store), "modificationTime", as_of)[1].write.parquet(out)


def query(spark: SparkSession, tables: str, statement: str) -> DataFrame:
    """Rows of a SELECT over the six tables, named as they are."""
    for name in PRIMARY_KEYS:
        read_table(spark, tables, name).createOrReplaceTempView(name)
    return spark.sql(statement)


def insert_rows(spark: SparkSession, tables: str, name: str, rows: str, out: str) -> None:
    """Rows of a CSV whose headers are column names, appended without a look at keys."""
    added = normalize.as_table(read_export(spark, rows).drop(ORDER), name)
    _write(merge.append(read_table(spark, tables, name), added), out, name)


def update_rows(spark: SparkSession, tables: str, name: str, where: str, changes: dict[str, str], out: str) -> None:
    """``changes`` maps columns to SQL expressions, applied where ``where`` is true."""
    values = {column: F.expr(value) for column, value in changes.items()}
    _write(merge.update_where(read_table(spark, tables, name), F.expr(where), **values), out, name)


def delete_rows(spark: SparkSession, tables: str, name: str, where: str, out: str) -> None:
    _write(merge.delete_where(read_table(spark, tables, name), F.expr(where)), out, name)


def check_tables(spark: SparkSession, tables: str, out: str) -> None:
    """Broken keys, references and text bounds of the six tables, one report each."""
    stored = {name: read_table(spark, tables, name) for name in PRIMARY_KEYS}
    for name, key in PRIMARY_KEYS.items():
        _write(quality.broken_keys(stored[name], key), out, f"{name}_{key}_broken")
    for name, column, other in FOREIGN_KEYS:
        orphans = quality.orphan_keys(stored[name], column, stored[other], PRIMARY_KEYS[other])
        _write(orphans, out, f"{name}_{column}_orphans")
    for name in BOUNDED_TEXT:
        _write(quality.overlong_text(stored[name], PRIMARY_KEYS[name], name), out, f"{name}_overlong")
