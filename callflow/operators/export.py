"""Sinks: landed records, projected CSV and CSV in numbered chunks."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callflow.functions import records, text
from callflow.operators.merge import last_per_key
from callflow.operators.running import block_starts
from callflow.session import written
from callflow.sources.exports import ORDER, write_options
from callflow.sources.landing import record_id

ROWS_PER_CHUNK = 2000  # fixed value: default size of a chunk


def latest_records(listed: DataFrame, order: Column, keep: str | None = None) -> DataFrame:
    """``id, record`` with the last record of each id; ``listed`` comes from pages.

    ``keep`` names a column to carry where each record stood. The record travels as text: VARIANT values can not be compared or shuffled
    by every operator.
    """
    record = F.col("record")
    made = record_id(record, F.col("path"), F.col("place").cast("string"))
    rows = listed.select(
        made.alias("id"),
        records.with_id(record, made).alias("json"),
        order.alias(ORDER),
        *([order.alias(keep)] if keep else []),
    )
    return last_per_key(rows, "id")


def land_records(latest: DataFrame, path: str, day: Column) -> None:
    """Write ``latest`` as JSON lines under ``dt=<day>``, many records to a file.

    ``path`` must be new: a fetch lands in a folder of its own and overwrites nothing.
    The rebalance splits a day with a large share of the rows over several tasks.
    """
    rows = latest.select(F.col("json").alias("value"), day.alias("dt"))
    rows.hint("rebalance", "dt").write.partitionBy("dt").text(path)


def project_records(landed: DataFrame, time_member: str, only_recorded: bool = False) -> DataFrame:
    """``id`` and the start time of landed objects, named as in the record."""
    record = F.col("record")
    if only_recorded:
        landed = landed.filter(records.truthy(record, records.TRACKING_RECORDING))
    return landed.select(
        records.member(record, records.RECORD_ID).alias("id"),
        records.member(record, time_member).alias(time_member.removeprefix("$.")),
    )


def write_projection(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Write CSV with a header; no rows at all is an error.

    ``files=1`` gives the single file of a small export. By default each task
    writes its own.
    """
    if rows.isEmpty():
        raise ValueError("no valid data to write")
    if files:
        rows = rows.coalesce(files)
    rows.write.options(**write_options()).csv(path)


def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their file, split and id, and where each split starts, one row per split."""
    placed = rows.select("*", *[F.col(f"{ORDER}.{c}").alias(f"_{c}") for c in ("path", "block", "row")])
    return placed, block_starts(placed, "_path", "_block", "_row", F.lit(1))


def _numbered(rows: DataFrame, placed: DataFrame, starts: DataFrame) -> DataFrame:
    index = F.col("before") + F.col("_row") - F.col("first_row")
    return placed.join(starts, ["_path", "_block"]).select(*rows.columns, index.alias("row_index"))


def number_export_rows(rows: DataFrame) -> DataFrame:
    """``row_index`` from 0 in file order, for each file of an export scan.

    Ids rise by one inside a split, so the place in a file is the id less the split's
    first one, plus the rows of earlier splits: counts only, no row is shuffled or sorted.
    """
    return _numbered(rows, *_placed(rows))


def number_rows(rows: DataFrame, *order: str) -> DataFrame:
    """``row_index`` from 0 over all rows, sorted by ``order``, which should be total.

    Rows are range-partitioned and sorted, then written, so that numbering reads
    the same partitions twice.
    """
    in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id holds the partition above bit 33 and the place in it below
    place = F.monotonically_increasing_id()
    stored = written(in_order.withColumn("_row", place), "numbered")
    stored = stored.withColumn("_source", F.lit(0)).withColumn("_block", F.shiftright("_row", 33))
    starts = block_starts(stored, "_source", "_block", "_row", F.lit(1)).drop("_source")
    index = F.col("before") + F.col("_row") - F.col("first_row")
    return stored.join(starts, "_block").select(*rows.columns, index.alias("row_index"))


def chunk_number(row_index: Column, size: int = ROWS_PER_CHUNK) -> Column:
    """Chunk of a row, from 1."""
    return (F.floor(row_index / size) + 1).cast("int")


def write_chunks(rows: DataFrame, path: str, size: int = ROWS_PER_CHUNK) -> None:
    """Write an export scan as CSV files of at most ``size`` rows in input order.

    Each chunk is one file with a header in the folder ``chunk=<key>``, its key the
    path of the input below the folder that all inputs share, as
    ``<base>-part<n>.csv``: files of one name in two folders stay apart. One shuffle.
    """
    columns = [c for c in rows.columns if c != ORDER]
    part = chunk_number(F.col("row_index"), size)
    placed, starts = _placed(rows)
    first, last = starts.agg(F.min("_path"), F.max("_path")).first()
    root = os.path.commonprefix([first or "", last or ""]).rpartition("/")[0]
    named = _numbered(rows, placed, starts).withColumn("chunk", text.chunk_key(F.col(f"{ORDER}.path"), part, root))
    placed = named.repartition("chunk").sortWithinPartitions("chunk", "row_index")
    placed.select(*columns, "chunk").write.partitionBy("chunk").options(**write_options()).csv(path)


def chunk_counts(numbered: DataFrame, size: int = ROWS_PER_CHUNK) -> DataFrame:
    return numbered.groupBy(chunk_number(F.col("row_index"), size).alias("part")).agg(F.count(F.lit(1)).alias("n"))
