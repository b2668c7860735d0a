"""Header lines of CSV files, from the first bytes of each file."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callflow.sources.listing import list_objects
from callflow.sources.storage import opened, qualified, reachable

#: Bytes of a file that are asked for at once.
STEP = 1 << 16
#: Endings of compressed files that Arrow reads as Spark does.
PACKED = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}
#: Endings that only Hadoop's codecs read.
HADOOP_ONLY = (".deflate", ".snappy", ".lz4")
HEADS = "path string, modified timestamp_ltz, names array<string>, error string"


def packing(path: str) -> str | None:
    return next((kind for end, kind in PACKED.items() if path.lower().endswith(end)), None)


def first_record(read) -> str | None:
    """The first line that is not empty, up to a line end outside quotes; None if there is none.

    ``read(n)`` gives the next bytes. What is read beyond the line is less than a step.
    """
    data, at = b"", 0
    quoted, start = False, 0
    while True:
        more = read(STEP)
        data += more
        while at < len(data):
            c = data[at]
            if c == 0x22:
                quoted = not quoted
            elif c in (0x0A, 0x0D) and not quoted:
                line = data[start:at].decode("utf-8", "replace").removeprefix("﻿")
                if line:
                    return line
                start = at + 1
            at += 1
        if not more:
            line = data[start:].decode("utf-8", "replace").removeprefix("﻿")
            return line or None


def column_names(line: str) -> list[str]:
    """The cells of a header; a name that is empty or was there before is numbered."""
    names: list[str] = []
    for k, name in enumerate(next(csv.reader(io.StringIO(line, newline="")), [])):
        names.append(name if name and name not in names else f"_{k}_{name}")
    return names


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, errors = [], []
        for path in batch["path"].to_pylist():
            line = error = None
            try:
                system, inner = opened(path)
                if kind := packing(path):
                    with system.open_input_stream(inner, compression=kind, buffer_size=STEP) as stream:
                        line = first_record(stream.read)
                else:
                    with system.open_input_file(inner) as file:
                        line = first_record(file.read)
            except (OSError, pa.ArrowException) as problem:
                error = str(problem)
            names.append(column_names(line) if line is not None else None)
            errors.append(error)
        yield pa.RecordBatch.from_arrays(
            [batch["path"], batch["modified"], pa.array(names, pa.list_(pa.string())), pa.array(errors, pa.string())],
            names=["path", "modified", "names", "error"],
        )


def file_heads(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path, modified, names, error`` of every file in ``paths`` and below.

    Tasks ask for the first 64 KiB of each file, and for more only while the header has not ended.
    ``names`` is null for a file without a line, ``error`` tells why one could not be read. Where
    Arrow knows neither scheme nor compression the first lines come from Spark's text reader.
    """
    some = [paths] if isinstance(paths, str) else paths
    listed = list_objects(spark, paths).select("path", F.col("modificationTime").alias("modified"))
    if not all(reachable(qualified(spark, p)) for p in some):
        return _heads_by_spark(spark, paths)
    odd = F.lower("path").rlike("[.](" + "|".join(e[1:] for e in HADOOP_ONLY) + ")$")
    heads = listed.filter(~odd).mapInArrow(_heads, HEADS)
    rest = [r["path"] for r in listed.filter(odd).collect()]
    return heads.unionByName(_heads_by_spark(spark, rest)) if rest else heads


def _heads_by_spark(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", True).text(paths).filter("value != ''")
    placed = lines.select(
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    found = placed.filter("block = 0").groupBy("path", "modified").agg(F.min_by("value", "row").alias("line"))
    return found.mapInArrow(_named, HEADS)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [column_names(line.removeprefix("﻿")) for line in batch["line"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["path"], batch["modified"], pa.array(names, pa.list_(pa.string())), pa.nulls(len(names), pa.string())],
            names=["path", "modified", "names", "error"],
        )


def _read_through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        errors = []
        for path in batch["path"].to_pylist():
            error = None
            try:
                system, inner = opened(path)
                with system.open_input_stream(inner, compression=packing(path)) as stream:
                    while stream.read(1 << 20):
                        pass
            except (OSError, EOFError, pa.ArrowException) as problem:
                error = str(problem) or type(problem).__name__
            errors.append(error)
        yield pa.RecordBatch.from_arrays([batch["path"], pa.array(errors, pa.string())], names=["path", "error"])


def unreadable(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, error`` of those files that cannot be read to their end."""
    named = spark.createDataFrame([(p,) for p in paths], "path string")
    spread = named.repartition(max(1, min(len(paths), 1 << 10)), "path")
    return spread.mapInArrow(_read_through, "path string, error string").filter("error IS NOT NULL")
