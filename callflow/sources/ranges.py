"""CSV files by ranges of bytes: where the rows of each range start, and reading from a row on."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callflow.session import written
from callflow.sources.exports import file_headers
from callflow.sources.heads import packing
from callflow.sources.listing import list_objects
from callflow.sources.storage import opened

#: Bytes of a range: what one task reads at once, about.
RANGE = 64 << 20
#: Bytes asked for at once.
STEP = 1 << 20
LINES = "path string, begin bigint, row bigint, value string"


def _lines(path: str, begin: int, end: int) -> Iterator[bytes]:
    """The lines that start in ``[begin, end)``, without their ends; empty ones are left out."""
    system, inner = opened(path)
    kind = packing(path)
    with system.open_input_stream(inner, compression=kind) if kind else system.open_input_file(inner) as file:
        if begin:
            file.seek(begin - 1)  # a line starts at begin if the byte before ends one
        rest, at, skip = b"", begin - 1 if begin else 0, bool(begin)
        while True:
            more = file.read(STEP)
            data = rest + more
            start = 0
            while True:
                cut = data.find(b"\n", start)
                if cut < 0:
                    break
                if skip:
                    skip = False
                elif at + start >= end:
                    return
                elif line := data[start:cut].removesuffix(b"\r"):
                    yield line
                start = cut + 1
            rest, at = data[start:], at + start
            if not more:
                if rest and not skip and at < end:
                    yield rest
                return
            if not skip and at >= end:
                return


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = zip(*(batch[c].to_pylist() for c in ("path", "begin", "end")), strict=True)
        rows = [sum(1 for _ in _lines(*span)) for span in spans]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.int64())], names=[*batch.schema.names, "rows"])


def _emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "begin", "row", "value"]
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("path", "begin", "end", "before", "wanted"))
        for path, begin, end, before, wanted in zip(*columns, strict=True):
            rows, size = [], 0
            for k, line in enumerate(_lines(path, begin, end)):
                if before + k <= wanted:  # row 0 is the header
                    continue
                rows.append((path, begin, before + k - 1, line.decode("utf-8", "replace")))
                size += len(line)
                if size > STEP:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)


def row_starts(spark: SparkSession, paths: str | list[str], size: int = RANGE) -> DataFrame:
    """``path, modified, begin, end, rows, before`` of each range of ``size`` bytes of the files.

    ``before`` is how many lines of the file stand before the range, its header included. Cells
    must not hold line breaks; a compressed file is one range. Keep the table beside the files:
    it is made by one reading and spares others.
    """
    whole = F.lower("path").rlike("[.](gz|bz2|zst)$")
    listed = list_objects(spark, paths).filter("length > 0").select(
        "path", F.unix_millis(F.col("modificationTime")).alias("modified"), "length", whole.alias("whole")
    )
    end = F.when(F.col("whole"), F.lit((1 << 63) - 1)).otherwise(F.least(F.col("begin") + size, F.col("length")))
    last = F.when(F.col("whole"), F.lit(0)).otherwise(F.floor((F.col("length") - 1) / size))
    spans = listed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k"))
    spans = spans.withColumn("begin", F.col("k") * size)
    spans = written(spans.select("path", "modified", "begin", end.alias("end")), "spans")
    spread = spans.repartition(max(2, min(spans.count(), 1 << 14)), "path", "begin")
    counted = spread.mapInArrow(_counted, "path string, modified bigint, begin bigint, end bigint, rows bigint")
    earlier = Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    return written(counted.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0))), "row_starts")


def read_from(
    spark: SparkSession, starts: DataFrame, begin: DataFrame, headers: Sequence[str] | None = None
) -> DataFrame:
    """Rows of the files in ``begin(path, row)`` from that row (0 is the first after the header) on.

    Only ranges of ``starts`` that reach the row are opened, each at its first byte; files not in
    ``begin`` and ranges before the row are not read. Gives the cells by the names of each file's own
    header, as :func:`callflow.sources.exports.read_export` does, with ``path`` and ``row_index``.
    """
    wanted = begin.select(F.col("path").alias("_path"), F.greatest("row", F.lit(0)).cast("long").alias("wanted"))
    met = starts.join(wanted, F.col("path") == F.col("_path")).filter(F.col("before") + F.col("rows") > F.col("wanted") + 1)
    spans = written(met.select("path", "begin", "end", "before", "wanted"), "spans")
    number = spans.count()
    spread = spans.repartition(max(2, min(number, 1 << 14)), "path", "begin")
    lines = spread.mapInArrow(_emitted, LINES)
    files = [r["path"] for r in spans.select("path").distinct().collect()]  # of the ranges that are read
    layouts = file_headers(spark, files) if files else {}
    if headers is None:
        headers = list(dict.fromkeys(name for names in layouts for name in names))
    rows = None
    for names, some in layouts.items():
        layout = ", ".join(f"_{k} string" for k in range(len(names)))
        own = lines if len(layouts) == 1 else lines.filter(F.col("path").isin(some))
        cells = own.select("path", "row", F.from_csv("value", layout, {"escape": '"'}).alias("_cells"))
        at = {name: k for k, name in enumerate(names)}
        picked = [
            (F.col(f"_cells._{at[h]}") if h in at else F.lit(None).cast("string")).alias(h) for h in headers
        ]
        part = cells.select(*picked, "path", F.col("row").alias("row_index"))
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        columns = ", ".join(f"`{h}` string" for h in headers)
        return spark.createDataFrame([], f"{columns}{', ' if columns else ''}path string, row_index bigint")
    return rows


def after(starts: DataFrame, path: str, row: int) -> DataFrame:
    """``path, row`` to read on from: the rest of one file, and the files that stand after it, by time and path."""
    files = starts.select("path", "modified").distinct()
    found = files.filter(F.col("path") == path).first()
    if found is None:
        raise ValueError(f"no rows of {path} are known")
    here = F.col("path") == path
    later = (F.col("modified") > found["modified"]) | ((F.col("modified") == found["modified"]) & (F.col("path") >= path))
    return files.filter(later).select("path", F.when(here, row).otherwise(0).cast("long").alias("row"))
