"""CSV files whose lines are their rows, so that many tasks may read one."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from callflow.session import written
from callflow.sources.heads import HADOOP_ONLY, packing
from callflow.sources.storage import opened, reachable

#: Bytes from which a file is worth a look: smaller ones one task reads soon.
LARGE = 16 << 20
#: Bytes that one task looks at, about.
RANGE = 32 << 20
#: Bytes asked for at once.
STEP = 1 << 20
#: Bytes of a line beyond which a file is left to one task.
LONGEST = 16 << 20

# Quoted cells with doubled quotes, and cells without a quote. Lines of white space alone are rows to a reader
# of whole files only.
_CELL = rb'(?:"[^"\n]*+(?:""[^"\n]*+)*+"|[^",\n]*+)'
_LINES = re.compile(rb"(?:(?![\x00-\x09\x0b-\x20]+\n)%b(?:,%b)*+\n)*+" % (_CELL, _CELL))


def line_end(lines: bytes) -> str:
    """How whole lines end, ``\\n`` or ``\\r\\n``; empty if not all alike, or if they are not rows each."""
    end = "\n"
    if b"\r" in lines:
        number, size = lines.count(b"\n"), len(lines)
        lines = lines.replace(b"\r\n", b"\n")
        if b"\r" in lines or size - len(lines) != number:
            return ""
        end = "\r\n"
    return end if _LINES.fullmatch(lines) else ""


def _line_ends(path: str, begin: int, end: int) -> set[str]:
    """The kinds of ends of the lines that start in ``[begin, end)``."""
    system, inner = opened(path)
    kinds: set[str] = set()
    with system.open_input_file(inner) as file:
        at = max(0, begin - 1)  # a line starts at begin if the byte before ends one
        file.seek(at)
        rest, skip = b"", begin > 0
        while "" not in kinds:
            more = file.read(STEP)
            data = rest + more
            if skip:
                cut = data.find(b"\n") + 1
                skip = not cut
                at, data = at + (cut or len(data)), data[cut:] if cut else b""
            if at >= end:
                return kinds
            whole = data.rfind(b"\n") + 1
            if not more and data[whole:]:
                data += b"\n"
                whole = len(data)
            if whole:
                kinds.add(line_end(data[:whole]))
            at, rest = at + whole, data[whole:]
            if not more or at >= end:
                return kinds
            if len(rest) > LONGEST:
                kinds.add("")
    return kinds


def _looked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = zip(*(batch[c].to_pylist() for c in ("path", "begin", "end")), strict=True)
        ends = [sorted(_line_ends(*span)) for span in spans]
        yield pa.RecordBatch.from_arrays([batch["path"], pa.array(ends, pa.list_(pa.string()))], names=["path", "ends"])


def read_by_line(spark: SparkSession, files: Sequence[tuple[str, int]]) -> set[str]:
    """Those of ``files(path, length)`` that read the same by line as whole; small ones are not looked at.

    No cell of theirs holds a line break, their quotes are closed in each line and all lines end alike. Tasks look at
    ranges of bytes. Compressed files and those that Arrow does not reach are left out.
    """
    some = [
        (path, length)
        for path, length in files
        if length >= LARGE and not packing(path) and not path.lower().endswith(HADOOP_ONLY) and reachable(path)
    ]
    if not some:
        return set()
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(RANGE).cast("long")))
    spans = spark.createDataFrame(some, "path string, length bigint").select("path", "length", begin.alias("begin"))
    spans = written(spans.select("path", "begin", F.least(F.col("begin") + RANGE, "length").alias("end")), "spans")
    number = sum(-(-length // RANGE) for _, length in some)
    looked = spans.repartition(min(number, 1 << 14), "path", "begin").mapInArrow(_looked, "path string, ends array<string>")
    ends = F.array_distinct(F.flatten(F.collect_list("ends")))
    alike = looked.groupBy("path").agg(ends.alias("ends")).filter("size(ends) = 1 AND ends[0] != ''")
    return {r["path"] for r in alike.select("path").collect()}
