"""Object listings: names, times and sizes, never contents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callflow.functions import text
from callflow.session import written
from callflow.sources.storage import is_hidden, opened, qualified, reachable

#: Folders that a task opens in one round; those it finds beyond are dealt out again.
FOLDERS_PER_TASK = 256
#: Names sent on together.
NAMES = 10_000
ENTRIES = "path string, modificationTime timestamp_ltz, length bigint, folder boolean"


def suffix_glob(suffix: str) -> str:
    return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def _expand(suffix: str, most: int):
    """Lists folders and what lies below them, ``most`` folders to a task; further ones are given back."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.timestamp("us", "UTC"), pa.int64(), pa.bool_()]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["path", "modificationTime", "length", "folder"],
        )

    def entry(path: str, info: fs.FileInfo) -> tuple:
        # Spark's readers know times to the millisecond.
        return path, info.mtime_ns // 1_000_000 * 1000 if info.mtime_ns else 0, info.size, False

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for root in batch["path"].to_pylist():
                todo, done = [root], 0
                while todo:
                    folder = todo.pop()
                    if done == most:
                        rows.append((folder, 0, 0, True))
                        continue
                    done += 1
                    system, inner = opened(folder)
                    itself = system.get_file_info(inner)
                    if itself.type == fs.FileType.File:
                        if itself.base_name.lower().endswith(suffix.lower()):
                            rows.append(entry(folder, itself))
                        continue
                    for info in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
                        if is_hidden(info.base_name):
                            continue
                        path = f"{folder.rstrip('/')}/{info.base_name}"
                        if info.type == fs.FileType.Directory:
                            todo.append(path)
                        elif info.base_name.lower().endswith(suffix.lower()):
                            rows.append(entry(path, info))
                        if len(rows) == NAMES:
                            yield batch_of(rows)
                            rows = []
        if rows:
            yield batch_of(rows)

    return expand


def list_objects(spark: SparkSession, root: str | list[str], suffix: str = "") -> DataFrame:
    """``path, modificationTime, length`` of every object below ``root`` whose name ends in ``suffix``,
    in capitals or not.

    Tasks list folders and the folders in them; a task that has opened its share gives the others
    back, which are dealt to further tasks in the next round. Names are written as a table: none comes
    to the driver. A folder's own names pass through one task. Names that Spark's readers pass over
    are left out. A root that is missing is an error. Where Arrow does not know the scheme, and for
    globs, Spark's own listing is used; no file is opened either way.
    """
    roots = [qualified(spark, r) for r in ([root] if isinstance(root, str) else root)]
    if not roots or not all(reachable(r) for r in roots):
        return _listed_by_spark(spark, root, suffix)
    for path in roots:
        system, inner = opened(path)
        if system.get_file_info(inner).type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
    folders, number, rounds = spark.createDataFrame([(r,) for r in roots], "path string"), len(roots), []
    while number:
        # Neighbours in a listing tend to be alike in size, so they are spread.
        spread = folders.repartition(-(-number // FOLDERS_PER_TASK) if number > len(roots) else min(number, 64), F.xxhash64("path"))
        rounds.append(written(spread.mapInArrow(_expand(suffix, FOLDERS_PER_TASK), ENTRIES), "listing"))
        folders = rounds[-1].filter("folder").select("path")
        number = folders.count()
    listed = rounds[0]
    for later in rounds[1:]:
        listed = listed.unionByName(later)
    return listed.filter("NOT folder").drop("folder")


def _listed_by_spark(spark: SparkSession, root: str | list[str], suffix: str) -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", suffix_glob(suffix))
        .load(root)
    )
    return files.select("path", "modificationTime", "length")


def stored_recordings(listing: DataFrame) -> DataFrame:
    """``call_id`` of each stored recording in a listing with a ``path`` column."""
    return listing.select(text.call_of_recording(F.col("path")).alias("call_id")).filter(
        F.col("call_id").isNotNull()
    )
