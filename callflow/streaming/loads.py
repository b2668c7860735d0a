"""Loads of files as they arrive: each file once, broken ones apart, every load visible as a whole."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from callflow.session import written
from callflow.sources.exports import stream_arrivals
from callflow.sources.heads import unreadable
from callflow.sources.listing import list_objects
from callflow.streaming import commits
from callflow.streaming.commits import LOAD

BAD = "bad_files"
BAD_FILES = StructType([StructField(name, StringType()) for name in ("path", "error")])


def load_arrivals(
    spark: SparkSession,
    arrivals: str,
    root: str,
    checkpoint: str,
    write: Callable[[str, list[tuple[str, int]]], list[str]],
    max_files: int,
    suffix: str,
) -> None:
    """Load every file below ``arrivals`` that no committed load holds as it is now.

    ``write(load, files)`` writes outputs of some files ``(path, length)`` to folders of the load's name and returns their
    names; the commit row then makes them visible. New names come by a stream, which also remembers
    them; a file put again under its name is found by its time or size in a listing afterwards, oldest
    first, at most ``max_files`` to a load either way. If a load fails and some of its files cannot be
    read to their end, these go to ``bad_files`` with the reason, the others are loaded, and the load
    counts for all of them.
    """

    def store(batch: DataFrame) -> None:
        files = [tuple(f) for f in commits.not_committed(batch, root).collect()]  # at most max_files
        if not files:
            return
        sizes = [(path, length) for path, _, length in files]
        load = commits.new_load(spark, root)
        try:
            names = write(load, sizes)
        except (Py4JJavaError, PySparkException):
            bad = written(unreadable(spark, [path for path, _ in sizes]), "bad")
            broken = {row["path"] for row in bad.collect()}
            if not broken:
                raise
            # What the first attempt wrote is in no commit; the others load under another name.
            load, good = commits.new_load(spark, root), [s for s in sizes if s[0] not in broken]
            bad.write.parquet(f"{root}/{BAD}/{LOAD}={load}")
            names = [*(write(load, good) if good else []), BAD]
        commits.commit(spark, root, load, names, files)

    query = (
        stream_arrivals(spark, arrivals, max_files, suffix)
        .writeStream.foreachBatch(lambda batch, _: store(commits.identified(batch)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # What is listed now is loaded now; what changes meanwhile is the next run's.
    listed = commits.identified(list_objects(spark, arrivals, suffix))
    again = written(commits.not_committed(listed, root), "again")
    left = again.count()
    while left > 0:
        oldest = commits.not_committed(again, root).orderBy("modified", "path").limit(max_files).collect()
        store(spark.createDataFrame(oldest, commits.FILES))
        left -= max_files


def bad_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, error`` of files that could not be read to their end and were left out of their load."""
    return commits.outputs_of(spark, root, BAD, BAD_FILES).select(*BAD_FILES.names)
