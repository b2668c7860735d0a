"""The log of loads: a load counts once its commit row, which names its files and outputs, is written."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LOAD = "load"
COMMITS = "commits"
#: A file as it was when it was listed: put again, it has another time or size.
FILE = ["path", "modified", "length"]
FILES = "path string, modified bigint, length bigint"
COMMIT = f"{LOAD} string, outputs array<string>, files array<struct<path: string, modified: bigint, length: bigint>>, merged array<string>"


def identified(listed: DataFrame) -> DataFrame:
    """``path, modified, length`` of a listing, the time as milliseconds, which no time zone changes."""
    return listed.select("path", F.unix_millis(F.col("modificationTime")).alias("modified"), "length")


def committed(spark: SparkSession, root: str) -> DataFrame:
    """One row per committed load: ``load, outputs, files, merged``."""
    try:
        return spark.read.schema(COMMIT).option("recursiveFileLookup", True).parquet(f"{root}/{COMMITS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], COMMIT)


def not_committed(files: DataFrame, root: str) -> DataFrame:
    """Those of ``files`` that no committed load holds as they are."""
    held = committed(files.sparkSession, root).select(F.inline("files")).distinct()
    return files.join(held, FILE, "left_anti").select(*FILE)


def new_load(spark: SparkSession, root: str) -> str:
    """A name that no other load has and that sorts after those of all committed loads."""
    last = committed(spark, root).agg(F.max(LOAD)).first()[0]
    return f"{int(last.partition('-')[0]) + 1 if last else 0:09d}-{uuid.uuid4().hex}"


def commit(
    spark: SparkSession, root: str, load: str, outputs: Sequence[str], files: Sequence[tuple], merged: Sequence[str] = ()
) -> None:
    """Make the outputs of ``load`` visible, all at once.

    The row is one file, which the store shows whole or not at all. ``files`` are at most those of a
    batch; ``merged`` names the loads that a snapshot holds.
    """
    row = spark.createDataFrame([(load, list(outputs), list(files), list(merged))], COMMIT)
    row.coalesce(1).write.parquet(f"{root}/{COMMITS}/{LOAD}={load}")


def outputs_of(spark: SparkSession, root: str, output: str, schema: StructType | str) -> DataFrame:
    """Rows of an output in committed loads, with the name of their load; none before the first."""
    try:
        found = spark.read.parquet(f"{root}/{output}")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema).withColumn(LOAD, F.lit(""))
    whole = committed(spark, root).filter(F.array_contains("outputs", output)).select(LOAD)
    return found.join(whole, LOAD, "left_semi")


def loads_of(spark: SparkSession, root: str, output: str) -> list[str]:
    """Names of the committed loads with an output, first to last; one per batch of files."""
    rows = committed(spark, root).filter(F.array_contains("outputs", output)).select(LOAD).orderBy(LOAD)
    return [row[LOAD] for row in rows.collect()]
