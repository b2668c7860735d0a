"""Tables kept in folders by a hash of their key, of which a load rewrites those its keys fall in."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callflow.operators.merge import last_per_key
from callflow.session import written
from callflow.sources.exports import ORDER

KEYLESS = -1
BUCKET = "_bucket"
VERSION = "version string, key string, buckets int, folders map<int, array<string>>"


@dataclass
class Version:
    """One state of a table: the folders of each bucket. ``version`` sorts after earlier ones."""

    version: str
    key: str
    buckets: int
    folders: dict[int, list[str]]


def _bucket(key: str, buckets: int) -> Column:
    return F.when(F.col(key).isNull(), KEYLESS).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def current(spark: SparkSession, root: str) -> Version:
    """The last version, whose row is one small file: a load that was killed before it left no trace."""
    rows = spark.read.schema(VERSION).option("recursiveFileLookup", True).parquet(f"{root}/versions")
    last = rows.agg(F.max_by(F.struct("*"), "version").alias("last")).first()["last"]
    return Version(**last.asDict())


def _name(after: str | None) -> str:
    return f"{int(after.partition('-')[0]) + 1 if after else 0:09d}-{uuid.uuid4().hex}"


def _save(rows: DataFrame, root: str, version: str) -> None:
    """One folder per bucket; a bucket with a large share of the rows is written by several tasks."""
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{root}/data/{version}")


def _commit(spark: SparkSession, root: str, state: Version) -> None:
    row = spark.createDataFrame([(state.version, state.key, state.buckets, state.folders)], VERSION)
    row.coalesce(1).write.parquet(f"{root}/versions/{state.version}")


def _folder(version: str, bucket: int) -> str:
    return f"data/{version}/{BUCKET}={bucket}"


def create(rows: DataFrame, root: str, key: str, buckets: int) -> None:
    """``rows``, one per key besides those without, as the first version of the table in ``root``."""
    marked = written(rows.withColumn(BUCKET, _bucket(key, buckets)), "rows")
    version = _name(None)
    _save(marked, root, version)
    held = [r[BUCKET] for r in marked.select(BUCKET).distinct().collect()]  # at most one more than buckets
    _commit(rows.sparkSession, root, Version(version, key, buckets, {b: [_folder(version, b)] for b in held}))


def read(spark: SparkSession, root: str, schema, state: Version | None = None, only: list[int] | None = None) -> DataFrame:
    """The table as of ``state`` or the last version; ``only`` some of its buckets."""
    state = state or current(spark, root)
    folders = [f"{root}/{f}" for b, some in sorted(state.folders.items()) if only is None or b in only for f in some]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert(spark: SparkSession, root: str, schema, batch: DataFrame, order: str = ORDER) -> list[int]:
    """A load: the rows of each key in ``batch`` replaced by its last one. Returns the buckets rewritten.

    Only buckets that a key of the batch falls in are read and written, so both follow the batch, and
    only their rows are shuffled. Rows without key are added in a folder of their own. The new
    version names the folders of all buckets, old or new, and is one row; earlier versions stay
    readable until :func:`unused` folders are deleted. One load at a time.
    """
    state = current(spark, root)
    key = state.key
    marked = written(batch.withColumn(BUCKET, _bucket(key, state.buckets)), "batch")
    touched = sorted(r[BUCKET] for r in marked.select(BUCKET).distinct().collect())  # at most one more than buckets
    if not touched:
        return []
    keyed = marked.filter(F.col(BUCKET) != KEYLESS)
    kept = read(spark, root, schema, state, [b for b in touched if b != KEYLESS])
    kept = kept.join(keyed.select(key).distinct(), key, "left_anti").select(*kept.columns)
    kept = kept.withColumn(BUCKET, _bucket(key, state.buckets))
    latest = last_per_key(keyed, key, order).unionByName(marked.filter(F.col(BUCKET) == KEYLESS).drop(order))
    version = _name(state.version)
    _save(kept.unionByName(latest, allowMissingColumns=True), root, version)
    folders = dict(state.folders)
    for b in touched:
        folders[b] = [*(folders.get(b, []) if b == KEYLESS else []), _folder(version, b)]
    _commit(spark, root, Version(version, key, state.buckets, folders))
    return touched


def unused(spark: SparkSession, root: str) -> list[str]:
    """Folders of earlier versions that the last one does not name, for a storage job to delete."""
    rows = spark.read.schema(VERSION).option("recursiveFileLookup", True).parquet(f"{root}/versions")
    named = rows.select("version", F.explode(F.flatten(F.map_values("folders"))).alias("folder"))
    last = named.groupBy("folder").agg(F.max("version").alias("version"))
    return sorted(r["folder"] for r in last.filter(F.col("version") < current(spark, root).version).collect())
