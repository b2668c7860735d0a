"""Keyed loads: last row wins, first row wins, and predicate changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from callflow.operators import prefilter
from callflow.session import written
from callflow.sources.exports import ORDER


def _one_per_key(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key in ``order``.

    Spark keeps one row per key and task before the shuffle (WindowGroupLimit),
    so a key with a large share of the rows does not gather in one task.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")


def last_per_key(rows: DataFrame, key: str, order: str = ORDER) -> DataFrame:
    """The row of each key that stands last in ``order``, without that column."""
    return _one_per_key(rows, key, F.col(order).desc()).drop(order)


def first_per_key(rows: DataFrame, key: str, order: str = ORDER) -> DataFrame:
    """The row of each key that stands first in ``order``, without that column."""
    return _one_per_key(rows, key, F.col(order).asc()).drop(order)


def _stored_batch(batch: DataFrame, key: str) -> tuple[DataFrame, int, int]:
    """A batch as a table, with how many keys it has at most and the bytes that they take."""
    seen = Observation("batch")
    size = F.octet_length(F.col(key).cast("string"))
    batch = written(batch.observe(seen, F.count(key).alias("keys"), F.sum(size).alias("bytes")), "batch")
    return batch, seen.get["keys"], seen.get["bytes"] or 0


def _too_many(keys: DataFrame, number: int, size: int, table: DataFrame, most: int | None) -> bool:
    """Whether keys would not fit a broadcast, so that joining them shuffles ``table``."""
    if keys.dtypes[0][1] != dict(table.dtypes)[keys.columns[0]]:
        return False  # equal values of two types hash apart
    bound = prefilter.broadcast_bytes(table.sparkSession) if most is None else most
    return 0 <= bound < size + prefilter.KEY_BYTES * number  # a session may forbid broadcasts, filters too


def without_keys(table: DataFrame, keys: DataFrame, key: str, number: int, size: int, most: int | None = None) -> DataFrame:
    """Rows of ``table`` whose key is not in ``keys``, those without a key included.

    Keys that fit a broadcast (``most`` bytes) are joined where the table lies. Of others a Bloom
    filter is broadcast: rows it does not know, and those without a key, stay as they are, and only
    the others are shuffled, beside keys that are a table, so that adaptive execution may split a
    key that many rows share.
    """
    keys = keys.select(key).distinct()
    if not _too_many(keys, number, size, table, most):
        return table.join(keys, key, "left_anti").select(*table.columns)
    keys = written(keys, "keys")
    rows = prefilter.marked(table, keys, key, number)
    rest = rows.filter("_may").join(keys, key, "left_anti")
    return rows.filter("NOT _may").drop("_may").unionByName(rest.select(*table.columns))


def known_keys(table: DataFrame, keys: DataFrame, key: str, number: int, size: int, most: int | None = None) -> DataFrame:
    """The keys of ``table`` that are in ``keys``; beyond a broadcast only those a Bloom filter lets through are shuffled."""
    keys, held = keys.select(key).distinct(), table.select(key)
    if _too_many(keys, number, size, table, most):
        keys = written(keys, "keys")
        held = prefilter.marked(held, keys, key, number).filter("_may").select(key).distinct()
    return held.join(keys, key, "left_semi")


def upsert(
    target: DataFrame, batch: DataFrame, key: str, order: str = ORDER, keyless: bool = True, most: int | None = None
) -> DataFrame:
    """``target`` with the rows of each key in ``batch`` replaced by its last one.

    ``target`` keeps its partitioning and is not shuffled while the batch's keys
    fit a broadcast (the session's bound, or ``most`` bytes); beyond it only rows that may be
    replaced are, see :func:`without_keys`. Batch rows without a key replace nothing and are all added;
    ``keyless=False`` saves a scan where there can be none. The batch is evaluated
    once, into a table that keys and rows are then read from.
    """
    batch, number, size = _stored_batch(batch, key)
    keyed = batch.filter(F.col(key).isNotNull())
    kept = without_keys(target, keyed, key, number, size, most)
    merged = kept.unionByName(last_per_key(keyed, key, order), allowMissingColumns=True)
    if keyless:
        added = batch.filter(F.col(key).isNull()).drop(order)
        merged = merged.unionByName(added, allowMissingColumns=True)
    return merged


def upsert_brokers(target: DataFrame, batch: DataFrame, order: str = ORDER) -> DataFrame:
    """Brokers replaced by name; nameless ones by the id that follows from their other fields."""
    batch = written(batch, "roster")
    named = F.col("broker_name").isNotNull()
    by_name = upsert(target.filter(named), batch.filter(named), "broker_name", order, keyless=False)
    by_id = upsert(target.filter(~named), batch.filter(~named), "broker_id", order, keyless=False)
    return by_name.unionByName(by_id)


def insert_absent(target: DataFrame, batch: DataFrame, key: str, order: str = ORDER) -> DataFrame:
    """``target`` plus the first batch row of each key it lacks; its own rows stay."""
    return target.unionByName(absent_rows(target, batch, key, order), allowMissingColumns=True)


def absent_rows(target: DataFrame, batch: DataFrame, key: str, order: str = ORDER, most: int | None = None) -> DataFrame:
    """The rows :func:`insert_absent` adds. NULL keys are skipped. The batch is evaluated once."""
    keyed, number, size = _stored_batch(batch.filter(F.col(key).isNotNull()), key)
    return not_in(first_per_key(keyed, key, order), keyed, target, key, number, size, most)


def not_in(
    rows: DataFrame, keys: DataFrame, table: DataFrame, key: str, number: int, size: int, most: int | None = None
) -> DataFrame:
    """``rows`` whose key is not in ``table``, which may be far larger.

    An anti join can broadcast its right side only, and would shuffle all keys of
    ``table`` for a few rows. So the table is first cut down to ``keys``, the keys
    of ``rows``, see :func:`known_keys`.
    """
    return rows.join(known_keys(table, keys, key, number, size, most), key, "left_anti").select(*rows.columns)


def lacking(rows: DataFrame, table: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """``rows``, one per key, whose key ``table`` lacks; they are evaluated once."""
    rows, number, size = _stored_batch(rows, key)
    return not_in(rows, rows, table, key, number, size, most)


def append(target: DataFrame, rows: DataFrame) -> DataFrame:
    """All rows of both, with no look at keys."""
    return target.unionByName(rows, allowMissingColumns=True)


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which ``predicate`` is false or unknown."""
    return target.filter(~F.coalesce(predicate, F.lit(False)))


def update_where(target: DataFrame, predicate: Column, **changes: Column) -> DataFrame:
    """``changes`` applied to the rows for which ``predicate`` is true.

    New values see the old row, as in an SQL UPDATE.
    """
    types = dict(target.dtypes)
    return target.select(
        *[
            F.when(predicate, changes[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in changes else F.col(c)
            for c in target.columns
        ]
    )
