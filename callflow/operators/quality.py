"""Reports of rows that break a declared key, reference or text bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callflow.operators.joins import join_unique
from callflow.schemas import BOUNDED_TEXT, TEXT_LIMIT_BYTES


def broken_keys(table: DataFrame, key: str) -> DataFrame:
    """``key, n`` of keys that occur more than once, and of NULL if it occurs."""
    counts = table.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.col("n") > 1) | F.col(key).isNull())


def orphan_rows(table: DataFrame, column: str, referenced: DataFrame, key: str) -> DataFrame:
    """Rows whose non-NULL ``column`` has no row in ``referenced``."""
    keys = referenced.select(F.col(key).alias(column))
    return join_unique(table.filter(F.col(column).isNotNull()), keys, column, "left_anti").select(*table.columns)


def orphan_keys(table: DataFrame, column: str, referenced: DataFrame, key: str) -> DataFrame:
    """``column, n`` of non-NULL values that have no row in ``referenced``.

    Counts first, so the join sees each value once however often it occurs.
    """
    counts = table.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(referenced.select(F.col(key).alias(column)), column, "left_anti")


def overlong_text(table: DataFrame, key: str, name: str, limit: int = TEXT_LIMIT_BYTES) -> DataFrame:
    """``key, column_name, octets`` of cells longer than their bound, in bytes."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.octet_length(F.col(c)).alias("octets"))
            for c in BOUNDED_TEXT[name]
        ]
    )
    too_long = F.filter(cells, lambda cell: cell["octets"] > limit)
    return table.select(key, F.inline(too_long))
