"""Totals that run over the rows of a file in order, however many splits it has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callflow.session import written


def block_starts(rows: DataFrame, source: str, block: str, row: str, amount: Column) -> DataFrame:
    """``source, block, first_row, before``: the total of ``amount`` in earlier blocks.

    One row per input split. It is written, so that a join sees its real size:
    small ones are broadcast, others are shuffled.
    """
    totals = rows.groupBy(source, block).agg(F.min(row).alias("first_row"), F.sum(amount).alias("total"))
    earlier = Window.partitionBy(source).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("total").over(earlier), F.lit(0))
    return written(totals.select(source, block, "first_row", before.alias("before")), "block_starts")
