"""Split of a listing or table by age."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callflow.functions.text import moment

RETENTION_SECONDS = 2_592_000  # fixed value: 30 days


def is_expired(time: Column, as_of: datetime, seconds: int = RETENTION_SECONDS) -> Column:
    """Strictly older than ``seconds`` at ``as_of``. An unknown time is kept.

    The bound is a literal, so the predicate reaches the scan.
    """
    return time < moment(as_of - timedelta(seconds=seconds))


def split_by_age(
    rows: DataFrame, time: str, as_of: datetime, seconds: int = RETENTION_SECONDS
) -> tuple[DataFrame, DataFrame]:
    """``(kept, expired)``. Nothing is deleted here: a job acts on the lists."""
    expired = is_expired(F.col(time).cast("timestamp_ntz"), as_of, seconds)
    return rows.filter(~F.coalesce(expired, F.lit(False))), rows.filter(expired)
