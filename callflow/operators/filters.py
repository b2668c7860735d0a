"""Row predicates of feeds, written as ranges so that they reach the scan."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callflow.functions.text import moment

VOICE = "Voice"  # fixed value: the call type that feeds ask for


def in_window(time: Column, since: datetime | None = None, until: datetime | None = None) -> Column:
    """``since <= time < until``; either end may be open, both open keeps all rows."""
    bounds = []
    if since is not None:
        bounds.append(time >= moment(since))
    if until is not None:
        bounds.append(time < moment(until))
    if not bounds:
        return F.lit(True)
    return bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]


def on_day_before(time: Column, as_of: date) -> Column:
    """Rows of the day before ``as_of``."""
    midnight = datetime(as_of.year, as_of.month, as_of.day)
    return in_window(time, midnight - timedelta(days=1), midnight)


def voice_with_recording(
    calls: DataFrame, kind: str, recording: str, time: str, since: datetime | None = None
) -> DataFrame:
    return calls.filter(
        (F.col(kind) == VOICE) & has_recording(F.col(recording)) & in_window(F.col(time), since)
    )


def has_recording(url: Column) -> Column:
    return url.isNotNull() & (url != "")


def has_web_recording(url: Column) -> Column:
    """For exports, where other text than a web address may stand in the cell."""
    return F.coalesce(url.startswith("http"), F.lit(False))
