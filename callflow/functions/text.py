"""Column expressions for text fields of exports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats and texts that results depend on.
NULL_TEXT = "NULL"
UNKNOWN_CALL = "unknown"
RECORD_SUFFIX = ".json"
RECORDING_SUFFIX = ".mp3"
CSV_SUFFIX = ".csv"
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
EXPORT_TIME_FORMATS = ("M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm:ss", "M/d/yyyy")

_WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
_DURATION = r"^\s*[+-]?[0-9]+\s*:\s*[+-]?[0-9]+\s*:\s*[+-]?[0-9]+\s*$"
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def clean(text: Column) -> Column:
    """NULL for a missing cell, an empty cell and the word NULL; spaces are kept."""
    return F.when(~text.isin("", NULL_TEXT), text)


def field(df: DataFrame, name: str) -> Column:
    """The cleaned cell under header ``name``, NULL when no such header exists."""
    return clean(F.col(f"`{name}`")) if name in df.columns else F.lit(None).cast("string")


def whole_number(text: Column) -> Column:
    """INT value of text such as ``' -12 '``; NULL for anything else.

    The pattern comes first because casts differ on ``12.5`` and ``1e3``.
    """
    return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast("int"))


def is_duration(text: Column) -> Column:
    """Whether text is ``h:m:s`` in whole numbers, signed or padded with spaces."""
    return F.coalesce(text.rlike(_DURATION), F.lit(False))


def total_seconds(text: Column) -> Column:
    """BIGINT seconds of an ``h:m:s`` text; NULL beyond that type."""
    hours = F.substring_index(text, ":", 1)
    minutes = F.substring_index(F.substring_index(text, ":", 2), ":", -1)
    seconds = F.substring_index(text, ":", -1)
    scaled = [
        F.try_multiply(part.try_cast("bigint"), F.lit(scale).cast("bigint"))
        for part, scale in ((hours, 3600), (minutes, 60))
    ]
    return F.try_add(F.try_add(*scaled), seconds.try_cast("bigint"))


def duration_seconds(text: Column) -> Column:
    """Seconds in ``h:m:s``; NULL when malformed and also when the total is zero.

    Parts may be of any size, so ``0:99:-5`` counts.
    """
    return F.when(is_duration(text), F.nullif(total_seconds(text), F.lit(0).cast("bigint")))


def fits_int(number: Column) -> Column:
    return F.coalesce((number >= _INT_MIN) & (number <= _INT_MAX), F.lit(False))


def duration_out_of_range(text: Column) -> Column:
    """True for a well-formed duration whose seconds do not fit an INT."""
    return is_duration(text) & ~fits_int(total_seconds(text))


def timestamp(text: Column, formats: Sequence[str] = EXPORT_TIME_FORMATS) -> Column:
    """Zone-free timestamp from ISO text or one of ``formats``; NULL otherwise."""
    readings = [text.try_cast("timestamp_ntz")]
    readings += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*readings)


def moment(time: datetime) -> Column:
    """``time`` as a zone-free literal, whatever the zone of session and driver."""
    return F.expr(f"timestamp_ntz'{time.isoformat(sep=' ')}'")


def iso_utc(time: Column) -> Column:
    return F.date_format(time, ISO_UTC)


def stable_id(*natural_key: Column) -> Column:
    """An id that a repeated load of the same key yields again.

    Each part carries its length, so ('ab','c') and ('a','bc') stay apart.
    """
    if len(natural_key) == 1:
        return F.md5(natural_key[0])
    parts = []
    for part in natural_key:
        parts += [F.coalesce(F.length(part).cast("string"), F.lit("-")), F.coalesce(part, F.lit(""))]
    return F.md5(F.concat_ws(":", *parts))


def record_key(record_id: Column) -> Column:
    return F.concat(record_id, F.lit(RECORD_SUFFIX))


def recording_key(call_id: Column) -> Column:
    return F.concat(call_id, F.lit(RECORDING_SUFFIX))


def call_of_recording(path: Column) -> Column:
    """Inverse of :func:`recording_key` for a path ending in the key; NULL otherwise."""
    name = F.element_at(F.split(path, "/"), -1)
    stem_length = F.length(name) - F.lit(len(RECORDING_SUFFIX))
    return F.when(name.endswith(RECORDING_SUFFIX), F.substring(name, F.lit(1), stem_length))


def chunk_key(path: Column, part: Column, root: str | None = None) -> Column:
    """``calls.csv`` and 3 → ``calls-part3.csv``, with the folders below ``root`` if that is named."""
    name = F.element_at(F.split(path, "/"), -1) if root is None else F.substring(path, F.lit(len(root) + 2), F.length(path))
    ends = F.lower(name).endswith(CSV_SUFFIX)
    base = F.when(ends, F.left(name, F.length(name) - len(CSV_SUFFIX))).otherwise(name)
    return F.concat(base, F.lit("-part"), part.cast("string"), F.lit(CSV_SUFFIX))
