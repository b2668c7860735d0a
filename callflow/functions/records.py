"""Column expressions for JSON records held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Record members that loads read.
RECORD_ID = "$.id"
TELEPHONY_START = "$.startTime"
TELEPHONY_RECORDING = "$.recording.contentUri"
TRACKING_START = "$.start_time"
TRACKING_RECORDING = "$.recording"
TELEPHONY_RECORDS = "$.records"
TELEPHONY_NEXT_PAGE = "$.navigation.nextPage.uri"
TRACKING_RECORDS = "$.calls"
TRACKING_EXTRA_FIELDS = (
    "agent_email",
    "call_type",
    "lead_status",
    "note",
    "source",
    "total_calls",
    "speaker_percent",
    "keywords",
    "campaign",
    "milestones",
    "timeline_url",
    "person_id",
    "transcription",
    "keywords_spotted",
    "call_highlights",
    "zip_code",
)

_FALSY = r'^(null|false|""|\{\}|\[\]|-?0+(\.0*)?([eE][+-]?[0-9]+)?)$'


def parse(text: Column) -> Column:
    """VARIANT of JSON text; NULL when malformed. See also :func:`with_record`."""
    values = _values(text)
    return F.when(F.size(values) == 1, F.get(values, F.lit(0)))


def with_record(df: DataFrame, text: Column, name: str = "record") -> DataFrame:
    """``df`` plus :func:`parse` of ``text``, parsed once however often it is used.

    No filter on the record is pushed below the generator, where it would parse
    a second time.
    """
    listed = df.select("*", F.inline(F.array(F.struct(_values(text).alias("_values")))))
    record = F.when(F.size("_values") == 1, F.get("_values", F.lit(0)))
    return listed.withColumn(name, record).drop("_values")


def _values(text: Column) -> Column:
    """The values in JSON text, one when it is valid.

    The parser stops after one value and would take ``{"a":1} rest`` for valid.
    Read as the only element of an array, such text is malformed.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.try_variant_get(wrapped, "$", "array<variant>")


def is_object_text(text: Column) -> Column:
    """Whether valid JSON text is an object, which its first character tells."""
    return F.coalesce(F.ltrim(text, F.lit(" \t\n\r")).startswith("{"), F.lit(False))


def member(record: Column, path: str, kind: str = "string") -> Column:
    """A member of the record; NULL when absent, null or of another kind."""
    return F.try_variant_get(record, path, kind)


def truthy(record: Column, path: str) -> Column:
    """False for an absent member, null, '', {}, [], any zero and false."""
    text = F.to_json(F.try_variant_get(record, path, "variant"))
    return F.coalesce(~text.rlike(_FALSY), F.lit(False))


def as_text(record: Column) -> Column:
    return F.to_json(record)


def with_id(record: Column, made: Column) -> Column:
    """The record as text, with ``made`` as its id where it has none, or one that is null or ''."""
    members = F.try_variant_get(record, "$", "map<string,variant>")
    quoted = F.to_json(F.array(made))
    text = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    others = F.map_filter(members, lambda name, _: name != F.lit(RECORD_ID.removeprefix("$.")))
    renewed = F.map_concat(others, F.create_map(F.lit(RECORD_ID.removeprefix("$.")), F.parse_json(text)))
    given = F.nullif(member(record, RECORD_ID), F.lit(""))
    return F.when(given.isNull(), F.to_json(renewed)).otherwise(as_text(record))
