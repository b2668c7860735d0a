"""Raw rows to typed table rows, with a reason on each row that cannot load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callflow.functions import text
from callflow.functions.text import EXPORT_TIME_FORMATS, field
from callflow.schemas import TABLES
from callflow.sources.batches import ROSTER_FIELDS
from callflow.sources.exports import ORDER

# Platform of dialer calls, headers of the two exports, reasons.
DIALER_PLATFORM = "Velocify"
CALL_HEADERS = ("Call Id", "Lead Id", "Origin", "Time", "Call Duration (hrs:min:sec)", "Recording")
LEAD_HEADERS = ("Id", "Lead Source", "Status", "Lead Score #", "Date Added")
CALL_ID_MISSING = "call_id_missing"
LEAD_ID_MISSING = "lead_id_missing"
LEAD_ID_NOT_INTEGER = "lead_id_not_integer"
TIME_UNPARSABLE = "time_unparsable"
TALK_TIME_OUT_OF_RANGE = "talk_time_out_of_range"

REASON, RAW = "reason", "raw"


def as_table(df: DataFrame, table: str, *carried: str) -> DataFrame:
    """Columns of ``table`` in order and type, absent ones NULL, then ``carried``."""
    columns = []
    for column in TABLES[table]:
        value = F.col(column.name) if column.name in df.columns else F.lit(None)
        columns.append(value.cast(column.dataType).alias(column.name))
    return df.select(*columns, *carried)


def _first_reason(*checks: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(failed, F.lit(name)) for failed, name in checks])


def _with_parsed(cells: DataFrame, **values: Column) -> DataFrame:
    """``cells`` plus columns that are parsed once.

    A filter on a reason would be pushed below a projection and parse everything
    a second time. It is not pushed below a generator.
    """
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return cells.select("*", F.inline(F.array(row)))


def _raw_cells(rows: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != ORDER])


def _raw_of_rejects() -> Column:
    return F.when(F.col(REASON).isNotNull(), F.to_json(F.col(RAW)))


def _order_column(rows: DataFrame) -> list[str]:
    return [ORDER] if ORDER in rows.columns else []


def normalize_calls(
    rows: DataFrame,
    broker_id: Column | str | None = None,
    time_formats: Sequence[str] = EXPORT_TIME_FORMATS,
    platform: str = DIALER_PLATFORM,
) -> DataFrame:
    """Call rows plus ``recording``, ``reason`` (NULL when loadable) and ``raw``.

    ``raw`` is the row as JSON where there is a reason.
    ``broker_id`` is the broker all calls of the export belong to, or a column.
    """
    if not isinstance(broker_id, Column):
        broker_id = F.lit(broker_id)
    duration = F.col(f"`{CALL_HEADERS[4]}`") if CALL_HEADERS[4] in rows.columns else F.lit("0:00:00")
    cells = rows.select(
        field(rows, "Call Id").alias("call_id"),
        field(rows, "Lead Id").alias("lead_text"),
        field(rows, "Origin").alias("call_type"),
        field(rows, "Time").alias("time_text"),
        field(rows, "Recording").alias("recording"),
        F.when(text.is_duration(duration), duration).alias("duration"),
        broker_id.cast("string").alias("broker_id"),
        _raw_cells(rows).alias(RAW),
        *_order_column(rows),
    )
    typed = _with_parsed(
        cells,
        lead_id=text.whole_number(F.col("lead_text")),
        date_time=text.timestamp(F.col("time_text"), time_formats),
        seconds=text.total_seconds(F.col("duration")),
    )
    bad_time = F.col("time_text").isNotNull() & F.col("date_time").isNull()
    out = typed.withColumns(
        {
            "call_platform": F.lit(platform),
            "talk_time": F.nullif(F.col("seconds").try_cast("int"), F.lit(0)),
            REASON: _first_reason(
                (F.col("call_id").isNull(), CALL_ID_MISSING),
                (F.col("lead_text").isNotNull() & F.col("lead_id").isNull(), LEAD_ID_NOT_INTEGER),
                (bad_time, TIME_UNPARSABLE),
                (F.col("duration").isNotNull() & ~text.fits_int(F.col("seconds")), TALK_TIME_OUT_OF_RANGE),
            ),
            # a lead is created from any row with a usable lead id and time,
            # whether or not the call itself can be loaded
            "names_lead": F.col("lead_id").isNotNull() & ~bad_time,
        }
    )
    out = out.withColumn(RAW, _raw_of_rejects())
    return as_table(out, "call", "recording", REASON, "names_lead", RAW, *_order_column(rows))


def leads_of_calls(normalized: DataFrame, source: str = DIALER_PLATFORM) -> DataFrame:
    """The lead each call row names; its creation date is the time of the call."""
    named = normalized.filter("names_lead").select(
        "lead_id",
        F.lit(source).alias("source"),
        F.col("date_time").alias("creation_date"),
        *_order_column(normalized),
    )
    return as_table(named, "lead", *_order_column(normalized))


def normalize_leads(rows: DataFrame, time_formats: Sequence[str] = EXPORT_TIME_FORMATS) -> DataFrame:
    cells = rows.select(
        field(rows, "Id").alias("lead_text"),
        field(rows, "Lead Source").alias("source"),
        field(rows, "Status").alias("lead_status"),
        field(rows, "Lead Score #").alias("lead_score"),
        field(rows, "Date Added").alias("date_text"),
        _raw_cells(rows).alias(RAW),
        *_order_column(rows),
    )
    typed = _with_parsed(
        cells,
        lead_id=text.whole_number(F.col("lead_text")),
        creation_date=text.timestamp(F.col("date_text"), time_formats),
    )
    reason = _first_reason(
        (F.col("lead_text").isNull(), LEAD_ID_MISSING),
        (F.col("lead_id").isNull(), LEAD_ID_NOT_INTEGER),
        (F.col("date_text").isNotNull() & F.col("creation_date").isNull(), TIME_UNPARSABLE),
    )
    out = typed.withColumn(REASON, reason).withColumn(RAW, _raw_of_rejects())
    return as_table(out, "lead", REASON, RAW, *_order_column(rows))


def normalize_brokers(roster: DataFrame) -> DataFrame:
    """Broker rows whose id follows from the name, so reloading keeps it.

    A broker without a name gets an id of its other fields and is replaced by that id, see
    :func:`callflow.operators.merge.upsert_brokers`.
    """
    name = field(roster, "name")
    others = [field(roster, f) for f in ROSTER_FIELDS[1:]]
    out = roster.select(
        F.coalesce(text.stable_id(name), text.stable_id(*others)).alias("broker_id"),
        name.alias("broker_name"),
        *[field(roster, f).alias(f.lower()) for f in ROSTER_FIELDS[1:]],
        *_order_column(roster),
    )
    return as_table(out, "broker", *_order_column(roster))


def normalize_transcripts(rows: DataFrame) -> DataFrame:
    """Transcript rows; the id follows from the call, or the text if there is none."""
    call_id, words = field(rows, "call_id"), field(rows, "transcript")
    out = rows.select(
        F.coalesce(text.stable_id(call_id), text.stable_id(words)).alias("transcript_id"),
        call_id.alias("call_id"),
        words.alias("transcript"),
        *_order_column(rows),
    )
    return as_table(out, "transcript", *_order_column(rows))


def split_rejects(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``; every row is in exactly one of the two."""
    carried = _order_column(normalized)
    good = normalized.filter(F.col(REASON).isNull()).drop(REASON, RAW)
    return good, normalized.filter(F.col(REASON).isNotNull()).select(REASON, RAW, *carried)
