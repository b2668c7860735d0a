"""The six tables: column types, keys, references and bounded text columns."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_INT, _TEXT, _TIME, _FLAG = IntegerType(), StringType(), TimestampNTZType(), BooleanType()


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


# Table layouts, keys, references and text bounds of the data model.
TABLES: dict[str, StructType] = {
    "stage": _table(stage_id=_INT, stage_name=_TEXT, description=_TEXT),
    "lead": _table(
        lead_id=_INT,
        source=_TEXT,
        lead_status=_TEXT,
        lead_score=_TEXT,
        stage_id=_INT,
        creation_date=_TIME,
        notes=_TEXT,
    ),
    "customer": _table(
        customer_id=_INT,
        lead_id=_INT,
        name=_TEXT,
        contact_info=_TEXT,
        region=_TEXT,
        last_purchase=_TIME,
        revenue=_INT,
        investment_type=_TEXT,
    ),
    "call": _table(
        call_id=_TEXT,
        call_platform=_TEXT,
        broker_id=_TEXT,
        lead_id=_INT,
        call_type=_TEXT,
        call_forwarded=_FLAG,
        date_time=_TIME,
        talk_time=_INT,
        outcome=_TEXT,
    ),
    "broker": _table(
        broker_id=_TEXT,
        broker_name=_TEXT,
        phonenumber=_TEXT,
        email=_TEXT,
        extension=_TEXT,
        state=_TEXT,
        role=_TEXT,
    ),
    "transcript": _table(transcript_id=_TEXT, call_id=_TEXT, transcript=_TEXT),
}

PRIMARY_KEYS = {
    "stage": "stage_id",
    "lead": "lead_id",
    "customer": "customer_id",
    "call": "call_id",
    "broker": "broker_id",
    "transcript": "transcript_id",
}

# (table, column, referenced table); the referenced column is that table's key
FOREIGN_KEYS = [
    ("lead", "stage_id", "stage"),
    ("customer", "lead_id", "lead"),
    ("call", "broker_id", "broker"),
    ("call", "lead_id", "lead"),
    ("transcript", "call_id", "call"),
]

TEXT_LIMIT_BYTES = 255
BOUNDED_TEXT = {
    "stage": ["stage_name"],
    "lead": ["source", "lead_status", "lead_score"],
    "customer": ["name", "contact_info", "region", "investment_type"],
    "call": ["call_platform", "call_type", "outcome"],
    "broker": ["broker_name", "phonenumber", "email", "extension", "state", "role"],
}

# The column a load replaces rows by. Brokers are replaced by name and
# transcripts by call, not by their generated primary keys.
LOAD_KEYS = {
    "call": "call_id",
    "lead": "lead_id",
    "broker": "broker_name",
    "transcript": "call_id",
}


def create_table(spark: SparkSession, path: str, schema: StructType | str) -> None:
    """An empty table; ``schema`` may be DDL text such as ``id int, name string``."""
    spark.createDataFrame([], schema).write.parquet(path)


def create_tables(spark: SparkSession, root: str) -> None:
    """Each of the six tables, empty, as ``<root>/<table>``."""
    for name, schema in TABLES.items():
        create_table(spark, f"{root}/{name}", schema)
