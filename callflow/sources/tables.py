"""Scans of stored tables and ad-hoc SQL over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callflow.schemas import TABLES


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the six tables; columns missing from older files read as NULL."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Save as a catalog table that joins on ``key`` without shuffling it again.

    For tables that loads of any size are merged into. With fewer ``buckets`` than
    shuffle partitions Spark may still prefer to shuffle.
    """
    df.write.bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def run_sql(spark: SparkSession, statement: str, **tables: DataFrame) -> DataFrame:
    """Rows of a SELECT that names its tables as ``{name}``, with native types."""
    return spark.sql(statement, **tables)
