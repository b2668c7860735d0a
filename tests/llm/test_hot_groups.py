"""A group that holds a third of all rows is split where it meets its aggregate."""

import contextlib

import pytest
from pyspark.sql import functions as F

from callflow.llm import repeated_spans
from callflow.llm.shared import pair_units
from callflow.session import written

LOWERED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def lowered(spark):
    before = {k: spark.conf.get(k, None) for k in LOWERED}
    try:
        for k, v in LOWERED.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    core = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000)
    text = F.sha2(F.col("id").cast("string"), 512)
    return spark.range(60_000).select(
        core.cast("long").alias("core"), F.xxhash64("id").alias("whole"), F.col("id").alias("place"),
        F.lit(1).cast("long").alias("doc_id"), F.lit(2).cast("long").alias("hash"), text.alias("text"),
    )


def test_units_of_a_hot_group(spark, rows):
    table = written(rows.select("core", "place", "text"), "rows")
    with lowered(spark):
        units = pair_units(table, ["core"], F.col("place"), 8000)
        assert "skew=true" in final_plan(units)
        sizes = units.groupBy("core", "first", "second").count().collect()
    assert max(r["count"] for r in sizes) < 18_000 and sum(r.core == 7 for r in sizes) == 6


def test_refinement_of_a_hot_bucket(spark, rows):
    whole = F.when(F.col("core") == 7, 9).otherwise(F.col("whole")).cast("long").alias("whole")
    table = written(rows.select("core", whole, F.xxhash64("place").alias("place"), "doc_id", "hash"), "rows")
    with lowered(spark):
        found, _ = repeated_spans.refine(table, F.xxhash64("place"), "doc_id", "hash", "place")
        assert "skew=true" in final_plan(found)
        assert found.where("done AND core = 7").count() >= 20_000
