"""Column expressions on edge values."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callflow.functions import records, text


def values(spark, kind, inputs, expression):
    rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_clean(spark):
    assert values(spark, "string", ["", "NULL", None, " ", "null", "x"], text.clean) == [
        None, None, None, " ", "null", "x"
    ]


def test_missing_header_is_null(spark):
    rows = spark.createDataFrame([("1",)], ["Call Id"])
    assert rows.select(text.field(rows, "Origin")).first()[0] is None


def test_whole_number(spark):
    inputs = ["12", " -3 ", "+4", "12.5", "1e3", "abc", "", None, "2147483648", "--1", "\t7\n"]
    assert values(spark, "string", inputs, text.whole_number) == [
        12, -3, 4, None, None, None, None, None, None, None, 7
    ]


DURATIONS = {
    "0:00:00": None,
    "1:02:03": 3723,
    "00:99:00": 5940,
    "": None,
    "1:2": None,
    "1:2:3:4": None,
    " 1 : 2 : 3 ": 3723,
    "a:b:c": None,
    "-1:00:00": -3600,
    "+1:00:00": 3600,
    "1:00:00.5": None,
    "0:-1:60": None,
    "99999999:0:0": 359999996400,
    "99999999999999999999999:0:0": None,
    "9223372036854775807:0:0": None,
    "1:: 2": None,
}


def test_duration_seconds(spark):
    got = values(spark, "string", [*DURATIONS, None], text.duration_seconds)
    assert got == [*DURATIONS.values(), None]


def test_duration_out_of_range(spark):
    got = values(spark, "string", [*DURATIONS, None], text.duration_out_of_range)
    wide = {"99999999:0:0", "99999999999999999999999:0:0", "9223372036854775807:0:0"}
    assert got == [*[d in wide for d in DURATIONS], False]


def test_timestamp(spark):
    inputs = ["2024-01-02 03:04:05.678", "2024-01-02T03:04:05", "1/2/2024 3:04:05 PM", "1/2/2024", "soon", "", None]
    assert values(spark, "string", inputs, text.timestamp) == [
        datetime(2024, 1, 2, 3, 4, 5, 678000),
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2, 15, 4, 5),
        datetime(2024, 1, 2),
        None,
        None,
        None,
    ]


def test_timestamp_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = values(spark, "string", ["7/2/2024 3:04:05 PM", "2024-07-02 15:04:05"], text.timestamp)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [datetime(2024, 7, 2, 15, 4, 5)] * 2


def test_stable_ids_differ_by_cell_borders(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("ab", None), (None, "ab"), ("ab", "")], "a string, b string")
    ids = [r[0] for r in rows.select(text.stable_id(F.col("a"), F.col("b"))).collect()]
    assert len(set(ids)) == 5


def test_keys(spark):
    assert values(spark, "string", ["s3://b/x/12.mp3", "12.mp3", "x.wav", ".mp3"], text.call_of_recording) == [
        "12", "12", None, ""
    ]
    assert values(spark, "string", ["in/a.csv"], lambda c: text.chunk_key(c, F.lit(3))) == ["a-part3.csv"]


TRUTHY = {
    '{"r": "x"}': True,
    '{"r": {"a": 1}}': True,
    '{"r": [0]}': True,
    '{"r": 1}': True,
    '{"r": -0.5}': True,
    '{"r": 1e-9}': True,
    '{"r": true}': True,
    '{"r": " "}': True,
    '{"r": "0"}': True,
    '{"r": "false"}': True,
    '{"r": "null"}': True,
    '{"r": 0}': False,
    '{"r": 0.00}': False,
    '{"r": 0e5}': False,
    '{"r": ""}': False,
    '{"r": {}}': False,
    '{"r": []}': False,
    '{"r": null}': False,
    '{"r": false}': False,
    "{}": False,
    "[1]": False,
    "broken": False,
}


def test_truthy(spark):
    got = values(spark, "string", list(TRUTHY), lambda c: records.truthy(records.parse(c), "$.r"))
    assert dict(zip(TRUTHY, got)) == TRUTHY


def test_members(spark):
    record = '{"id": 7, "recording": {"contentUri": "http://x"}, "n": null}'
    for path, want in [("$.id", "7"), ("$.recording.contentUri", "http://x"), ("$.n", None), ("$.z.y", None)]:
        assert values(spark, "string", [record], lambda c: records.member(records.parse(c), path)) == [want]


def test_malformed_text_is_no_record(spark):
    inputs = ['{"a":1}', ' {"a":1}\n', '{"a":1} rest', '{"a":1}{"b":2}', '{"a":1},{"b":2}', "", "{", "1 2", None, "null"]
    got = values(spark, "string", inputs, lambda c: records.as_text(records.parse(c)))
    assert got == ['{"a":1}', '{"a":1}', None, None, None, None, None, None, None, "null"]


def test_a_record_parsed_once_is_the_same(spark):
    inputs = ['{"a":1}', '{"a":1} rest', "[1,2]", "[1]", "null", "", None]
    rows = spark.createDataFrame([(v,) for v in inputs], "v string")
    both = records.with_record(rows, F.col("v")).select(
        records.as_text(F.col("record")), records.as_text(records.parse(F.col("v")))
    )
    assert all(a == b for a, b in both.collect())


@pytest.mark.parametrize("value,want", [('{"a":1}', True), ("[1]", False), ('"{"', False), ("3", False), (" \n{}", True), (None, False)])
def test_object_text(spark, value, want):
    assert values(spark, "string", [value], records.is_object_text) == [want]
