"""Whole jobs on small files, through the command line's entry point."""

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from callflow.__main__ import main
from callflow.operators import normalize
from callflow.schemas import TABLES, create_tables
from callflow.sources.tables import read_table


def put_csv(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as handle:
        csv.writer(handle).writerows([header, *rows])
    return str(path)


@pytest.fixture
def tables(spark, tmp_path):
    create_tables(spark, str(tmp_path / "tables"))
    return str(tmp_path / "tables")


def store(spark, tables, name, rows, columns):
    df = normalize.as_table(spark.createDataFrame(rows, columns), name)
    df.write.mode("append").parquet(f"{tables}/{name}")


def test_load_calls(spark, tmp_path, tables, capsys):
    store(spark, tables, "call", [("1", "old"), ("9", "old")], "call_id string, call_type string")
    store(spark, tables, "lead", [(5, "web")], "lead_id int, source string")
    rows = [
        ["1", "5", "a", "2024-01-01 00:00:00", "0:00:05", "http://1"],
        ["1", "6", "b", "2024-01-02 00:00:00", "0:00:00", ""],
        ["2", "6", 'say "x"\nand y', "2024-01-03 00:00:00", "1:00:00", "http://2"],
        ["3", "y", "c", "2024-01-04 00:00:00", "0:00:07", "http://3"],
    ]
    source = put_csv(tmp_path / "in" / "calls.csv", normalize.CALL_HEADERS, rows)
    out = str(tmp_path / "out")
    main(["load-calls", source, tables, out, "--broker-id", "b1"])
    assert "{'rows': 4, 'rejects': 1}" in capsys.readouterr().out
    calls = {r.call_id: (r.call_type, r.lead_id, r.talk_time, r.broker_id) for r in read_table(spark, out, "call").collect()}
    assert calls == {
        "1": ("b", 6, None, "b1"), "2": ('say "x"\nand y', 6, 3600, "b1"), "9": ("old", None, None, None)
    }
    leads = {r.lead_id: (r.source, str(r.creation_date)) for r in read_table(spark, out, "lead").collect()}
    assert leads == {5: ("web", "None"), 6: ("Velocify", "2024-01-02 00:00:00")}
    assert spark.read.parquet(f"{out}/rejects").first().reason == "lead_id_not_integer"
    assert json.loads(spark.read.parquet(f"{out}/rejects").first().raw)["Lead Id"] == "y"
    recordings = spark.read.parquet(f"{out}/recordings").collect()
    assert {(r.call_id, r.url, r.target_key) for r in recordings} == {
        ("1", "http://1", "1.mp3"), ("2", "http://2", "2.mp3"), ("3", "http://3", "3.mp3")
    }
    again = str(tmp_path / "again")
    main(["load-calls", source, out, again, "--broker-id", "b1"])
    for name in ("call", "lead"):
        both = [sorted(map(str, read_table(spark, root, name).collect())) for root in (out, again)]
        assert both[0] == both[1]


def test_load_the_other_tables(spark, tmp_path, tables):
    store(spark, tables, "lead", [(1, "old"), (2, "old")], "lead_id int, source string")
    source = put_csv(tmp_path / "leads.csv", normalize.LEAD_HEADERS, [["1", "web", "New", "7", "2024-01-01"], ["", "x", "", "", ""]])
    main(["load-leads", source, tables, str(tmp_path / "l")])
    assert {(r.lead_id, r.source) for r in read_table(spark, str(tmp_path / "l"), "lead").collect()} == {(1, "web"), (2, "old")}

    (tmp_path / "roster.json").write_text(json.dumps([{"name": "A", "role": "Jr"}, {"name": "A", "role": "Sr"}, {"name": "B"}]))
    main(["load-brokers", str(tmp_path / "roster.json"), tables, str(tmp_path / "b"), "--one-value"])
    assert {(r.broker_name, r.role) for r in read_table(spark, str(tmp_path / "b"), "broker").collect()} == {("A", "Sr"), ("B", None)}

    (tmp_path / "t.json").write_text('{"call_id":"1","transcript":"x"}\n{"call_id":"1","transcript":"y"}\n{"transcript":"z"}\n')
    main(["load-transcripts", str(tmp_path / "t.json"), tables, str(tmp_path / "t")])
    got = read_table(spark, str(tmp_path / "t"), "transcript").collect()
    assert sorted((r.call_id or "", r.transcript) for r in got) == [("", "z"), ("1", "y")]


def test_pages_to_csv_and_pending(spark, tmp_path, capsys):
    pages = tmp_path / "pages"
    pages.mkdir()
    record = lambda i: {"id": str(i), "startTime": f"2024-01-0{i}T00:00:00", "recording": {"contentUri": f"u{i}"}}
    page = {"records": [record(1), record(2)], "navigation": {"nextPage": {"uri": "next"}}}
    (pages / "p1.json").write_text(json.dumps(page))
    (pages / "p2.json").write_text("{broken")
    landed = str(tmp_path / "landed")
    main(["land-pages", str(pages), landed])
    assert "{'cursor': 'next'}" in capsys.readouterr().out
    assert spark.read.parquet(f"{landed}/malformed").count() == 1
    (pages / "p1.json").write_text(json.dumps({"records": [record(3), record(2) | {"startTime": "2024-01-02T01:00:00"}]}))
    main(["land-pages", str(pages), landed])
    (pages / "p1.json").write_text(json.dumps(page))
    out = str(tmp_path / "csv")
    main(["export-records", f"{landed}/records", out, "--feed", "telephony", "--lines", "--files", "1"])
    rows = spark.read.option("header", True).csv(out).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "2024-01-01T00:00:00"), ("2", "2024-01-02T01:00:00"), ("3", "2024-01-03T00:00:00")
    ]

    main(["pending-recordings", f"{landed}/records", str(pages), str(tmp_path / "all"), "--lines"])
    assert spark.read.parquet(str(tmp_path / "all")).count() == 3

    single, stored = tmp_path / "single", tmp_path / "store"
    single.mkdir(), stored.mkdir()
    for i in (1, 2):
        (single / f"{i}.json").write_text(json.dumps(record(i)))
    (stored / "1.mp3").write_bytes(b"x")
    main(["pending-recordings", str(single), str(stored), str(tmp_path / "pending")])
    assert [r.call_id for r in spark.read.parquet(str(tmp_path / "pending")).collect()] == ["2"]
    (single / "3.json").write_text("{")
    main(["export-records", str(single), str(tmp_path / "lenient"), "--only-recorded"])
    with pytest.raises(ValueError):
        main(["export-records", str(single), str(tmp_path / "strict"), "--strict"])


def test_split_and_expired(spark, tmp_path):
    source = put_csv(tmp_path / "in" / "calls.csv", ["a", "b"], [[i, "x\ny"] for i in range(25)])
    main(["split-export", source, str(tmp_path / "out"), "--rows", "10"])
    assert sorted(d for d in os.listdir(tmp_path / "out") if "=" in d) == [f"chunk=calls-part{i}.csv" for i in (1, 2, 3)]
    os.utime(source, (0, 0))
    main(["list-expired", str(tmp_path / "in"), str(tmp_path / "old"), "--as-of", "2024-01-01"])
    assert spark.read.parquet(str(tmp_path / "old")).count() == 1


def test_check_tables(spark, tmp_path, tables):
    store(spark, tables, "call", [("1", 7), ("1", 7), ("2", None)], "call_id string, lead_id int")
    main(["check-tables", tables, str(tmp_path / "out")])
    report = lambda name: [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out/{name}").collect()]
    assert report("call_call_id_broken") == [("1", 2)]
    assert report("call_lead_id_orphans") == [(7, 2)]
    assert len(os.listdir(tmp_path / "out")) == 6 + 5 + 5
    assert report("broker_overlong") == []
    assert set(TABLES) == {"stage", "lead", "customer", "call", "broker", "transcript"}
    assert read_table(spark, tables, "call").filter(F.col("lead_id") == 7).count() == 2


def test_rows_of_a_table(spark, tmp_path, tables, capsys):
    step = lambda n: str(tmp_path / f"step{n}")
    rows = put_csv(tmp_path / "rows.csv", ["stage_id", "stage_name"], [[1, "first"], [6, "o'clock"], [7, "x"]])
    main(["insert-rows", tables, "stage", rows, step(1)])
    main(["update-rows", step(1), "stage", "stage_id = 1", step(2), "--set", "description='new'", "--set", "stage_name=upper(stage_name)"])
    main(["delete-rows", step(2), "stage", "stage_id = 6 OR description = 'old'", step(3)])
    got = read_table(spark, step(3), "stage").orderBy("stage_id").collect()
    assert [tuple(r) for r in got] == [(1, "FIRST", "new"), (7, "x", None)]
    create_tables(spark, step(4))
    store(spark, step(4), "stage", [(1, "only")], "stage_id int, stage_name string")
    main(["query", step(4), "SELECT stage_name, count(*) AS n FROM stage GROUP BY stage_name"])
    assert "only" in capsys.readouterr().out
    main(["query", step(4), "SELECT * FROM stage LEFT JOIN lead USING (stage_id)", "--out", step(5)])
    assert spark.read.parquet(step(5)).count() == 1
