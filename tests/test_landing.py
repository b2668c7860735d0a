"""JSON landing zone, listings and recordings on files written for the test."""

import json
import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from callflow.functions import records
from callflow.operators import export, manifest, retention
from callflow.sources import landing, listing
from callflow.sources.exports import ORDER


def put(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.json").write_text(text if isinstance(text, str) else json.dumps(text))
    return str(folder)


def test_only_objects_are_records(spark, tmp_path):
    path = put(
        tmp_path / "landing",
        a={"id": "1", "start_time": "t1", "recording": {"x": 1}},
        b=[{"id": "2"}],
        c='"text"',
        d="{broken",
        e={"id": "3", "recording": {}},
        f={"id": "4", "recording": None},
        g={"id": "5", "recording": ""},
        h={"start_time": "t6"},
        i='{"id": "7",\n "recording": "u"}',
    )
    (tmp_path / "landing" / "x.txt").write_text('{"id": "8"}')
    objects, malformed = landing.split_objects(landing.read_json(spark, path))
    rows = export.project_records(objects, records.TRACKING_START).collect()
    assert sorted((r.id or "", r.start_time or "") for r in rows) == [
        ("", "t6"), ("1", "t1"), ("3", ""), ("4", ""), ("5", ""), ("7", "")
    ]
    assert [os.path.basename(r.path) for r in malformed.collect()] == ["d.json"]
    recorded = export.project_records(objects, records.TRACKING_START, only_recorded=True)
    assert sorted(r.id for r in recorded.collect()) == ["1", "7"]


def test_telephony_pages(spark, tmp_path):
    page = lambda ids, nxt: {"records": [{"id": i} for i in ids], "navigation": {"nextPage": nxt}}
    folder = tmp_path / "pages"
    path = put(folder, p1=page("ab", {"uri": "u2"}), p2=page("c", {"uri": "u3"}), p3=page("", None))
    for i, name in enumerate(("p1", "p2", "p3")):
        os.utime(folder / f"{name}.json", (1_000_000_000 + i, 1_000_000_000 + i))
    pages, _ = landing.split_objects(landing.read_json(spark, path))
    listed = landing.page_records(pages).orderBy("position", "place")
    assert [r[0] for r in listed.select(records.member(F.col("record"), "$.id")).collect()] == ["a", "b", "c"]
    assert landing.open_cursor(pages).collect() == []
    earlier = pages.filter(~F.col("path").endswith("p3.json"))
    assert [r.cursor for r in landing.open_cursor(earlier).collect()] == ["u3"]


def test_numbered_pages(spark, tmp_path):
    path = put(tmp_path / "pages", p1={"calls": [{"id": i} for i in range(3)]}, p2={"calls": [{"id": 3}]}, p3={})
    pages, _ = landing.split_objects(landing.read_json(spark, path))
    pages = pages.withColumn("number", F.regexp_extract("path", r"p(\d+)\.json", 1).cast("int"))
    assert landing.page_records(pages, records.TRACKING_RECORDS).count() == 4
    row = landing.numbered_pages_complete(pages.filter("number < 3"), "number", page_size=3).first()
    assert (row.last_page, row.complete) == (2, True)
    row = landing.numbered_pages_complete(pages.filter("number < 2"), "number", page_size=3).first()
    assert (row.last_page, row.complete) == (1, False)
    assert landing.numbered_pages_complete(pages, "number", page_size=3).first().complete is True


def test_landing_keeps_the_last_record_of_an_id(spark, tmp_path):
    inbox = put(
        tmp_path / "in",
        p1={"records": [{"id": "1", "startTime": "2024-01-01T00:00:00", "v": 1}, {"v": "none"}, {"id": None, "v": "null"}]},
        p2={"records": [{"id": "1", "startTime": "2024-01-02T00:00:00", "v": 2, "deep": {"a": [1, None]}}]},
    )
    for i, name in enumerate(("p1", "p2")):
        os.utime(f"{inbox}/{name}.json", (1_000_000_000 + i, 1_000_000_000 + i))

    def land(out):
        pages, _ = landing.split_objects(landing.read_json(spark, inbox))
        latest = export.latest_records(landing.page_records(pages), F.struct("position", "place"))
        day = F.substring(records.member(records.parse(F.col("json")), "$.startTime"), 1, 10)
        export.land_records(latest, out, day)
        return latest

    latest = land(str(tmp_path / "out"))
    assert len({r.id for r in latest.collect()}) == 3
    assert {r.id for r in land(str(tmp_path / "again")).collect()} == {r.id for r in latest.collect()}
    objects, malformed = landing.split_objects(
        landing.read_json(spark, str(tmp_path / "out"), one_per_file=False, suffix="")
    )
    got = [json.loads(r[0]) for r in objects.select(records.as_text(F.col("record"))).collect()]
    assert malformed.count() == 0
    assert {"id": "1", "startTime": "2024-01-02T00:00:00", "v": 2, "deep": {"a": [1, None]}} in got
    assert len(got) == 3
    assert sorted(d for d in os.listdir(tmp_path / "out") if d.startswith("dt=")) == [
        "dt=2024-01-02", "dt=__HIVE_DEFAULT_PARTITION__"
    ]


def test_several_fetches_together(spark, tmp_path):
    for age, (name, lines) in enumerate({"a": ['{"id":"1","v":1}', '{"v":2}'], "b": ['{"id":"1","v":3}', '{"v":2}']}.items()):
        folder = tmp_path / "fetches" / name
        folder.mkdir(parents=True)
        (folder / "part").write_text("\n".join(lines))
        os.utime(folder / "part", (1_000_000_000 + age, 1_000_000_000 + age))
    paths = [str(tmp_path / "fetches" / n) for n in "ab"]
    objects, _ = landing.split_objects(landing.read_json(spark, paths, one_per_file=False, suffix=""))
    latest = landing.latest_objects(objects)
    assert latest.columns == objects.columns
    assert sorted(r[0] for r in latest.select(records.as_text(F.col("record"))).collect()) == [
        '{"id":"1","v":3}', '{"v":2}', '{"v":2}'
    ]


def test_recordings(spark, tmp_path):
    store = tmp_path / "store"
    (store / "day").mkdir(parents=True)
    for name in ("1.mp3", "day/4.mp3", "2.json"):
        (store / name).write_bytes(b"x")
    stored = listing.stored_recordings(listing.list_objects(spark, str(store), ".mp3"))
    rows = [("1", "http://a"), ("2", "http://b"), ("2", "https://c"), ("3", "pending"), ("4", "http://d"), ("", "http://e")]
    export_rows = spark.createDataFrame(
        [(*r, i) for i, r in enumerate(rows)], f"`Call Id` string, Recording string, {ORDER} int"
    )
    wanted = manifest.wanted_of_export(export_rows)
    assert sorted(r.call_id for r in wanted.collect()) == ["1", "2", "4"]
    assert [tuple(r) for r in manifest.pending(wanted, stored).collect()] == [("2", "https://c", "2.mp3")]
    nameless = manifest.wanted_of_export(export_rows.drop("Call Id"))
    assert [tuple(r) for r in nameless.collect()] == [("unknown", "http://e", "unknown.mp3")]

    path = put(
        tmp_path / "landing",
        a={"id": "7", "recording": {"contentUri": "u"}},
        b={"id": "8", "recording": None},
        c={"id": "9", "recording": {"contentUri": ""}},
        d={"id": "1", "recording": {"contentUri": "v"}},
    )
    objects, _ = landing.split_objects(landing.read_json(spark, path))
    assert [r.call_id for r in manifest.pending(manifest.wanted_of_records(objects), stored).collect()] == ["7"]


def test_listing_ages(spark, tmp_path):
    as_of = datetime(2024, 3, 31, 12)
    for days in (29, 30, 31):
        path = tmp_path / f"{days}.csv"
        path.write_text("x")
        stamp = as_of.replace(tzinfo=timezone.utc).timestamp() - days * 86400
        os.utime(path, (stamp, stamp))
    found = listing.list_objects(spark, str(tmp_path))
    assert "content" not in found.columns
    kept, expired = retention.split_by_age(found, "modificationTime", as_of)
    assert sorted(os.path.basename(r.path) for r in kept.collect()) == ["29.csv", "30.csv"]
    assert [os.path.basename(r.path) for r in expired.collect()] == ["31.csv"]
