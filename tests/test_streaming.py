"""Arrivals: loaded once, in order, and equal to a batch load."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from callflow.operators import merge, normalize
from callflow.sources import exports
from callflow.streaming import arrivals

CALLS = ",".join(normalize.CALL_HEADERS)
LEADS = ",".join(normalize.LEAD_HEADERS)


def arrive(folder, name, header, lines, age):
    folder.mkdir(exist_ok=True, parents=True)
    path = folder / name
    path.write_text(header + "\n" + "".join(line + "\n" for line in lines))
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))


def call(i, lead, kind, recording=""):
    return f"{i},{lead},{kind},2024-01-0{1 + i % 9} 00:00:00,0:0{i % 9}:01,{recording}"


def snapshot(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_arrivals_equal_a_batch_load(spark, tmp_path):
    inbox, root, check = tmp_path / "inbox", str(tmp_path / "tables"), str(tmp_path / "check")
    load = lambda: arrivals.load_arrived_calls(spark, str(inbox), root, check, "b1", max_files=1)
    arrive(inbox, "z.csv", CALLS, [call(1, 5, "a", "http://1"), call(2, "x", "a"), call(3, 6, "a"), call(1, 5, "b")], 0)
    load()
    first = snapshot(arrivals.current_calls(spark, root))
    assert len(first) == 2
    arrive(inbox, "b.csv", CALLS, [call(3, 7, "c", "http://3"), call(4, 5, "c")], 10)
    arrive(inbox, "a.csv", CALLS, [call(4, 8, "d"), call(1, 5, "d", "http://1b")], 20)
    load()
    streamed = arrivals.current_calls(spark, root)

    rows = exports.read_export(spark, str(inbox), normalize.CALL_HEADERS)
    normalized = normalize.normalize_calls(rows, "b1")
    good, rejects = normalize.split_rejects(normalized)
    batch = merge.last_per_key(good.drop("recording", "names_lead"), "call_id")
    assert snapshot(streamed) == snapshot(batch)
    assert {r.call_id: r.call_type for r in streamed.collect()} == {"1": "d", "3": "c", "4": "d"}
    assert arrivals.rejects(spark, root).count() == rejects.count() == 1
    assert {(r.call_id, r.url) for r in arrivals.wanted_recordings(spark, root).collect()} == {
        ("1", "http://1b"), ("3", "http://3")
    }

    stored = normalize.as_table(spark.createDataFrame([(5, "kept")], "lead_id int, source string"), "lead")
    leads = arrivals.leads_with_calls(spark, root, stored)
    assert {(r.lead_id, r.source) for r in leads.collect()} == {
        (5, "kept"), (6, "Velocify"), (7, "Velocify"), (8, "Velocify")
    }

    before = sorted(os.listdir(f"{root}/calls"))
    assert len([n for n in before if n.startswith("load=")]) == 3
    load()  # nothing new
    assert sorted(os.listdir(f"{root}/calls")) == before
    assert snapshot(arrivals.current_calls(spark, root)) == snapshot(batch)

    # a snapshot of the first load and the loads after it give the same table
    base = str(tmp_path / "base")
    done = arrivals.loads(spark, root, "calls")[:1]
    first_load = arrivals.changes(spark, root, "calls", "call").filter(F.col("load").isin(done)).drop("load")
    merge.last_per_key(first_load, "call_id", "place").write.parquet(base)
    later = arrivals.current_calls(spark, root, spark.read.parquet(base), done=done)
    assert snapshot(later) == snapshot(batch)


def kinds(spark, root):
    return {r.call_id: r.call_type for r in arrivals.current_calls(spark, root).collect()}


def test_no_arrival_is_lost(spark, tmp_path):
    inbox, root, check = tmp_path / "inbox", str(tmp_path / "tables"), str(tmp_path / "check")
    load = lambda: arrivals.load_arrived_calls(spark, str(inbox), root, check)
    arrive(inbox, "new.csv", CALLS, [call(1, 5, "a")], 1000)
    load()
    arrive(inbox, "old.csv", CALLS, [call(2, 5, "b")], 1000 - 30 * 86_400)
    arrive(inbox, "c.CSV", CALLS, [call(3, 5, "c")], 1001)
    arrive(inbox, "plain", CALLS, [call(4, 5, "d")], 1002)
    arrive(inbox / "sub", "b.csv", CALLS, [call(5, 5, "e")], 1003)
    load()
    assert kinds(spark, root) == {"1": "a", "2": "b", "3": "c", "4": "d", "5": "e"}
    arrive(inbox, "new.csv", CALLS, [call(1, 5, "put again"), call(6, 5, "f")], 2000)
    for _ in range(2):
        load()
        assert kinds(spark, root) == {"1": "put again", "2": "b", "3": "c", "4": "d", "5": "e", "6": "f"}


def test_layouts_of_arrivals(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "tables")
    arrive(inbox, "a.csv", "Extra," + CALLS, ["x," + call(1, 5, "a")], 0)
    arrive(inbox, "b.csv", "Origin,Call Id", ["b,2"], 1)
    arrive(inbox, "c.csv", "Origin", ["no id"], 2)
    arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "check"))
    assert kinds(spark, root) == {"1": "a", "2": "b"}
    assert [r.reason for r in arrivals.rejects(spark, root).collect()] == ["call_id_missing"]


def test_recordings_without_call_ids_share_a_name(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "tables")
    arrive(inbox, "a.csv", "Origin,Recording", ["x,http://1", "y,http://2"], 0)
    arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "check"))
    got = arrivals.wanted_recordings(spark, root).collect()
    assert [(r.call_id, r.url, r.target_key) for r in got] == [("unknown", "http://2", "unknown.mp3")]


def test_a_new_checkpoint_keeps_later_rows(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "tables")
    for age, kind in enumerate(("first", "second")):
        arrive(inbox, f"{kind}.csv", CALLS, [call(1, 5, kind)], age)
        arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "check"))
    arrive(inbox, "third.csv", CALLS, [call(1, 5, "third")], 2)
    arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "renewed"), max_files=1)
    assert kinds(spark, root) == {"1": "third"}


def test_nothing_arrived_yet(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "tables")
    inbox.mkdir()
    arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "check"))
    for output in (arrivals.current_calls, arrivals.rejects, arrivals.wanted_recordings):
        assert output(spark, root).collect() == []
    stored = normalize.as_table(spark.createDataFrame([(5, "kept")], "lead_id int, source string"), "lead")
    assert arrivals.leads_with_calls(spark, root, stored).count() == 1


def test_lead_arrivals(spark, tmp_path):
    inbox, root, check = tmp_path / "inbox", str(tmp_path / "tables"), str(tmp_path / "check")
    arrive(inbox, "a.csv", LEADS, ["1,web,New,9,2024-01-01", '2,"a ""b""",,,', ",web,New,9,"], 0)
    arrivals.load_arrived_leads(spark, str(inbox), root, check)
    arrive(inbox, "b.csv", LEADS, ["1,phone,NULL,,1/2/2024 1:02:03 PM"], 10)
    arrivals.load_arrived_leads(spark, str(inbox), root, check)
    got = {r.lead_id: (r.source, r.lead_status, str(r.creation_date)) for r in arrivals.current_leads(spark, root).collect()}
    assert got == {1: ("phone", None, "2024-01-02 13:02:03"), 2: ('a "b"', None, "None")}
    assert [r.reason for r in arrivals.rejects(spark, root).collect()] == ["lead_id_missing"]


def test_files_put_again_at_one_time_stamp_all_load(spark, tmp_path):
    inbox, root, check = tmp_path / "inbox", str(tmp_path / "tables"), str(tmp_path / "check")
    load = lambda n: arrivals.load_arrived_calls(spark, str(inbox), root, check, max_files=n)
    for name, i in (("a.csv", 1), ("b.csv", 2)):
        arrive(inbox, name, CALLS, [call(i, 5, "old")], 0)
    load(10)
    for name, i in (("a.csv", 1), ("b.csv", 2)):
        arrive(inbox, name, CALLS, [call(i, 5, "new")], 100)
    load(1)  # ends, though each batch holds one of two files of one time
    assert kinds(spark, root) == {"1": "new", "2": "new"}
    for kind in ("newer", "newest"):  # two runs find two files of one time, then of the same time and another size
        for name, i in (("a.csv", 1), ("b.csv", 2)):
            arrive(inbox, name, CALLS, [call(i, 5, kind)], 200)
            load(1)
    assert kinds(spark, root) == {"1": "newest", "2": "newest"}
    assert len(arrivals.loads(spark, root, "calls")) == 7


def test_a_load_that_was_killed_shows_nothing(spark, tmp_path, monkeypatch):
    inbox, root = tmp_path / "inbox", str(tmp_path / "tables")
    arrive(inbox, "a.csv", CALLS, [call(1, 5, "a", "http://1"), call(2, "x", "a")], 0)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(arrivals.commits, "commit", killed)
        with pytest.raises(Exception):  # noqa: B017
            arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "check"))
    assert os.listdir(f"{root}/calls")  # written, but named by no commit
    for output in (arrivals.current_calls, arrivals.rejects, arrivals.wanted_recordings):
        assert output(spark, root).collect() == []
    for _ in range(2):
        arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "check"))
        assert kinds(spark, root) == {"1": "a"} and arrivals.rejects(spark, root).count() == 1


def test_a_file_is_loaded_once_whatever_the_checkpoint(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "tables")
    arrive(inbox, "a.csv", CALLS, [call(2, "x", "a")], 0)
    for check in ("one", "two", "one"):
        arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / check))
    assert arrivals.rejects(spark, root).count() == 1 and len(arrivals.loads(spark, root, "rejects")) == 1


def test_a_broken_file_does_not_stop_the_others(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "tables")
    load = lambda: arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "check"))
    inbox.mkdir()

    def packed(lines):
        return gzip.compress((CALLS + "\n" + "".join(line + "\n" for line in lines)).encode())

    many = [f"{os.urandom(16).hex()},5,cut,2024-01-01 00:00:00,0:00:01," for _ in range(9000)]
    (inbox / "a.csv.gz").write_bytes(packed([call(1, 5, "a")]))
    (inbox / "b.csv.gz").write_bytes(packed(many)[:-20_000])
    (inbox / "c.csv.gz").write_bytes(packed([call(3, 5, "c")]))
    (inbox / "d.csv.gz").write_bytes(b"no gzip at all")
    load()
    assert kinds(spark, root) == {"1": "a", "3": "c"}
    bad = {os.path.basename(r.path): r.error for r in arrivals.bad_files(spark, root).collect()}
    assert set(bad) == {"b.csv.gz", "d.csv.gz"} and all(bad.values())
    load()
    assert arrivals.bad_files(spark, root).count() == 2
    (inbox / "b.csv.gz").write_bytes(packed([call(2, 5, "whole")]))
    load()
    assert kinds(spark, root) == {"1": "a", "2": "whole", "3": "c"}


def test_only_broken_files(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "tables")
    inbox.mkdir()
    (inbox / "d.csv.gz").write_bytes(b"no gzip at all")
    arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "check"))
    assert arrivals.current_calls(spark, root).collect() == [] and arrivals.bad_files(spark, root).count() == 1


def test_empty_files_are_loaded_once(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "tables")
    inbox.mkdir()
    (inbox / "a.csv").write_text("")
    for _ in range(2):
        arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "check"))
    assert arrivals.current_calls(spark, root).collect() == [] and len(arrivals.loads(spark, root, "calls")) == 1
