"""Gaps and chains of pages, and pages that land as a stream, against brute force."""

import json
import os
import random

import pytest

from callflow.operators import pages
from callflow.streaming import commits
from callflow.streaming import pages as page_stream


def brute_gaps(numbers, first):
    out, seen = [], sorted(set(numbers))
    for number in seen:
        if number > first:
            out.append((first, number - 1, number - first))
        first = number + 1
    return out


@pytest.mark.parametrize("first", [0, 1])
def test_page_gaps(spark, first):
    rng = random.Random(first)
    feeds = {None: [5, 5, 6, 9], "a": [first], "b": list(range(first, 50)), "big": rng.sample(range(first, 5000), 3000)}
    rows = [(f, n) for f, numbers in feeds.items() for n in numbers] + [("a", None), ("only null", None)]
    got = pages.page_gaps(spark.createDataFrame(rows, "feed string, n int").repartition(5), "n", ["feed"], first)
    want = {(f, *gap) for f, numbers in feeds.items() for gap in brute_gaps(numbers, first)}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_page_gaps_of_one_feed_and_of_none(spark):
    got = pages.page_gaps(spark.createDataFrame([(2,), (4,), (4,)], "n long"), "n")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 1), (3, 3, 1)]
    assert pages.page_gaps(spark.createDataFrame([], "n long"), "n").collect() == []


def brute_chains(rows):
    following = {}
    for feed, page, to in rows:
        if page is not None:
            old = following.get((feed, page)) or ""
            following[(feed, page)] = max(old, to or "") or None
    before = {}
    for (feed, page), to in sorted(following.items(), key=lambda e: e[0][1]):
        if (feed, to) in following:
            before.setdefault((feed, to), (feed, page))
    after = {b: a for a, b in before.items()}
    placed, heads = {}, sorted((n for n in following if n not in before), key=str)
    for start in heads + sorted(before, key=lambda n: n[1]):
        node, k = start, 0
        while node is not None and node not in placed:
            placed[node] = (start[1], k)
            node, k = after.get(node), k + 1
    out = set()
    for (feed, page), to in following.items():
        chain, place = placed[(feed, page)]
        if to is None:
            ends = "end"
        elif (feed, to) not in following:
            ends = "open"
        elif before[(feed, to)] != (feed, page):
            ends = "joined"
        else:
            ends = "loop" if to == chain else None
        out.add((feed, page, chain, place, ends))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_cursor_chains(spark, seed):
    rng = random.Random(seed)
    rows = []
    for feed in (None, "a", "b"):
        names = [f"p{k}" for k in range(40)]
        for name in rng.sample(names, 33):
            rows.append((feed, name, rng.choice([*names, None, "", name, f"p{int(name[1:]) + 1}"])))
    rows += [("long", f"{k:04d}", f"{k + 1:04d}") for k in range(700)]
    rows += [("round", f"{k:03d}", f"{(k + 1) % 100:03d}") for k in range(100)]
    rows += [("self", "x", "x"), ("twice", "x", "y"), ("twice", "x", None), ("twice", "y", None), ("a", None, "p1")]
    table = spark.createDataFrame(rows, "feed string, page string, following string").repartition(4)
    got = pages.cursor_chains(table, "page", "following", ["feed"])
    assert {tuple(r) for r in got.collect()} == brute_chains(rows)
    assert got.count() == len(brute_chains(rows))
    report = {r.feed: (r.pages, r.chains, r.whole) for r in pages.fetch_report(got, ["feed"]).collect()}
    assert report["long"] == (700, 1, False) and report["round"] == (100, 1, False) and report["twice"] == (2, 1, True)


def test_chains_without_pages(spark):
    assert pages.cursor_chains(spark.createDataFrame([], "page string, following string"), "page", "following").collect() == []


def put(folder, name, ids, cursor, age, day="2024-01-01"):
    folder.mkdir(exist_ok=True, parents=True)
    listed = [{"id": i, "startTime": f"{day}T00:00:00", "from": name} for i in ids]
    page = {"records": listed, "navigation": {"nextPage": {"uri": cursor}} if cursor else {}}
    (folder / f"{name}.json").write_text(json.dumps(page))
    os.utime(folder / f"{name}.json", (1_700_000_000 + age, 1_700_000_000 + age))


def held(spark, root):
    return {r.id: json.loads(r.json)["from"] for r in page_stream.current_records(spark, root).collect()}


def test_pages_land_as_they_arrive(spark, tmp_path):
    inbox, root, check = tmp_path / "inbox", str(tmp_path / "landed"), str(tmp_path / "check")
    load = lambda: page_stream.land_arrived_pages(spark, str(inbox), root, check, max_files=1)
    cursor = lambda: [r.cursor for r in page_stream.open_cursor(spark, root).collect()]
    inbox.mkdir()
    load()
    assert held(spark, root) == {} and cursor() == []
    put(inbox, "p1", "ab", "u2", 10)
    put(inbox, "p2", "bc", "u3", 20)
    (inbox / "broken.json").write_text("{broken")
    os.utime(inbox / "broken.json", (1_700_000_000, 1_700_000_000))
    load()
    assert held(spark, root) == {"a": "p1", "b": "p2", "c": "p2"} and cursor() == ["u3"]
    assert [os.path.basename(r.path) for r in page_stream.malformed(spark, root).collect()] == ["broken.json"]
    page_stream.compact(spark, root)
    assert held(spark, root) == {"a": "p1", "b": "p2", "c": "p2"}
    put(inbox, "p3", "cd", None, 30)
    put(inbox, "p0", "ae", "u1", 5)  # arrives late, but stands first
    load()
    want = {"a": "p1", "b": "p2", "c": "p3", "d": "p3", "e": "p0"}
    assert held(spark, root) == want and cursor() == []
    page_stream.compact(spark, root)
    page_stream.compact(spark, root)
    load()
    assert held(spark, root) == want


def test_a_killed_snapshot_costs_nothing(spark, tmp_path, monkeypatch):
    inbox, root, check = tmp_path / "inbox", str(tmp_path / "landed"), str(tmp_path / "check")
    put(inbox, "p1", "ab", None, 10)
    page_stream.land_arrived_pages(spark, str(inbox), root, check)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "commit", killed)
        with pytest.raises(RuntimeError):
            page_stream.compact(spark, root)
    assert held(spark, root) == {"a": "p1", "b": "p1"}


def test_reading_after_a_snapshot_shuffles_the_new_part_only(spark, tmp_path):
    inbox, root, check = tmp_path / "inbox", str(tmp_path / "landed"), str(tmp_path / "check")
    put(inbox, "p1", [f"{k}" for k in range(5000)], "u2", 10)
    page_stream.land_arrived_pages(spark, str(inbox), root, check)
    page_stream.compact(spark, root)
    put(inbox, "p2", ["7", "x"], None, 20)
    page_stream.land_arrived_pages(spark, str(inbox), root, check)
    current = page_stream.current_records(spark, root)
    assert current.count() == 5001
    current.collect()
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan  # the snapshot stays where it lies
