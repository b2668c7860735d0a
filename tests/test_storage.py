"""Listings on executors and the first bytes of files, against what Spark's readers see."""

import bz2
import gzip
import os

import pytest

from callflow.sources import exports, heads, listing, storage


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def make(folder, names):
    for k, name in enumerate(names):
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x" * (k + 1))
        os.utime(path, ns=(0, 1_700_000_000_123_456_789 + k * 10**6))


NAMES = [
    "a.csv", "b.CSV", "c d%20e+ü.csv", "plain", "x[1].csv", "sub/a.csv", "sub/deep/er/z.json", "sub/_hidden/a.csv",
    "sub/k=1/a.csv", "sub/_k=1/a.csv", ".dot/a.csv", "_SUCCESS", ".a.csv", "up._COPYING_", "empty.csv",
]


@pytest.mark.parametrize("suffix", ["", ".csv", ".CSV", ".none"])
def test_listing_equals_sparks_own(spark, tmp_path, suffix):
    make(tmp_path / "in", NAMES)
    got = rows(listing.list_objects(spark, str(tmp_path / "in"), suffix))
    assert got == rows(listing._listed_by_spark(spark, str(tmp_path / "in"), suffix))
    assert (len(got) > 0) == (suffix != ".none")
    (tmp_path / "in" / "empty.csv").write_text("")  # which Spark's own scan passes over
    assert len(rows(listing.list_objects(spark, str(tmp_path / "in"), suffix))) == len(got)


def test_listing_of_files_several_roots_and_no_root(spark, tmp_path):
    make(tmp_path / "in", NAMES)
    roots = [str(tmp_path / "in" / "sub"), str(tmp_path / "in" / "a.csv")]
    assert rows(listing.list_objects(spark, roots)) == rows(listing._listed_by_spark(spark, roots, ""))
    with pytest.raises(FileNotFoundError):
        listing.list_objects(spark, str(tmp_path / "none"))
    (tmp_path / "nothing").mkdir()
    assert listing.list_objects(spark, str(tmp_path / "nothing")).collect() == []


def test_folders_beyond_a_tasks_share_are_dealt_out(spark, tmp_path, monkeypatch):
    make(tmp_path / "in", [f"{a}/{b}/{c}.csv" for a in range(6) for b in range(6) for c in range(2)])
    monkeypatch.setattr(listing, "FOLDERS_PER_TASK", 4)
    assert rows(listing.list_objects(spark, str(tmp_path / "in"))) == rows(
        listing._listed_by_spark(spark, str(tmp_path / "in"), "")
    )


def test_a_hundred_thousand_names(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(100_000):
        open(folder / f"{k}.csv", "w").close()
    listed = listing.list_objects(spark, str(tmp_path))
    assert listed.select("path").distinct().count() == 100_000


def test_heads_of_files(spark, tmp_path):
    texts = {
        "a.csv": b'x,"y\nz",x,\r\n1,2,3,4\r\n', "bom.csv": b"\xef\xbb\xbfx,y\n", "blank.csv": b"\n\nx,y\n1,2\n",
        "none.csv": b"", "lines.csv": b"\n\n", "noend.csv": b"only", "g.csv.gz": gzip.compress(b"p,q\n1,2\n"),
        "b.csv.bz2": bz2.compress(b"p,q\n1,2\n"), "long.csv": ",".join(f"c{k}" for k in range(30_000)).encode() + b"\n1\n",
        "x[1]*.csv": b"star,y\n5,6\n", "bad.csv.gz": b"not packed",
    }
    for name, data in texts.items():
        (tmp_path / name).write_bytes(data)
    found = {os.path.basename(r.path): (r.names, bool(r.error)) for r in heads.file_heads(spark, str(tmp_path)).collect()}
    assert found.pop("long.csv")[0] == [f"c{k}" for k in range(30_000)]
    assert found == {
        "a.csv": (["x", "y\nz", "_2_x", "_3_"], False), "bom.csv": (["x", "y"], False), "blank.csv": (["x", "y"], False),
        "none.csv": (None, False), "lines.csv": (None, False), "noend.csv": (["only"], False),
        "g.csv.gz": (["p", "q"], False), "b.csv.bz2": (["p", "q"], False), "x[1]*.csv": (["star", "y"], False),
        "bad.csv.gz": (None, True),
    }
    for name in ("bad.csv.gz", "long.csv"):
        (tmp_path / name).unlink()
    table = exports.read_export(spark, str(tmp_path), ("x", "p", "star"))
    assert {(r.x, r.p, r.star) for r in table.collect()} == {("1", None, None), (None, "1", None), (None, None, "5")}


def test_heads_ask_for_few_bytes(tmp_path):
    asked = []

    class Watched:
        def __init__(self, file):
            self.file = file

        def read(self, n):
            asked.append(n)
            return self.file.read(n)

    (tmp_path / "a.csv").write_bytes(b"x,y\n" + b"1,2\n" * 5_000_000)
    system, inner = storage.opened(f"file:{tmp_path}/a.csv")
    with system.open_input_file(inner) as file:
        assert heads.first_record(Watched(file).read) == "x,y"
        assert file.tell() == heads.STEP and asked == [heads.STEP]


def test_heads_leave_the_rest_of_the_files_unread(spark, tmp_path):
    """What Spark itself reads for the headers: the listing, no byte of the files."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(b"x,y\n" + b"1,2\n" * 2_000_000)
    plan = heads.file_heads(spark, str(tmp_path / "in"))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "FileScan csv" not in plan


def test_schemes_that_arrow_does_not_know(spark, tmp_path):
    assert not storage.reachable("viewfs://store/a") and not storage.reachable("file:/tmp/*.csv")
    make(tmp_path / "in", ["a.csv", "sub/b.csv"])
    got = rows(listing.list_objects(spark, f"{tmp_path}/in/*"))
    assert len(got) == 2
    (tmp_path / "heads").mkdir()
    (tmp_path / "heads" / "a+b c.csv").write_text("\nx,y\n1,2\n")
    assert {tuple(r.names) for r in heads.file_heads(spark, f"{tmp_path}/heads/*.csv").collect()} == {("x", "y")}
