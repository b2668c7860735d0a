"""Large files whose lines are their rows: found by ranges, split, and read as whole ones are."""

import pytest
from pyspark.sql import functions as F

from callflow.operators import normalize
from callflow.sources import exports, lines, listing
from callflow.streaming import arrivals

CALLS = ",".join(normalize.CALL_HEADERS)
PLAIN = {
    "plain": b'a,b\n1,"x, ""y"""\n\n2,\n3,"",\n4,z',
    "windows": b'a,b\r\n1,"x"\r\n\r\n2,y\r\n',
}
OTHERS = {
    "breaks": b'a,b\n1,"x\ny"\n2,z\n',
    "quote_inside": b'a,b\n1,x"y\n2,"u\n3,v"\n',
    "late_quote": b'a,b\n1,x"y,"u\n3,v"\n',
    "mixed": b'a,b\r\n1,x\n2,y\r\n',
    "carriage": b'a,b\n1,x\ry\n2,z\n',
    "white": b'a\n  \nx\n',
    "packed.gz": b"",
}


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(lines, "LARGE", 1)
    monkeypatch.setattr(lines, "RANGE", 5)
    monkeypatch.setattr(lines, "STEP", 3)


def listed(spark, folder):
    return [(r.path, r.length) for r in listing.list_objects(spark, str(folder)).collect()]


def test_only_files_that_read_the_same_by_line_are_named(spark, tmp_path, small):
    for name, data in (PLAIN | OTHERS).items():
        (tmp_path / name).write_bytes(data)
    files = listed(spark, tmp_path)
    found = lines.read_by_line(spark, files)
    assert {p.rpartition("/")[2] for p in found} == set(PLAIN)

    def cells(**more):
        for name in PLAIN | OTHERS:
            read = exports.read_export(spark, str(tmp_path / name), ("a", "b"), **more)
            yield name, [tuple(r) for r in read.orderBy(exports.ORDER).drop(exports.ORDER).collect()]

    assert dict(cells(by_line=found)) == dict(cells())


def test_small_files_are_not_looked_at(spark, tmp_path):
    (tmp_path / "plain").write_bytes(PLAIN["plain"])
    assert lines.read_by_line(spark, listed(spark, tmp_path)) == set()


@pytest.mark.parametrize("kind", ["plain", "breaks"])
def test_a_large_file_is_loaded_by_many_tasks_if_its_lines_are_rows(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(lines, "LARGE", 1 << 16)
    monkeypatch.setattr(lines, "RANGE", 1 << 15)
    word = '"a ""b"", c"' if kind == "plain" else '"a\nb"'
    rows = [f"{i},5,{word},2024-01-01 00:00:00,0:00:01," for i in range(4000)]
    inbox, root = tmp_path / "inbox", str(tmp_path / "tables")
    inbox.mkdir()
    (inbox / "calls.csv").write_text("\n".join([CALLS, *rows]) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        arrivals.load_arrived_calls(spark, str(inbox), root, str(tmp_path / "check"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    got = arrivals.changes(spark, root, "calls", "call")
    assert got.select(F.col("place.block")).distinct().count() > 1 if kind == "plain" else got.filter("place.block > 0").isEmpty()
    got = {r.call_id: r.call_type for r in arrivals.current_calls(spark, root).collect()}
    assert got == {str(i): 'a "b", c' if kind == "plain" else "a\nb" for i in range(4000)}


def test_one_file_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 4).select(
        F.col("id").cast("string").alias("a b"), F.concat(F.lit('x "y", '), "id").alias('c "d"'), F.lit("").alias("e")
    )
    for part, number in ((rows, 1000), (rows.filter("`a b` = 'none'"), 0)):
        exports.write_file(part, str(tmp_path / f"in/{number}.csv"))
        read = exports.read_export(spark, str(tmp_path / f"in/{number}.csv"))
        assert read.columns[:3] == rows.columns
        read = [(r[0], r[1], r[2] or "") for r in read.orderBy(exports.ORDER).collect()]
        assert read == [(str(i), f'x "y", {i}', "") for i in range(number)]
