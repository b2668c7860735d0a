"""Loads into tables far larger than the batch: prefilters, buckets, and reading from a row on."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from callflow.operators import buckets, merge, prefilter
from callflow.session import written
from callflow.sources import exports, heads, ranges


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def loads(spark):
    target = [(f"k{i}" if i % 3 else None, i, "old") for i in range(3000)]
    batch = [(f"k{i * 7}", i, "new", i) for i in range(600)] + [(None, 1, "new", 1), ("k7", 9, "newest", 10_000)]
    schema = "key string, n int, kind string"
    return spark.createDataFrame(target, schema), spark.createDataFrame(batch, f"{schema}, _position int")


@pytest.mark.parametrize("most_bytes", [48, 4000, 64 << 20])
def test_prefilter_changes_no_result(spark, loads, monkeypatch, most_bytes):
    target, batch = loads
    monkeypatch.setattr(prefilter.marked, "__defaults__", (most_bytes,))
    plain = merge.upsert(target, batch, "key")
    assert rows(merge.upsert(target, batch, "key", most=0)) == rows(plain)
    assert rows(merge.insert_absent(target, batch, "key")) == rows(
        target.unionByName(merge.absent_rows(target, batch, "key", most=0), allowMissingColumns=True)
    )


def test_prefilter_of_other_key_types_and_empty_sides(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "key int, kind string")
    batch = spark.createDataFrame([(2, "new", 1), (3, "new", 1)], "key long, kind string, _position int")
    want = [(1, "old"), (2, "new"), (3, "new"), (None, "old")]
    assert rows(merge.upsert(target, batch, "key", most=0)) == sorted(want, key=str)
    assert rows(merge.upsert(target, batch.limit(0), "key", most=0)) == rows(target)
    assert len(rows(merge.upsert(target.limit(0), batch, "key", most=0))) == 2


def test_prefilter_lets_few_other_rows_through(spark):
    table = spark.range(200_000).select(F.col("id").cast("string").alias("key"))
    keys = written(table.filter("key % 40 = 0"), "keys")
    through = prefilter.marked(table, keys, "key", 5000).filter("_may").count()
    assert 5000 <= through < 5000 + 195_000 * 0.05


def test_only_rows_that_may_match_are_shuffled(spark):
    table = written(spark.range(100_000).select(F.col("id").cast("string").alias("key"), F.lit("x" * 20).alias("text")), "t")
    keys = written(table.filter("key % 100 = 0").select("key"), "k")
    kept = merge.without_keys(table, keys, "key", 1000, 5000, most=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert kept.count() == 99_000
        counted = kept.groupBy("text").count()
        counted.collect()
        plan = counted._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan.toString() and "BroadcastHashJoin" in plan.toString()


def test_a_key_that_many_rows_share_is_split(spark):
    """A third of the table has one key of the batch, a third has none: neither gathers in one task."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    table = written(spark.range(300_000).select(key.alias("key"), F.sha2(F.col("id").cast("string"), 512).alias("text")), "t")
    keys = written(table.filter("key = 'hot' OR key % 5 = 0").select("key").distinct(), "k")
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        kept = merge.without_keys(table, keys, "key", 20_000, 100_000, most=0)
        assert kept.count() == 300_000 - 100_000 - 20_000
        rest = kept.filter("key IS NOT NULL")
        rest.write.format("noop").mode("overwrite").save()
        rest.collect()
        plan = rest._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan


SCHEMA = "key string, n int, kind string"


def test_bucket_loads_equal_upsert(spark, loads, tmp_path):
    target, batch = loads
    first = target.dropDuplicates(["n"])
    root = str(tmp_path / "table")
    buckets.create(first, root, "key", 16)
    assert rows(buckets.read(spark, root, SCHEMA)) == rows(first)
    buckets.upsert(spark, root, SCHEMA, batch)
    want = merge.upsert(first, batch, "key")
    assert rows(buckets.read(spark, root, SCHEMA)) == rows(want)
    buckets.upsert(spark, root, SCHEMA, batch.filter("key IS NULL"))  # adds one more row without key
    assert buckets.read(spark, root, SCHEMA).count() == want.count() + 1


def test_a_load_writes_the_buckets_of_its_keys(spark, tmp_path):
    root = str(tmp_path / "table")
    table = spark.range(20_000).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("n"), F.lit("x").alias("kind"))
    buckets.create(table, root, "key", 64)
    batch = spark.createDataFrame([("5", 2, "y", 1), ("new", 2, "y", 1)], f"{SCHEMA}, _position int")
    touched = buckets.upsert(spark, root, SCHEMA, batch)
    assert 1 <= len(touched) <= 2
    last = buckets.current(spark, root)
    sizes = {
        v: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{root}/data/{v}") for f in fs)
        for v in os.listdir(f"{root}/data")
    }
    assert sizes[last.version] < sum(sizes.values()) / 10
    assert buckets.read(spark, root, SCHEMA).filter("n = 2").count() == 2 and buckets.read(spark, root, SCHEMA).count() == 20_001
    assert len(buckets.unused(spark, root)) == len([b for b in touched])
    assert buckets.upsert(spark, root, SCHEMA, batch.limit(0)) == []


def test_a_killed_bucket_load_shows_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    buckets.create(spark.createDataFrame([("a", 1, "x")], SCHEMA), root, "key", 4)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(buckets, "_commit", killed)
        with pytest.raises(RuntimeError):
            buckets.upsert(spark, root, SCHEMA, spark.createDataFrame([("a", 2, "y", 1)], f"{SCHEMA}, _position int"))
    assert rows(buckets.read(spark, root, SCHEMA)) == [("a", 1, "x")]


def make_files(folder, seed):
    rng = random.Random(seed)
    folder.mkdir()
    for k in range(5):
        end = rng.choice([b"\n", b"\r\n"])
        header = [b"a,b", b"b,c,a"][k % 2]
        lines = [header] + [
            b",".join(rng.choice([b"", b'"q"" x"', b"word", b"\xc3\xbc", str(rng.randrange(10**6)).encode()]) for _ in header.split(b",")) or b"x"
            for _ in range(rng.choice([0, 1, 40, 200]))
        ]
        data = end.join(lines) + rng.choice([b"", end, end + end])
        name = f"f{k}.csv"
        if k == 3:
            data, name = gzip.compress(data), name + ".gz"
        (folder / name).write_bytes(data)
        os.utime(folder / name, (1_700_000_000 + 100 - k, 1_700_000_000 + 100 - k))


@pytest.mark.parametrize(("seed", "size"), [(1, 64), (2, 700), (3, 1 << 20)])
def test_reading_from_a_row_on(spark, tmp_path, seed, size):
    make_files(tmp_path / "in", seed)
    starts = ranges.row_starts(spark, str(tmp_path / "in"), size)
    files = sorted(r.path for r in starts.select("path").distinct().collect())
    assert len(files) == 5
    whole = {}
    for path in files:
        table = exports.read_export(spark, path, ("a", "b", "c"), multi_line=False)
        order = table.orderBy(exports.ORDER).collect()
        whole[path] = [(r.a or "", r.b or "", r.c or "") for r in order]
    for row in (0, 1, 17, 39, 1000):
        begin = spark.createDataFrame([(p, row) for p in files], "path string, row long")
        got = ranges.read_from(spark, starts, begin, ("a", "b", "c"))
        found = {}
        for r in got.orderBy("path", "row_index").collect():
            found.setdefault(r.path, []).append((r.row_index, (r.a or "", r.b or "", r.c or "")))
        assert found == {p: [(k, c) for k, c in enumerate(whole[p]) if k >= row] for p in files if len(whole[p]) > row}
    # Files by time: the later the number, the older.
    begin = ranges.after(starts, files[2], 5)
    assert sorted(tuple(r) for r in begin.collect()) == [(files[0], 0), (files[1], 0), (files[2], 5)]
    with pytest.raises(ValueError):
        ranges.after(starts, "file:/none", 0)


def test_ranges_before_the_row_are_not_opened(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = [f"{k},{'x' * 50}" for k in range(2000)]
    (folder / "a.csv").write_text("n,text\n" + "\n".join(lines) + "\n")
    (folder / "b.csv").write_text("n,text\n1,x\n")
    starts = ranges.row_starts(spark, str(folder), 10_000)
    begin = spark.createDataFrame([(f"file:{folder}/a.csv", 1900)], "path string, row long")
    got = ranges.read_from(spark, starts, begin)
    assert [int(r.n) for r in got.orderBy("row_index").collect()] == list(range(1900, 2000))
    asked = starts.filter("before + rows > 1901 AND path LIKE '%a.csv'").count()
    assert asked <= 2 and starts.count() == 13
    (folder / "b.csv").unlink()  # not needed
    assert got.count() == 100


def test_cells_with_many_names(spark, tmp_path):
    assert heads.column_names("a,a,,b") == ["a", "_1_a", "_2_", "b"]
