"""Normalisation, keyed loads, joins and reports on small tables."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callflow.operators import filters, joins, merge, normalize, quality, retention
from callflow.plans import inputs
from callflow.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES, create_tables
from callflow.sources.exports import ORDER
from callflow.sources.tables import read_table, run_sql, save_bucketed


def call_rows(spark, *rows):
    names = [*normalize.CALL_HEADERS, ORDER]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join(f"`{n}` string" for n in names[:-1]) + f", {ORDER} int")


def test_call_rows_and_reasons(spark):
    rows = call_rows(
        spark,
        ("1", "10", "In", "2024-01-02 03:04:05", "0:01:00", "http://a"),
        ("", "10", "In", "2024-01-02 03:04:05", "0:01:00", None),
        ("2", "x", "In", "bad", "99999999:0:0", None),
        ("3", "11", "In", "bad", "99999999:0:0", None),
        ("4", "12", "NULL", "", "99999999:0:0", None),
        ("5", None, None, None, None, None),
    )
    normalized = normalize.normalize_calls(rows, "b1")
    good, rejects = normalize.split_rejects(normalized)
    assert [(r.call_id, r.lead_id, r.call_type, r.date_time, r.talk_time) for r in good.orderBy(ORDER).collect()] == [
        ("1", 10, "In", datetime(2024, 1, 2, 3, 4, 5), 60),
        ("5", None, None, None, None),
    ]
    assert {r.broker_id for r in good.collect()} == {"b1"}
    assert [r.reason for r in rejects.orderBy(ORDER).collect()] == [
        "call_id_missing", "lead_id_not_integer", "time_unparsable", "talk_time_out_of_range"
    ]
    assert '"Lead Id":"x"' in rejects.orderBy(ORDER).collect()[1].raw
    # leads come from rows the call table rejects too, but not from a bad time
    leads = normalize.leads_of_calls(normalized).orderBy(ORDER).collect()
    assert [(r.lead_id, r.source, r.creation_date is None) for r in leads] == [
        (10, "Velocify", False), (10, "Velocify", False), (12, "Velocify", True)
    ]


def test_missing_headers(spark):
    rows = spark.createDataFrame([("1", 0)], f"`Call Id` string, {ORDER} int")
    row = normalize.split_rejects(normalize.normalize_calls(rows))[0].first()
    assert (row.call_id, row.lead_id, row.talk_time, row.broker_id) == ("1", None, None, None)


def test_values_are_data_not_sql(spark):
    rows = spark.createDataFrame([("1", "O'Brien; DROP", None, None, None, 0)], "Id string, `Lead Source` string, Status string, `Lead Score #` string, `Date Added` string, _position int")
    assert normalize.split_rejects(normalize.normalize_leads(rows))[0].first().source == "O'Brien; DROP"


def test_brokers_keep_their_id(spark):
    roster = spark.createDataFrame([("A", "1"), ("A", "2"), (None, "3"), (None, "4")], "name string, phoneNumber string")
    roster = roster.withColumn(ORDER, F.monotonically_increasing_id())
    once = normalize.normalize_brokers(roster)
    empty = spark.createDataFrame([], TABLES["broker"])
    loaded = merge.upsert(empty, once, "broker_name").collect()
    assert sorted((r.broker_name or "", r.phonenumber) for r in loaded) == [("", "3"), ("", "4"), ("A", "2")]
    assert len({r.broker_id for r in loaded}) == 3
    assert loaded[0].asDict().keys() == set(TABLES["broker"].names)


def random_batch(rng, n, keys=20):
    return [(rng.choice([None, *range(keys)]), rng.randrange(1000), i) for i in range(n)]


def table_of(spark, rows):
    return spark.createDataFrame(rows, f"k int, v int, {ORDER} int")


def by_hand(target, batch):
    """Delete the key, insert the row, one row after the other."""
    kept = list(target)
    for k, v, _ in batch:
        kept = [r for r in kept if k is None or r[0] != k] + [(k, v)]
    return kept


def sort(rows):
    return sorted(tuple(r) for r in rows) if not any(r[0] is None for r in rows) else sorted(
        (str(r[0]), r[1]) for r in rows
    )


@pytest.mark.parametrize("seed", range(3))
def test_upsert_properties(spark, seed):
    rng = random.Random(seed)
    target = [(k, -k) for k in range(5, 15)]
    batch = random_batch(rng, 60)
    stored = spark.createDataFrame(target, "k int, v int")
    rows = table_of(spark, batch)
    once = merge.upsert(stored, rows, "k")
    assert sort(once.collect()) == sort(by_hand(target, batch))
    keyed = rows.filter("k is not null")
    loaded = merge.upsert(stored, keyed, "k", keyless=False)
    assert sort(merge.upsert(loaded, keyed, "k", keyless=False).collect()) == sort(loaded.collect())
    cut = rng.randrange(60)
    first = merge.upsert(stored, keyed.filter(F.col(ORDER) < cut), "k", keyless=False)
    both = merge.upsert(first, keyed.filter(F.col(ORDER) >= cut), "k", keyless=False)
    assert sort(both.collect()) == sort(loaded.collect())


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.col("id").alias(ORDER))
    for pick, want in ((merge.last_per_key, {997, 998, 999}), (merge.first_per_key, {0, 1, 2})):
        picked = pick(rows, "k")
        plan = picked._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
        assert {r.v for r in picked.collect()} == want


@pytest.mark.parametrize("seed", range(2))
def test_insert_absent_properties(spark, seed):
    rng = random.Random(seed)
    target, batch = [(k, -k) for k in range(5, 15)], random_batch(rng, 60)
    want = list(target)
    for k, v, _ in batch:
        if k is not None and k not in [r[0] for r in want]:
            want.append((k, v))
    stored = spark.createDataFrame(target, "k int, v int")
    got = merge.insert_absent(stored, table_of(spark, batch), "k")
    assert sort(got.collect()) == sort(want)
    assert sort(merge.insert_absent(got, table_of(spark, batch), "k").collect()) == sort(want)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange hashpartitioning" in line for line in plan.splitlines())


def test_a_small_batch_does_not_shuffle_the_table(spark, tmp_path):
    spark.range(200_000).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("v")).write.parquet(str(tmp_path / "t"))
    spark.range(10).select((F.col("id") + 199_995).cast("int").alias("k"), F.lit(1).alias("v"), F.col("id").cast("int").alias(ORDER)).write.parquet(str(tmp_path / "b"))
    target, batch = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "b"))
    # the batch is shuffled to its keys, the table is only scanned
    inserted = merge.absent_rows(target, batch, "k")
    assert exchanges(inserted) <= 2 and "LeftSemi, BuildRight" in inserted._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.k for r in inserted.collect()) == [200_000 + i for i in range(5)]
    replaced = merge.upsert(target, batch, "k", keyless=False)
    assert exchanges(replaced) <= 2 and replaced.count() == 200_005


def test_a_bucketed_table_is_not_shuffled(spark):
    save_bucketed(spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit(0).alias("v")), "bucketed_t", "k", 16)
    batch = table_of(spark, [(k, 1, i) for i, k in enumerate(range(990, 1010))])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge.upsert(spark.table("bucketed_t"), batch, "k", keyless=False)
        plan = merged._jdf.queryExecution().executedPlan().toString().splitlines()
        scan = next(i for i, line in enumerate(plan) if "Bucketed: true" in line)
        above = [line.split("+- ")[-1].split(":- ")[-1] for line in plan[scan - 2 : scan]]
        assert [line.split(" ")[0] for line in above] == ["SortMergeJoin", "Sort"]  # no Exchange
        assert merged.count() == 1010 and merged.filter("v = 1").count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_predicates_that_are_unknown_change_nothing(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k int, v string")
    assert sort(merge.delete_where(rows, F.col("v") == "a").collect()) == [("2", None), ("None", "c")]
    updated = merge.update_where(rows, F.col("k") == 1, v=F.concat(F.col("v"), F.lit("!")), k=F.col("k") + 10)
    assert {(r.k, r.v) for r in updated.collect()} == {(11, "a!"), (2, None), (None, "c")}
    assert updated.dtypes == rows.dtypes
    assert merge.append(rows, rows).count() == 6


def hot_rows(spark, value):
    # one key holds a third of the rows, some keys match nothing, some are NULL
    key = F.when(F.col("id") % 3 == 0, 7 if value else None).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
    return spark.range(6000).select(key.cast("int").alias("k"), F.col("id"))


@pytest.mark.parametrize("how", ["left", "left_anti"])
@pytest.mark.parametrize("limit", ["-1", "10MB"])
@pytest.mark.parametrize("value", [7, None])
def test_join_with_hot_keys_and_doubles(spark, how, limit, value):
    rows = hot_rows(spark, value)
    others = [(k, str(k)) for k in range(30)] + [(7, "again"), (8, "again")]
    unique = spark.createDataFrame(others, "k int, w string")
    held = [(r.k, r.id) for r in rows.collect()]
    if how == "left":
        want = sort([(i, w) for k, i in held for w in [w for o, w in others if o == k] or [""]])
    else:
        want = sort([(i,) for k, i in held if k is None or k >= 30])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = joins.join_unique(rows, unique, "k", how)
        columns = ["id", F.coalesce("w", F.lit("")).alias("w")] if how == "left" else ["id"]
        assert sort(got.select(*columns).collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_nameless_brokers_are_not_doubled(spark):
    entries = [(None, "1", 0), ("Ann", "2", 1), (None, "3", 2)]
    roster = spark.createDataFrame(entries, f"name string, phoneNumber string, {ORDER} int")
    rows = normalize.normalize_brokers(roster)
    once = merge.upsert_brokers(normalize.as_table(spark.createDataFrame([], "broker_id string"), "broker"), rows)
    twice = merge.upsert_brokers(once, rows)
    assert sort([tuple(map(str, r)) for r in twice.collect()]) == sort([tuple(map(str, r)) for r in once.collect()])
    assert once.count() == 3


def test_a_batch_is_evaluated_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    source = spark.createDataFrame([(i % 7, i, i) for i in range(100)], f"k int, v int, {ORDER} int")
    target = spark.range(5).select(F.col("id").cast("int").alias("k"), F.lit(-1).alias("v"))
    for load in (merge.upsert, merge.insert_absent):
        before = reads.value
        load(target, source.mapInArrow(counted, source.schema), "k").collect()
        assert reads.value - before == 100


def test_call_report_keeps_every_call(spark):
    calls = normalize.as_table(spark.createDataFrame([("1", "b"), ("2", "x"), ("3", None)], "call_id string, broker_id string"), "call")
    brokers = normalize.as_table(spark.createDataFrame([("b", "Ann")], "broker_id string, broker_name string"), "broker")
    spoken = normalize.as_table(spark.createDataFrame([("2", "hi"), (None, "lost")], "call_id string, transcript string"), "transcript")
    got = joins.call_report(calls, brokers, spoken)
    assert len(got.columns) == 17
    assert sort([(r.call_id, r.broker_name or "", r.transcript or "") for r in got.collect()]) == [
        ("1", "Ann", ""), ("2", "", "hi"), ("3", "", "")
    ]


def test_reports(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "é" * 128), (None, "c" * 255)], "lead_id int, source string")
    leads = normalize.as_table(rows, "lead")
    assert sorted((r.lead_id or -1, r.n) for r in quality.broken_keys(leads, "lead_id").collect()) == [(-1, 1), (1, 2)]
    assert [tuple(r) for r in quality.overlong_text(leads, "lead_id", "lead").collect()] == [(2, "source", 256)]
    referenced = spark.createDataFrame([(1,), (1,)], "id int")
    assert [r.lead_id for r in quality.orphan_rows(leads, "lead_id", referenced, "id").collect()] == [2]
    assert [tuple(r) for r in quality.orphan_keys(leads, "lead_id", referenced, "id").collect()] == [(2, 1)]


def test_age_boundary(spark):
    as_of = datetime(2024, 3, 31, 12)
    times = {"29": datetime(2024, 3, 2, 12), "30": datetime(2024, 3, 1, 12), "31": datetime(2024, 2, 29, 12), "?": None}
    rows = spark.createDataFrame(list(times.items()), "name string, t timestamp_ntz")
    kept, expired = retention.split_by_age(rows, "t", as_of)
    assert {r.name for r in kept.collect()} == {"29", "30", "?"}
    assert {r.name for r in expired.collect()} == {"31"}


def test_windows(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, d),) for d in range(1, 6)], "t timestamp_ntz")
    count = lambda c: rows.filter(c).count()
    assert count(filters.in_window(F.col("t"))) == 5
    assert count(filters.in_window(F.col("t"), datetime(2024, 1, 2), datetime(2024, 1, 4))) == 2
    assert count(filters.on_day_before(F.col("t"), datetime(2024, 1, 3).date())) == 1


def test_empty_tables(spark, tmp_path):
    create_tables(spark, str(tmp_path))
    for name, schema in TABLES.items():
        stored = read_table(spark, str(tmp_path), name)
        assert stored.schema == schema and stored.count() == 0
        assert PRIMARY_KEYS[name] in stored.columns
    assert all(column in TABLES[table].names and other in TABLES for table, column, other in FOREIGN_KEYS)


def test_sql_over_tables(spark):
    stage = spark.createDataFrame([(1, "x", True)], "stage_id int, stage_name string, open boolean")
    assert [tuple(r) for r in run_sql(spark, "SELECT * FROM {stage}", stage=stage).collect()] == [(1, "x", True)]


def test_splits_lose_no_row(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    normalized = normalize.normalize_calls(inputs.call_export(events))
    good, rejects = normalize.split_rejects(normalized)
    assert good.count() + rejects.count() == events.count() and rejects.count() > 0
    kept, expired = retention.split_by_age(events, "ts", datetime(2024, 2, 14))
    assert sort([(r.event_id,) for r in kept.select("event_id").union(expired.select("event_id")).collect()]) == [
        (i,) for i in range(events.count())
    ]
