"""Queries over the given tables, one per operator."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callflow.functions import records, text
from callflow.operators import buckets, export, filters, joins, manifest, merge, normalize, pages, quality, retention
from callflow.plans import inputs, jobs
from callflow.plans.inputs import table
from callflow.schemas import PRIMARY_KEYS, TABLES, create_tables
from callflow.session import new_work_path, written
from callflow.sources import batches, exports, landing, listing, ranges, tables
from callflow.sources.exports import ORDER
from callflow.streaming import arrivals
from callflow.streaming import pages as page_stream

CALL_COLUMNS = ("call_id", "call_platform", "broker_id", "lead_id", "call_type", "date_time", "talk_time")
SECOND_LOAD = datetime(2024, 1, 20)
AS_OF = datetime(2024, 2, 14)


def _normalized(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.call_export(table(spark, folder, "events"))
    return normalize.normalize_calls(rows, inputs.broker_of_call())


def _good(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = normalize.split_rejects(_normalized(spark, folder))
    return good.drop("recording", "names_lead")


def _calls(spark: SparkSession, folder: str) -> DataFrame:
    return merge.last_per_key(_good(spark, folder), "call_id")


def _transcripts(spark: SparkSession, folder: str) -> DataFrame:
    rows = normalize.normalize_transcripts(inputs.transcript_rows(table(spark, folder, "conversations")))
    return merge.last_per_key(rows, "call_id")


# functions


def duration_seconds(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.call_export(table(spark, folder, "events"))
    seconds = text.duration_seconds(F.col(f"`{normalize.CALL_HEADERS[4]}`"))
    return rows.select(F.col(ORDER).alias("seq"), seconds.alias("talk_time"))


def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.call_export(table(spark, folder, "events"))
    return rows.select(
        F.col(ORDER).alias("seq"),
        text.field(rows, "Call Id").alias("call_id"),
        text.field(rows, "Lead Id").alias("lead_text"),
        text.whole_number(text.field(rows, "Lead Id")).alias("lead_id"),
        text.field(rows, "No Such Header").alias("absent"),
    )


def object_keys(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("c_name")
    return table(spark, folder, "customer").select(
        "c_custkey",
        text.record_key(name).alias("record_key"),
        text.recording_key(name).alias("recording_key"),
        text.call_of_recording(F.concat(F.lit("store/day/"), text.recording_key(name))).alias("call_id"),
        text.chunk_key(F.concat(F.lit("in/"), name, F.lit(".csv")), F.col("c_nationkey")).alias("chunk_key"),
        text.stable_id(name).alias("stable_id"),
    )


def iso_times(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", text.iso_utc(F.col("ts")).alias("iso"))


def time_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Times of events written in each accepted form, and in one that is not, read back."""
    events = table(spark, folder, "events").select("event_id", "ts")
    written_as = ["yyyy-MM-dd HH:mm:ss", *text.EXPORT_TIME_FORMATS, "'at' HH:mm"]
    kind = F.col("event_id") % len(written_as)
    cell = F.coalesce(*[F.when(kind == k, F.date_format("ts", form)) for k, form in enumerate(written_as)])
    return events.select("event_id", text.timestamp(cell).alias("read"))


# sources


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All turns written as CSV, line breaks and quotes included, and read back."""
    turns = table(spark, folder, "conversations").select(
        *[F.col(c).cast("string").alias(c) for c in ("conv_id", "turn", "role", "text")]
    )
    path = new_work_path(spark, "turns")
    turns.write.options(**exports.write_options()).csv(path)
    rows = exports.read_export(spark, path, turns.columns)
    return rows.select(
        text.whole_number(F.col("conv_id")).cast("bigint").alias("conv_id"),
        text.whole_number(F.col("turn")).cast("bigint").alias("turn"),
        text.field(rows, "role").alias("role"),
        text.field(rows, "text").alias("text"),
    )


def large_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, whole texts with line breaks, written as CSV and read back."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").cast("string"), "lang", "text")
    path = new_work_path(spark, "documents")
    documents.write.options(**exports.write_options()).csv(path)
    rows = exports.read_export(spark, path, documents.columns)
    return rows.select(text.whole_number(F.col("doc_id")).cast("bigint").alias("doc_id"), "lang", "text")


def csv_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """All calls in files of three layouts: as they are, turned around with one column more, and one less."""
    rows = inputs.call_export(table(spark, folder, "events"))
    path, headers = new_work_path(spark, "layouts"), normalize.CALL_HEADERS
    layouts = [headers, ("Extra", *reversed(headers)), [h for h in headers if h != "Recording"]]
    for k, names in enumerate(layouts):
        part = rows.filter(F.col(ORDER) % 3 == k).withColumn("Extra", F.lit("more")).select(*names)
        part.write.options(**exports.write_options()).csv(f"{path}/layout{k}")
    found = exports.read_export(spark, path, headers)
    return found.select(
        text.field(found, "Call Id").alias("call_id"),
        text.field(found, "Lead Id").alias("lead_text"),
        text.field(found, "Origin").alias("origin"),
        text.field(found, "Recording").alias("recording"),
    )


def _orders_in_files(spark: SparkSession, folder: str) -> str:
    """Orders as CSV, ten thousand keys to a file, each in the order of its keys."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    orders = orders.withColumn("f", F.floor(F.col("o_orderkey") / 10_000))
    path = new_work_path(spark, "orders")
    sorted_orders = orders.repartition("f").sortWithinPartitions("f", "o_orderkey")
    sorted_orders.write.partitionBy("f").options(**exports.write_options()).csv(path)
    return path


def row_order(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each order in its file, as the scan tells it."""
    rows = exports.read_export(spark, _orders_in_files(spark, folder), ("o_orderkey",), multi_line=False)
    numbered = export.number_export_rows(rows)
    return numbered.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("row_index").alias("place"))


def resume_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders from some row of each file on, read by ranges of 64 KiB from stored row starts."""
    starts = ranges.row_starts(spark, _orders_in_files(spark, folder), 1 << 16)
    files = starts.select("path").distinct()
    begin = files.withColumn("row", _file_number() * 37 % 2500)
    rows = ranges.read_from(spark, starts, begin)
    return rows.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderpriority", F.col("row_index").alias("place")
    )


def _file_number() -> F.Column:
    return F.regexp_extract("path", "f=([0-9]+)/", 1).cast("bigint")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Listed ``.csv`` files of customers, one for each nation; those of suppliers are JSON."""
    path = new_work_path(spark, "listed")
    customers = table(spark, folder, "customer").select("c_nationkey", "c_name")
    customers.repartition("c_nationkey").write.partitionBy("c_nationkey").csv(f"{path}/customers")
    table(spark, folder, "supplier").write.json(f"{path}/suppliers")
    listed = listing.list_objects(spark, path, ".CSV").filter(F.col("length") > 0)
    nation = F.regexp_extract("path", "c_nationkey=([0-9]+)/", 1).cast("int")
    return listed.groupBy(nation.alias("nation")).agg(F.count(F.lit(1)).alias("files"))


def json_scan(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "props")
    parsed = records.with_record(events.filter(records.is_object_text(F.col("props"))), F.col("props"))
    record = F.col("record")
    return parsed.filter(record.isNotNull()).select(
        "event_id", records.member(record, "$.k", "bigint").alias("k"), records.as_text(record).alias("json")
    )


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = inputs.telephony_pages(table(spark, folder, "events"))
    placed = pages.select(F.col("number").cast("string").alias("path"), F.col("number").alias("position"), "text")
    return records.with_record(placed, F.col("text"))


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    listed = landing.page_records(_pages(spark, folder))
    record = F.col("record")
    return listed.select(
        F.col("position").alias("page"),
        "place",
        records.member(record, records.RECORD_ID).alias("id"),
        records.member(record, records.TELEPHONY_START).alias("start_time"),
    )


def open_cursor(spark: SparkSession, folder: str) -> DataFrame:
    return landing.open_cursor(_pages(spark, folder))


def page_counts(spark: SparkSession, folder: str) -> DataFrame:
    listed = landing.page_records(_pages(spark, folder))
    return listed.groupBy(F.col("position").alias("page")).agg(F.count(F.lit(1)).alias("n"))


def _tracking_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = inputs.tracking_pages(table(spark, folder, "orders"))
    placed = pages.select(F.col("number").cast("string").alias("path"), F.col("number").alias("position"), "text")
    return records.with_record(placed, F.col("text"))


def numbered_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Records of numbered pages with all extra members."""
    listed = landing.page_records(_tracking_pages(spark, folder), records.TRACKING_RECORDS)
    record = F.col("record")
    chosen = listed.select(
        F.col("position").alias("page"),
        "place",
        records.member(record, records.RECORD_ID).alias("id"),
        records.member(record, records.TRACKING_START).alias("start_time"),
        *landing.select_extra_fields(record),
    )
    return chosen


def pages_complete(spark: SparkSession, folder: str) -> DataFrame:
    return landing.numbered_pages_complete(_tracking_pages(spark, folder), "position")


def page_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of missing pages of three fetches, some of whose pages were taken out."""
    number = F.col("position")
    kept = _tracking_pages(spark, folder).filter((number % 7 != 3) & ~(number % 11).isin(4, 5))
    fetched = kept.select((number % 3).alias("feed"), F.floor(number / 3).alias("number"))
    return pages.page_gaps(fetched, "number", ["feed"], first=0)


def cursor_chains(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of ten records in fetches of up to 700, some missing, some with another next page, as chains."""
    made = inputs.telephony_pages(table(spark, folder, "events"), 10).filter(F.col("number") % 30 != 12)
    number, following = F.col("number"), F.get_json_object("text", records.TELEPHONY_NEXT_PAGE)
    following = (
        F.when(number % 10 == 9, F.lit(None).cast("string"))
        .when(number % 50 == 24, (number - 4).cast("string"))
        .when(number % 40 == 33, (number + 3).cast("string"))
        .otherwise(following)
    )
    landed = made.select(F.floor(number / 700).alias("feed"), number.cast("string").alias("page"), following.alias("following"))
    return pages.cursor_chains(landed, "page", "following", ["feed"])


def malformed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Landed values that are no JSON; arrays are valid and in neither part."""
    files = inputs.landed_files(table(spark, folder, "events"))
    values = files.select(F.col("event_id").alias("path"), F.col("text").alias("raw"))
    _, malformed = landing.split_objects(records.with_record(values, F.col("raw")))
    return malformed.select(F.col("path").alias("event_id"), "raw")


def wanted_records(spark: SparkSession, folder: str) -> DataFrame:
    """Recordings that records of the telephony pages name, the last one per call."""
    listed = landing.page_records(_pages(spark, folder))
    return manifest.wanted_of_records(listed.withColumn("position", F.struct("position", "place")))


def source_filters(spark: SparkSession, folder: str) -> DataFrame:
    calls = table(spark, folder, "events").withColumn(
        "kind", F.when(F.col("event_type").isin("view", "click"), "Voice").otherwise("Fax")
    )
    return filters.voice_with_recording(calls, "kind", "props", "ts", SECOND_LOAD).select("event_id", "ts")


def calls_yesterday(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.filter(filters.on_day_before(F.col("ts"), date(2024, 1, 16))).select("event_id", "ts")


def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    return tables.run_sql(spark, "SELECT * FROM {customer}", customer=table(spark, folder, "customer"))


def stored_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Calls and leads written as tables, joined and counted by SQL over the stored tables."""
    path = new_work_path(spark, "stored")
    create_tables(spark, path)
    _calls(spark, folder).write.mode("append").parquet(f"{path}/call")
    inputs.customer_leads(table(spark, folder, "customer")).write.mode("append").parquet(f"{path}/lead")
    statement = """
        SELECT l.source, c.call_type, count(*) AS calls, max(c.talk_time) AS longest
        FROM call AS c LEFT JOIN lead AS l ON c.lead_id = l.lead_id GROUP BY l.source, c.call_type
    """
    return jobs.query(spark, path, statement)


def feed_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two feeds appended; the dialer's rows have no record id."""
    dialer = inputs.call_export(table(spark, folder, "events"))
    dialer = dialer.select(text.field(dialer, "Call Id").alias("call_id"), F.col("Origin").alias("origin"))
    spoken = table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("call_id"), F.col("turn").alias("turn")
    )
    return merge.append(dialer, spoken)


# normalisation and loads


def reject_rows(spark: SparkSession, folder: str) -> DataFrame:
    _, rejects = normalize.split_rejects(_normalized(spark, folder))
    return rejects.select(F.col(ORDER).alias("seq"), "reason")


def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Reasons of both exports, with broken times, huge durations and leads without id besides."""
    events = table(spark, folder, "events")
    seq = F.col(ORDER)
    broken = {
        "Time": F.when(seq % 11 == 0, F.lit("soon")).otherwise(F.col("Time")),
        normalize.CALL_HEADERS[4]: F.when(seq % 13 == 0, F.lit("999999999:0:0")).otherwise(F.col(normalize.CALL_HEADERS[4])),
    }
    calls = normalize.normalize_calls(inputs.call_export(events).withColumns(broken))
    cells = {
        "Id": F.when(seq % 7 == 0, F.lit("")).when(seq % 7 == 1, F.lit("1e3")).otherwise(F.col("Id")),
        "Date Added": F.when(seq % 11 == 0, F.lit("soon")).otherwise(F.col("Date Added")),
    }
    leads = normalize.normalize_leads(inputs.lead_export(events).withColumns(cells))
    parts = [
        normalize.split_rejects(rows)[1].select(F.lit(feed).alias("feed"), F.col(ORDER).alias("seq"), "reason")
        for feed, rows in (("calls", calls), ("leads", leads))
    ]
    return parts[0].unionByName(parts[1])


def upsert_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Calls of a first load replaced by those of a second one."""
    good = _good(spark, folder)
    first = merge.last_per_key(good.filter(F.col("date_time") < text.moment(SECOND_LOAD)), "call_id")
    second = good.filter(F.col("date_time") >= text.moment(SECOND_LOAD))
    return merge.upsert(first, second, "call_id", keyless=False).select(*CALL_COLUMNS)


def upsert_prefiltered(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`upsert_calls` as with more keys than a broadcast takes: rows that a Bloom filter lets through are shuffled."""
    good = _good(spark, folder)
    first = merge.last_per_key(good.filter(F.col("date_time") < text.moment(SECOND_LOAD)), "call_id")
    second = good.filter(F.col("date_time") >= text.moment(SECOND_LOAD))
    return merge.upsert(written(first, "first"), second, "call_id", keyless=False, most=0).select(*CALL_COLUMNS)


def upsert_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`upsert_calls` on a table in 64 folders by key, of which the second load rewrites those it falls in."""
    good, root = _good(spark, folder), new_work_path(spark, "buckets")
    first = merge.last_per_key(good.filter(F.col("date_time") < text.moment(SECOND_LOAD)), "call_id")
    buckets.create(first.select(*CALL_COLUMNS), root, "call_id", 64)
    second = good.filter(F.col("date_time") >= text.moment(SECOND_LOAD)).select(*CALL_COLUMNS, ORDER)
    schema = first.select(*CALL_COLUMNS).schema
    buckets.upsert(spark, root, schema, second)
    return buckets.read(spark, root, schema)


def upsert_leads(spark: SparkSession, folder: str) -> DataFrame:
    stored = inputs.customer_leads(table(spark, folder, "customer"))
    good, _ = normalize.split_rejects(normalize.normalize_leads(inputs.lead_export(table(spark, folder, "events"))))
    merged = merge.upsert(stored, good, "lead_id", keyless=False)
    return merged.select("lead_id", "source", "lead_status", "lead_score", "creation_date")


def leads_of_both_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as leads, those of even id replaced by customers, whose ids are doubled, then those calls name."""
    customers = table(spark, folder, "customer").withColumn("c_custkey", F.col("c_custkey") * 2)
    batch = inputs.customer_leads(customers).withColumn(ORDER, F.col("lead_id"))
    stored = merge.upsert(inputs.supplier_leads(table(spark, folder, "supplier")), batch, "lead_id")
    named = normalize.leads_of_calls(_normalized(spark, folder))
    return merge.insert_absent(stored, named, "lead_id").select("lead_id", "source", "creation_date")


def upsert_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Every other call's first turn is stored; the last turns of all calls but some of those come as JSON lines."""
    turns = table(spark, folder, "conversations")
    first = normalize.normalize_transcripts(inputs.transcript_rows(turns.filter(F.col("conv_id") % 2 == 0)))
    stored = merge.first_per_key(first, "call_id")
    path = new_work_path(spark, "transcripts")
    spoken = turns.filter((F.col("conv_id") % 3 != 1) | (F.col("conv_id") % 2 == 1)).repartitionByRange("conv_id").sortWithinPartitions("conv_id", "turn")
    spoken.select(F.col("conv_id").cast("string").alias("call_id"), F.col("text").alias("transcript")).write.json(path)
    batch = normalize.normalize_transcripts(batches.read_transcripts(spark, path))
    return merge.upsert(stored, batch, "call_id").select("transcript_id", "call_id", "transcript")


def brokers(spark: SparkSession, folder: str) -> DataFrame:
    """Two of three suppliers are stored in an old role; a roster of half of them and all others comes as JSON lines."""
    rows = inputs.roster(table(spark, folder, "supplier"), table(spark, folder, "nation"))
    old = rows.filter(F.col(ORDER) % 3 != 0).withColumn("role", F.lit("Old"))
    stored = normalize.normalize_brokers(old).drop(ORDER)
    path = new_work_path(spark, "roster")
    rows.filter((F.col(ORDER) % 2 == 0) | (F.col(ORDER) % 3 == 0)).drop(ORDER).write.json(path)
    return merge.upsert_brokers(stored, normalize.normalize_brokers(batches.read_roster(spark, path)))


def insert_absent_leads(spark: SparkSession, folder: str) -> DataFrame:
    stored = inputs.supplier_leads(table(spark, folder, "supplier"))
    named = normalize.leads_of_calls(_normalized(spark, folder))
    return merge.insert_absent(stored, named, "lead_id").select("lead_id", "source", "creation_date")


def empty_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each of the six tables after their creation and one load of customers as leads."""
    path = new_work_path(spark, "six")
    create_tables(spark, path)
    inputs.customer_leads(table(spark, folder, "customer")).write.mode("append").parquet(f"{path}/lead")
    counts = [
        tables.read_table(spark, path, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name in PRIMARY_KEYS
    ]
    return functools.reduce(DataFrame.unionByName, counts)


def insert_values(spark: SparkSession, folder: str) -> DataFrame:
    """Literal rows appended to the parts, whose keys they may repeat."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    added = spark.createDataFrame([(5, "fixture five"), (6, "fixture six")], "p_partkey bigint, p_name string")
    return merge.append(parts, added)


def update_where(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return merge.update_where(orders, F.col("o_orderstatus") == "P", o_orderpriority=F.lit("updated"))


def delete_where(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return merge.delete_where(orders, F.col("o_orderpriority") == "5-LOW")


# joins and reports


def call_broker_transcript(spark: SparkSession, folder: str) -> DataFrame:
    stored = written(inputs.brokers(spark, folder).drop(ORDER), "brokers")
    return joins.call_report(_calls(spark, folder), stored, _transcripts(spark, folder))


def report_doubled_brokers(spark: SparkSession, folder: str) -> DataFrame:
    """Calls with their brokers where every other broker is stored twice: both rows meet each call."""
    stored = inputs.brokers(spark, folder).withColumn("second", F.lit(False))
    doubled = stored.filter(F.col(ORDER) % 2 == 0).withColumn("role", F.lit("again")).withColumn("second", F.lit(True))
    both = written(stored.unionByName(doubled).drop(ORDER, "second"), "brokers")
    joined = joins.join_unique(_calls(spark, folder), both, "broker_id")
    return joined.select("call_id", "broker_id", "broker_name", "role")


def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    rows = _good(spark, folder).select(F.col(ORDER).alias("seq"), "lead_id")
    return quality.orphan_rows(rows, "lead_id", inputs.supplier_leads(table(spark, folder, "supplier")), "lead_id")


def fk_orphan_keys(spark: SparkSession, folder: str) -> DataFrame:
    stored = inputs.supplier_leads(table(spark, folder, "supplier"))
    return quality.orphan_keys(_good(spark, folder), "lead_id", stored, "lead_id")


def pk_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return quality.broken_keys(_good(spark, folder), "call_id")


def pk_broken(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of calls before rejects are taken out: those that repeat, and NULL."""
    return quality.broken_keys(_normalized(spark, folder), "call_id")


def overlong_text(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as leads: whole texts in a column that is bounded."""
    leads = table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("source"), F.col("lang").alias("lead_status"), F.col("source").alias("lead_score")
    )
    return quality.overlong_text(leads, "doc_id", "lead")


# exports, recordings, retention


def json_export(spark: SparkSession, folder: str) -> DataFrame:
    events = records.with_record(table(spark, folder, "events").select("event_id", "props"), F.col("props"))
    record = F.col("record")
    kept = events.filter(records.truthy(record, "$.k"))
    path = new_work_path(spark, "projection")
    export.write_projection(kept.select(F.col("event_id").alias("id"), records.member(record, "$.k").alias("k")), path)
    rows = exports.read_export(spark, path, ("id", "k"), multi_line=False)
    return rows.select(F.col("id").cast("bigint").alias("id"), F.col("k").cast("bigint").alias("k"))


def land_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all pages landed by day, the last one per id, and read back."""
    listed = landing.page_records(_pages(spark, folder))
    order = F.struct(F.col("position"), F.col("place"))
    latest = export.latest_records(listed, order)
    start = F.get_json_object("json", records.TELEPHONY_START)
    path = new_work_path(spark, "landed")
    export.land_records(latest, path, F.substring(start, 1, 10))
    objects, _ = landing.split_objects(landing.read_json(spark, path, one_per_file=False, suffix=""))
    return _with_day(objects)


def _with_day(objects: DataFrame) -> DataFrame:
    """``id``, start time and the day folder of landed objects."""
    record = F.col("record")
    return objects.select(
        records.member(record, records.RECORD_ID).alias("id"),
        records.member(record, records.TELEPHONY_START).alias("start_time"),
        F.regexp_extract("path", "dt=([0-9-]+)/", 1).alias("dt"),
    )


def land_two_fetches(spark: SparkSession, folder: str) -> DataFrame:
    """Two of three pages landed by one fetch, two of three by the next; the later one counts."""
    root = new_work_path(spark, "fetched")
    for number, left_out in enumerate((2, 0)):
        listed = landing.page_records(_pages(spark, folder).filter(F.col("position") % 3 != left_out))
        latest = export.latest_records(listed, F.struct(F.col("position"), F.col("place")))
        start = F.get_json_object("json", records.TELEPHONY_START)
        export.land_records(latest, f"{root}/fetch={number}", F.substring(start, 1, 10))
    objects, _ = landing.split_objects(landing.read_json(spark, root, one_per_file=False, suffix=""))
    return _with_day(landing.latest_objects(objects))


def chunk_rows(spark: SparkSession, folder: str) -> DataFrame:
    numbered = export.number_rows(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    return numbered.select("o_orderkey", export.chunk_number(F.col("row_index")).alias("part"))


def chunk_counts(spark: SparkSession, folder: str) -> DataFrame:
    numbered = export.number_rows(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    return export.chunk_counts(numbered)


def export_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """All orders, in several files, split into chunk files: what each written file holds."""
    source, out = _orders_in_files(spark, folder), new_work_path(spark, "chunks")
    export.write_chunks(exports.read_export(spark, source, multi_line=False), out)
    rows = spark.read.options(header=True, escape='"').csv(out)
    key = F.col("o_orderkey").cast("bigint")
    written_files = rows.groupBy(F.col("_metadata.file_path").alias("path"), "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key")
    )
    return written_files.select(
        # The path of a single file has no folder that differs.
        F.coalesce(
            F.regexp_extract("chunk", "f=([0-9]+)/", 1).try_cast("bigint"), F.floor(F.col("first_key") / 10_000)
        ).alias("f"),
        F.regexp_extract("chunk", "-part([0-9]+)[.]csv$", 1).cast("int").alias("part"),
        "n",
        "first_key",
        "last_key",
    )


def unknown_recordings(spark: SparkSession, folder: str) -> DataFrame:
    """Recordings of a call export without call ids: all share one name."""
    return manifest.wanted_of_export(inputs.call_export(table(spark, folder, "events")).drop("Call Id"))


def pending_recordings(spark: SparkSession, folder: str) -> DataFrame:
    """Recordings of the call export that are not stored; conversations are."""
    wanted = manifest.wanted_of_export(inputs.call_export(table(spark, folder, "events")))
    stored = table(spark, folder, "conversations").select(F.col("conv_id").cast("string").alias("call_id"))
    return manifest.pending(wanted, stored)


def retention_expired(spark: SparkSession, folder: str) -> DataFrame:
    return retention.split_by_age(table(spark, folder, "events"), "ts", AS_OF)[1].select("event_id")


def retention_kept(spark: SparkSession, folder: str) -> DataFrame:
    return retention.split_by_age(table(spark, folder, "events"), "ts", AS_OF)[0].select("event_id")


# streaming


def _streamed_calls(spark: SparkSession, folder: str) -> str:
    """The call export written as files and loaded as they arrive; where to."""
    rows = inputs.call_export(table(spark, folder, "events"))
    inbox, root = new_work_path(spark, "inbox"), new_work_path(spark, "tables")
    rows.withColumnRenamed(ORDER, "Row").write.options(**exports.write_options()).csv(inbox)
    arrivals.load_arrived_calls(
        spark,
        inbox,
        root,
        new_work_path(spark, "checkpoint"),
        inputs.broker_of_call(),
        headers=(*normalize.CALL_HEADERS, "Row"),
        row_order=F.col("Row").cast("bigint"),
    )
    return root


def stream_calls(spark: SparkSession, folder: str) -> DataFrame:
    return arrivals.current_calls(spark, _streamed_calls(spark, folder)).select(*CALL_COLUMNS)


def stream_two_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs over two arrivals that share calls; the rows of the later one count."""
    rows = inputs.call_export(table(spark, folder, "events"))
    inbox, root, checkpoint = (new_work_path(spark, n) for n in ("inbox", "tables", "checkpoint"))
    for number, left_out in enumerate((1, 0)):
        part = rows.filter(F.col(ORDER) % 3 != left_out).withColumn("Row", F.col(ORDER) + number * 10**12).drop(ORDER)
        part.write.options(**exports.write_options()).csv(f"{inbox}/arrival{number}")
        arrivals.load_arrived_calls(
            spark, inbox, root, checkpoint, inputs.broker_of_call(), row_order=F.col("Row").cast("bigint"), suffix=".csv"
        )
    return arrivals.current_calls(spark, root).select(*CALL_COLUMNS)


def stream_put_again(spark: SparkSession, folder: str) -> DataFrame:
    """Two files that arrive, are loaded, and are put again under their names with other rows; the later rows count."""
    rows = inputs.call_export(table(spark, folder, "events"))
    inbox, root, checkpoint = (new_work_path(spark, n) for n in ("inbox", "tables", "checkpoint"))
    for number, left_out in enumerate((1, 0)):
        part = rows.filter(F.col(ORDER) % 3 != left_out).withColumn("Row", F.col(ORDER) + number * 10**12)
        for k in range(2):
            exports.write_file(part.filter(F.col(ORDER) % 2 == k).drop(ORDER), f"{inbox}/calls{k}.csv")
        arrivals.load_arrived_calls(
            spark, inbox, root, checkpoint, inputs.broker_of_call(), row_order=F.col("Row").cast("bigint"), max_files=1
        )
    return arrivals.current_calls(spark, root).select(*CALL_COLUMNS)


def stream_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Two of three pages land as they arrive, are compacted, and two of three land later; the later record counts."""
    made = inputs.telephony_pages(table(spark, folder, "events"))
    inbox, root, checkpoint = (new_work_path(spark, n) for n in ("inbox", "landed", "checkpoint"))
    for number, left_out in enumerate((2, 0)):
        arrived = made.filter(F.col("number") % 3 != left_out).orderBy("number").coalesce(1).select("text")
        arrived.write.text(f"{inbox}/arrival{number}")
        page_stream.land_arrived_pages(spark, inbox, root, checkpoint, suffix="", one_per_file=False)
        if number == 0:
            page_stream.compact(spark, root)
    landed = page_stream.current_records(spark, root)
    return landed.select("id", F.get_json_object("json", records.TELEPHONY_START).alias("start_time"), F.col("day").alias("dt"))


def stream_new_leads(spark: SparkSession, folder: str) -> DataFrame:
    stored = inputs.supplier_leads(table(spark, folder, "supplier"))
    leads = arrivals.leads_with_calls(spark, _streamed_calls(spark, folder), stored)
    return leads.select("lead_id", "source", "creation_date")


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    kept = arrivals.rejects(spark, _streamed_calls(spark, folder))
    return kept.select(F.get_json_object("raw", "$.Row").cast("bigint").alias("seq"), "reason")


def stream_recordings(spark: SparkSession, folder: str) -> DataFrame:
    return arrivals.wanted_recordings(spark, _streamed_calls(spark, folder))


def stream_leads(spark: SparkSession, folder: str) -> DataFrame:
    """The lead export written as files, loaded as they arrive, into the stored leads."""
    rows = inputs.lead_export(table(spark, folder, "events"))
    inbox, root = new_work_path(spark, "inbox"), new_work_path(spark, "tables")
    rows.withColumnRenamed(ORDER, "Row").write.options(**exports.write_options()).csv(inbox)
    arrivals.load_arrived_leads(
        spark,
        inbox,
        root,
        new_work_path(spark, "checkpoint"),
        headers=(*normalize.LEAD_HEADERS, "Row"),
        row_order=F.col("Row").cast("bigint"),
    )
    stored = inputs.customer_leads(table(spark, folder, "customer"))
    leads = arrivals.current_leads(spark, root, stored)
    return leads.select("lead_id", "source", "lead_status", "lead_score", "creation_date")


ALL: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        duration_seconds,
        clean_text,
        object_keys,
        iso_times,
        time_formats,
        csv_scan,
        large_csv_scan,
        csv_mixed_headers,
        row_order,
        resume_rows,
        list_files,
        json_scan,
        page_records,
        open_cursor,
        page_counts,
        numbered_pages,
        pages_complete,
        page_gaps,
        cursor_chains,
        malformed_records,
        wanted_records,
        source_filters,
        calls_yesterday,
        table_scan,
        stored_tables,
        feed_union,
        reject_rows,
        reject_reasons,
        upsert_calls,
        upsert_prefiltered,
        upsert_buckets,
        upsert_leads,
        leads_of_both_feeds,
        upsert_transcripts,
        brokers,
        insert_absent_leads,
        empty_tables,
        insert_values,
        update_where,
        delete_where,
        call_broker_transcript,
        report_doubled_brokers,
        fk_orphans,
        fk_orphan_keys,
        pk_duplicates,
        pk_broken,
        overlong_text,
        json_export,
        land_records,
        land_two_fetches,
        chunk_rows,
        chunk_counts,
        export_chunks,
        pending_recordings,
        unknown_recordings,
        retention_expired,
        retention_kept,
        stream_calls,
        stream_two_batches,
        stream_put_again,
        stream_pages,
        stream_new_leads,
        stream_rejects,
        stream_recordings,
        stream_leads,
    )
}
