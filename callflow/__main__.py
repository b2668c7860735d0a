"""Jobs from the command line: ``spark-submit … -m callflow <job> …`` or ``python -m callflow <job> …``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from callflow.functions import records
from callflow.plans import jobs
from callflow.schemas import create_tables
from callflow.session import build_session, work_cleaned
from callflow.streaming import arrivals, pages

# The two API feeds and the members that differ between them.
FEEDS = {
    "telephony": (records.TELEPHONY_RECORDS, records.TELEPHONY_START, records.TELEPHONY_RECORDING),
    "tracking": (records.TRACKING_RECORDS, records.TRACKING_START, records.TRACKING_RECORDING),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="callflow")
    top.add_argument("--master", help="only outside spark-submit, such as local[8]")
    job = top.add_subparsers(dest="job", required=True)

    def add(name: str, *positional: str) -> argparse.ArgumentParser:
        sub = job.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        return sub

    add("create-tables", "tables")
    add("load-calls", "exports", "tables", "out").add_argument("--broker-id")
    add("load-leads", "exports", "tables", "out")
    for name, source in (("load-brokers", "roster"), ("load-transcripts", "transcripts")):
        batch = add(name, source, "tables", "out")
        batch.add_argument("--one-value", action="store_true", help="each JSON file is one array, not lines")
    for name in ("load-arrived-calls", "load-arrived-leads"):
        arrived = add(name, "arrivals", "out", "checkpoint")
        arrived.add_argument("--suffix", default="", help="load only files whose names end so")
        if name == "load-arrived-calls":
            arrived.add_argument("--broker-id")
    arrived = add("land-arrived-pages", "arrivals", "out", "checkpoint")
    arrived.add_argument("--feed", choices=FEEDS, default="telephony")
    arrived.add_argument("--lines", action="store_true", help="one page per line, not per file")
    add("compact-pages", "out")
    add("call-report", "tables", "out")
    landed = add("land-pages", "pages", "out")
    landed.add_argument("--feed", choices=FEEDS, default="telephony")
    exported = add("export-records", "landed", "out")
    exported.add_argument("--feed", choices=FEEDS, default="tracking")
    exported.add_argument("--only-recorded", action="store_true")
    exported.add_argument("--strict", action="store_true")
    exported.add_argument("--files", type=int)
    pending = add("pending-recordings", "landed", "store", "out")
    pending.add_argument("--feed", choices=FEEDS, default="telephony")
    for sub in (landed, exported, pending):
        sub.add_argument("--lines", action="store_true", help="one JSON value per line, not per file")
    add("split-export", "source", "out").add_argument("--rows", type=int, default=2000)
    add("list-expired", "store", "out").add_argument("--as-of", type=datetime.fromisoformat)
    add("check-tables", "tables", "out")
    add("query", "tables", "statement").add_argument("--out", help="write Parquet instead of printing all rows")
    add("insert-rows", "tables", "name", "rows", "out")
    updated = add("update-rows", "tables", "name", "where", "out")
    updated.add_argument("--set", action="append", required=True, metavar="COLUMN=EXPRESSION")
    add("delete-rows", "tables", "name", "where", "out")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(args.master)
    with work_cleaned():
        run(spark, args)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "create-tables":
        create_tables(spark, args.tables)
    elif args.job == "load-calls":
        print(jobs.load_calls(spark, args.exports, args.tables, args.out, args.broker_id))
    elif args.job == "load-leads":
        print(jobs.load_leads(spark, args.exports, args.tables, args.out))
    elif args.job == "load-brokers":
        print(jobs.load_brokers(spark, args.roster, args.tables, args.out, args.one_value))
    elif args.job == "load-transcripts":
        print(jobs.load_transcripts(spark, args.transcripts, args.tables, args.out, args.one_value))
    elif args.job == "load-arrived-calls":
        arrivals.load_arrived_calls(
            spark, args.arrivals, args.out, args.checkpoint, args.broker_id, suffix=args.suffix
        )
    elif args.job == "load-arrived-leads":
        arrivals.load_arrived_leads(spark, args.arrivals, args.out, args.checkpoint, suffix=args.suffix)
    elif args.job == "land-arrived-pages":
        pages.land_arrived_pages(
            spark, args.arrivals, args.out, args.checkpoint, *FEEDS[args.feed][:2], one_per_file=not args.lines
        )
        cursor = pages.open_cursor(spark, args.out).first()
        print({"cursor": cursor["cursor"] if cursor else None})
    elif args.job == "compact-pages":
        pages.compact(spark, args.out)
    elif args.job == "call-report":
        jobs.call_report(spark, args.tables, args.out)
    elif args.job == "land-pages":
        print(jobs.land_pages(spark, args.pages, args.out, *FEEDS[args.feed][:2], not args.lines))
    elif args.job == "export-records":
        time_member, one_per_file = FEEDS[args.feed][1], not args.lines
        jobs.export_records(
            spark, args.landed, args.out, time_member, args.only_recorded, one_per_file, args.strict, args.files
        )
    elif args.job == "pending-recordings":
        jobs.pending_recordings(spark, args.landed, args.store, args.out, FEEDS[args.feed][2], not args.lines)
    elif args.job == "split-export":
        jobs.split_export(spark, args.source, args.out, args.rows)
    elif args.job == "list-expired":
        as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
        jobs.list_expired(spark, args.store, args.out, as_of)
    elif args.job == "check-tables":
        jobs.check_tables(spark, args.tables, args.out)
    elif args.job == "query":
        rows = jobs.query(spark, args.tables, args.statement)
        if args.out:
            rows.write.parquet(args.out)
        else:
            print(*rows.columns, sep="\t")
            for row in rows.toLocalIterator():
                print(*row, sep="\t")
    elif args.job == "insert-rows":
        jobs.insert_rows(spark, args.tables, args.name, args.rows, args.out)
    elif args.job == "update-rows":
        changes = dict(change.split("=", 1) for change in args.set)
        jobs.update_rows(spark, args.tables, args.name, args.where, changes, args.out)
    else:
        jobs.delete_rows(spark, args.tables, args.name, args.where, args.out)


if __name__ == "__main__":
    main()
