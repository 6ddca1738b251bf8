"""Command line: parse, sync, list, stats, mark, coverage."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import sys

from docketry.config import load_settings


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docketry", description=__doc__)
    p.add_argument("--config")
    p.add_argument("--catalog")
    p.add_argument("--download-folder")
    p.add_argument("--verbose", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("parse", help="parse one file or a directory")
    where = c.add_mutually_exclusive_group(required=True)
    where.add_argument("--file")
    where.add_argument("--dir")
    c.add_argument("--output", required=True)
    c.add_argument("--ticker")
    c.add_argument("--workers", type=int)
    c.add_argument("--process-all", action=argparse.BooleanOptionalAction, default=None)
    c = sub.add_parser("sync", help="catalog new files")
    c.add_argument("--tickers", nargs="*")
    c = sub.add_parser("list", help="list filings")
    for name in ("--ticker", "--filing-type", "--start-date", "--end-date"):
        c.add_argument(name)
    c.add_argument("--parsed", action=argparse.BooleanOptionalAction, default=None)
    c.add_argument("--limit", type=int, default=100)
    c.add_argument("--json", action="store_true")
    c = sub.add_parser("stats", help="counts and dates")
    c.add_argument("--json", action="store_true")
    c = sub.add_parser("mark", help="set or clear a parse status")
    kind = c.add_mutually_exclusive_group(required=True)
    kind.add_argument("--parsed", action="store_true")
    kind.add_argument("--unparsed", action="store_true")
    for name in ("--ticker", "--accession", "--path"):
        c.add_argument(name)
    c.add_argument("--status", default="success")
    c = sub.add_parser("coverage", help="ranges without a filing")
    c.add_argument("--ticker")
    c.add_argument("--filing-type")
    c.add_argument("--start-date", default="2010-01-01")
    c.add_argument("--end-date")
    c.add_argument("--show-filing-types", action="store_true")
    return p


def session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("docketry").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    from docketry.operators import catalog as C
    from docketry.operators import coverage as V

    args = parser().parse_args(argv)
    settings = load_settings(args.config, process_all_documents=getattr(args, "process_all", None), catalog_path=args.catalog, download_folder=args.download_folder)
    logging.basicConfig(level="DEBUG" if args.verbose else settings.log_level)
    if args.command == "coverage" and args.show_filing_types:
        print("\n".join(sorted(V.FILING_TYPES)))
        return 0
    date = lambda s: V.parse_date(s) if s else None
    if args.command == "mark" and not (args.path or args.ticker and args.accession):
        print("mark needs --path, or --ticker with --accession", file=sys.stderr)
        return 2
    spark, today = session(), dt.date.today()
    catalog = C.Catalog(spark, settings.catalog_path)
    show = lambda df: [print(json.dumps(r.asDict(True), default=str)) for r in df.toLocalIterator()]
    if args.command == "parse":
        from docketry.sources.filings import parse_filings
        from docketry.sources.sinks import write_parsed

        write_parsed(parse_filings(spark, args.file or args.dir, settings, args.ticker, partitions=args.workers), args.output)
    elif args.command == "sync":
        show(catalog.sync(settings.download_folder, today, args.tickers))
    elif args.command == "list":
        found = C.get_filings(catalog.filings(), args.ticker, args.filing_type, date(args.start_date), date(args.end_date), args.parsed, args.limit)
        show(found) if args.json else found.show(args.limit, truncate=False)
    elif args.command == "stats":
        rows = catalog.filings()
        show(C.summary(rows))
        show(C.counts(rows).where("measure <> 'ticker'"))
        show(C.top_tickers(rows))
    elif args.command == "mark":
        hit = C.selected(ticker=args.ticker, accession_number=args.accession, file_path=args.path)
        return 0 if catalog.set_status(hit, args.parsed, args.status, today) else 1
    elif args.command == "coverage":
        wanted = catalog.filings().select("ticker", "filing_type").distinct()
        if args.ticker and args.filing_type:
            wanted = spark.createDataFrame([(args.ticker, V.resolve_type(args.filing_type) or args.filing_type)], "ticker string, filing_type string")
        elif args.ticker:
            wanted = wanted.where(wanted.ticker == args.ticker)
        show(V.missing_ranges(catalog.filings(), wanted, date(args.start_date), date(args.end_date) or today))
    return 0


if __name__ == "__main__":
    sys.exit(main())
