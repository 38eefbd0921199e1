"""Command line: load trip files, load new ones, print a report.

    spark-submit --py-files tripmill.zip -m tripmill load --trips 's3a://in/trips_2025-*.parquet' \\
        --zones s3a://in/zones.csv --tables s3a://out/trips
    python -m tripmill new --folder in/ --zones zones.csv --tables out/ --checkpoint out/checkpoint
    python -m tripmill report zone_top_pickup --tables out/ --limit 10
    python -m tripmill profile profile_raw_quality --trips 'in/*.parquet' --zones zones.csv
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from tripmill.config import Settings
from tripmill.operators import clean
from tripmill.plans import catalog, load, sql
from tripmill.plans.tables import SavedTables, TripTables
from tripmill.session import build_session
from tripmill.sources.dimensions import clean_zones, read_locations, read_zone_lookup
from tripmill.sources.trips import open_trips, read_trips
from tripmill.streaming.incremental import load_new_files


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripmill", description="Trip analytics on Spark")
    parser.add_argument("--home", default=Settings.home, help="borough to load and report on")
    actions = parser.add_subparsers(dest="action", required=True)

    whole = actions.add_parser("load", help="load trip files from scratch")
    whole.add_argument("--trips", nargs="+", required=True, help="files, folders or globs")
    whole.add_argument("--zones", required=True)
    whole.add_argument("--tables", required=True)
    whole.add_argument("--rows", type=int, default=1000, help="most rows of the audit to print")

    new = actions.add_parser("new", help="load files that arrived since the last time")
    new.add_argument("--folder", required=True)
    new.add_argument("--zones", required=True)
    new.add_argument("--tables", required=True)
    new.add_argument("--checkpoint", required=True)
    for loading in (whole, new):
        loading.add_argument("--cbd-fee", action="store_true", help="read the cbd_congestion_fee of files that have it")

    free = actions.add_parser("sql", help="a query over loaded tables and reports, such as SELECT * FROM zone_top_pickup(5)")
    free.add_argument("query")
    free.add_argument("--tables", required=True)
    free.add_argument("--json", action="store_true", help="one JSON object per row")
    free.add_argument("--out", help="write all rows to this path, as Parquet or with --json as JSON")
    free.add_argument("--rows", type=int, default=1000, help="most rows to print")

    for name, text in (("report", "a report over loaded tables"), ("profile", "a report over raw files")):
        report = actions.add_parser(name, help=text)
        report.add_argument("name", choices=sorted(catalog.REPORTS))
        report.add_argument("--limit", type=int)
        report.add_argument("--json", action="store_true", help="one JSON object per row")
        report.add_argument("--out", help="write all rows to this path, as Parquet or with --json as JSON")
        report.add_argument("--rows", type=int, default=1000, help="most rows to print")
        if name == "report":
            report.add_argument("--tables", required=True)
        else:
            report.add_argument("--trips", nargs="+", required=True)
            report.add_argument("--zones", required=True)
    return parser.parse_args(argv)


def _print(df, rows: int, as_json: bool) -> None:
    """The first rows for the terminal, and a word if there are more."""
    found = df.limit(rows + 1).select(F.to_json(F.struct("*"))).collect() if as_json else None
    if as_json:
        for row in found[:rows]:
            print(row[0])
        more = len(found) > rows
    else:
        df.show(rows, truncate=False)
        more = df.limit(rows + 1).count() > rows
    if more:
        print(f"only the first {rows} rows; write all with --out", file=sys.stderr)


def _deliver(df, args: argparse.Namespace) -> None:
    """All rows to a path, written by the executors, or the first ones to the terminal."""
    if args.out:
        df.write.mode("overwrite").format("json" if args.json else "parquet").save(args.out)
    else:
        _print(df, args.rows, args.json)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session()
    settings = Settings(home=args.home, cbd_fee=getattr(args, "cbd_fee", False))
    if args.action == "load":
        zones = read_locations(spark, args.zones)
        tables = load.load(spark, open_trips(spark, *args.trips, cbd_fee=args.cbd_fee), zones, args.tables, settings)
        _print(tables.load_audit.orderBy("source_file"), args.rows, False)
        clean.audit_totals(tables.load_audit).show()
        catalog.run("load_table_counts", tables).show(truncate=False)
        catalog.run("load_averages", tables).show()
    elif args.action == "new":
        zones = read_locations(spark, args.zones)
        load_new_files(spark, args.folder, zones, args.tables, args.checkpoint, settings).awaitTermination()
        load.merge_rollups(spark, args.tables, settings)
    elif args.action == "sql":
        sql.register(SavedTables(spark, args.tables, settings=settings))
        _deliver(spark.sql(args.query), args)
    else:
        if args.action == "report":
            tables = SavedTables(spark, args.tables, settings=settings)
        else:
            lookup = read_zone_lookup(spark, args.zones)
            tables = TripTables(spark, clean_zones(lookup), read_trips(spark, *args.trips), settings=settings)
            tables.zone_lookup = lookup
        options = {} if args.limit is None else {"limit": args.limit}
        _deliver(catalog.run(args.name, tables, **options), args)


if __name__ == "__main__":
    main()
