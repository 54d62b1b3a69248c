"""Command line: python -m dwellmart <job> ..., or spark-submit with the same arguments.

What is published is noted below --root, so a later process finds the tables without a persistent catalog.
--star publishes the folder of an earlier load (printed by load) again.
"""

from __future__ import annotations

import argparse
import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from dwellmart.fixed_values import DROP_STAMP, SEARCH_LIMIT, SEARCH_MAX_PRICE, SEARCH_MIN_PRICE, SEARCH_MIN_ROOMS
from dwellmart.plans.curate import curate
from dwellmart.plans.daily import Folders, land_once, run_daily
from dwellmart.plans.load import append, refresh
from dwellmart.plans.reports import Reports
from dwellmart.session import build_session
from dwellmart.sources.curated import read_curated
from dwellmart.sources.landing import QUARANTINE, STRICT, load_landing
from dwellmart.sources.ledger import Ledger
from dwellmart.sources.warehouse import Warehouse

REPORTS = [
    "kpi", "kpi_display", "trend", "by_city", "by_area_bucket", "by_rooms",
    "search", "search_display", "macro",
]


def stamp(text: str) -> datetime:
    return datetime.strptime(text, DROP_STAMP).replace(tzinfo=timezone.utc)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="dwellmart")
    parser.add_argument("--master", help="Spark master; left to spark-submit by default")
    parser.add_argument("--input-bytes", type=int, default=0, help="input size, for the shuffles")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("curate", help="landing zone to curated zone")
    job.add_argument("--landing", required=True)
    job.add_argument("--curated", required=True)
    job.add_argument("--mode", choices=[STRICT, QUARANTINE], default=STRICT)
    job.add_argument("--rejected", help="folder for rejected records (quarantine)")
    job.add_argument("--preview", type=int, default=0, help="raw and curated rows to print")

    tables = argparse.ArgumentParser(add_help=False)
    tables.add_argument("--database", required=True)
    tables.add_argument("--root", required=True, help="folder below which loads are stored")
    tables.add_argument("--star", help="folder of an earlier load to publish first")

    job = jobs.add_parser("land", help="records of one source to a drop of the landing zone")
    job.add_argument("--input", required=True, help="file or folder of newline-delimited JSON")
    job.add_argument("--landing", required=True)
    job.add_argument("--source", required=True)
    job.add_argument("--at", type=stamp, help="time of the drop, yyyymmdd_hhmmss; now by default")

    jobs.add_parser("init", parents=[tables], help="create the database and empty tables")

    job = jobs.add_parser("vacuum", parents=[tables], help="delete old loads and what failed ones have left")
    job.add_argument("--keep", type=int, default=2, help="loads to keep")

    job = jobs.add_parser("load", parents=[tables], help="curated zone to star schema")
    job.add_argument("--curated", required=True)
    job.add_argument("--append", action="store_true", help="add what is new; default is a full load")
    job.add_argument("--mode", choices=[STRICT, QUARANTINE], default=QUARANTINE)
    job.add_argument("--rejected", help="folder for curated rows that cannot become facts")

    job = jobs.add_parser("daily", parents=[tables], help="curate and load what was landed")
    job.add_argument("--landing", required=True)
    job.add_argument("--curated", required=True)
    job.add_argument("--full", action="store_true", help="everything landed; default is what is not loaded yet")
    job.add_argument("--mode", choices=[STRICT, QUARANTINE], default=STRICT, help="for unreadable records")
    job.add_argument("--rejected-records", help="folder for rejected records (quarantine)")
    job.add_argument("--rejected", help="folder for curated rows that cannot become facts")

    job = jobs.add_parser("report", parents=[tables], help="print a report")
    job.add_argument("name", choices=REPORTS)
    job.add_argument("--city")
    job.add_argument("--min-price", type=int, default=SEARCH_MIN_PRICE)
    job.add_argument("--max-price", type=int, default=SEARCH_MAX_PRICE)
    job.add_argument("--min-rooms", type=int, default=SEARCH_MIN_ROOMS)
    job.add_argument("--limit", type=int, default=SEARCH_LIMIT)
    job.add_argument("--rows", type=int, help="rows to print; all by default")
    job.add_argument("--output", help="folder to write the whole result to instead, as Parquet")

    job = jobs.add_parser("query", parents=[tables], help="print the result of a SQL text")
    job.add_argument("text")
    job.add_argument("--rows", type=int, default=100, help="rows to print; more are mentioned")
    job.add_argument("--output", help="folder to write the whole result to instead, as Parquet")
    return parser


def tell(result: DataFrame, rows: int | None, output: str | None) -> None:
    """Write the result to a folder, or print it, saying so if rows are left out."""
    if output:
        result.write.parquet(output)
        return
    found = result.count()
    shown = found if rows is None else min(rows, found)
    result.show(shown, truncate=False)
    if shown < found:
        print(f"{shown} of {found} rows; --output stores all of them")


def report_of(reports: Reports, chosen: argparse.Namespace):
    if chosen.name == "macro":
        return reports.macro()
    filters = {"city": chosen.city}
    if chosen.name.startswith("search"):
        filters |= {
            "min_price": chosen.min_price, "max_price": chosen.max_price,
            "min_rooms": chosen.min_rooms, "limit": chosen.limit,
        }
    return getattr(reports, chosen.name)(**filters)


def main(given: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    chosen = arguments().parse_args(given)
    spark = build_session("dwellmart", chosen.master, chosen.input_bytes)
    if chosen.job == "curate":
        print(curate(spark, chosen.landing, chosen.curated, chosen.mode, chosen.rejected, chosen.preview))
        return

    if chosen.job == "land":
        ledger = Ledger(spark, chosen.landing, "")
        rows = load_landing(spark, chosen.input)
        drop = land_once(ledger, rows, chosen.source, chosen.at or datetime.now(timezone.utc))
        print(ledger.path_of(drop))
        return

    warehouse = Warehouse(spark, chosen.database, chosen.root)
    if chosen.star:
        warehouse.attach(chosen.star)
    if chosen.job == "vacuum":
        print(*warehouse.vacuum(chosen.keep), sep="\n")
    elif chosen.job == "init":
        warehouse.bootstrap()
    elif chosen.job == "load":
        load = append if chosen.append else refresh
        counts = load(warehouse, read_curated(spark, chosen.curated), chosen.mode, chosen.rejected)
        logging.getLogger(__name__).info("%s", counts)
        print(warehouse.location_of("fact_listings").rsplit("/", 1)[0])
    elif chosen.job == "daily":
        folders = Folders(chosen.landing, chosen.curated, chosen.rejected_records, chosen.rejected)
        print(run_daily(spark, folders, warehouse, {}, chosen.mode, incremental=not chosen.full))
    elif chosen.job == "report":
        tell(report_of(Reports(warehouse), chosen), chosen.rows, chosen.output)
    else:
        tell(warehouse.query(chosen.text), chosen.rows, chosen.output)


if __name__ == "__main__":
    main()
