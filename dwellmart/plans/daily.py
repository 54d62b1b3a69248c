"""The daily run: prepare the catalog, land the drops, curate, load."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from dwellmart.fixed_values import DROP_STAMP
from dwellmart.plans.curate import CurateCounts, curate
from dwellmart.plans.load import LoadCounts, append, counts_of, refresh
from dwellmart.plans.together import together
from dwellmart.sources.curated import read_curated
from dwellmart.sources.landing import STRICT, drop_name, land
from dwellmart.sources.ledger import Ledger
from dwellmart.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Folders:
    landing: str
    curated: str
    rejected_records: str | None = None
    rejected_facts: str | None = None


@dataclass(frozen=True)
class RunCounts(CurateCounts):
    """What a run took, and what the star and the rejects held after it. ``raw`` are the records of the
    drops taken, as the ledger has them."""

    drops: tuple[str, ...]
    load: LoadCounts


def ledger_of(warehouse: Warehouse, zone: str) -> Ledger:
    """The ledger of a landing zone, as far as this warehouse has loaded it."""
    return Ledger(warehouse.spark, zone, f"{warehouse.root}/loaded-{warehouse.database}")


def land_once(ledger: Ledger, rows: DataFrame, source: str, at: datetime) -> str:
    """Land a drop and note it in the ledger. A complete drop of that name is left as it is; what a run that
    was cut off has left of one is removed first."""
    drop = drop_name(source, at)
    if drop not in ledger.complete_drops():
        ledger.files.delete(ledger.path_of(drop))
        land(rows, ledger.zone, source, at)
    ledger.record(drop)
    return drop


def run_daily(
    spark: SparkSession,
    folders: Folders,
    warehouse: Warehouse,
    feeds: Mapping[str, DataFrame],
    landing_mode: str = STRICT,
    incremental: bool = False,
    at: datetime | None = None,
) -> RunCounts:
    """One run over all feeds, in this order; an error in a step ends the run.

    A full run curates the whole landing zone and replaces the star once its load is complete and
    sound, so there is no moment with empty tables. An incremental run curates the complete drops that
    the ledger doesn't name as loaded, its own ones and late ones alike, adds them to the star, and lets
    later records replace stored ones; it takes a curated folder of its own. Drops are named as loaded
    after the load, so a run that was cut off takes them again, and a run that is repeated takes none.
    Drops are the files and folders directly below the landing zone.
    """
    if incremental:
        warehouse.prepare()
    stamped = at or datetime.now(timezone.utc)
    ledger = ledger_of(warehouse, folders.landing)
    if feeds:
        together(spark, *[partial(land_once, ledger, rows, source, stamped) for source, rows in feeds.items()])
    drops = ledger.waiting() if incremental else ledger.complete_drops()
    if incremental and not drops:
        return RunCounts(0, 0, 0, (), counts_of(warehouse, folders.rejected_facts))
    if drops:
        together(spark, *[partial(ledger.record, drop) for drop in drops])
    taken = [ledger.path_of(drop) for drop in drops] if incremental else folders.landing
    told = curate(spark, taken, folders.curated, landing_mode, folders.rejected_records)
    curated = read_curated(spark, folders.curated)
    load = partial(append, latest=True) if incremental else refresh
    loaded = load(warehouse, curated, rejected=folders.rejected_facts, known_unique=True)
    ledger.mark_loaded(drops, stamped.strftime(DROP_STAMP))
    return RunCounts(ledger.rows_of(drops), told.curated, told.rejected, tuple(drops), loaded)
