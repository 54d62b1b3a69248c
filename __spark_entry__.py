"""Registered queries and their SQL counterparts.

The tables of a folder are turned into raw listings and taken through the daily run once per
session (land as JSON, curate, load the star schema); the queries then read the results. What is
written on the way goes to the session's shared scratch folder.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle_queries
from dwellmart.fixed_values import FOREIGN_KEYS, TABLES
from dwellmart.operators.clean import clean
from dwellmart.operators.contract import MALFORMED, fact_rules, record_rules
from dwellmart.operators.dedup import latest_per_listing
from dwellmart.operators.facts import listing_facts
from dwellmart.operators.integrity import audit
from dwellmart.operators.kinds import listings_of, with_kind
from dwellmart.operators.rules import keep_valid, rejects
from dwellmart.plans.curate import CurateCounts, curate, curate_frame
from dwellmart.plans.daily import Folders, ledger_of, run_daily
from dwellmart.plans.load import append, fact_rejects, refresh
from dwellmart.plans.reports import Reports
from dwellmart.session import configure, drop_written, scratch_root, shuffle_files_dropped, written
from dwellmart.sources.curated import read_curated
from dwellmart.sources.landing import QUARANTINE, land, load_landing
from dwellmart.sources.table_feed import feeds, raw_listings
from dwellmart.sources.warehouse import Warehouse

try:  # the training-data operators and the pipeline over them may be left out of an installation
    import corpus_pipeline
    from dwellmart.llm.queries import QUERIES as LLM_QUERIES
    from dwellmart.llm.sql import ORACLE_SQL as LLM_SQL
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "dwellmart.llm"):
        raise
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL is not None:
        LLM_SQL = {**LLM_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}

Query = Callable[[SparkSession, str], DataFrame]
CITY = "Asia"
DIMENSION_IDS = {
    "dim_date": "date_id",
    "dim_location": "location_id",
    "dim_property": "property_id",
    "dim_source": "source_id",
}

FACT_IDS = {"fact_listings": "listing_sk", "fact_macro_indicators": "macro_sk"}


# -- what the queries read --------------------------------------------------------------------


@dataclass(frozen=True)
class Loaded:
    folders: Folders
    warehouse: Warehouse
    counts: CurateCounts
    stored_before: dict[str, int]  # largest id of each dimension before the append

    @property
    def reports(self) -> Reports:
        return Reports(self.warehouse)

    def curated(self) -> DataFrame:
        return read_curated(self.warehouse.spark, self.folders.curated)


_loaded: dict[tuple[str, str, str], Loaded] = {}


def _once(kind: str, build: Callable[[SparkSession, str, str], Loaded]):
    """One load per session, table folder and kind."""

    def get(spark: SparkSession, tables: str) -> Loaded:
        configure(spark)
        key = (spark.sparkContext.applicationId, os.path.abspath(tables), kind)
        if key not in _loaded:
            name = f"dwellmart_{kind}_{uuid.uuid4().hex}"
            _loaded[key] = build(spark, tables, name)
        return _loaded[key]

    return get


def _build_daily(spark: SparkSession, tables: str, name: str) -> Loaded:
    root = f"{scratch_root(spark)}/{name}"
    folders = Folders(f"{root}/landing", f"{root}/curated", rejected_facts=f"{root}/rejected")
    warehouse = Warehouse(spark, name, f"{root}/warehouse")
    counts = run_daily(spark, folders, warehouse, feeds(spark, tables))
    return Loaded(folders, warehouse, counts, {})


def _build_incremental(spark: SparkSession, tables: str, name: str) -> Loaded:
    """A load of the records up to a date, then everything appended to it."""
    full = daily(spark, tables)
    warehouse = Warehouse(spark, name, f"{scratch_root(spark)}/{name}")
    _refresh_early(warehouse, full)
    stored = {table: warehouse.largest(table, key) for table, key in DIMENSION_IDS.items()}
    append(warehouse, full.curated())
    return Loaded(full.folders, warehouse, full.counts, stored)


def _build_latest(spark: SparkSession, tables: str, name: str) -> Loaded:
    """As above, but later records replace the stored ones."""
    full = daily(spark, tables)
    warehouse = Warehouse(spark, name, f"{scratch_root(spark)}/{name}")
    _refresh_early(warehouse, full)
    append(warehouse, full.curated(), latest=True)
    return Loaded(full.folders, warehouse, full.counts, {})


def _early_until():
    return F.lit(oracle_queries.EARLY_UNTIL).cast("timestamp")


def _curated_early(spark: SparkSession, full: Loaded) -> DataFrame:
    """The landed records before the early date, curated and stored once: the load reads them for every
    table it builds, which would otherwise parse and curate the landing zone again each time."""
    raw = load_landing(spark, full.folders.landing)
    with shuffle_files_dropped(spark):
        return written(curate_frame(raw.where(F.col("date_scraped") < _early_until())), "curated-early")


def _refresh_early(warehouse: Warehouse, full: Loaded, **options) -> None:
    """Load the records up to the early date, which are stored only as long as the load reads them."""
    early = _curated_early(warehouse.spark, full)
    refresh(warehouse, early, **options)
    drop_written(early)


def _build_replayed(spark: SparkSession, tables: str, name: str) -> Loaded:
    """Two daily runs, with a drop in between that bears an earlier time, and the second run once more."""
    root = f"{scratch_root(spark)}/{name}"
    folders = Folders(f"{root}/landing", f"{root}/curated", rejected_facts=f"{root}/rejected")
    warehouse = Warehouse(spark, name, f"{root}/warehouse")
    early = {source: rows.where(F.col("date_scraped") < _early_until()) for source, rows in feeds(spark, tables).items()}
    late = {source: rows.where(F.col("date_scraped") >= _early_until()) for source, rows in feeds(spark, tables).items()}
    run_daily(spark, folders, warehouse, early, incremental=True, at=datetime(2026, 1, 1, tzinfo=timezone.utc))
    land(late.pop("olx"), folders.landing, "olx", datetime(2025, 12, 31, tzinfo=timezone.utc))
    for _ in range(2):
        counts = run_daily(spark, folders, warehouse, late, incremental=True, at=datetime(2026, 1, 2, tzinfo=timezone.utc))
    return Loaded(folders, warehouse, counts, {})


def _build_broken(spark: SparkSession, tables: str, name: str) -> Loaded:
    """The star with faults of every kind: repeated keys, nulls, members left out, keys without a member."""
    full = daily(spark, tables)
    star, warehouse = full.warehouse, Warehouse(spark, name, f"{scratch_root(spark)}/{name}")
    warehouse.bootstrap()
    dates, facts, macro = (star.table(t) for t in ("dim_date", "fact_listings", "fact_macro_indicators"))

    def without(column: str, condition: str):
        return F.expr(f"CASE WHEN {condition} THEN NULL ELSE {column} END").alias(column)

    parts = {
        "dim_date": [dates, dates.where("year = 1997")],
        "dim_location": [star.table("dim_location").select("location_id", without("city", "location_id = 1"), "district")],
        "dim_property": [star.table("dim_property").where("rooms IS NULL OR rooms <> 3")],
        "dim_source": [star.table("dim_source").where("source_name <> 'olx'")],
        "fact_listings": [
            facts.withColumn("price", without("price", "area > 90")).withColumn("date_id", F.expr("IF(location_id = 2, 19000101, date_id)")),
            facts.where("price_per_m2 < 5000"),
        ],
        "fact_macro_indicators": [
            macro.withColumn("location_id", F.expr("IF(average_price_per_m2 < 2000, -location_id, location_id)"))
            .withColumn("source_id", without("source_id", "average_price_per_m2 BETWEEN 5000 AND 5100")),
            macro.where("average_price_per_m2 > 9000"),
        ],
    }
    for table, frames in parts.items():
        for rows in frames:
            warehouse.append(table, rows)
    return Loaded(full.folders, warehouse, full.counts, {})


def _build_quarantined(spark: SparkSession, tables: str, name: str) -> Loaded:
    """Records as lines of text, some of them no JSON, of a wrong type, or without a field they need,
    curated in quarantine."""
    root = f"{scratch_root(spark)}/{name}"
    folders = Folders(f"{root}/landing", f"{root}/curated", f"{root}/records")
    rows = raw_listings(spark, tables)
    kept = rows.withColumn("city", F.expr("CASE WHEN floor = 5 THEN NULL ELSE city END"))
    kept = kept.withColumn("price", F.expr("CASE WHEN floor = 6 THEN DOUBLE('NaN') ELSE price END"))
    line = F.to_json(F.struct(*kept.columns), {"ignoreNullFields": "true"})
    line = F.regexp_replace(line, '"price":"NaN"', '"price":NaN')
    line = F.when(F.expr("floor = 3 AND rooms = 2"), F.concat(F.lit("cut off "), "listing_id")).otherwise(line)
    line = F.when(F.expr("floor = 4 AND rooms = 1"), F.regexp_replace(line, '"rooms":1', '"rooms":1.5')).otherwise(line)
    kept.select(line.alias("value")).write.text(f"{folders.landing}/mixed_20260101_000000")
    counts = curate(spark, folders.landing, folders.curated, QUARANTINE, folders.rejected_records)
    return Loaded(folders, Warehouse(spark, name, root), counts, {})


def _build_dense(spark: SparkSession, tables: str, name: str) -> Loaded:
    """A load of the records up to a date and the rest appended, with fact ids that leave no gaps."""
    full = daily(spark, tables)
    warehouse = Warehouse(spark, name, f"{scratch_root(spark)}/{name}")
    _refresh_early(warehouse, full, dense_ids=True)
    stored = {table: warehouse.largest(table, key) for table, key in FACT_IDS.items()}
    append(warehouse, full.curated(), dense_ids=True)
    return Loaded(full.folders, warehouse, full.counts, stored)


daily = _once("daily", _build_daily)
quarantined = _once("quarantined", _build_quarantined)
incremental = _once("incremental", _build_incremental)
latest = _once("latest", _build_latest)
replayed = _once("replayed", _build_replayed)
broken = _once("broken", _build_broken)
dense = _once("dense", _build_dense)


# -- presentation -------------------------------------------------------------------------------


def plain(rows: DataFrame) -> DataFrame:
    """Types both engines print alike: decimals as doubles, dates and times as text."""
    shown = {}
    for field in rows.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            shown[field.name] = F.col(f"`{field.name}`").cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType)):
            shown[field.name] = F.col(f"`{field.name}`").cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            shown[field.name] = F.array_join(F.col(f"`{field.name}`"), ", ")
    return rows.withColumns(shown) if shown else rows


# -- queries over frames ------------------------------------------------------------------------


def _raw(spark: SparkSession, tables: str) -> DataFrame:
    return raw_listings(configure(spark), tables)


def _validate_rejects(spark: SparkSession, tables: str) -> DataFrame:
    """Records the contract refuses and curated rows the facts refuse, with the reasons."""
    raw = _raw(spark, tables)
    stages = {"record": rejects(raw, record_rules(raw)), "fact": fact_rejects(curate_frame(raw))}
    parts = [
        rows.select(F.lit(stage).alias("stage"), "listing_id", "reasons")
        for stage, rows in stages.items()
    ]
    return parts[0].unionAll(parts[1])


def _etl_counts(spark: SparkSession, tables: str) -> DataFrame:
    """Row counts of a daily run, all from what it stored; the raw one is that of its ledger."""
    loaded = daily(spark, tables)
    landed = ledger_of(loaded.warehouse, loaded.folders.landing).read_landed()
    stored = {
        "curated": loaded.curated(),
        "rejected facts": spark.read.parquet(loaded.folders.rejected_facts),
        **{table: loaded.warehouse.table(table) for table in TABLES},
    }
    lines = landed.agg(F.sum("rows").alias("rows")).select(F.lit("raw").alias("stage"), "rows")
    for stage, rows in stored.items():
        counted = rows.agg(F.count("*").alias("rows"))
        lines = lines.unionAll(counted.select(F.lit(stage).alias("stage"), "rows"))
    return lines


def _record_rejects(spark: SparkSession, tables: str) -> DataFrame:
    """The records that a curate run in quarantine has set aside, with the reasons; the id of an unreadable
    line is taken from its text."""
    loaded = quarantined(spark, tables)
    stored = spark.read.parquet(loaded.folders.rejected_records)
    found = F.regexp_extract(MALFORMED, "[a-z]+_[0-9]+_[0-9]+", 0)
    return stored.select(F.coalesce(F.when(F.col(MALFORMED).isNotNull(), found), "listing_id").alias("record"), "reasons")


def _length_rejects(spark: SparkSession, tables: str) -> DataFrame:
    """Curated rows with texts beyond their columns, and with their times as text, that the facts refuse."""
    long = {
        "url": "CASE WHEN floor = 7 THEN repeat('x', 501) ELSE url END",
        "district": "CASE WHEN floor = 8 THEN repeat('d', 101) ELSE district END",
        "city": "CASE WHEN floor = 9 THEN repeat('c', 101) ELSE city END",
        "listing_id": "CASE WHEN floor = 10 THEN concat(listing_id, '_', repeat('i', 100)) "
                      "WHEN floor = 11 THEN concat(repeat('s', 51), listing_id) ELSE listing_id END",
    }
    raw = _raw(spark, tables).withColumns({name: F.expr(text) for name, text in long.items()})
    curated = curate_frame(raw).withColumn("date_scraped", F.col("date_scraped").cast("string"))
    return fact_rejects(curated).select("listing_id", "reasons")


def _lookup_large(spark: SparkSession, tables: str) -> DataFrame:
    """Listing facts as they are made where every dimension is too large to be sent around."""
    loaded = daily(spark, tables)
    valid = keep_valid(with_kind(loaded.curated()), fact_rules())
    return listing_facts(listings_of(valid), loaded.warehouse.table, broadcast_members=0)


def _daily_replay(spark: SparkSession, tables: str) -> DataFrame:
    """The drops of the ledger with their records and the run that loaded each, and the facts stored in the end."""
    loaded = replayed(spark, tables)
    ledger = ledger_of(loaded.warehouse, loaded.folders.landing)
    drops = ledger.read_landed().join(ledger.read_loaded(), "drop", "full").select("drop", "rows", "run")
    for table in ("fact_listings", "fact_macro_indicators"):
        stored = loaded.warehouse.table(table).agg(F.count("*").alias("rows"))
        drops = drops.unionAll(stored.select(F.lit(table).alias("drop"), "rows", F.lit("all").alias("run")))
    taken = len(loaded.counts.drops)
    return drops.unionAll(spark.range(1).select(F.lit("taken again"), F.lit(taken).cast("long"), F.lit("20260102_000000")))


# -- queries over a loaded star ------------------------------------------------------------------


def _table(name: str, without: str | None = None) -> Query:
    def run(spark: SparkSession, tables: str) -> DataFrame:
        rows = daily(spark, tables).warehouse.table(name)
        return rows.drop(without) if without else rows

    return run


def _appended(name: str, surrogate: str) -> Query:
    def run(spark: SparkSession, tables: str) -> DataFrame:
        return incremental(spark, tables).warehouse.table(name).drop(surrogate)

    return run


def _resolved(name: str, surrogate: str) -> Query:
    """Facts with the texts of their members, whose ids depend on the order of loads."""

    def run(spark: SparkSession, tables: str) -> DataFrame:
        warehouse = latest(spark, tables).warehouse
        rows = warehouse.table(name).drop(surrogate)
        for key, dimension in FOREIGN_KEYS[name].items():
            if key != "date_id":
                rows = rows.join(warehouse.table(dimension), key).drop(key)
        return rows

    return run


def _fact_ids(spark: SparkSession, tables: str) -> DataFrame:
    """Of each fact table the ids in use, before and after an append: how many, how many different ones, and their ends."""
    loaded = dense(spark, tables)
    parts = []
    for table, key in FACT_IDS.items():
        rows = loaded.warehouse.table(table).withColumn("appended", F.col(key) > loaded.stored_before[table])
        ids = [F.count("*").alias("rows"), F.countDistinct(key).alias("ids"), F.min(key).alias("first"), F.max(key).alias("last")]
        parts.append(rows.groupBy("appended").agg(*ids).select(F.lit(table).alias("fact"), "appended", "rows", "ids", "first", "last"))
    return parts[0].unionAll(parts[1])


def _append_new_members(spark: SparkSession, tables: str) -> DataFrame:
    """The dimension members an append added to an earlier load, with the ids they got."""
    loaded = incremental(spark, tables)
    parts = []
    for table, key in DIMENSION_IDS.items():
        rows = loaded.warehouse.table(table).where(F.col(key) > loaded.stored_before[table])
        texts = ["date_id"] if table == "dim_date" else rows.columns[1:]
        member = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in texts])
        parts.append(
            rows.select(F.lit(table).alias("dimension"), F.col(key).alias("id"), member.alias("member"))
        )
    added = parts[0]
    for part in parts[1:]:
        added = added.unionAll(part)
    return added


def _report(name: str, **filters) -> Query:
    return lambda spark, tables: getattr(daily(spark, tables).reports, name)(**filters)


def _summed_report(name: str, **filters) -> Query:
    """A report from the sums noted by file, after later records have replaced stored ones."""
    return lambda spark, tables: getattr(Reports(latest(spark, tables).warehouse, from_sums=True), name)(**filters)


def _adhoc_sql(spark: SparkSession, tables: str) -> DataFrame:
    text = """
        SELECT s.source_name, count(*) AS total_listings
        FROM fact_listings f JOIN dim_source s ON f.source_id = s.source_id
        WHERE f.price >= :least GROUP BY s.source_name"""
    return daily(spark, tables).reports.query(text, least=500_000)


_QUERIES: dict[str, Query] = {
    "landing_roundtrip": lambda s, d: load_landing(s, daily(s, d).folders.landing),
    "clean_listings": lambda s, d: clean(_raw(s, d)),
    "dedup_listings": lambda s, d: latest_per_listing(clean(_raw(s, d))),
    "curated_listings": lambda s, d: curate_frame(_raw(s, d)),
    "validate_rejects": _validate_rejects,
    "dim_date": _table("dim_date"),
    "dim_location": _table("dim_location"),
    "dim_property": _table("dim_property"),
    "dim_source": _table("dim_source"),
    "fact_listings": _table("fact_listings", without="listing_sk"),
    "fact_macro": _table("fact_macro_indicators", without="macro_sk"),
    "fact_integrity": lambda s, d: audit(daily(s, d).warehouse),
    "etl_counts": _etl_counts,
    "append_new_members": _append_new_members,
    "append_fact_listings": _appended("fact_listings", "listing_sk"),
    "append_fact_macro": _appended("fact_macro_indicators", "macro_sk"),
    "append_latest": _resolved("fact_listings", "listing_sk"),
    "append_latest_macro": _resolved("fact_macro_indicators", "macro_sk"),
    "fact_ids": _fact_ids,
    "lookup_large": _lookup_large,
    "fact_integrity_broken": lambda s, d: audit(broken(s, d).warehouse),
    "daily_replay": _daily_replay,
    "adhoc_sql": _adhoc_sql,
    "kpi": _report("kpi"),
    "kpi_city": _report("kpi", city=CITY),
    "kpi_display": _report("kpi_display"),
    "kpi_display_empty": _report("kpi_display", city="Nowhere"),
    "trend_month": _report("trend"),
    "trend_month_city": _report("trend", city=CITY),
    "by_city": _report("by_city"),
    "by_area_bucket": _report("by_area_bucket"),
    "by_area_bucket_city": _report("by_area_bucket", city=CITY),
    "by_rooms": _report("by_rooms"),
    "by_rooms_city": _report("by_rooms", city=CITY),
    "search_top100": _report("search"),
    "search_city": _report("search", city=CITY, min_price=250_000, max_price=600_000, min_rooms=3),
    "search_display": _report("search_display"),
    "macro_listing": _report("macro"),
    "trend_month_ranked": _report("trend", ranked=True),
    "by_city_ranked": _report("by_city", ranked=True),
    "by_area_bucket_ranked": _report("by_area_bucket", ranked=True),
    "by_rooms_ranked": _report("by_rooms", ranked=True),
    "macro_ranked": _report("macro", ranked=True),
    "record_rejects": _record_rejects,
    "length_rejects": _length_rejects,
    "kpi_from_sums": _summed_report("kpi"),
    "kpi_city_from_sums": _summed_report("kpi", city=CITY),
    "trend_month_from_sums": _summed_report("trend"),
    "by_city_from_sums": _summed_report("by_city"),
    "by_area_bucket_from_sums": _summed_report("by_area_bucket"),
    "by_rooms_from_sums": _summed_report("by_rooms"),
}


def entry(spark: SparkSession) -> DataFrame:
    """Average price per square metre by city, over a star loaded from the smallest tables."""
    return queries()["by_city"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    def presented(query: Query) -> Query:
        return lambda spark, tables: plain(query(spark, tables))

    return {name: presented(query) for name, query in _QUERIES.items()} | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return oracle_queries.statements(CITY) | LLM_SQL
