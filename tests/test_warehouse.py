"""Star schema: members, keys, facts, constraints, full load and append."""

import os
import uuid
from datetime import datetime

import pytest
from conftest import columns_of, ids, plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dwellmart.fixed_values import FOREIGN_KEYS, TABLES
from dwellmart.operators import dimensions as dims
from dwellmart.operators.facts import unseen, unseen_or_later, with_dense_key
from dwellmart.operators.integrity import IntegrityError, audit, require_sound
from dwellmart.operators.lookup import Lookup, lookup, lookups
from dwellmart.operators.normalize import transform
from dwellmart.plans.curate import curate_frame
from dwellmart.plans.daily import Folders, run_daily
from dwellmart.plans.load import append, fact_rejects, refresh
from dwellmart.session import scratch_root
from dwellmart.sources.landing import load_landing
from dwellmart.sources.warehouse import Warehouse, append_jdbc


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(spark, f"star_{uuid.uuid4().hex}", str(tmp_path / "owner's warehouse"))
    yield made
    made.discard()


@pytest.fixture
def curated(raw, macro_record):
    def build(*records):
        return transform(raw(*records))

    build.macro = macro_record
    return build


def counts(warehouse):
    return {table: warehouse.table(table).count() for table in TABLES}


def violations(warehouse):
    lines = audit(warehouse).where("violations > 0").collect()
    return {line["constraint"]: line["violations"] for line in lines}


# -- tables -----------------------------------------------------------------------------------


def test_tables_and_their_columns():
    assert set(TABLES) == {
        "dim_date", "dim_location", "dim_property", "dim_source",
        "fact_listings", "fact_macro_indicators",
    }
    assert TABLES["dim_date"].split()[:2] == ["date_id", "INT,"]
    assert {"date_id", "location_id", "property_id", "source_id"} == set(FOREIGN_KEYS["fact_listings"])


def test_bootstrap_drops_and_creates(warehouse, curated):
    refresh(warehouse, curated({}))
    warehouse.bootstrap()
    assert set(counts(warehouse).values()) == {0}
    assert warehouse.table("dim_date").columns[:4] == ["date_id", "full_date", "year", "month"]


def test_text_limits_hold_on_write(spark, warehouse):
    warehouse.bootstrap()
    long = spark.sql("SELECT 1 AS source_id, repeat('x', 51) AS source_name")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        warehouse.append("dim_source", long)
    assert warehouse.table("dim_source").count() == 0


def test_largest_id(warehouse, curated):
    refresh(warehouse, curated(*[{"listing_id": f"olx_{i}", "rooms": i + 1} for i in range(9)]))
    assert warehouse.largest("dim_property", "property_id") == 9
    assert warehouse.largest("fact_macro_indicators", "macro_sk") == 0
    stored = [row["listing_sk"] for row in warehouse.table("fact_listings").collect()]
    assert warehouse.largest("fact_listings", "listing_sk") == max(stored)


# -- members and keys ---------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbering_is_dense_and_in_key_order(spark, partitions):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        members = spark.range(500).select(
            F.when(F.col("id") % 100 != 0, F.col("id") % 9).alias("a"),
            F.sha1(F.col("id").cast("string")).alias("b"),
        )
        numbered = dims.number_members(members, ["a", "b"], "k", after=40).orderBy("k").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert [row["k"] for row in numbered] == list(range(41, 541))
    keys = [(row["a"] is not None, row["a"] or 0, row["b"]) for row in numbered]
    assert keys == sorted(keys)


@pytest.fixture
def hot_rows(spark):
    """900 rows, a third of them with one key and some without."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 5 == 0, None)
    return spark.range(900).select(
        "id",
        key.otherwise(F.col("id") % 11).cast("int").alias("a"),
        F.concat(F.lit("x"), F.col("id") % 2).alias("b"),
    )


@pytest.mark.parametrize("null_safe", [[], ["a"]])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup(spark, hot_rows, join_strategy, how, null_safe):
    members = spark.sql("SELECT * FROM VALUES (1,'x0',10), (NULL,'x1',20), (4,'x0',30) AS m(a,b,key)")
    key_of = {(1, "x0"): 10, (4, "x0"): 30} | ({(None, "x1"): 20} if null_safe else {})
    expected = []
    for row in hot_rows.collect():
        key = key_of.get((row["a"], row["b"]))
        if how == "left" or (how == "inner" and key):
            expected.append((*row, key))
        elif (how == "left_semi" and key) or (how == "left_anti" and not key):
            expected.append(tuple(row))
    found = lookup(hot_rows, members, ["a", "b"], null_safe, how)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    assert ("SortMergeJoin" in plan_of(found, "simple")) == (join_strategy == "shuffled")


def test_frequent_keys_are_found_in_one_pass(hot_rows, monkeypatch):
    from dwellmart.operators.lookup import frequent_keys

    monkeypatch.setattr("dwellmart.operators.lookup.HOT_KEYS", 8)
    by_a, by_b = frequent_keys(hot_rows.repartition(7), [["a"], ["b"]])
    hashes = hot_rows.select("a", F.xxhash64("a").alias("h")).distinct().collect()
    names = {row["h"]: row["a"] for row in hashes}
    shares = {row["a"]: row["count"] / 900 for row in hot_rows.groupBy("a").count().collect()}
    assert {names[h]: s for h, s in by_a.items()} == {k: s for k, s in shares.items() if s > 1 / 8}
    assert sorted(by_b.values()) == [0.5, 0.5]
    assert frequent_keys(hot_rows.limit(0), [["a"]]) == [{}]


def test_frequent_keys_are_spread(spark, hot_rows, monkeypatch):
    """A third of the rows has one key: no task of the join gets much more than its share of it."""
    monkeypatch.setattr("dwellmart.operators.lookup.BROADCAST_MEMBERS", 0)
    monkeypatch.setattr("dwellmart.operators.lookup.HOT_KEYS", 8)
    for name, value in {"autoBroadcastJoinThreshold": "-1", "shuffle.partitions": "16",
                        "adaptive.coalescePartitions.enabled": "false"}.items():
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        members = spark.sql("SELECT * FROM VALUES (1, 10), (4, 30) AS m(a, key)")
        found = lookup(hot_rows, members, ["a"])
        sizes = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert found.count() == 900 and sizes < 250
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rows_are_scanned_once_for_two_large_dimensions(spark, hot_rows, join_strategy, tmp_path):
    hot_rows.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    first = spark.sql("SELECT * FROM VALUES (1, 10), (NULL, 20), (4, 30) AS m(a, one)")
    second = spark.sql("SELECT * FROM VALUES ('x0', 5), ('x1', 6) AS m(b, two)")
    found = lookups(stored, [Lookup(first, ["a"], ["a"]), Lookup(second, ["b"], how="inner")])
    assert plan_of(found, "simple").count("FileScan") == 1
    expected = [(i, a, b, {1: 10, None: 20, 4: 30}.get(a), {"x0": 5, "x1": 6}[b]) for i, a, b in columns_of(hot_rows, "id", "a", "b")]
    assert sorted(map(str, columns_of(found, "id", "a", "b", "one", "two"))) == sorted(map(str, expected))


def test_lookup_of_reduced_rows(spark, hot_rows, join_strategy):
    members = spark.sql("SELECT * FROM VALUES (1, 10), (NULL, 20) AS m(a, key)")
    found = lookup(hot_rows.groupBy("a").count(), members, ["a"], ["a"], "inner", reduced=True)
    ones = sum(1 for i in range(900) if i % 3 == 0 or (i % 5 and i % 11 == 1))
    nulls = sum(1 for i in range(900) if i % 3 and i % 5 == 0)
    assert sorted(columns_of(found, "key", "count")) == [(10, ones), (20, nulls)]


def test_property_members_match_null_to_null(warehouse, curated, join_strategy):
    shapes = [(None, None), (2, None), (None, 1990), (2, 1990)]
    refresh(
        warehouse,
        curated(*[
            {"listing_id": f"olx_{i}", "rooms": rooms, "building_year": year}
            for i, (rooms, year) in enumerate(shapes * 2)
        ]),
    )
    facts = warehouse.table("fact_listings").join(warehouse.table("dim_property"), "property_id")
    assert warehouse.table("dim_property").count() == 4
    found = {k: s for k, *s in columns_of(facts, "listing_natural_key", "rooms", "building_year")}
    assert found == {f"olx_{i}": list(shape) for i, shape in enumerate(shapes * 2)}


def test_dates_are_one_member_per_day(warehouse, curated):
    refresh(
        warehouse,
        curated(
            {"listing_id": "olx_1", "date_scraped": "2025-12-19 23:30:00"},
            {"listing_id": "olx_2", "date_scraped": "2025-12-19 01:00:00"},
            {"listing_id": "olx_3", "date_scraped": "2025-12-20 00:00:00"},
        ),
    )
    assert ids(warehouse.table("dim_date"), "date_id") == [20251219, 20251220]


# -- facts ------------------------------------------------------------------------------------


def test_facts_of_a_full_load(warehouse, curated):
    refresh(
        warehouse,
        curated({"listing_id": "olx_1"}, {"listing_id": "olx_2", "price": None},
                curated.macro(listing_id="gus_1")),
        verify=True,
    )
    assert counts(warehouse) == {
        "dim_date": 1, "dim_location": 1, "dim_property": 1, "dim_source": 2,
        "fact_listings": 1, "fact_macro_indicators": 1,
    }
    (fact,) = columns_of(warehouse.table("fact_listings"), "listing_natural_key", "date_id",
                         "location_id", "property_id", "source_id", "date_scraped")
    assert fact == ("olx_1", 20250601, 1, 1, 2, datetime(2025, 6, 1, 10))
    (measures,) = columns_of(warehouse.table("fact_listings"), "price", "area", "price_per_m2")
    assert [str(m) for m in measures] == ["500000.00", "50.00", "10000.00"]
    (macro,) = columns_of(warehouse.table("fact_macro_indicators"), "indicator_natural_key",
                          "source_id", "average_price_per_m2")
    assert (macro[0], macro[1], str(macro[2])) == ("gus_1", 1, "9000.00")
    assert warehouse.table("fact_listings").agg(F.count("listing_sk")).first()[0] == 1


def test_every_curated_row_is_a_fact_or_a_reject(warehouse, curated):
    rows = curated(
        *[{"listing_id": f"olx_{i}", "price": None if i % 3 else 1e5} for i in range(20)],
        *[curated.macro(listing_id=f"gus_{i}", price_per_m2=None if i % 2 else 5.0) for i in range(9)],
    )
    refresh(warehouse, rows)
    stored = counts(warehouse)
    total = stored["fact_listings"] + stored["fact_macro_indicators"] + fact_rejects(rows).count()
    assert total == rows.count()
    assert violations(warehouse) == {}


def test_rejects_are_kept_with_their_reasons(spark, warehouse, curated, tmp_path):
    refused = str(tmp_path / "refused")
    rows = curated({}, {"listing_id": "olx_2", "area": None, "price_per_m2": 1.0})
    refresh(warehouse, rows, rejected=refused)
    assert columns_of(spark.read.parquet(refused), "listing_id", "reasons") == [
        ("olx_2", ["area_missing"])
    ]


def test_rejects_are_kept_without_being_asked_for(spark, warehouse, curated):
    rows = curated(
        {"listing_id": "olx_1"}, {"listing_id": "olx_2", "price": None}, curated.macro(),
        curated.macro(listing_id="gus_9", price_per_m2=None),
    )
    told = refresh(warehouse, rows)
    assert (told.listings, told.macro, told.rejected) == (1, 1, 2)
    assert ids(spark.read.parquet(told.rejected_folder), "listing_id") == ["gus_9", "olx_2"]
    assert told.rejected_folder == warehouse.rejects_folder()
    assert append(warehouse, rows) == append(warehouse, rows) == told


def test_strict_load_publishes_nothing_on_a_bad_row(warehouse, curated):
    refresh(warehouse, curated({"listing_id": "olx_1"}))
    bad = curated({"listing_id": "olx_2"}, {"listing_id": "olx_3", "price": None})
    with pytest.raises(PySparkException, match="olx_3 breaks price_missing"):
        refresh(warehouse, bad, mode="strict")
    assert ids(warehouse.table("fact_listings"), "listing_natural_key") == ["olx_1"]


def test_repeated_ids_in_a_batch_publish_nothing(warehouse, curated):
    rows = curated({"listing_id": "olx_1"})
    refresh(warehouse, rows)
    with pytest.raises(IntegrityError):
        refresh(warehouse, rows.union(rows))
    with pytest.raises(IntegrityError):
        append(warehouse, rows.union(rows))
    assert counts(warehouse)["fact_listings"] == 1


def test_refresh_replaces_the_star(warehouse, curated):
    refresh(warehouse, curated({"listing_id": "olx_1", "city": "lodz"}))
    before = warehouse.location_of("fact_listings")
    refresh(warehouse, curated({"listing_id": "olx_2"}))
    assert ids(warehouse.table("fact_listings"), "listing_natural_key") == ["olx_2"]
    assert ids(warehouse.table("dim_location"), "city") == ["Warsaw"]
    assert warehouse.location_of("fact_listings") != before


def test_attach_reopens_a_stored_star(spark, warehouse, curated):
    refresh(warehouse, curated({"listing_id": "olx_1"}))
    folder = warehouse.location_of("fact_listings").rsplit("/", 1)[0].removeprefix("file:")
    again = Warehouse(spark, f"{warehouse.database}_again", warehouse.root)
    again.attach(folder)
    assert counts(again) == counts(warehouse)
    again.discard()
    assert counts(warehouse)["fact_listings"] == 1


# -- append -------------------------------------------------------------------------------------


def test_curated_times_as_text_are_loaded(warehouse, curated):
    rows = curated({"listing_id": "olx_1"})
    refresh(warehouse, rows.withColumn("date_scraped", F.col("date_scraped").cast("string")))
    assert ids(warehouse.table("fact_listings"), "date_id") == [20250601]


def test_append_adds_only_what_is_new(warehouse, curated):
    refresh(warehouse, curated({"listing_id": "olx_1", "rooms": None}, curated.macro()))
    first = {table: warehouse.table(table).collect() for table in TABLES}
    append(
        warehouse,
        curated(
            {"listing_id": "olx_1", "rooms": None, "price": 1.0},
            {"listing_id": "olx_2", "rooms": None, "city": "krakow"},
            {"listing_id": "otodom_3", "date_scraped": "2025-06-02"},
            curated.macro(),
            curated.macro(listing_id="gus_2"),
        ),
    )
    assert counts(warehouse) == {
        "dim_date": 2, "dim_location": 2, "dim_property": 2, "dim_source": 3,
        "fact_listings": 3, "fact_macro_indicators": 2,
    }
    for table, rows in first.items():
        kept = warehouse.table(table).collect()
        assert all(row in kept for row in rows)
    for table, key in [("dim_location", "location_id"), ("dim_source", "source_id")]:
        numbers = ids(warehouse.table(table), key)
        assert numbers == list(range(1, len(numbers) + 1))
    keys = ids(warehouse.table("fact_listings"), "listing_sk")
    assert len(set(keys)) == 3
    assert violations(warehouse) == {}


@pytest.mark.parametrize("split", ["128m", "2k"])
def test_dense_keys_leave_no_gaps(spark, split):
    """Over files of several sizes, an empty one among them, each read whole or in several splits."""
    rows = spark.range(900).select("id", F.repeat(F.md5(F.col("id").cast("string")), 4).alias("text"))
    facts = rows.repartition(7, F.col("id") % 5).sortWithinPartitions("id")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        numbered = with_dense_key(facts, "key", after=40)
        found = numbered.collect()
        assert numbered.columns == ["id", "text", "key"]
        assert sorted(r.key for r in found) == list(range(41, 941)) and len({r.id for r in found}) == 900
        by_key = [r.id for r in sorted(found, key=lambda r: r.key)]
        assert sum(a > b for a, b in zip(by_key, by_key[1:])) < 7  # the order within each file is kept
        assert with_dense_key(facts.limit(0), "key", after=40).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_second_append_of_a_batch_adds_nothing(warehouse, curated):
    rows = curated({"listing_id": "olx_1", "rooms": None}, {"listing_id": "olx_2"}, curated.macro())
    refresh(warehouse, rows)
    before = counts(warehouse)
    append(warehouse, rows)
    assert counts(warehouse) == before


def test_append_to_an_empty_warehouse(warehouse, curated):
    warehouse.bootstrap()
    append(warehouse, curated({"listing_id": "olx_1"}, curated.macro()))
    assert counts(warehouse)["fact_listings"] == 1
    assert violations(warehouse) == {}


def test_stored_keys_of_a_small_batch_are_not_shuffled(spark, warehouse, curated, tmp_path):
    refresh(warehouse, curated({"listing_id": "olx_1"}))
    curated({"listing_id": "olx_1"}, {"listing_id": "olx_2"}).write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    new = unseen(batch, warehouse.table("fact_listings"), "listing_natural_key")
    assert ids(new) == ["olx_2"]
    assert "BroadcastHashJoin LeftSemi BuildRight" in plan_of(new)
    assert "hashpartitioning" not in plan_of(new)


# -- constraints --------------------------------------------------------------------------------


def test_audit_counts_each_violation(spark, warehouse, curated):
    refresh(warehouse, curated({"listing_id": "olx_1"}))
    facts = warehouse.table("fact_listings")
    warehouse.append("fact_listings", facts.withColumn("date_id", F.lit(19000101)))
    other = facts.where("date_id = 20250601").withColumn("listing_natural_key", F.lit("olx_9"))
    warehouse.append("fact_listings", other.withColumn("price", F.lit(None).cast("decimal(15,2)")))
    assert violations(warehouse) == {
        "fact_listings: unique": 1,
        "fact_listings: date_id in dim_date": 1,
        "fact_listings: not null": 1,
    }
    with pytest.raises(IntegrityError, match="unique: 1"):
        require_sound(warehouse)


def test_a_fact_without_its_member_fails_the_write(spark, warehouse, curated):
    from dwellmart.operators.facts import listing_facts

    refresh(warehouse, curated({"listing_id": "olx_1"}))
    stranger = curated({"listing_id": "olx_2", "city": "atlantis"})
    with pytest.raises(PySparkException, match="no location_id for olx_2"):
        listing_facts(stranger, warehouse.table).collect()


# -- whole run ------------------------------------------------------------------------------------


def test_daily_run_full_and_incremental(spark, raw, macro_record, warehouse, tmp_path):
    folders = Folders(str(tmp_path / "landing"), str(tmp_path / "curated"),
                      rejected_facts=str(tmp_path / "rejected"))
    negative = {"listing_id": "olx_2", "price": -1.0}
    feeds = {"olx": raw({"listing_id": "olx_1"}, {"listing_id": "olx_1"}, negative),
             "gus": raw(macro_record())}
    counted = run_daily(spark, folders, warehouse, feeds, at=datetime(2026, 1, 1))
    assert (counted.raw, counted.curated, counted.rejected) == (4, 2, 0)
    assert counts(warehouse)["fact_listings"] == counts(warehouse)["fact_macro_indicators"] == 1

    folders = Folders(folders.landing, str(tmp_path / "batch"))
    more = {"otodom": raw({"listing_id": "otodom_1"}), "gus": raw(macro_record(listing_id="gus_2"))}
    counted = run_daily(spark, folders, warehouse, more, incremental=True, at=datetime(2026, 1, 2))
    assert (counted.raw, counted.curated) == (2, 2)
    assert counts(warehouse)["fact_listings"] == counts(warehouse)["fact_macro_indicators"] == 2
    assert violations(warehouse) == {}
    everything = load_landing(spark, folders.landing)
    assert everything.count() == 6


def test_first_incremental_run_creates_the_tables(raw, macro_record, warehouse, tmp_path):
    folders = Folders(str(tmp_path / "landing"), str(tmp_path / "curated"))
    feeds = {"olx": raw({"listing_id": "olx_1"})}
    run_daily(spark=warehouse.spark, folders=folders, warehouse=warehouse, feeds=feeds, incremental=True)
    assert counts(warehouse)["fact_listings"] == 1 and counts(warehouse)["fact_macro_indicators"] == 0
    folders = Folders(folders.landing, str(tmp_path / "second"))
    run_daily(warehouse.spark, folders, warehouse, {"gus": raw(macro_record())}, incremental=True)
    assert counts(warehouse)["fact_listings"] == counts(warehouse)["fact_macro_indicators"] == 1


@pytest.mark.parametrize("records", [[], [{"price": -1.0}]])
def test_a_day_without_usable_records(raw, warehouse, tmp_path, records):
    folders = Folders(str(tmp_path / "landing"), str(tmp_path / "curated"))
    feed = raw({}).limit(0) if not records else raw(*records)
    for incremental in (True, False):
        told = run_daily(warehouse.spark, folders, warehouse, {"olx": feed}, incremental=incremental,
                         at=datetime(2026, 1, 1 + incremental))
        assert told.curated == 0
        assert set(counts(warehouse).values()) == {0}


def test_curate_frame_does_not_depend_on_partitioning(raw, macro_record):
    records = [{"listing_id": f"olx_{i % 7}", "price": float(i + 1)} for i in range(50)]
    frame = raw(*records, macro_record())
    one = sorted(map(str, curate_frame(frame.coalesce(1)).collect()))
    many = sorted(map(str, curate_frame(frame.repartition(13)).collect()))
    assert one == many and len(one) == 8


def test_jdbc_export_names_a_missing_driver(spark):
    with pytest.raises(Exception, match="No suitable driver"):
        append_jdbc(spark.range(1), "jdbc:nosuchdb://host/db", "t")


# -- later records of stored listings ---------------------------------------------------------------


def resolved(warehouse):
    """Facts with the texts their keys stand for, so that stars with other keys compare equal."""
    found = []
    for table, own in [("fact_listings", "listing_sk"), ("fact_macro_indicators", "macro_sk")]:
        rows = warehouse.table(table).drop(own)
        for key, dimension in FOREIGN_KEYS[table].items():
            rows = rows.join(warehouse.table(dimension), key)
        found.append(sorted(map(str, rows.drop("location_id", "property_id", "source_id").collect())))
    return found


def files_of(warehouse, table):
    rows = warehouse.table(table).select("_metadata.file_name").distinct().collect()
    return {row[0] for row in rows}


@pytest.fixture
def two_days(curated):
    """A first day in several files, and a second day with later, earlier, equal, unusable and new records."""
    first = curated(*[{"listing_id": f"olx_{i}", "price": 1e5 + i, "city": f"c{i % 4}"} for i in range(40)],
                    *[curated.macro(listing_id=f"gus_{i}") for i in range(6)])
    day = {"date_scraped": "2025-07-01 09:00:00"}
    second = curated(
        {"listing_id": "olx_3", "price": 7.0, "city": "new town", "rooms": 9, **day},
        {"listing_id": "olx_4", "price": None, **day},
        {"listing_id": "olx_5", "price": 8.0, "date_scraped": "2025-05-31 09:00:00"},
        {"listing_id": "olx_6", "price": 9.0},
        {"listing_id": "olx_99", "price": 10.0, **day},
        curated.macro(listing_id="gus_2", price_per_m2=3.5, **day),
        curated.macro(listing_id="gus_77", **day),
    )
    return first, second


@pytest.fixture
def small_files(spark):
    """As many files as there are shuffle partitions, however small they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_later_records_replace_stored_ones(warehouse, two_days, small_files, join_strategy):
    first, second = two_days
    refresh(warehouse, first)
    keys = dict(columns_of(warehouse.table("fact_listings"), "listing_natural_key", "listing_sk"))
    before = files_of(warehouse, "fact_listings")
    untouched = {row[0] for row in warehouse.table("fact_listings")
                 .where("listing_natural_key NOT IN ('olx_3', 'olx_4')").select("_metadata.file_name").collect()}
    changed = {row[0] for row in warehouse.table("fact_listings")
               .where("listing_natural_key IN ('olx_3', 'olx_4')").select("_metadata.file_name").collect()}
    told = append(warehouse, second, latest=True)
    assert (told.listings, told.macro) == (40, 7)
    after = dict(columns_of(warehouse.table("fact_listings"), "listing_natural_key", "listing_sk"))
    assert set(after) == {f"olx_{i}" for i in range(40) if i != 4} | {"olx_99"}
    assert {k: v for k, v in after.items() if k != "olx_99"} == {k: v for k, v in keys.items() if k != "olx_4"}
    assert len(set(after.values())) == 40
    prices = {k: str(p) for k, p in columns_of(warehouse.table("fact_listings"), "listing_natural_key", "price")}
    assert (prices["olx_3"], prices["olx_5"], prices["olx_6"]) == ("7.00", "100005.00", "100006.00")
    assert violations(warehouse) == {}
    # Files without a changed listing are the same files as before.
    assert before - changed <= files_of(warehouse, "fact_listings") and not changed & files_of(warehouse, "fact_listings")
    assert untouched - changed


def test_loading_day_by_day_equals_loading_all(spark, warehouse, two_days):
    from dwellmart.operators.dedup import latest_per_listing

    first, second = two_days
    refresh(warehouse, first)
    append(warehouse, second, latest=True)
    whole = Warehouse(spark, f"{warehouse.database}_whole", f"{warehouse.root} whole")
    refresh(whole, latest_per_listing(first.union(second)))
    ours, theirs = resolved(warehouse), resolved(whole)
    whole.discard()
    # At equal times the stored record stays, where removing duplicates goes by the price.
    assert [row for row in ours[0] if "olx_6" not in row] == [row for row in theirs[0] if "olx_6" not in row]
    assert ours[1] == theirs[1]


def shuffle_files(spark):
    """The shuffle files on the disk of a local session."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_loads_leave_neither_shuffle_files_nor_passing_tables(spark, warehouse, two_days, small_files):
    first, second = two_days
    root, setting = scratch_root(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    files, tables, before = shuffle_files(spark), set(os.listdir(root)), spark.conf.get(setting, "false")
    refresh(warehouse, first)
    append(warehouse, second, latest=True)
    append(warehouse, second)
    assert shuffle_files(spark) <= files
    left = {name for name in set(os.listdir(root)) - tables if not name.startswith("ranges-")}
    assert left == set()
    assert spark.conf.get(setting, "false") == before


@pytest.mark.parametrize("small", [False, True])
def test_later_records_are_shuffled_once(spark, curated, small):
    stored = spark.createDataFrame([("olx_1", 7, "f", True), ("olx_2", 8, "f", False)], "listing_id STRING, sk LONG, _file STRING, _later BOOLEAN")
    rows = curated({"listing_id": "olx_1"}, {"listing_id": "olx_2"}, {"listing_id": "olx_3"})
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit if small else -1)
    try:
        found = unseen_or_later(rows, stored, "sk")
        assert sorted(columns_of(found, "listing_id", "sk")) == [("olx_1", 7), ("olx_3", None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_repeating_a_batch_of_later_records_changes_nothing(warehouse, two_days):
    first, second = two_days
    refresh(warehouse, first)
    told = append(warehouse, second, latest=True)
    files = files_of(warehouse, "fact_listings")
    assert append(warehouse, second, latest=True) == told
    assert files <= files_of(warehouse, "fact_listings")


def test_a_load_without_later_records_only_adds_files(warehouse, curated):
    refresh(warehouse, curated({"listing_id": "olx_1"}))
    before = files_of(warehouse, "fact_listings")
    append(warehouse, curated({"listing_id": "olx_2"}), latest=True)
    assert before < files_of(warehouse, "fact_listings")


@pytest.mark.parametrize("cut", ["move", "delete"])
def test_a_merge_that_was_cut_off_is_completed(warehouse, two_days, small_files, monkeypatch, cut):
    from dwellmart.sources.files import Files

    first, second = two_days
    refresh(warehouse, first)
    calls = []
    plain = getattr(Files, cut)

    def failing(self, path, *to):
        calls.append(path)
        if "part-" in path and len([c for c in calls if "part-" in c]) > 1:
            raise OSError("cut off")
        plain(self, path, *to)

    with monkeypatch.context() as patched:
        patched.setattr(Files, cut, failing)
        with pytest.raises(OSError, match="cut off"):
            append(warehouse, second, latest=True)
    append(warehouse, second, latest=True)
    assert counts(warehouse)["fact_listings"] == 40 and counts(warehouse)["fact_macro_indicators"] == 7
    assert violations(warehouse) == {}
    assert not [n for n in Files(warehouse.spark).names(warehouse.location_of("fact_listings")) if n.startswith("_merge")]


def test_a_merge_that_fails_before_its_note_changes_nothing(spark, warehouse, two_days):
    first, second = two_days
    refresh(warehouse, first)
    names = sorted(files_of(warehouse, "fact_listings"))
    rows = warehouse.stored_files("fact_listings", names)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        warehouse.replace_files("fact_listings", names, rows.withColumn("url", F.lit("x" * 501)))
    assert counts(warehouse)["fact_listings"] == 40 and sorted(files_of(warehouse, "fact_listings")) == names


# -- manifests ---------------------------------------------------------------------------------------


def test_a_switch_that_is_cut_between_two_tables_is_invisible(spark, warehouse, curated, monkeypatch):
    refresh(warehouse, curated({"listing_id": "olx_1", "city": "lodz"}))
    switched = []

    def cut(self, text, *args, **named):
        if text.startswith("ALTER TABLE"):
            switched.append(text)
            if len(switched) == 3:
                raise OSError("cut off")
        return plain(self, text, *args, **named)

    plain = type(spark).sql
    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", cut)
        with pytest.raises(OSError, match="cut off"):
            refresh(warehouse, curated({"listing_id": "olx_2", "city": "hel"}, {"listing_id": "olx_3", "city": "hel"}))
    again = Warehouse(spark, warehouse.database, warehouse.root)
    for star in (warehouse, again):
        assert ids(star.table("dim_location"), "city") == ["Hel"]
        assert ids(star.table("fact_listings"), "listing_natural_key") == ["olx_2", "olx_3"]
        text = "SELECT city, count(*) AS n FROM fact_listings JOIN dim_location USING (location_id) GROUP BY city"
        assert [tuple(r) for r in star.query(text).collect()] == [("Hel", 2)]
    # The next load points the catalog to the published tables before it adds to them.
    append(again, curated({"listing_id": "olx_4", "city": "hel"}))
    assert spark.table(again.name_of("fact_listings")).count() == counts(again)["fact_listings"] == 3
    assert violations(again) == {}


def test_vacuum_keeps_the_newest_loads(spark, warehouse, curated):
    from dwellmart.sources.files import Files

    other = Warehouse(spark, f"{warehouse.database}_other", warehouse.root)
    refresh(other, curated({"listing_id": "olx_9"}))
    folders = []
    for i in range(4):
        refresh(warehouse, curated({"listing_id": f"olx_{i}"}))
        folders.append(warehouse.folder().rsplit("/", 1)[1])
    with pytest.raises(IntegrityError):
        rows = curated({"listing_id": "olx_1"})
        refresh(warehouse, rows.union(rows))
    Files(spark).write_text(f"{warehouse.root}/load-left/part", "x")
    with pytest.raises(ValueError, match="published"):
        warehouse.vacuum(keep=0)
    assert sorted(warehouse.vacuum(keep=2)) == sorted([*folders[:2], "load-left"])
    assert ids(warehouse.table("fact_listings"), "listing_natural_key") == ["olx_3"]
    assert ids(other.table("fact_listings"), "listing_natural_key") == ["olx_9"]
    warehouse.attach(f"{warehouse.root}/{folders[2]}")
    assert ids(warehouse.table("fact_listings"), "listing_natural_key") == ["olx_2"]
    assert warehouse.vacuum(keep=5) == []
    other.discard()


def test_nothing_published_is_said_so(warehouse):
    with pytest.raises(FileNotFoundError, match="nothing is published"):
        warehouse.table("dim_date")
