"""Reports against hand-computed results, and the plans they run with."""

import uuid
from decimal import Decimal

import pytest
from conftest import columns_of, plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from dwellmart.fixed_values import SEARCH_HEADINGS
from dwellmart.operators.normalize import transform
from dwellmart.plans.load import append, refresh
from dwellmart.plans.reports import Reports
from dwellmart.sources.warehouse import Warehouse


@pytest.fixture(scope="module")
def reports(spark, raw, tmp_path_factory):
    made = []

    def build(*records):
        root = str(tmp_path_factory.mktemp("warehouse"))
        warehouse = Warehouse(spark, f"star_{uuid.uuid4().hex}", root)
        made.append(warehouse)
        rows = [{"listing_id": f"olx_{i}", **record} for i, record in enumerate(records)]
        refresh(warehouse, transform(raw(*rows)))
        return Reports(warehouse)

    yield build
    for warehouse in made:
        warehouse.discard()


@pytest.fixture(scope="module")
def market(reports, macro_record):
    return reports(
        {"city": "warsaw", "district": "wola", "price": 100.0, "area": 10.0, "rooms": 1,
         "date_scraped": "2024-12-31"},
        {"city": "warsaw", "district": "praga", "price": 400.0, "area": 50.0, "rooms": 2,
         "date_scraped": "2025-01-01"},
        {"city": "krakow", "district": "wola", "price": 300.0, "area": 70.0, "rooms": None,
         "price_per_m2": 4.015, "date_scraped": "2025-01-15"},
        {"city": "lodz", "district": "wola", "price": 90.0, "area": 90.0, "rooms": 2,
         "date_scraped": "2025-11-15", "url": "https://example.com/3"},
        macro_record(city="lodz", date_scraped="2025-02-01", price_per_m2=1.5),
        macro_record(listing_id="gus_2", city="warsaw", date_scraped="2025-03-01", price_per_m2=2.0),
    )


def rows(frame):
    return [tuple(str(v) if isinstance(v, Decimal) else v for v in row) for row in frame.collect()]


def test_kpi(market):
    assert rows(market.kpi()) == [(4, "5.76", "222.50")]
    assert rows(market.kpi("Warsaw")) == [(2, "9.00", "250.00")]
    assert rows(market.kpi("All")) == rows(market.kpi())
    assert rows(market.kpi("Lodz")) == [(1, "1.00", "90.00")]


def test_kpi_of_nothing(market):
    assert rows(market.kpi("Atlantis")) == [(0, None, None)]
    assert rows(market.kpi_display("Atlantis")) == [("0", "N/A", "N/A")]


def test_kpi_display(market):
    assert rows(market.kpi_display()) == [("4", "5.76 PLN", "222.50 PLN")]


def test_trend(market):
    assert market.trend().columns == ["year", "month", "month_name", "avg_price_m2", "Year-Month"]
    assert rows(market.trend()) == [
        (2024, 12, "December", "10.00", "2024-12"),
        (2025, 1, "January", "6.01", "2025-01"),
        (2025, 11, "November", "1.00", "2025-11"),
    ]
    assert rows(market.trend("Krakow")) == [(2025, 1, "January", "4.02", "2025-01")]


def test_city_whose_ids_are_not_adjacent(reports, raw):
    """Districts that arrive later get ids behind those of other cities."""
    market = reports({"city": "gdynia", "price": 100.0}, {"city": "sopot", "price": 300.0})
    later = raw({"listing_id": "olx_late", "city": "gdynia", "district": "port", "price": 500.0})
    append(market.warehouse, transform(later))
    assert rows(market.kpi("Gdynia")) == [(2, "6.00", "300.00")]
    assert rows(market.kpi("Sopot")) == [(1, "6.00", "300.00")]


def test_by_city(market):
    assert rows(market.by_city()) == [("Warsaw", "9.00"), ("Krakow", "4.02"), ("Lodz", "1.00")]
    assert rows(market.by_city("Krakow")) == [("Krakow", "4.02")]


def test_by_area_bucket(market):
    assert rows(market.by_area_bucket()) == [
        ("0-40", "10.00"), ("40-60", "8.00"), ("60-80", "4.02"), ("80+", "1.00"),
    ]
    assert rows(market.by_area_bucket("Lodz")) == [("80+", "1.00")]


def test_by_rooms_leaves_out_unknown(market):
    assert rows(market.by_rooms()) == [(1, "10.00"), (2, "4.50")]
    assert rows(market.by_rooms("Krakow")) == []


def test_search(market):
    found = market.search(max_price=1000)
    assert found.columns == list(SEARCH_HEADINGS.values())
    assert rows(found) == [
        ("Lodz", "Wola", 1999, 2, "90.00", "90.00", "1.00", "olx", "https://example.com/3"),
        ("Warsaw", "Wola", 1999, 1, "10.00", "100.00", "10.00", "olx", None),
        ("Warsaw", "Praga", 1999, 2, "50.00", "400.00", "8.00", "olx", None),
    ]
    prices = SEARCH_HEADINGS["price"]
    assert rows(market.search("Warsaw").select(f"`{prices}`")) == [("100.00",), ("400.00",)]
    assert rows(market.search(min_price=100, max_price=400, min_rooms=2).select(f"`{prices}`")) == [
        ("400.00",)
    ]
    assert market.search(min_rooms=3).isEmpty()


def test_search_limit_and_ties(reports):
    many = reports(*[{"price": 100.0 if i % 2 else 50.0, "url": f"u{i:03}"} for i in range(101)])
    urls = [row["URL"] for row in many.search().collect()]
    in_order = sorted(range(101), key=lambda i: (i % 2, f"olx_{i}"))
    assert urls == [f"u{i:03}" for i in in_order[:100]]


def test_search_display(reports):
    shown = reports({"price": 1234567.5, "area": 1000.0}).search_display()
    assert columns_of(shown, "`Price (PLN)`", "`Price/m²`") == [("1,234,567.50", "1,234.57")]


def test_macro(market):
    assert rows(market.macro()) == [
        (2025, 3, "Warsaw", "average_price_per_m2", "2.00", "2025-03"),
        (2025, 2, "Lodz", "average_price_per_m2", "1.50", "2025-02"),
    ]


def test_adhoc_sql(market):
    assert rows(market.query("SELECT count(*) AS total_listings FROM fact_listings")) == [(4,)]
    text = "SELECT count(*) FROM dim_location WHERE city = :city"
    assert rows(market.query(text, city="x' OR '1'='1")) == [(0,)]
    assert rows(market.query(text, city="Warsaw")) == [(2,)]
    with pytest.raises(AnalysisException):
        market.query("SELECT * FROM invalid_table")


def test_remembered_results_follow_the_warehouse(reports, raw):
    market = reports({"city": "lodz"})
    first = market.remember("by_city")
    assert market.remember("by_city") is first and first.is_cached
    assert market.remember("by_city", city="Lodz") is not first
    count = "SELECT count(*) AS n FROM fact_listings"
    assert market.remember("query", text=count) is market.remember("query", text=count)
    assert rows(market.remember("query", text=count)) == [(1,)]
    append(market.warehouse, transform(raw({"listing_id": "olx_new", "city": "gdynia"})))
    assert ("Gdynia", "10000.00") in rows(market.remember("by_city"))
    assert rows(market.remember("query", text=count)) == [(2,)]
    assert not first.is_cached


def test_reports_do_not_depend_on_the_join_strategy(market, join_strategy):
    assert rows(market.by_city("Warsaw")) == [("Warsaw", "9.00")]
    assert len(rows(market.search(max_price=1000))) == 3
    assert len(rows(market.macro())) == 2


def test_facts_are_summed_before_they_meet_a_dimension(market):
    plan = plan_of(market.by_rooms(), "simple")
    scan = next(at for line in plan.splitlines() if "FileScan" in line and "price_per_m2" in line for at in [plan.index(line)])
    assert plan.rindex("partial_sum(price_per_m2") < scan
    assert plan.index("BroadcastHashJoin") < plan.rindex("partial_sum(price_per_m2")
    assert "ReadSchema: struct<property_id:int,price_per_m2:decimal(15,2)>" in plan_of(market.by_rooms())


def test_the_range_of_a_city_reaches_the_scan(market):
    plan = plan_of(market.kpi("Warsaw"))
    scan = next(part for part in plan.split("\n\n") if "fact_listings" in part and "PushedFilters" in part)
    assert "GreaterThanOrEqual(location_id," in scan and "LessThanOrEqual(location_id," in scan


def test_files_without_the_city_are_not_opened(spark, reports, raw):
    """16 files, one city with half of the listings; an append adds files of its own."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        records = [{"city": "hot" if i % 2 else f"town {i % 14:02}", "price": 1000.0 + i} for i in range(600)]
        market = reports(*records)
        more = [{"listing_id": f"olx_new{i}", "city": "hot" if i % 2 else "town 04", "price": 5.0 * (i + 1)} for i in range(100)]
        for added in (0, 100):
            if added:
                append(market.warehouse, transform(raw(*more)))
            everything, hot, town = (
                    sum("/fact_listings/" in file for file in market._listings(c).inputFiles()) for c in (None, "Hot", "Town 04")
                )
            assert everything == 16 + added * 16 // 100
            assert 4 <= hot < everything and town <= (11 if added else 4)
            count, _, total = market.kpi("Town 04").first()
            wanted = [r["price"] for r in records + more[:added] if r["city"] == "town 04"]
            assert (count, float(total)) == (len(wanted), pytest.approx(sum(wanted) / len(wanted), abs=0.006))
            assert market.kpi("Hot").first()[0] == 300 + added // 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_files_without_a_noted_range_are_opened(reports):
    market = reports({"city": "lodz"}, {"city": "hel"})
    facts = market.warehouse.table("fact_listings")
    market.warehouse.append("fact_listings", facts.withColumn("listing_natural_key", F.concat("listing_natural_key", F.lit("x"))))
    assert rows(market.kpi("Lodz"))[0][0] == 2


def test_search_takes_the_cheapest_before_looking_up_texts(market):
    plan = plan_of(market.search(), "simple")
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters: [IsNotNull(price), GreaterThanOrEqual(price,0.00)" in plan_of(market.search())


# -- sums noted by file, positions ---------------------------------------------------------------------


def test_reports_from_sums_follow_appends_and_merges(reports, raw):
    """Sums of added, replaced, and not yet noted files; equal to the reports over the facts."""
    plain = reports(*[{"city": f"c{i % 3}", "price": 100.0 + i, "rooms": i % 4 or None, "date_scraped": f"2025-0{1 + i % 3}-01"}
                      for i in range(30)])
    warehouse = plain.warehouse
    later = {"listing_id": "olx_3", "city": "c9", "price": 1.0, "date_scraped": "2026-01-01"}
    append(warehouse, transform(raw(later, {"listing_id": "olx_4", "price": None, "date_scraped": "2026-01-01"},
                                    {"listing_id": "olx_new", "city": "c1", "price": 7.0})), latest=True)
    summed = Reports(warehouse, from_sums=True)
    for step in range(2):
        if step:
            facts = warehouse.table("fact_listings").where("listing_natural_key = 'olx_new'")
            warehouse.append("fact_listings", facts.withColumn("listing_natural_key", F.lit("olx_unnoted")))
        for name in ("trend", "by_city", "by_area_bucket", "by_rooms", "kpi"):
            assert rows(getattr(summed, name)()) == rows(getattr(plain, name)()) != []
        for city in ("C1", "C9", "Atlantis"):
            assert rows(summed.kpi(city)) == rows(plain.kpi(city))
            assert rows(summed.by_rooms(city)) == rows(plain.by_rooms(city))
            assert rows(summed.by_city(city)) == rows(plain.by_city(city))
        opened = [file for file in summed.by_rooms().inputFiles() if "/fact_listings/part-" in file]
        assert len(opened) == step


def test_sums_of_nothing(spark, tmp_path):
    warehouse = Warehouse(spark, f"star_{uuid.uuid4().hex}", str(tmp_path))
    warehouse.bootstrap()
    assert rows(Reports(warehouse, from_sums=True).kpi()) == [(0, None, None)]
    assert rows(Reports(warehouse, from_sums=True).by_city()) == []
    warehouse.discard()


def test_ranked_reports_number_the_order(market):
    for name in ("trend", "by_city", "by_area_bucket", "by_rooms", "macro"):
        plain, ranked = rows(getattr(market, name)()), rows(getattr(market, name)(ranked=True))
        assert [row[0] for row in sorted(ranked)] == list(range(1, len(plain) + 1))
        assert [row[1:] for row in sorted(ranked)] == plain
