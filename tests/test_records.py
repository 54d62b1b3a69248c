"""Cleaning, duplicates, derived columns and the record contract, at their boundaries."""

import math

import pytest
from conftest import columns_of, ids, plan_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dwellmart.functions.dates import calendar_columns, date_key
from dwellmart.functions.measures import as_decimal, exceeds_decimal, mean_to_cents
from dwellmart.functions.text import count_text, month_label, priced_text, source_of
from dwellmart.operators.clean import clean
from dwellmart.operators.contract import fact_rules, record_rules
from dwellmart.operators.dedup import latest_per_listing
from dwellmart.operators.kinds import with_kind
from dwellmart.operators.normalize import derive, transform
from dwellmart.operators.rules import enforce, keep_valid, rejects


def test_usable_records(raw, macro_record):
    frame = raw(
        {"listing_id": "olx_neither", "price": None, "area": None},
        {"listing_id": "olx_price", "area": None},
        {"listing_id": "olx_area", "price": None},
        macro_record(listing_id="gus_neither"),
        macro_record(listing_id="gus"),
        macro_record(listing_id="gusx1"),
        macro_record(listing_id=None),
        {"listing_id": None},
    )
    assert [i for i in columns_of(clean(frame), "listing_id")] == [
        ("olx_price",), ("olx_area",), ("gus_neither",), (None,),
    ]


@pytest.mark.parametrize(
    "column, values, kept",
    [
        ("price", [0.0, -1.0, 0.01, None], [0.01, None]),
        ("area", [5.0, 5.01, None], [5.01, None]),
        ("rooms", [0, 1, 49, 50, None], [1, 49, None]),
    ],
)
def test_plausible_values(raw, column, values, kept):
    frame = clean(raw(*[{column: value} for value in values]))
    assert [value for (value,) in columns_of(frame, column)] == kept


def test_clean_filters_reach_the_file_scan(spark, raw, tmp_path):
    raw({}).write.parquet(str(tmp_path / "raw"))
    plan = plan_of(clean(spark.read.parquet(str(tmp_path / "raw"))))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for part in ("GreaterThan(price,0.0)", "GreaterThan(area,5.0)", "LessThan(rooms,50)"):
        assert part in pushed


def test_latest_record_survives(raw):
    frame = raw(
        {"listing_id": "a_1", "price": 1.0, "date_scraped": "2025-01-01"},
        {"listing_id": "a_1", "price": 2.0, "date_scraped": "2025-01-02"},
        {"listing_id": "a_2", "price": 3.0},
        {"listing_id": "a_2", "price": 4.0},
        {"listing_id": "a_2", "price": None},
        {"listing_id": "a_3", "price": 5.0},
    )
    kept = sorted(columns_of(latest_per_listing(frame), "listing_id", "price"))
    assert kept == [("a_1", 2.0), ("a_2", 4.0), ("a_3", 5.0)]


def test_duplicates_are_cut_before_the_shuffle(raw):
    plan = plan_of(latest_per_listing(raw({})), "simple")
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_hot_key_does_not_lose_the_others(spark, raw):
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "olx_hot").otherwise(F.concat(F.lit("olx_"), "id")).alias("k"),
        "id",
    )
    frame = raw({}).drop("listing_id", "price").crossJoin(
        hot.select(F.col("k").alias("listing_id"), F.col("id").cast("double").alias("price"))
    )
    kept = latest_per_listing(frame)
    assert kept.count() == 2001
    assert columns_of(kept.where("listing_id = 'olx_hot'"), "price") == [(2997.0,)]


def test_bad_duplicate_does_not_hide_a_good_one(raw):
    frame = raw(
        {"price": -5.0, "date_scraped": "2025-02-02"}, {"price": 7.0, "date_scraped": "2025-02-01"}
    )
    assert columns_of(transform(frame), "price") == [(7.0,)]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("  stare  MIASTO ", "Stare  Miasto"),
        ("bielsko-biała o'neil", "Bielsko-biała O'neil"),
        ("", ""),
        (None, None),
    ],
)
def test_names(raw, name, expected):
    assert columns_of(derive(raw({"city": name})), "city") == [(expected,)]


@pytest.mark.parametrize(
    "given, price, area, expected",
    [
        (123.456, 500000.0, 50.0, 123.46),
        (None, 500000.0, 30.0, 16666.67),
        (None, 500000.0, None, None),
        (None, None, 50.0, None),
        (None, 500000.0, 0.0, None),
    ],
)
def test_unit_price(raw, given, price, area, expected):
    frame = derive(raw({"price_per_m2": given, "price": price, "area": area}))
    assert columns_of(frame, "price_per_m2") == [(expected,)]


@pytest.mark.parametrize(
    "area, bucket",
    [(40.0, "0-40"), (40.01, "40-60"), (60.0, "40-60"), (60.01, "60-80"), (80.0, "60-80"),
     (80.01, "80+"), (None, "80+")],
)
def test_area_bucket(raw, area, bucket):
    assert columns_of(derive(raw({"area": area})), "area_bucket") == [(bucket,)]


def test_record_contract(raw, macro_record):
    frame = raw(
        {"listing_id": "olx_ok"},
        macro_record(listing_id="gus_ok"),
        {"listing_id": None},
        {"listing_id": "olx_c", "city": None, "district": None},
        {"listing_id": "olx_t", "date_scraped": None},
        {"listing_id": "olx_n", "price": math.nan, "area": math.inf},
    )
    rules = record_rules(frame)
    assert ids(keep_valid(frame, rules)) == ["gus_ok", "olx_ok"]
    assert columns_of(rejects(frame, rules), "listing_id", "reasons") == [
        (None, ["listing_id_missing"]),
        ("olx_c", ["city_missing", "district_missing"]),
        ("olx_t", ["date_scraped_missing"]),
        ("olx_n", ["price_not_finite", "area_not_finite"]),
    ]


def test_strict_contract_fails_the_job(raw):
    good, bad = raw({}), raw({"city": None})
    assert enforce(good, record_rules(good), "listing_id").count() == 1
    with pytest.raises(PySparkException, match="olx_1 breaks city_missing"):
        enforce(bad, record_rules(bad), "listing_id").collect()


def test_fact_rules(raw, macro_record):
    frame = with_kind(derive(
        raw(
            {"listing_id": "olx_ok"},
            {"listing_id": "olx_p", "price": None},
            {"listing_id": "olx_a", "area": None, "price_per_m2": 5.0},
            {"listing_id": "olx_big", "price": 1e14, "price_per_m2": 5.0},
            {"listing_id": "olx_u", "url": "x" * 501},
            {"listing_id": "olx_" + "9" * 97},
            {"listing_id": "olx_city", "city": "c" * 101},
            macro_record(listing_id="gus_ok"),
            macro_record(listing_id="gus_p", price_per_m2=None),
        )
    ))
    assert ids(keep_valid(frame, fact_rules())) == ["gus_ok", "olx_ok"]
    reasons = {i[:8]: r for i, r in columns_of(rejects(frame, fact_rules()), "listing_id", "reasons")}
    assert reasons == {
        "olx_p": ["price_missing", "price_per_m2_missing"],
        "olx_a": ["area_missing"],
        "olx_big": ["price_overflow"],
        "olx_u": ["url_too_long"],
        "olx_9999": ["listing_id_too_long"],
        "olx_city": ["city_too_long"],
        "gus_p": ["price_per_m2_missing"],
    }


@pytest.mark.parametrize(
    "listing_id, source", [("a_b_c", "a"), ("nounderscore", "nounderscore"), ("_x", "")]
)
def test_source(raw, listing_id, source):
    frame = raw({"listing_id": listing_id}).select(source_of("listing_id").alias("s"))
    assert columns_of(frame, "s") == [(source,)]


def test_calendar(spark):
    days = ["2025-12-20", "2025-12-21", "2025-12-22", "2024-02-29"]
    frame = spark.createDataFrame([(d,) for d in days], "d string")
    found = frame.select(F.to_date("d").alias("day")).select(*calendar_columns("day"))
    rows = columns_of(found, "date_id", "month_name", "day_of_week", "day_name", "quarter",
                      "is_weekend")
    assert rows == [
        (20251220, "December", 6, "Saturday", 4, True),
        (20251221, "December", 7, "Sunday", 4, True),
        (20251222, "December", 1, "Monday", 4, False),
        (20240229, "February", 4, "Thursday", 1, False),
    ]


def test_date_key_is_the_utc_date(spark):
    late = spark.sql("SELECT timestamp'2025-12-19T23:30:00Z' AS t")
    assert columns_of(late.select(date_key("t").alias("k")), "k") == [(20251219,)]


def test_decimal_rounding_and_overflow(spark):
    frame = spark.createDataFrame([(1.005,), (2.345,), (-2.345,), (1e13,), (None,)], "price double")
    fits = frame.where(~exceeds_decimal("price"))
    assert [str(v) for (v,) in columns_of(fits.select(as_decimal("price").alias("v")), "v")] == [
        "1.01", "2.35", "-2.35", "None",
    ]
    assert frame.where(exceeds_decimal("price")).count() == 1


@pytest.mark.parametrize(
    "total, count, expected",
    [("0.01", 2, "0.01"), ("-0.01", 2, "-0.01"), ("10.00", 3, "3.33"), ("20.00", 3, "6.67"),
     ("0.00", 5, "0.00"), ("1004999.96", 1000000, "1.00"), ("123456789012345.67", 1, "123456789012345.67")],
)
def test_mean_is_rounded_once(spark, total, count, expected):
    frame = spark.sql(f"SELECT CAST('{total}' AS DECIMAL(35,2)) AS t, CAST({count} AS BIGINT) AS n")
    mean = frame.select(mean_to_cents(F.col("t"), F.col("n")).alias("m"))
    assert str(mean.first()["m"]) == expected


def test_mean_of_nothing_is_null(spark):
    frame = spark.sql("SELECT CAST(NULL AS DECIMAL(35,2)) AS t, 0L AS n")
    assert frame.select(mean_to_cents(F.col("t"), F.col("n"))).first()[0] is None


def test_display_texts(spark):
    frame = spark.sql(
        "SELECT 1234567.5D AS m, CAST(NULL AS DOUBLE) AS e, 1234L AS n, 2025 AS year, 3 AS month"
    )
    shown = frame.select(priced_text("m"), priced_text("e"), count_text("n"), month_label())
    assert tuple(shown.first()) == ("1,234,567.50 PLN", "N/A", "1,234", "2025-03")
