"""The registered queries once more, as plain SQL for another engine.

Each statement starts from the same tables and repeats every stage as common table expressions,
so it shares nothing with the Spark code but the rules.
"""

from __future__ import annotations

EARLY_UNTIL = "1998-06-01 00:00:00"


def _stages(prefix: str, records_where: str = "TRUE", replaced: str = "") -> str:
    """CTEs raw, clean, dedup, curated, members, listings, records, each named with ``prefix``; ``replaced``
    changes columns of the raw records."""
    p = prefix
    proper = (
        "array_to_string(list_transform(string_split(lower(trim({0})), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )
    reason = """concat_ws(', ',
        CASE WHEN listing_id IS NULL THEN 'listing_id_missing' END,
        CASE WHEN city IS NULL THEN 'city_missing' END,
        CASE WHEN district IS NULL THEN 'district_missing' END,
        CASE WHEN date_scraped IS NULL THEN 'date_scraped_missing' END,
        CASE WHEN length(city) > 100 THEN 'city_too_long' END,
        CASE WHEN length(district) > 100 THEN 'district_too_long' END,
        CASE WHEN length(source_name) > 50 THEN 'source_name_too_long' END,
        CASE WHEN length(listing_id) > 100 THEN 'listing_id_too_long' END,
        CASE WHEN source_name <> 'gus' AND price IS NULL THEN 'price_missing' END,
        CASE WHEN source_name <> 'gus' AND abs(price) >= 1e13 THEN 'price_overflow' END,
        CASE WHEN price_per_m2 IS NULL THEN 'price_per_m2_missing' END,
        CASE WHEN abs(price_per_m2) >= 1e13 THEN 'price_per_m2_overflow' END,
        CASE WHEN source_name <> 'gus' AND area IS NULL THEN 'area_missing' END,
        CASE WHEN source_name <> 'gus' AND abs(area) >= 1e8 THEN 'area_overflow' END,
        CASE WHEN source_name <> 'gus' AND length(url) > 500 THEN 'url_too_long' END)"""
    return f"""
    {p}lines AS (
        SELECT l.*, p_size, n_name, r_name,
               CASE l_returnflag WHEN 'A' THEN 'otodom' WHEN 'N' THEN 'olx' WHEN 'R' THEN 'gus'
               END AS src
        FROM lineitem l
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey),
    {p}raw AS (
        SELECT src || '_' || l_orderkey || '_' || l_linenumber AS listing_id,
               '  ' || lower(r_name) || ' ' AS city,
               n_name || ' ' AS district,
               CASE WHEN src = 'gus' OR l_discount = 0 THEN NULL
                    WHEN l_tax = 0 THEN -l_extendedprice
                    ELSE 10 * l_extendedprice END AS price,
               CASE WHEN src = 'gus' THEN l_extendedprice / 7
                    WHEN l_partkey % 2 = 0 THEN NULL
                    ELSE 10 * l_extendedprice / (2 * l_quantity + 0.3::DOUBLE) END AS price_per_m2,
               CASE WHEN src = 'gus' OR l_suppkey % 17 = 0 THEN NULL
                    ELSE 2 * l_quantity + 0.3::DOUBLE END AS area,
               CAST(CASE WHEN src = 'gus' THEN NULL WHEN l_suppkey % 25 = 0 THEN 60
                    WHEN l_suppkey % 10 = 1 THEN NULL ELSE l_linenumber END AS INT) AS rooms,
               CAST(CASE WHEN src <> 'gus' THEN l_suppkey % 13 END AS INT) AS floor,
               CAST(CASE WHEN src <> 'gus' AND p_size % 10 <> 0 THEN 1950 + p_size END AS INT)
                    AS building_year,
               CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01'
                    THEN 'https://example.com/' || l_orderkey END AS url,
               l_shipdate + l_linenumber * INTERVAL '1' HOUR AS date_scraped
        FROM {p}lines),
    {p}clean AS (
        SELECT * {replaced} FROM {p}raw
        WHERE (substr(listing_id, 1, 4) = 'gus_' OR price IS NOT NULL OR area IS NOT NULL)
          AND (price IS NULL OR price > 0)
          AND (area IS NULL OR area > 5)
          AND (rooms IS NULL OR (rooms > 0 AND rooms < 50))
          AND {records_where}),
    {p}dedup AS (
        SELECT * FROM {p}clean
        QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY
            date_scraped DESC NULLS LAST, price DESC NULLS LAST, area DESC NULLS LAST,
            price_per_m2 DESC NULLS LAST, building_year DESC NULLS LAST, floor DESC NULLS LAST,
            rooms DESC NULLS LAST, city DESC NULLS LAST, district DESC NULLS LAST,
            url DESC NULLS LAST) = 1),
    {p}curated AS (
        SELECT listing_id, {proper.format("city")} AS city, {proper.format("district")} AS district,
               price, round(coalesce(price_per_m2, price / area), 2) AS price_per_m2, area,
               rooms, floor, building_year, url, date_scraped,
               CASE WHEN area <= 40 THEN '0-40' WHEN area <= 60 THEN '40-60'
                    WHEN area <= 80 THEN '60-80' ELSE '80+' END AS area_bucket
        FROM {p}dedup),
    {p}sourced AS (
        SELECT *, split_part(listing_id, '_', 1) AS source_name,
               CAST(strftime(date_scraped, '%Y%m%d') AS INT) AS date_id
        FROM {p}curated),
    {p}judged AS (SELECT *, {reason} AS reasons FROM {p}sourced),
    {p}members AS (
        SELECT * FROM {p}judged
        WHERE listing_id IS NOT NULL AND city IS NOT NULL AND district IS NOT NULL
          AND date_scraped IS NOT NULL AND length(city) <= 100 AND length(district) <= 100
          AND length(source_name) <= 50),
    {p}listings AS (SELECT * FROM {p}judged WHERE reasons = '' AND source_name <> 'gus'),
    {p}records AS (SELECT * FROM {p}judged WHERE reasons = '' AND source_name = 'gus')"""


def _dimensions(p: str = "") -> str:
    return f"""
    {p}dim_date AS (
        SELECT DISTINCT date_id, CAST(date_scraped AS DATE) AS full_date,
               CAST(year(date_scraped) AS INT) AS year, CAST(month(date_scraped) AS INT) AS month,
               monthname(date_scraped) AS month_name,
               CAST(day(date_scraped) AS INT) AS day_of_month,
               CAST(isodow(date_scraped) AS INT) AS day_of_week,
               dayname(date_scraped) AS day_name, CAST(quarter(date_scraped) AS INT) AS quarter,
               isodow(date_scraped) >= 6 AS is_weekend
        FROM {p}members),
    {p}dim_location AS (
        SELECT CAST(row_number() OVER (ORDER BY city, district) AS INT) AS location_id,
               city, district
        FROM (SELECT DISTINCT city, district FROM {p}members)),
    {p}dim_property AS (
        SELECT CAST(row_number() OVER (ORDER BY rooms NULLS FIRST, building_year NULLS FIRST,
                                                area_bucket) AS INT) AS property_id,
               rooms, building_year, area_bucket
        FROM (SELECT DISTINCT rooms, building_year, area_bucket FROM {p}members
              WHERE source_name <> 'gus')),
    {p}dim_source AS (
        SELECT CAST(row_number() OVER (ORDER BY source_name) AS INT) AS source_id, source_name
        FROM (SELECT DISTINCT source_name FROM {p}members))"""


_FACTS = """
    fact_listings AS (
        SELECT c.listing_id AS listing_natural_key, c.date_id, l.location_id, p.property_id,
               s.source_id, c.date_scraped, CAST(c.price AS DECIMAL(15,2)) AS price,
               CAST(c.area AS DECIMAL(10,2)) AS area,
               CAST(c.price_per_m2 AS DECIMAL(15,2)) AS price_per_m2, c.url
        FROM listings c
        JOIN dim_location l ON c.city = l.city AND c.district = l.district
        JOIN dim_property p ON c.rooms IS NOT DISTINCT FROM p.rooms
                           AND c.building_year IS NOT DISTINCT FROM p.building_year
                           AND c.area_bucket = p.area_bucket
        JOIN dim_source s ON c.source_name = s.source_name),
    fact_macro AS (
        SELECT c.listing_id AS indicator_natural_key, c.date_id, l.location_id, s.source_id,
               c.date_scraped AS date_recorded,
               CAST(c.price_per_m2 AS DECIMAL(15,2)) AS average_price_per_m2
        FROM records c
        JOIN dim_location l ON c.city = l.city AND c.district = l.district
        JOIN dim_source s ON c.source_name = s.source_name),
    wide AS (
        SELECT f.*, d.year, d.month, d.month_name, l.city, l.district, p.rooms, p.building_year,
               p.area_bucket, s.source_name
        FROM fact_listings f
        JOIN dim_date d ON f.date_id = d.date_id
        JOIN dim_location l ON f.location_id = l.location_id
        JOIN dim_property p ON f.property_id = p.property_id
        JOIN dim_source s ON f.source_id = s.source_id)"""

_MONEY = "CAST({0} AS DOUBLE) AS {0}"
_RAW_OUT = "* REPLACE (CAST(date_scraped AS VARCHAR) AS date_scraped)"


def _mean(measure: str) -> str:
    """Half-up to 2 decimals over whole cents; the measures averaged here are positive."""
    cents = f"CAST(round({measure} * 100) AS HUGEINT)"
    return f"((2 * sum({cents}) + count({measure})) // (2 * count({measure}))) / 100.0::DOUBLE"


def _upto_curated(select: str) -> str:
    return f"WITH {_stages('')} {select}"


def _upto_dimensions(select: str) -> str:
    return f"WITH {_stages('')}, {_dimensions()} {select}"


def _star(select: str) -> str:
    return f"WITH {_stages('')}, {_dimensions()}, {_FACTS} {select}"


def _kpi(where: str) -> str:
    return _star(
        f"""SELECT count(*) AS total_listings, {_mean('price_per_m2')} AS avg_price_m2,
                   {_mean('price')} AS avg_total_price FROM wide {where}"""
    )


def _kpi_display(where: str) -> str:
    return _star(
        f"""SELECT format('{{:,}}', count(*)) AS total_listings,
                   coalesce(format('{{:,.2f}}', {_mean('price_per_m2')}) || ' PLN', 'N/A')
                       AS avg_price_m2,
                   coalesce(format('{{:,.2f}}', {_mean('price')}) || ' PLN', 'N/A')
                       AS avg_total_price
            FROM wide {where}"""
    )


def _grouped(columns: str, where: str = "") -> str:
    return _star(
        f"SELECT {columns}, {_mean('price_per_m2')} AS avg_price_m2 FROM wide {where} "
        f"GROUP BY {columns}"
    )


def _trend(where: str = "") -> str:
    return _star(
        f"""SELECT year, month, month_name, {_mean('price_per_m2')} AS avg_price_m2,
                   year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS "Year-Month"
            FROM wide {where} GROUP BY year, month, month_name"""
    )


def _search(where: str, price: str = "CAST({0} AS DOUBLE)") -> str:
    return _star(
        f"""SELECT city AS "City", district AS "District", building_year AS "Building Year",
                   rooms AS "Rooms", CAST(area AS DOUBLE) AS "Area (m²)",
                   {price.format("price")} AS "Price (PLN)",
                   {price.format("price_per_m2")} AS "Price/m²",
                   source_name AS "Source", url AS "URL"
            FROM (SELECT * FROM wide WHERE {where} ORDER BY price, listing_natural_key LIMIT 100)"""
    )


def _ranked(query: str, order: str, without: str = "") -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) AS position, * {without} FROM ({query})"


_MACRO = _star(
    """SELECT d.year, d.month, l.city, 'average_price_per_m2' AS indicator_name,
              CAST(f.average_price_per_m2 AS DOUBLE) AS indicator_value,
              d.year || '-' || lpad(CAST(d.month AS VARCHAR), 2, '0') AS "Year-Month"
       FROM fact_macro f JOIN dim_date d ON f.date_id = d.date_id
       JOIN dim_location l ON f.location_id = l.location_id"""
)



def _integrity(p: str = "") -> str:
    """A line per constraint, over tables named with prefix ``p``."""
    unique = {
        "dim_date": "date_id", "dim_location": "city, district", "dim_property": "rooms, building_year, area_bucket",
        "dim_source": "source_name", "fact_listings": "listing_natural_key", "fact_macro": "indicator_natural_key",
    }
    needed = {
        "dim_date": ["date_id", "year"], "dim_location": ["city", "district"], "dim_property": ["area_bucket"],
        "dim_source": ["source_name"],
        "fact_listings": ["date_id", "location_id", "property_id", "source_id", "date_scraped", "price", "area", "price_per_m2"],
        "fact_macro": ["date_id", "location_id", "source_id", "date_recorded", "average_price_per_m2"],
    }
    dimensions = {"date_id": "dim_date", "location_id": "dim_location", "property_id": "dim_property", "source_id": "dim_source"}
    lines = {}
    for table in unique:
        name = "fact_macro_indicators" if table == "fact_macro" else table
        nulls = " + ".join(f"count(*) - count({column})" for column in needed[table])
        lines[f"{name}: not null"] = f"SELECT {nulls} FROM {p}{table}"
        lines[f"{name}: unique"] = f"SELECT count(*) FROM (SELECT 1 FROM {p}{table} GROUP BY {unique[table]} HAVING count(*) > 1)"
        for key, dimension in dimensions.items():
            if table.startswith("fact") and key in needed[table]:
                lines[f"{name}: {key} in {dimension}"] = (
                    f"SELECT count(*) FROM {p}{table} WHERE {key} NOT IN (SELECT {key} FROM {p}{dimension})"
                )
    return " UNION ALL ".join(
        f"SELECT '{line}' AS \"constraint\", CAST(({count}) AS BIGINT) AS violations" for line, count in lines.items()
    )


# The faults put into a star to see the audit find them.
_BROKEN = """
    broken_dim_date AS (SELECT * FROM dim_date UNION ALL SELECT * FROM dim_date WHERE year = 1997),
    broken_dim_location AS (
        SELECT * REPLACE (CASE WHEN location_id <> 1 THEN city END AS city) FROM dim_location),
    broken_dim_property AS (SELECT * FROM dim_property WHERE rooms IS NULL OR rooms <> 3),
    broken_dim_source AS (SELECT * FROM dim_source WHERE source_name <> 'olx'),
    broken_fact_listings AS (
        SELECT * REPLACE (CASE WHEN area <= 90 THEN price END AS price,
                          CASE WHEN location_id = 2 THEN 19000101 ELSE date_id END AS date_id)
        FROM fact_listings
        UNION ALL SELECT * FROM fact_listings WHERE price_per_m2 < 5000),
    broken_fact_macro AS (
        SELECT * REPLACE (CASE WHEN average_price_per_m2 < 2000 THEN -location_id ELSE location_id END AS location_id,
                          CASE WHEN average_price_per_m2 NOT BETWEEN 5000 AND 5100 THEN source_id END AS source_id)
        FROM fact_macro
        UNION ALL SELECT * FROM fact_macro WHERE average_price_per_m2 > 9000)"""

_REPLAYED = f"""
    SELECT source || stamp AS drop, (SELECT count(*) FROM raw
           WHERE starts_with(listing_id, source) AND (date_scraped < TIMESTAMP '{EARLY_UNTIL}') = early) AS "rows",
           run
    FROM (VALUES ('otodom_', '20260101_000000', TRUE, '20260101_000000'), ('olx_', '20260101_000000', TRUE, '20260101_000000'),
                 ('gus_', '20260101_000000', TRUE, '20260101_000000'), ('olx_', '20251231_000000', FALSE, '20260102_000000'),
                 ('otodom_', '20260102_000000', FALSE, '20260102_000000'), ('gus_', '20260102_000000', FALSE, '20260102_000000'))
         AS drops(source, stamp, early, run)
    UNION ALL SELECT 'fact_listings', (SELECT count(*) FROM fact_listings), 'all'
    UNION ALL SELECT 'fact_macro_indicators', (SELECT count(*) FROM fact_macro), 'all'
    UNION ALL SELECT 'taken again', 0, '20260102_000000'"""

_COUNTS = """
    SELECT 'raw' AS stage, CAST((SELECT count(*) FROM raw) AS BIGINT) AS "rows"
    UNION ALL SELECT 'curated', (SELECT count(*) FROM curated)
    UNION ALL SELECT 'rejected facts', (SELECT count(*) FROM judged WHERE reasons <> '')
    UNION ALL SELECT 'dim_date', (SELECT count(*) FROM dim_date)
    UNION ALL SELECT 'dim_location', (SELECT count(*) FROM dim_location)
    UNION ALL SELECT 'dim_property', (SELECT count(*) FROM dim_property)
    UNION ALL SELECT 'dim_source', (SELECT count(*) FROM dim_source)
    UNION ALL SELECT 'fact_listings', (SELECT count(*) FROM fact_listings)
    UNION ALL SELECT 'fact_macro_indicators', (SELECT count(*) FROM fact_macro)"""

# An early load, then the whole data appended: stored listings and members stay as they are.
_EARLY = f"""
    {_stages('early_', f"date_scraped < TIMESTAMP '{EARLY_UNTIL}'")}, {_dimensions('early_')},
    {_stages('all_')},
    added_location AS (
        SELECT CAST((SELECT count(*) FROM early_dim_location)
                    + row_number() OVER (ORDER BY city, district) AS INT) AS location_id,
               city, district
        FROM (SELECT DISTINCT city, district FROM all_members
              EXCEPT SELECT city, district FROM early_dim_location)),
    added_property AS (
        SELECT CAST((SELECT count(*) FROM early_dim_property)
                    + row_number() OVER (ORDER BY rooms NULLS FIRST, building_year NULLS FIRST,
                                         area_bucket) AS INT) AS property_id,
               rooms, building_year, area_bucket
        FROM (SELECT DISTINCT rooms, building_year, area_bucket FROM all_members
              WHERE source_name <> 'gus'
              EXCEPT SELECT rooms, building_year, area_bucket FROM early_dim_property)),
    added_source AS (
        SELECT CAST((SELECT count(*) FROM early_dim_source)
                    + row_number() OVER (ORDER BY source_name) AS INT) AS source_id, source_name
        FROM (SELECT DISTINCT source_name FROM all_members
              EXCEPT SELECT source_name FROM early_dim_source)),
    added_date AS (
        SELECT DISTINCT date_id FROM all_members
        WHERE date_id NOT IN (SELECT date_id FROM early_dim_date))"""

_APPEND_MEMBERS = f"""WITH {_EARLY}
    SELECT 'dim_date' AS dimension, date_id AS id, CAST(date_id AS VARCHAR) AS member
    FROM added_date
    UNION ALL SELECT 'dim_location', location_id, city || '|' || district FROM added_location
    UNION ALL SELECT 'dim_property', property_id,
        coalesce(CAST(rooms AS VARCHAR), '-') || '|' || coalesce(CAST(building_year AS VARCHAR), '-')
        || '|' || area_bucket FROM added_property
    UNION ALL SELECT 'dim_source', source_id, source_name FROM added_source"""

_APPEND_FACTS = f"""WITH {_EARLY},
    listings AS (
        SELECT * FROM early_listings
        UNION ALL SELECT * FROM all_listings
        WHERE listing_id NOT IN (SELECT listing_id FROM early_listings)),
    records AS (
        SELECT * FROM early_records
        UNION ALL SELECT * FROM all_records
        WHERE listing_id NOT IN (SELECT listing_id FROM early_records)),
    dim_date AS (SELECT date_id, year, month, month_name FROM early_dim_date
                 UNION ALL SELECT date_id, NULL, NULL, NULL FROM added_date),
    dim_location AS (SELECT * FROM early_dim_location UNION ALL SELECT * FROM added_location),
    dim_property AS (SELECT * FROM early_dim_property UNION ALL SELECT * FROM added_property),
    dim_source AS (SELECT * FROM early_dim_source UNION ALL SELECT * FROM added_source),
    {_FACTS}"""

_FACT_IDS = f"""{_APPEND_FACTS},
    facts AS (
        SELECT 'fact_listings' AS fact, listing_natural_key NOT IN (SELECT listing_id FROM early_listings) AS appended
        FROM fact_listings
        UNION ALL SELECT 'fact_macro_indicators', indicator_natural_key NOT IN (SELECT listing_id FROM early_records)
        FROM fact_macro),
    counted AS (SELECT fact, appended, count(*) AS n FROM facts GROUP BY fact, appended)
    SELECT fact, appended, n AS "rows", n AS ids, CAST(sum(n) OVER so_far - n + 1 AS BIGINT) AS "first",
           CAST(sum(n) OVER so_far AS BIGINT) AS "last"
    FROM counted WINDOW so_far AS (PARTITION BY fact ORDER BY appended)"""

_FACT_OUT = """* REPLACE (CAST(date_scraped AS VARCHAR) AS date_scraped,
    CAST(price AS DOUBLE) AS price, CAST(area AS DOUBLE) AS area,
    CAST(price_per_m2 AS DOUBLE) AS price_per_m2)"""
_MACRO_OUT = """* REPLACE (CAST(date_recorded AS VARCHAR) AS date_recorded,
    CAST(average_price_per_m2 AS DOUBLE) AS average_price_per_m2)"""


def statements(city: str) -> dict[str, str]:
    here = f"WHERE city = '{city}'"
    in_range = "price BETWEEN 0 AND 2000000 AND rooms >= 1"
    return {
        "landing_roundtrip": _upto_curated(f"SELECT {_RAW_OUT} FROM raw"),
        "clean_listings": _upto_curated(f"SELECT {_RAW_OUT} FROM clean"),
        "dedup_listings": _upto_curated(f"SELECT {_RAW_OUT} FROM dedup"),
        "curated_listings": _upto_curated(f"SELECT {_RAW_OUT} FROM curated"),
        "validate_rejects": _upto_curated(
            """SELECT 'record' AS stage, listing_id, concat_ws(', ',
                   CASE WHEN listing_id IS NULL THEN 'listing_id_missing' END,
                   CASE WHEN city IS NULL THEN 'city_missing' END,
                   CASE WHEN district IS NULL THEN 'district_missing' END,
                   CASE WHEN date_scraped IS NULL THEN 'date_scraped_missing' END,
                   CASE WHEN NOT isfinite(price) THEN 'price_not_finite' END,
                   CASE WHEN NOT isfinite(price_per_m2) THEN 'price_per_m2_not_finite' END,
                   CASE WHEN NOT isfinite(area) THEN 'area_not_finite' END) AS reasons
               FROM raw WHERE reasons <> ''
               UNION ALL
               SELECT 'fact', listing_id, reasons FROM judged WHERE reasons <> ''"""
        ),
        "dim_date": _upto_dimensions(
            "SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date"
        ),
        "dim_location": _upto_dimensions("SELECT * FROM dim_location"),
        "dim_property": _upto_dimensions("SELECT * FROM dim_property"),
        "dim_source": _upto_dimensions("SELECT * FROM dim_source"),
        "fact_listings": _star(f"SELECT {_FACT_OUT} FROM fact_listings"),
        "fact_macro": _star(f"SELECT {_MACRO_OUT} FROM fact_macro"),
        "fact_integrity": _star(_integrity()),
        "fact_integrity_broken": _star(f", {_BROKEN} {_integrity('broken_')}"),
        "daily_replay": _star(_REPLAYED),
        "lookup_large": _star(f"SELECT {_FACT_OUT} FROM fact_listings"),
        "append_latest": _star(f"SELECT {_FACT_OUT} FROM (SELECT listing_natural_key, date_id, date_scraped, price, area, "
                               "price_per_m2, url, city, district, rooms, building_year, area_bucket, source_name FROM wide)"),
        "append_latest_macro": _star(
            f"""SELECT {_MACRO_OUT} FROM (SELECT f.indicator_natural_key, f.date_id, f.date_recorded, f.average_price_per_m2,
                       l.city, l.district, s.source_name
                FROM fact_macro f JOIN dim_location l ON f.location_id = l.location_id
                JOIN dim_source s ON f.source_id = s.source_id)"""
        ),
        "etl_counts": _star(_COUNTS),
        "append_new_members": _APPEND_MEMBERS,
        "fact_ids": _FACT_IDS,
        "append_fact_listings": f"{_APPEND_FACTS} SELECT {_FACT_OUT} FROM fact_listings",
        "append_fact_macro": f"{_APPEND_FACTS} SELECT {_MACRO_OUT} FROM fact_macro",
        "adhoc_sql": _star(
            """SELECT s.source_name, count(*) AS total_listings FROM fact_listings f
               JOIN dim_source s ON f.source_id = s.source_id
               WHERE f.price >= 500000 GROUP BY s.source_name"""
        ),
        "kpi": _kpi(""),
        "kpi_from_sums": _kpi(""),
        "kpi_city_from_sums": _kpi(here),
        "trend_month_from_sums": _trend(),
        "by_city_from_sums": _grouped("city"),
        "by_area_bucket_from_sums": _grouped("area_bucket"),
        "by_rooms_from_sums": _grouped("rooms", "WHERE rooms IS NOT NULL"),
        "kpi_city": _kpi(here),
        "kpi_display": _kpi_display(""),
        "kpi_display_empty": _kpi_display("WHERE city = 'Nowhere'"),
        "trend_month": _trend(),
        "trend_month_city": _trend(here),
        "by_city": _grouped("city"),
        "by_area_bucket": _grouped("area_bucket"),
        "by_area_bucket_city": _grouped("area_bucket", here),
        "by_rooms": _grouped("rooms", "WHERE rooms IS NOT NULL"),
        "by_rooms_city": _grouped("rooms", f"{here} AND rooms IS NOT NULL"),
        "search_top100": _search(in_range),
        "search_city": _search(
            f"city = '{city}' AND price BETWEEN 250000 AND 600000 AND rooms >= 3"
        ),
        "search_display": _search(in_range, price="format('{{:,.2f}}', CAST({0} AS DOUBLE))"),
        "macro_listing": _MACRO,
        "trend_month_ranked": _ranked(_trend(), "year, month"),
        "by_city_ranked": _ranked(_grouped("city"), "avg_price_m2 DESC NULLS FIRST, city"),
        "by_area_bucket_ranked": _ranked(_grouped("area_bucket"), "area_bucket"),
        "by_rooms_ranked": _ranked(_grouped("rooms", "WHERE rooms IS NOT NULL"), "rooms"),
        "macro_ranked": _ranked(_MACRO.replace("SELECT d.year,", "SELECT f.indicator_natural_key, d.year,"),
                                "year DESC, month DESC, indicator_natural_key", "EXCLUDE (indicator_natural_key)"),
        "length_rejects": "WITH " + _stages("", replaced="""REPLACE (
                CASE WHEN floor = 7 THEN repeat('x', 501) ELSE url END AS url,
                CASE WHEN floor = 8 THEN repeat('d', 101) ELSE district END AS district,
                CASE WHEN floor = 9 THEN repeat('c', 101) ELSE city END AS city,
                CASE WHEN floor = 10 THEN listing_id || '_' || repeat('i', 100)
                     WHEN floor = 11 THEN repeat('s', 51) || listing_id ELSE listing_id END AS listing_id)""")
            + " SELECT listing_id, reasons FROM judged WHERE reasons <> ''",
        "record_rejects": _upto_curated(
            """SELECT listing_id AS record,
                      CASE WHEN floor = 3 AND rooms = 2
                           THEN 'malformed, listing_id_missing, city_missing, district_missing, date_scraped_missing'
                           ELSE concat_ws(', ', CASE WHEN floor = 4 AND rooms = 1 THEN 'malformed' END,
                                          CASE WHEN floor = 5 THEN 'city_missing' END,
                                          CASE WHEN floor = 6 THEN 'price_not_finite' END) END AS reasons
               FROM raw WHERE reasons <> ''"""
        ),
    }
