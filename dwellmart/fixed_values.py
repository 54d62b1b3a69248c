"""Fixed values.

Names, labels, formats and thresholds that results depend on. They are part of the data
contract (record layout, table layout, report headings), so they are stated here once, as text.
"""

# ---- raw and curated records -------------------------------------------------------------
RAW_TYPES = {
    "listing_id": "STRING",
    "city": "STRING",
    "district": "STRING",
    "price": "DOUBLE",
    "price_per_m2": "DOUBLE",
    "area": "DOUBLE",
    "rooms": "INT",
    "floor": "INT",
    "building_year": "INT",
    "url": "STRING",
    "date_scraped": "TIMESTAMP",
}
CURATED_TYPES = {**RAW_TYPES, "area_bucket": "STRING"}
RAW_COLUMNS = list(RAW_TYPES)
RAW_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in RAW_TYPES.items())
REQUIRED_COLUMNS = ["listing_id", "city", "district", "date_scraped"]
MEASURE_COLUMNS = ["price", "price_per_m2", "area"]

ID_SEPARATOR = "_"
MACRO_SOURCE = "gus"
MACRO_ID_PREFIX = "gus_"
DROP_STAMP = "%Y%m%d_%H%M%S"  # landing drops are named <source>_<stamp>

# ---- cleaning limits, all exclusive --------------------------------------------------------
PRICE_ABOVE = 0
AREA_ABOVE = 5
ROOMS_ABOVE = 0
ROOMS_BELOW = 50

# ---- size buckets: upper bound (inclusive) and label; anything else is the open bucket -----
AREA_BUCKETS = [(40, "0-40"), (60, "40-60"), (80, "60-80")]
OPEN_AREA_BUCKET = "80+"

# ---- warehouse tables ------------------------------------------------------------------------
TABLES = {
    "dim_date": """
        date_id INT, full_date DATE, year INT, month INT, month_name VARCHAR(20),
        day_of_month INT, day_of_week INT, day_name VARCHAR(20), quarter INT,
        is_weekend BOOLEAN""",
    "dim_location": "location_id INT, city VARCHAR(100), district VARCHAR(100)",
    "dim_property": "property_id INT, rooms INT, building_year INT, area_bucket VARCHAR(20)",
    "dim_source": "source_id INT, source_name VARCHAR(50)",
    "fact_listings": """
        listing_sk BIGINT, listing_natural_key VARCHAR(100), date_id INT, location_id INT,
        property_id INT, source_id INT, date_scraped TIMESTAMP, price DECIMAL(15,2),
        area DECIMAL(10,2), price_per_m2 DECIMAL(15,2), url VARCHAR(500)""",
    "fact_macro_indicators": """
        macro_sk BIGINT, indicator_natural_key VARCHAR(100), date_id INT, location_id INT,
        source_id INT, date_recorded TIMESTAMP, average_price_per_m2 DECIMAL(15,2)""",
}
NULLABLE_TABLE_COLUMNS = {"dim_property": ["rooms", "building_year"], "fact_listings": ["url"]}
UNIQUE_KEYS = {
    "dim_date": ["date_id"],
    "dim_location": ["city", "district"],
    "dim_property": ["rooms", "building_year", "area_bucket"],
    "dim_source": ["source_name"],
    "fact_listings": ["listing_natural_key"],
    "fact_macro_indicators": ["indicator_natural_key"],
}
FOREIGN_KEYS = {
    "fact_listings": {
        "date_id": "dim_date", "location_id": "dim_location",
        "property_id": "dim_property", "source_id": "dim_source",
    },
    "fact_macro_indicators": {
        "date_id": "dim_date", "location_id": "dim_location", "source_id": "dim_source",
    },
}
FACT_TIMES = {"fact_listings": "date_scraped", "fact_macro_indicators": "date_recorded"}
TEXT_LIMITS = {"listing_id": 100, "city": 100, "district": 100, "source_name": 50, "url": 500}
DECIMAL_DIGITS = {"price": (15, 2), "area": (10, 2), "price_per_m2": (15, 2)}

# ---- reports -------------------------------------------------------------------------------
ALL_CITIES = "All"
CURRENCY = "PLN"
NO_VALUE = "N/A"
MACRO_INDICATOR = "average_price_per_m2"
SEARCH_MIN_PRICE = 0
SEARCH_MAX_PRICE = 2_000_000
SEARCH_MIN_ROOMS = 1
SEARCH_LIMIT = 100
MONTH_LABEL = "Year-Month"
SEARCH_HEADINGS = {
    "city": "City",
    "district": "District",
    "building_year": "Building Year",
    "rooms": "Rooms",
    "area": "Area (m²)",
    "price": "Price (PLN)",
    "price_per_m2": "Price/m²",
    "source_name": "Source",
    "url": "URL",
}
