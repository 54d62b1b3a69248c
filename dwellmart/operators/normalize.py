"""From raw records to curated ones."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dwellmart.functions.measures import area_bucket, unit_price
from dwellmart.functions.text import proper_name
from dwellmart.operators.clean import clean
from dwellmart.operators.dedup import latest_per_listing


def derive(rows: DataFrame) -> DataFrame:
    """Tidy names, unit price and size bucket."""
    return rows.withColumns(
        {
            "city": proper_name("city"),
            "district": proper_name("district"),
            "price_per_m2": unit_price("price_per_m2", "price", "area"),
            "area_bucket": area_bucket("area"),
        }
    )


def normalize(cleaned: DataFrame) -> DataFrame:
    return derive(latest_per_listing(cleaned))


def transform(raw: DataFrame) -> DataFrame:
    """Clean, then remove duplicates, then derive. A bad duplicate never hides a good one."""
    return raw.transform(clean).transform(normalize)
