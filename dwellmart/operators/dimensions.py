"""Dimension members and their surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.functions.dates import calendar_columns
from dwellmart.functions.text import source_of
from dwellmart.operators.ranks import with_position


def date_members(curated: DataFrame) -> DataFrame:
    """One row per date that occurs. Names are formatted after the reduction, not per record."""
    days = curated.select(F.to_date("date_scraped").alias("day")).distinct()
    return days.select(*calendar_columns("day"))


def location_members(curated: DataFrame) -> DataFrame:
    return curated.select("city", "district").distinct()


def property_members(listings: DataFrame) -> DataFrame:
    return listings.select("rooms", "building_year", "area_bucket").distinct()


def source_members(curated: DataFrame) -> DataFrame:
    return curated.select(source_of("listing_id").alias("source_name")).distinct()


def new_members(found: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The members that are not known yet. Null equals null."""
    renamed = known.select(*[F.col(key).alias(f"_k_{key}") for key in keys])
    same = [F.col(key).eqNullSafe(F.col(f"_k_{key}")) for key in keys]
    return found.join(renamed, same, "left_anti")


def number_members(
    members: DataFrame, keys: Sequence[str], id_column: str, after: int = 0
) -> DataFrame:
    """Consecutive ids in key order, starting behind ``after``."""
    numbered = with_position(members, [F.asc(key) for key in keys], id_column, after)
    return numbered.withColumn(id_column, F.col(id_column).cast("int"))
