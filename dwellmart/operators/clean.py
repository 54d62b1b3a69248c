"""Removal of unusable and implausible records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmart.fixed_values import (
    AREA_ABOVE,
    MACRO_ID_PREFIX,
    PRICE_ABOVE,
    ROOMS_ABOVE,
    ROOMS_BELOW,
)


def _absent_or(column: str, test: Column) -> Column:
    """Written as an OR over the bare column, a form the file scan can evaluate itself."""
    return F.col(column).isNull() | test


def is_usable() -> Column:
    """A price or an area is there; macro records need neither."""
    measured = F.isnotnull("price") | F.isnotnull("area")
    return measured | F.startswith("listing_id", F.lit(MACRO_ID_PREFIX))


def is_plausible() -> Column:
    """Values that are present lie strictly inside their limits; absent ones pass."""
    plausible = _absent_or("rooms", F.col("rooms") < ROOMS_BELOW)
    for column, limit in {"price": PRICE_ABOVE, "area": AREA_ABOVE, "rooms": ROOMS_ABOVE}.items():
        plausible = plausible & _absent_or(column, F.col(column) > limit)
    return plausible


def clean(raw: DataFrame) -> DataFrame:
    return raw.where(is_usable() & is_plausible())
