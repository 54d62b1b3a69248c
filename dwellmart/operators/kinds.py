"""The two kinds of curated records: listings, and macro records of the statistics source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmart.fixed_values import CURATED_TYPES, MACRO_SOURCE
from dwellmart.functions.text import source_of

KIND = "record_kind"
LISTING = "listing"
MACRO = "macro"


def kind_of(listing_id: str = "listing_id") -> Column:
    """Follows from the id alone; an id that is missing counts as a listing."""
    return F.when(source_of(listing_id) == MACRO_SOURCE, MACRO).otherwise(LISTING)


def with_kind(curated: DataFrame) -> DataFrame:
    """The curated columns in their types, and the kind, derived where it is not stored.

    The casts only act on zones written by other tools, which may hold times as text or whole
    numbers as floating ones; otherwise the optimizer drops them.
    """
    columns = [F.col(name).cast(kind).alias(name) for name, kind in CURATED_TYPES.items()]
    kind = F.col(KIND) if KIND in curated.columns else kind_of()
    return curated.select(*columns, kind.alias(KIND))


def is_listing() -> Column:
    return F.col(KIND) == LISTING


def listings_of(curated: DataFrame) -> DataFrame:
    return curated.where(F.col(KIND) == LISTING)


def macro_of(curated: DataFrame) -> DataFrame:
    return curated.where(F.col(KIND) == MACRO)
