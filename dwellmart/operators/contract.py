"""The contracts rows have to meet: raw records, dimension members, fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmart.fixed_values import MEASURE_COLUMNS, REQUIRED_COLUMNS, TEXT_LIMITS
from dwellmart.functions.measures import exceeds_decimal, is_finite
from dwellmart.functions.text import source_of
from dwellmart.operators.kinds import is_listing

MALFORMED = "_corrupt_record"


def _missing(column: str) -> dict[str, Column]:
    return {f"{column}_missing": F.col(column).isNull()}


def _too_long(column: str, value: Column) -> dict[str, Column]:
    return {f"{column}_too_long": F.length(value) > TEXT_LIMITS[column]}


def record_rules(raw: DataFrame) -> dict[str, Column]:
    """Rules of a raw record: required fields present, numbers finite, line readable."""
    rules: dict[str, Column] = {}
    if MALFORMED in raw.columns:
        rules["malformed"] = F.col(MALFORMED).isNotNull()
    for column in REQUIRED_COLUMNS:
        rules |= _missing(column)
    for column in MEASURE_COLUMNS:
        rules[f"{column}_not_finite"] = ~is_finite(column)
    return rules


def member_rules() -> dict[str, Column]:
    """Rules every curated row must meet before it may add dimension members."""
    rules: dict[str, Column] = {}
    for column in REQUIRED_COLUMNS:
        rules |= _missing(column)
    for column in ("city", "district"):
        rules |= _too_long(column, F.col(column))
    return rules | _too_long("source_name", source_of("listing_id"))


def fact_rules() -> dict[str, Column]:
    """Rules of a curated row, with its kind, that is to become a fact: member rules plus measures
    and lengths. Price and area are asked of listings only, macro records carry neither."""
    listing_only = {"price", "area"}
    rules = member_rules() | _too_long("listing_id", F.col("listing_id"))
    for column in MEASURE_COLUMNS:
        applies = is_listing() if column in listing_only else F.lit(True)
        rules[f"{column}_missing"] = applies & F.col(column).isNull()
        rules[f"{column}_overflow"] = applies & exceeds_decimal(column)
    return rules | {"url_too_long": is_listing() & (F.length("url") > TEXT_LIMITS["url"])}
