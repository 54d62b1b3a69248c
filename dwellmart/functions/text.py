"""Text expressions: names, sources, display strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dwellmart.fixed_values import CURRENCY, ID_SEPARATOR, NO_VALUE


def proper_name(name: str) -> Column:
    """Blanks trimmed, each blank-separated word capitalised."""
    return F.initcap(F.trim(name))


def source_of(listing_id: str) -> Column:
    """The part of an id before its first separator; the whole id where there is none."""
    return F.substring_index(listing_id, ID_SEPARATOR, 1)


def month_label(year: str = "year", month: str = "month") -> Column:
    return F.concat_ws("-", F.col(year).cast("string"), F.lpad(F.col(month).cast("string"), 2, "0"))


def money_text(amount: str) -> Column:
    """Thousands separators and two decimals; null stays null."""
    return F.format_number(amount, 2)


def priced_text(amount: str) -> Column:
    """Money with its currency, or the no-value text."""
    return F.coalesce(F.concat(money_text(amount), F.lit(f" {CURRENCY}")), F.lit(NO_VALUE))


def count_text(number: str) -> Column:
    return F.format_number(number, 0)
