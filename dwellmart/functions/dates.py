"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(moment: str) -> Column:
    """yyyyMMdd as an integer, computed without a detour through text."""
    return (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("int")


def iso_weekday(day: str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(day) + 1).cast("int")


def calendar_columns(day: str) -> list[Column]:
    """The columns of the date dimension for a date column."""
    return [
        date_key(day).alias("date_id"),
        F.col(day).alias("full_date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.quarter(day).alias("quarter"),
        iso_weekday(day).isin(6, 7).alias("is_weekend"),
    ]
