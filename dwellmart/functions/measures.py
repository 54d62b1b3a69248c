"""Expressions over prices and areas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dwellmart.fixed_values import AREA_BUCKETS, DECIMAL_DIGITS, OPEN_AREA_BUCKET


def unit_price(given: str, price: str, area: str) -> Column:
    """Price per square metre to 2 decimals: the given one, else price over area."""
    return F.round(F.coalesce(F.col(given), F.try_divide(F.col(price), F.col(area))), 2)


def area_bucket(area: str) -> Column:
    """Size label. A missing area belongs to the open bucket."""
    label = F.lit(OPEN_AREA_BUCKET)
    for upper, name in reversed(AREA_BUCKETS):
        label = F.when(F.col(area) <= upper, name).otherwise(label)
    return label


def is_finite(number: str) -> Column:
    """True for a plain number, false for NaN and infinities, null for null."""
    value = F.col(number)
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def exceeds_decimal(measure: str) -> Column:
    """True where the value does not fit the decimal type of its warehouse column.

    The exact test converts the value, which is slow; it is only reached by values that use all
    the digits there are.
    """
    digits, scale = DECIMAL_DIGITS[measure]
    value = F.col(measure)
    long = value.isNotNull() & (F.abs(value) >= float(10 ** (digits - scale - 1)))
    return long & value.try_cast(f"decimal({digits},{scale})").isNull()


def as_decimal(measure: str) -> Column:
    """Half-up to the warehouse scale; a value that does not fit fails the job."""
    digits, scale = DECIMAL_DIGITS[measure]
    return F.col(measure).cast(f"decimal({digits},{scale})")


def mean_to_cents(total: Column, count: Column) -> Column:
    """``total / count`` to 2 decimals, half away from zero, rounded exactly once.

    Works on whole cents, because decimal division would round to its own scale first and so
    round ties twice. Null where there is nothing to average.
    """
    cents = (F.abs(total) * 100).cast("decimal(37,0)")
    n = F.nullif(count.cast("decimal(20,0)"), F.lit(0))
    size = F.call_function("div", cents * 2 + n, n * 2).cast("decimal(20,0)")
    signed = F.when(total < 0, -size).otherwise(size)
    return (signed * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(20,2)")
