"""Row rules: named conditions a row must not meet, and what to do with rows that meet one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "reasons"


def broken(rules: Mapping[str, Column]) -> Column:
    """The names of the rules a row breaks, as an array. A null condition counts as kept."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))


def passes(rules: Mapping[str, Column]) -> Column:
    """True where no rule is broken; cheaper than building the array."""
    kept = F.lit(True)
    for condition in rules.values():
        kept = kept & ~F.coalesce(condition, F.lit(False))
    return kept


def keep_valid(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return rows.where(passes(rules))


def rejects(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows that break a rule, with all the names."""
    return rows.where(~passes(rules)).withColumn(REASONS, broken(rules))


def enforce(rows: DataFrame, rules: Mapping[str, Column], subject: str) -> DataFrame:
    """All rows, or a failed job: the first row that breaks a rule raises inside its task.

    There is no separate checking pass, and a failed job commits no output.
    """
    message = F.concat(
        F.coalesce(F.col(subject), F.lit("(no key)")),
        F.lit(" breaks "),
        F.array_join(broken(rules), ", "),
    )
    return rows.where(F.when(passes(rules), F.lit(True)).otherwise(F.raise_error(message)))


def required(value: str, owner: str) -> Column:
    """The value, or a failed job where it is null."""
    message = F.concat(F.lit(f"no {value} for "), F.coalesce(F.col(owner), F.lit("(no key)")))
    return F.coalesce(F.col(value), F.raise_error(message))
