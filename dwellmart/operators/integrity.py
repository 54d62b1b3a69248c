"""Constraints of the star schema, checked as queries.

Parquet tables take any row, so required columns, unique keys and foreign keys are checked here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellmart.fixed_values import FOREIGN_KEYS, TABLES, UNIQUE_KEYS
from dwellmart.sources.warehouse import Warehouse


class IntegrityError(RuntimeError):
    """A load that breaks a constraint of the star schema."""


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count. Null equals null."""
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def audit(warehouse: Warehouse) -> DataFrame:
    """Every constraint with the number of rows or keys that violate it (all zero when sound).

    Null counts come from file footers. Of a fact table, the unique key and all foreign keys are
    counted in one scan.
    """
    parts = []
    for table in TABLES:
        line, nulls = f"{table}: not null", warehouse.null_count(table)
        parts.append(warehouse.spark.range(1).select(F.lit(line).alias("constraint"), F.lit(nulls).cast("long").alias("violations")))
        parts.append(_keys_of_fact(warehouse, table) if table in FOREIGN_KEYS else _keys_of_dimension(warehouse, table))
    return reduce(DataFrame.unionAll, parts)


def _keys_of_dimension(warehouse: Warehouse, table: str) -> DataFrame:
    repeated = duplicate_keys(warehouse.table(table), UNIQUE_KEYS[table])
    return repeated.agg(F.count("*").alias("violations")).select(
        F.lit(f"{table}: unique").alias("constraint"), "violations"
    )


def _keys_of_fact(warehouse: Warehouse, table: str) -> DataFrame:
    """Repeated unique keys, and rows whose foreign key has no member; null foreign keys are left to
    the count of nulls.

    One aggregation over grouping sets takes each key apart; what is left of a foreign key, one row a
    value, meets the members of all dimensions in one join.
    """
    (own,), foreign = UNIQUE_KEYS[table], FOREIGN_KEYS[table]
    lines = {0: f"{table}: unique"} | {i: f"{table}: {key} in {dim}" for i, (key, dim) in enumerate(foreign.items(), 1)}
    columns = [own, *foreign]
    sets = warehouse.table(table).groupingSets([[F.col(c)] for c in columns], *columns)
    which, key = F.lit(0), F.pmod(F.hash(own), F.lit(2**31 - 1))  # spreads repeated own keys; they meet no member
    for i, column in enumerate(foreign, 1):
        which = F.when(F.grouping(column) == 0, i).otherwise(which)
        key = F.when(F.grouping(column) == 0, F.col(column)).otherwise(key)
    counted = sets.agg(which.alias("which"), key.cast("int").alias("key"), F.count("*").alias("rows")).select("which", "key", "rows")
    doubtful = counted.where("which > 0 AND key IS NOT NULL OR which = 0 AND rows > 1")
    members = reduce(
        DataFrame.unionAll,
        [warehouse.table(dim).select(F.lit(i).alias("which"), F.col(key).alias("key")).distinct()
         for i, (key, dim) in enumerate(foreign.items(), 1)],
    ).withColumn("known", F.lit(True))
    lost = doubtful.join(members, ["which", "key"], "left").where("known IS NULL")
    found = lost.groupBy("which").agg(F.sum(F.when(F.col("which") == 0, 1).otherwise(F.col("rows"))).alias("violations"))
    every = warehouse.spark.createDataFrame(list(lines.items()), "which INT, constraint STRING")
    return every.join(found, "which", "left").select("constraint", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))


def require_sound(warehouse: Warehouse) -> None:
    """Raise unless every constraint holds. The report has one row per constraint."""
    broken = audit(warehouse).where(F.col("violations") > 0).collect()
    if broken:
        raise IntegrityError("; ".join(f"{r['constraint']}: {r['violations']}" for r in broken))


def require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    if not duplicate_keys(rows, keys).isEmpty():
        raise IntegrityError(f"repeated {', '.join(keys)} in the batch")
