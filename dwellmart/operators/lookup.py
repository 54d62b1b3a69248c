"""Equi-joins of many rows against dimensions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The widest member (two names of 100 characters) is below 1 kB, so a broadcast stays below
# 200 MB whatever the facts weigh.
BROADCAST_MEMBERS = 200_000
# A key is frequent if it holds more than one part in this many of the rows; there are fewer such
# keys than this. What is rarer is left to Spark's own splitting of skewed join partitions.
HOT_KEYS = 10_000
# Keys a sketch tells apart: it misses none that holds more than one part in some HOT_KEYS.
SKETCHED_KEYS = 65_536
# Sketches of tasks are merged in this many groups before they meet in one.
SKETCH_GROUPS = 200


@dataclass(frozen=True)
class Lookup:
    """One dimension to join: its members, one row per key; in ``null_safe`` keys null matches null.
    ``how`` is left, inner, left_semi or left_anti."""

    members: DataFrame
    keys: Sequence[str]
    null_safe: Sequence[str] = ()
    how: str = "left"


def lookup(
    rows: DataFrame,
    members: DataFrame,
    keys: Sequence[str],
    null_safe: Sequence[str] = (),
    how: str = "left",
    reduced: bool = False,
) -> DataFrame:
    """Join one dimension to ``rows``."""
    return lookups(rows, [Lookup(members, keys, null_safe, how)], reduced)


def lookups(
    rows: DataFrame,
    wanted: Sequence[Lookup],
    reduced: bool = False,
    broadcast_members: int | None = None,
) -> DataFrame:
    """Join several dimensions to ``rows``, in one pass over them.

    The members of each dimension are counted first (a read of file footers for a stored table) and
    broadcast only below the bound. Dimensions beyond it are joined by a shuffle. The frequent keys of
    all of these are found by one pass over the key columns; rows of a frequent key get a salt, and its
    member is repeated for every salt, so that no key becomes a large task. Rows that are ``reduced``
    to one per key have no such keys.
    """
    bound = BROADCAST_MEMBERS if broadcast_members is None else broadcast_members
    large = [each for each in wanted if each.members.count() > bound]
    frequent = {}
    if large and not reduced:
        frequent = dict(zip(map(id, large), frequent_keys(rows, [each.keys for each in large])))
    joined = rows
    for each in wanted:
        known = each.members.withColumnsRenamed({key: f"_m_{key}" for key in each.keys})
        condition = _matches(each.keys, each.null_safe)
        if frequent.get(id(each)):
            joined = _salted(joined, known, each, condition, frequent[id(each)])
        else:
            members = known if each in large else F.broadcast(known)
            joined = joined.join(members, condition, each.how)
        joined = joined.drop(*[f"_m_{key}" for key in each.keys])
    return joined


def frequent_keys(rows: DataFrame, keys: Sequence[Sequence[str]]) -> list[dict[int, float]]:
    """For each set of key columns, the hashes of the keys that hold more than one part in HOT_KEYS
    of the rows, with their shares. The sketches merge in any order; a key they overrate only gets a
    salt it could do without."""
    hashes = {f"_h{i}": F.xxhash64(*columns) for i, columns in enumerate(keys)}
    hashed = rows.select(*[column.alias(name) for name, column in hashes.items()])
    groups = hashed.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")).agg(
        F.count("*").alias("_rows"),
        *[F.expr(f"approx_top_k_accumulate({name}, {SKETCHED_KEYS})").alias(name) for name in hashes],
    )
    merged = groups.groupBy(F.lit("all")).agg(  # a group, because sketches of no rows can't be merged
        F.sum("_rows").alias("_rows"),
        *[F.expr(f"approx_top_k_combine({name}, {SKETCHED_KEYS})").alias(name) for name in hashes],
    )
    found = merged.select(
        "_rows", *[F.expr(f"approx_top_k_estimate({name}, {HOT_KEYS})").alias(name) for name in hashes]
    ).first()
    if found is None:
        return [{} for _ in keys]
    total = found["_rows"]
    return [
        {item["item"]: item["count"] / total for item in found[name] if item["count"] * HOT_KEYS > total}
        for name in hashes
    ]


def _salted(
    rows: DataFrame, members: DataFrame, wanted: Lookup, condition: Column, frequent: dict[int, float]
) -> DataFrame:
    """A shuffled join in which a frequent key goes to as many places as its share deserves."""
    spark = rows.sparkSession
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))
    copies = [(key, max(2, math.ceil(share * places))) for key, share in frequent.items()]
    hot = F.broadcast(spark.createDataFrame(copies, "_hash LONG, _copies INT"))
    # The salt follows from the row, so a repeated task gives the same one.
    salt = F.coalesce(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.col("_copies")), F.lit(0))
    salted = (
        rows.withColumn("_hash", F.xxhash64(*wanted.keys)).join(hot, "_hash", "left")
        .withColumn("_salt", salt.cast("int")).drop("_hash", "_copies")
    )
    every = F.sequence(F.lit(0), F.coalesce(F.col("_copies"), F.lit(1)) - 1)
    repeated = (
        members.withColumn("_hash", F.xxhash64(*[f"_m_{key}" for key in wanted.keys]))
        .join(hot, "_hash", "left").withColumn("_m_salt", F.explode(every)).drop("_hash", "_copies")
    )
    joined = salted.join(repeated, condition & (F.col("_salt") == F.col("_m_salt")), wanted.how)
    return joined.drop("_salt", "_m_salt")


def _matches(keys: Sequence[str], null_safe: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        row, member = F.col(key), F.col(f"_m_{key}")
        condition = condition & (row.eqNullSafe(member) if key in null_safe else row == member)
    return condition
