"""Fact rows from curated rows and dimensions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellmart.functions.dates import date_key
from dwellmart.functions.measures import as_decimal
from dwellmart.functions.text import source_of
from dwellmart.operators.lookup import Lookup, lookups
from dwellmart.operators.rules import required
from dwellmart.session import written

Dimension = Callable[[str], DataFrame]

SUMMED_KEYS = ["location_id", "property_id", "date_id"]


def fact_sums() -> list[Column]:
    """What is noted of listing facts by each of SUMMED_KEYS, for reports that need no more."""
    measures = ["price_per_m2", "price"]
    sums = [(F.sum(m).alias(m), F.count(m).alias(f"{m}_n")) for m in measures]
    return [F.count("*").alias("rows"), *[column for pair in sums for column in pair]]


def _with_keys(
    rows: DataFrame, dimension: Dimension, of_property: bool, broadcast_members: int | None
) -> DataFrame:
    """The rows with their dimension keys, joined in one pass."""
    rows = rows.withColumns(
        {"date_id": date_key("date_scraped"), "source_name": source_of("listing_id")}
    )
    wanted = [
        Lookup(dimension("dim_location"), ["city", "district"]),
        Lookup(dimension("dim_source"), ["source_name"]),
    ]
    if of_property:
        shape = ["rooms", "building_year", "area_bucket"]
        wanted.append(Lookup(dimension("dim_property"), shape, null_safe=["rooms", "building_year"]))
    return lookups(rows, wanted, broadcast_members=broadcast_members)


def listing_facts(
    listings: DataFrame, dimension: Dimension, broadcast_members: int | None = None, kept: Sequence[str] = ()
) -> DataFrame:
    """Listings with their four dimension keys, without a surrogate key of their own but for what is ``kept``."""
    keyed = _with_keys(listings, dimension, True, broadcast_members)
    return keyed.select(
        F.col("listing_id").alias("listing_natural_key"),
        "date_id",
        *[required(key, "listing_id").alias(key)
          for key in ("location_id", "property_id", "source_id")],
        "date_scraped",
        *[as_decimal(measure).alias(measure) for measure in ("price", "area", "price_per_m2")],
        "url",
        *kept,
    )


def macro_facts(
    records: DataFrame, dimension: Dimension, broadcast_members: int | None = None, kept: Sequence[str] = ()
) -> DataFrame:
    """Macro records with their three dimension keys, without a surrogate key of their own but for what is ``kept``."""
    return _with_keys(records, dimension, False, broadcast_members).select(
        F.col("listing_id").alias("indicator_natural_key"),
        "date_id",
        *[required(key, "listing_id").alias(key) for key in ("location_id", "source_id")],
        F.col("date_scraped").alias("date_recorded"),
        as_decimal("price_per_m2").alias("average_price_per_m2"),
        *kept,
    )


def with_surrogate_key(facts: DataFrame, id_column: str, after: int) -> DataFrame:
    """Unique ids behind ``after``: sparse, but given by each task on its own."""
    return facts.withColumn(id_column, F.lit(after + 1) + F.monotonically_increasing_id())


def with_dense_key(facts: DataFrame, id_column: str, after: int) -> DataFrame:
    """Consecutive ids behind ``after``, in the order the facts have in their tasks, without another shuffle.

    The facts are stored once; a file's ids then start behind the rows of the files before it (prefix sums
    over one row per file, sent around) and go on by the row's place in the file. Both are fixed by
    what is stored, so a repeated task gives the same ids, however the files are split over tasks.
    """
    stored = written(facts, "unnumbered")
    file, place = F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place")
    sizes = stored.select(file).groupBy("_file").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    placed = stored.select("*", file, place).join(F.broadcast(starts), "_file")
    return placed.withColumn(id_column, F.lit(after + 1) + F.col("_before") + F.col("_place")).drop("_file", "_place", "_before")


def unseen(rows: DataFrame, stored: DataFrame, stored_key: str) -> DataFrame:
    """The curated rows whose listing_id is not a stored natural key yet.

    The stored keys are first cut down to those of the batch. For a batch that is small next to
    the stored facts, the batch side of that step is the one sent around, so the stored table is
    scanned for one column and never shuffled whole.
    """
    batch_keys = rows.select("listing_id")
    stored_keys = stored.select(F.col(stored_key).alias("listing_id"))
    repeated = stored_keys.join(batch_keys, "listing_id", "left_semi")
    return rows.join(repeated, "listing_id", "left_anti")


def met(
    batch: DataFrame, stored: DataFrame, stored_key: str, stored_time: str, id_column: str
) -> DataFrame:
    """The stored facts of which the batch has a record: key, surrogate key, file, and whether the record is later.

    As in ``unseen``, a small batch is the side that is sent around, so of the stored facts three
    columns are scanned and none is shuffled.
    """
    facts = stored.select(
        F.col(stored_key).alias("listing_id"), F.col(stored_time).alias("_stored_at"), id_column,
        F.col("_metadata.file_name").alias("_file"),
    )
    records = batch.select("listing_id", F.col("date_scraped").alias("_scraped_at"))
    later = F.coalesce(F.col("_scraped_at") > F.col("_stored_at"), F.lit(False))
    return facts.join(records, "listing_id").select("listing_id", id_column, "_file", later.alias("_later"))


def unseen_or_later(rows: DataFrame, met: DataFrame, id_column: str) -> DataFrame:
    """The curated rows that are not stored yet, without a surrogate key, and those of a later time than the stored
    fact, with the key of that one. One shuffle of the rows at most."""
    found = rows.join(met.select("listing_id", id_column, "_later"), "listing_id", "left")
    return found.where("_later IS NULL OR _later").select(*rows.columns, id_column)
