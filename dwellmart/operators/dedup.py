"""One row per listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Latest record first; the other columns only make the survivor the same on every run.
SURVIVOR_ORDER = [
    "date_scraped", "price", "area", "price_per_m2", "building_year",
    "floor", "rooms", "city", "district", "url",
]


def latest_per_listing(rows: DataFrame) -> DataFrame:
    """The latest record of each listing_id.

    The rank filter is applied by Spark on both sides of the shuffle, so every map task sends at
    most one row per listing: an id that holds a large share of the rows does not become a large
    reduce task.
    """
    newest_first = Window.partitionBy("listing_id").orderBy(
        *[F.desc_nulls_last(column) for column in SURVIVOR_ORDER]
    )
    ranked = rows.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
