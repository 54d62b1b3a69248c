"""Raw listings derived from a set of order tables, one record per order line.

The test tables hold no property listings. This adapter gives their order lines the record layout
and the irregularities of raw listings: repeated ids, padded names, missing and implausible
values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PORTALS = {"A": "otodom", "N": "olx", "R": "gus"}


def feeds(spark: SparkSession, tables: str) -> dict[str, DataFrame]:
    """The raw listings of each portal; the choice of order lines is pushed to their scan."""
    return {
        name: raw_listings(spark, tables, F.col("l_returnflag") == flag)
        for flag, name in PORTALS.items()
    }


def raw_listings(spark: SparkSession, tables: str, lines_where: Column | None = None) -> DataFrame:
    """Raw listings from the tables in folder ``tables``.

    No join is hinted: part and supplier grow with the data, so Spark decides by their size.
    """

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{tables}/{name}.parquet")

    places = (
        read("supplier")
        .join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "n_name", "r_name")
    )
    lines = read("lineitem")
    if lines_where is not None:
        lines = lines.where(lines_where)
    lines = (
        lines.join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    source = F.lit(None).cast("string")
    for flag, name in PORTALS.items():
        source = F.when(F.col("l_returnflag") == flag, name).otherwise(source)
    return lines.withColumn("source", source).selectExpr(
        "concat_ws('_', source, l_orderkey, l_linenumber) AS listing_id",
        "concat('  ', lower(r_name), ' ') AS city",
        "concat(n_name, ' ') AS district",
        """CASE WHEN source = 'gus' OR l_discount = 0 THEN NULL
                WHEN l_tax = 0 THEN -l_extendedprice
                ELSE 10 * l_extendedprice END AS price""",
        """CASE WHEN source = 'gus' THEN l_extendedprice / 7
                WHEN l_partkey % 2 = 0 THEN NULL
                ELSE 10 * l_extendedprice / (2 * l_quantity + 0.3D) END AS price_per_m2""",
        """CASE WHEN source = 'gus' OR l_suppkey % 17 = 0 THEN NULL
                ELSE 2 * l_quantity + 0.3D END AS area""",
        """CAST(CASE WHEN source = 'gus' OR l_suppkey % 10 = 1 AND l_suppkey % 25 <> 0 THEN NULL
                WHEN l_suppkey % 25 = 0 THEN 60
                ELSE l_linenumber END AS INT) AS rooms""",
        "CAST(CASE WHEN source = 'gus' THEN NULL ELSE l_suppkey % 13 END AS INT) AS floor",
        """CAST(CASE WHEN source = 'gus' OR p_size % 10 = 0 THEN NULL
                ELSE 1950 + p_size END AS INT) AS building_year""",
        """CASE WHEN l_shipdate >= TIMESTAMP_NTZ'2000-01-01 00:00:00'
                THEN concat('https://example.com/', l_orderkey) END AS url""",
        "CAST(l_shipdate + l_linenumber * INTERVAL '1' HOUR AS TIMESTAMP) AS date_scraped",
    )
