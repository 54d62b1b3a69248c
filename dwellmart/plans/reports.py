"""Reports over the star schema.

Averages are taken in two steps: facts are reduced to sums per foreign key, an integer, and only
these few rows meet the dimension and are summed further. So no fact row is joined to a
dimension it is merely grouped by, and a key that most facts share is combined on the map side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellmart.fixed_values import (
    ALL_CITIES,
    MACRO_INDICATOR,
    MONTH_LABEL,
    SEARCH_HEADINGS,
    SEARCH_LIMIT,
    SEARCH_MAX_PRICE,
    SEARCH_MIN_PRICE,
    SEARCH_MIN_ROOMS,
)
from dwellmart.functions.measures import mean_to_cents
from dwellmart.functions.text import count_text, money_text, month_label, priced_text
from dwellmart.operators.facts import fact_sums
from dwellmart.operators.lookup import lookup
from dwellmart.operators.ranks import with_position
from dwellmart.sources.warehouse import Warehouse


POSITION = "position"


class Reports:
    """The report queries of one warehouse. ``city`` may be any city, or None / "All". A report that is
    ``ranked`` has the position of each row in a column, where others only come in that order: so it can be
    stored, joined and cut into pages."""

    def __init__(self, warehouse: Warehouse, from_sums: bool = False):
        """With ``from_sums``, averages over all cities, and the headline figures of any, come from the sums
        that loads have noted by file; only files without notes are read. A load adds to the sums what its
        own files hold, so nothing stored before is read again."""
        self.warehouse = warehouse
        self.from_sums = from_sums
        self._remembered: dict[tuple, DataFrame] = {}

    # -- headline figures ----------------------------------------------------------------------

    def kpi(self, city: str | None = None) -> DataFrame:
        """Count and averages in one row, also where nothing matches.

        Every fact has its surrogate key, so rows are counted and the key column is not read.
        """
        if self.from_sums:
            sums = self._summed("location_id", city)
            return sums.agg(
                F.coalesce(F.sum("rows"), F.lit(0)).alias("total_listings"),
                *[mean_to_cents(F.sum(name), F.sum(f"{name}_n")).alias(title)
                  for name, title in [("price_per_m2", "avg_price_m2"), ("price", "avg_total_price")]],
            )
        return self._listings(city).agg(
            F.count("*").alias("total_listings"),
            _mean("price_per_m2").alias("avg_price_m2"),
            _mean("price").alias("avg_total_price"),
        )

    def kpi_display(self, city: str | None = None) -> DataFrame:
        return self.kpi(city).select(
            count_text("total_listings").alias("total_listings"),
            priced_text("avg_price_m2").alias("avg_price_m2"),
            priced_text("avg_total_price").alias("avg_total_price"),
        )

    # -- average price per square metre ------------------------------------------------------

    def trend(self, city: str | None = None, ranked: bool = False) -> DataFrame:
        """By month, in calendar order."""
        months = self._mean_by("date_id", "dim_date", ["year", "month", "month_name"], city)
        return _in_order(months.withColumn(MONTH_LABEL, month_label()), [F.asc("year"), F.asc("month")], ranked)

    def by_city(self, city: str | None = None, ranked: bool = False) -> DataFrame:
        """By city, dearest first."""
        cities = self._mean_by("location_id", "dim_location", ["city"], city)
        return _in_order(cities, [F.desc_nulls_first("avg_price_m2"), F.asc("city")], ranked)

    def by_area_bucket(self, city: str | None = None, ranked: bool = False) -> DataFrame:
        buckets = self._mean_by("property_id", "dim_property", ["area_bucket"], city)
        return _in_order(buckets, [F.asc("area_bucket")], ranked)

    def by_rooms(self, city: str | None = None, ranked: bool = False) -> DataFrame:
        """By room count, leaving out properties without one."""
        rooms = self._mean_by(
            "property_id", "dim_property", ["rooms"], city, F.col("rooms").isNotNull()
        )
        return _in_order(rooms, [F.asc("rooms")], ranked)

    # -- listings and indicators -------------------------------------------------------------

    def search(
        self,
        city: str | None = None,
        min_price: int = SEARCH_MIN_PRICE,
        max_price: int = SEARCH_MAX_PRICE,
        min_rooms: int = SEARCH_MIN_ROOMS,
        limit: int = SEARCH_LIMIT,
    ) -> DataFrame:
        """The cheapest listings that match; the natural key decides between equal prices.

        Only the dimension that filters is joined before the limit; the texts of the others are
        fetched for the rows that remain.
        """
        rooms = self.warehouse.table("dim_property").where(F.col("rooms") >= min_rooms)
        priced = self._listings(city).where(F.col("price").between(min_price, max_price))
        matching = lookup(
            priced,
            rooms.select("property_id", "rooms", "building_year"),
            ["property_id"],
            how="inner",
        )
        order = [F.asc_nulls_last("price"), F.asc("listing_natural_key")]
        cheapest = matching.orderBy(*order).limit(limit)
        described = cheapest.join(self.warehouse.table("dim_location"), "location_id").join(
            self.warehouse.table("dim_source"), "source_id"
        )
        headings = [F.col(name).alias(title) for name, title in SEARCH_HEADINGS.items()]
        return described.orderBy(*order).select(*headings)

    def search_display(self, **filters) -> DataFrame:
        """The search with its prices as text."""
        found = self.search(**filters)
        prices = [SEARCH_HEADINGS[name] for name in ("price", "price_per_m2")]
        return found.withColumns({title: money_text(title) for title in prices})

    def macro(self, ranked: bool = False) -> DataFrame:
        """All indicator records, latest month first.

        Sorting goes on to the natural key, so that a month with very many records is spread
        over several sort ranges.
        """
        facts = self.warehouse.table("fact_macro_indicators")
        dated = self._join(facts, "dim_date", "date_id", ["year", "month"])
        placed = self._join(dated, "dim_location", "location_id", ["city"])
        order = [F.desc_nulls_first("year"), F.desc_nulls_first("month"), F.asc("indicator_natural_key")]
        return _in_order(placed, order, ranked).select(
            *([POSITION] if ranked else []),
            "year",
            "month",
            "city",
            F.lit(MACRO_INDICATOR).alias("indicator_name"),
            F.col(MACRO_INDICATOR).alias("indicator_value"),
            month_label().alias(MONTH_LABEL),
        )

    # -- reuse -------------------------------------------------------------------------------

    def remember(self, report: str, **filters) -> DataFrame:
        """The result of a report, kept for the next call until the warehouse changes.

        Kept blocks spill to disk, and Spark recomputes those of a lost executor.
        """
        key = (self.warehouse.version, report, tuple(sorted(filters.items())))
        if key not in self._remembered:
            if any(version != self.warehouse.version for version, *_ in self._remembered):
                self.forget()
            self._remembered[key] = getattr(self, report)(**filters).persist()
        return self._remembered[key]

    def query(self, text: str, **parameters) -> DataFrame:
        """Ad-hoc SQL over the warehouse tables."""
        return self.warehouse.query(text, **parameters)

    def forget(self) -> None:
        for result in self._remembered.values():
            result.unpersist()
        self._remembered.clear()

    # -- shared parts ------------------------------------------------------------------------

    def _listings(self, city: str | None) -> DataFrame:
        """Listing facts, of one city if one is given.

        Facts are laid out by location_id over their files, and ordered by it inside. The range of a
        city's ids picks the files and, inside them, rules out row groups; the join then decides.
        """
        facts = self.warehouse.table("fact_listings")
        if city is None or city == ALL_CITIES:
            return facts
        here = self.warehouse.table("dim_location").where(F.col("city") == city).select("location_id")
        lowest, highest = here.agg(F.min("location_id"), F.max("location_id")).first()
        if lowest is None:
            return facts.limit(0)
        near = self.warehouse.between("fact_listings", "location_id", lowest, highest)
        return lookup(near, here, ["location_id"], how="left_semi")

    def _summed(self, key: str, city: str | None) -> DataFrame:
        """Sums of the listing facts by a key, one row a key and file; for one city only by location."""
        noted, others = self.warehouse.noted_sums("fact_listings", key)
        names = [key, "rows", "price_per_m2", "price_per_m2_n", "price", "price_n"]
        parts = []
        if "rows" in noted.columns:
            parts.append(noted.withColumnRenamed("key", key).select(*names))
        if others or not parts:
            rows = self.warehouse.stored_files("fact_listings", others) if others else self.warehouse.table("fact_listings").limit(0)
            parts.append(rows.groupBy(key).agg(*fact_sums()).select(*names))
        sums = reduce(DataFrame.unionAll, parts)
        if city is None or city == ALL_CITIES:
            return sums
        here = self.warehouse.table("dim_location").where(F.col("city") == city).select("location_id")
        return lookup(sums, here, ["location_id"], how="left_semi", reduced=True)

    def _join(
        self, rows: DataFrame, dimension: str, key: str, columns: list[str], reduced: bool = False
    ) -> DataFrame:
        members = self.warehouse.table(dimension).select(key, *columns)
        return lookup(rows, members, [key], how="inner", reduced=reduced)

    def _mean_by(
        self,
        key: str,
        dimension: str,
        groups: list[str],
        city: str | None,
        members: Column | None = None,
    ) -> DataFrame:
        if self.from_sums and (key == "location_id" or city in (None, ALL_CITIES)):
            sums = self._summed(key, city).groupBy(key).agg(
                F.sum("price_per_m2").alias("_total"), F.sum("price_per_m2_n").alias("_n")
            )
        else:
            sums = self._listings(city).groupBy(key).agg(
                F.sum("price_per_m2").alias("_total"), F.count("price_per_m2").alias("_n")
            )
        joined = self._join(sums, dimension, key, groups, reduced=True)
        if members is not None:
            joined = joined.where(members)
        mean = mean_to_cents(F.sum("_total"), F.sum("_n"))
        return joined.groupBy(*groups).agg(mean.alias("avg_price_m2"))


def _in_order(rows: DataFrame, order: list[Column], ranked: bool) -> DataFrame:
    return with_position(rows, order, POSITION) if ranked else rows.orderBy(*order)


def _mean(measure: str) -> Column:
    return mean_to_cents(F.sum(measure), F.count(measure))
