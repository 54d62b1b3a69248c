"""Positions in a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellmart.session import written


def with_position(rows: DataFrame, order: Sequence[Column], name: str, after: int = 0) -> DataFrame:
    """Consecutive numbers in the given order, starting behind ``after``, without a single-task sort.

    The order must tell any two rows apart. Rows are dealt by ranges of it and written with their range
    number; a range's numbers then start behind the sizes of the ranges before it. The written table fixes
    the ranges, which a recomputation would be free to cut elsewhere. The offsets table has one row
    per range, that is, at most one per shuffle partition.
    """
    ranged = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    stored = written(ranged, "ranges")
    sizes = stored.groupBy("_range").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("_range").orderBy(*order)
    numbered = stored.withColumn("_position", F.row_number().over(within))
    position = F.lit(after) + F.col("_before") + F.col("_position")
    return numbered.join(F.broadcast(offsets), "_range").select(position.alias(name), *[f"`{c}`" for c in rows.columns])
