"""The curated zone: Parquet, listings and macro records in separate directories.

Which of the two a record is follows from its id. Keeping them apart lets the warehouse load read
only the directory it needs, and there are two whatever ids turn up.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from dwellmart.fixed_values import CURATED_TYPES
from dwellmart.operators.kinds import KIND, with_kind


def write_curated(curated: DataFrame, path: str) -> None:
    """Replace the curated zone."""
    with_kind(curated).write.mode("overwrite").partitionBy(KIND).parquet(path)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """The curated zone, also one that was written as a single directory, or one without any row."""
    try:
        curated = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no curated zone at {path}") from error
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        # No row, so no file to take the types from.
        types = ", ".join(f"{name} {kind}" for name, kind in {**CURATED_TYPES, KIND: "STRING"}.items())
        curated = spark.read.schema(types).parquet(path)
    return with_kind(curated)
