"""The raw landing zone: newline-delimited JSON, one drop per source and run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from dwellmart.fixed_values import DROP_STAMP, RAW_COLUMNS, RAW_SCHEMA
from dwellmart.operators.contract import MALFORMED, record_rules
from dwellmart.operators.rules import enforce
from dwellmart.session import shuffle_files_dropped

STRICT = "strict"
QUARANTINE = "quarantine"
# A compressed file is read by one task, so a drop has more files the more records it holds: some 14 MB of text each.
FILE_RECORDS = 50_000
# Landed text is some nine times as large as the tables made from it; the fastest level takes nearly all of that.
WRITTEN = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": FILE_RECORDS}


def load_landing(
    spark: SparkSession, zone: str | Sequence[str], mode: str = STRICT
) -> DataFrame:
    """All drops under a folder, or under several, as one frame with the fixed record layout.

    ``strict`` fails the job at the first unreadable line or value. ``quarantine`` keeps such
    lines, with their text in an extra column, so that they can be set aside. Unknown keys are
    ignored, missing keys are null.
    """
    if mode not in (STRICT, QUARANTINE):
        raise ValueError(f"unknown mode {mode!r}")
    reader = spark.read.option("recursiveFileLookup", "true")
    if mode == STRICT:
        reader = reader.option("mode", "FAILFAST").schema(RAW_SCHEMA)
    else:
        reader = (
            reader.option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", MALFORMED)
            .schema(f"{RAW_SCHEMA}, {MALFORMED} STRING")
        )
    try:
        return reader.json(zone if isinstance(zone, str) else list(zone))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no landing zone at {zone}") from error
        raise


def drop_name(source: str, at: datetime) -> str:
    return f"{source}_{at.strftime(DROP_STAMP)}"


def land(rows: DataFrame, zone: str, source: str, at: datetime | None = None) -> str:
    """Write one drop of ``source``, compressed, and return its path. A broken record aborts the drop."""
    drop = f"{zone.rstrip('/')}/{drop_name(source, at or datetime.now(timezone.utc))}"
    records = rows.select(*RAW_COLUMNS)
    with shuffle_files_dropped(rows.sparkSession):
        enforce(records, record_rules(records), "listing_id").write.options(**WRITTEN).json(drop)
    return drop


def preview(rows: DataFrame, count: int = 20) -> None:
    """Print the first rows untruncated."""
    rows.show(count, truncate=False)
