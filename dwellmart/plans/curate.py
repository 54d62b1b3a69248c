"""From the landing zone to the curated zone."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dwellmart.fixed_values import RAW_COLUMNS
from dwellmart.operators.contract import record_rules
from dwellmart.operators.normalize import transform
from dwellmart.operators.rules import enforce, keep_valid, rejects
from dwellmart.session import shuffle_files_dropped
from dwellmart.sources.curated import read_curated, write_curated
from dwellmart.sources.landing import QUARANTINE, STRICT, load_landing, preview

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class CurateCounts:
    """Rows seen by a curate run. ``raw`` is observed while the data passes; tasks that had to be
    repeated may count twice in it, so the daily run takes it from its ledger instead. ``curated`` is
    read back from what was written."""

    raw: int
    curated: int
    rejected: int


def curate_frame(raw: DataFrame, mode: str = STRICT) -> DataFrame:
    """Curated rows of a raw frame, without reading or writing files."""
    rules = record_rules(raw)
    valid = enforce(raw, rules, "listing_id") if mode == STRICT else keep_valid(raw, rules)
    return transform(valid.select(*RAW_COLUMNS))


def curate(
    spark: SparkSession,
    landing: str | Sequence[str],
    curated: str,
    mode: str = STRICT,
    rejected: str | None = None,
    previewed: int = 0,
) -> CurateCounts:
    """Read the drops under a landing folder, or under several, and write the curated zone.

    In quarantine mode the rejected records go to ``rejected``. That is a second read of the
    landing zone, which costs less than storing the parsed records for it. The first ``previewed`` raw
    and curated rows are printed.
    """
    if (mode == QUARANTINE) != (rejected is not None):
        raise ValueError("quarantine needs a folder for rejected records, strict takes none")
    raw = load_landing(spark, landing, mode)
    if previewed:
        preview(raw, previewed)
    seen = Observation("raw")
    observed = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
    with shuffle_files_dropped(spark):
        write_curated(curate_frame(observed, mode), curated)

    if previewed:
        preview(read_curated(spark, curated), previewed)
    refused = 0
    if rejected is not None:
        rejects(raw, record_rules(raw)).write.mode("overwrite").parquet(rejected)
        refused = spark.read.parquet(rejected).count()
    counts = CurateCounts(seen.get["rows"], read_curated(spark, curated).count(), refused)
    log.info("curated %s of %s records, %s rejected", counts.curated, counts.raw, counts.rejected)
    return counts
