"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import math
import tempfile
import threading
import uuid
import warnings
import weakref

from pyspark.sql import DataFrame, SparkSession

from dwellmart.sources.files import Files

PARTITION_BYTES = 256 * 1024 * 1024

# Settings a running session accepts. UTC keeps date keys independent of where the driver runs;
# the skew setting lets a key that holds a large share of the rows be split at run time; the two
# directories of the curated zone are written side by side instead of sorted apart first;
# timestamps are stored in the form that has column statistics.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def shuffle_partitions_for(input_bytes: int, cores: int, most: int | None = None) -> int:
    """Reduce tasks that keep a shuffle partition near PARTITION_BYTES, and every core busy.

    A cluster that can't schedule that many tasks may set ``most``; partitions then grow beyond
    PARTITION_BYTES, which is warned of.
    """
    wanted = math.ceil(input_bytes / PARTITION_BYTES)
    if most is not None and wanted > most:
        size = input_bytes // most // 2**20
        warnings.warn(f"{most} shuffle partitions instead of {wanted}: about {size} MB each", stacklevel=2)
        wanted = most
    return max(cores, wanted)


def build_session(app: str, master: str | None = None, input_bytes: int = 0, **settings: str):
    """A session for the jobs of this package.

    ``input_bytes`` sizes the shuffles; adaptive execution only merges partitions, so the number
    set here has to suit the largest input. Without it the cluster's own setting stays.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    if input_bytes:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions_for(input_bytes, cores))
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Bring a session someone else made to the settings the results depend on."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


@functools.cache
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"dwellmart-{application_id}-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    It is the cluster's ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, because there the executors share the driver's disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_scratch(context.applicationId)


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, stored in the scratch folder and read back: its lineage ends there."""
    spark = frame.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    stored = spark.read.schema(frame.schema).parquet(path)
    _paths[stored] = path
    return stored


_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def drop_written(*stored: DataFrame | None) -> None:
    """Delete tables that ``written`` returned, once everything made from them is stored; None is passed over."""
    for table in stored:
        path = None if table is None else _paths.pop(table, None)
        if path:
            Files(table.sparkSession).delete(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning = threading.Lock()
_under_way: dict[str, list] = {}  # by application: how many blocks are open, and the setting before the first


@contextlib.contextmanager
def shuffle_files_dropped(spark: SparkSession):
    """While the block runs, Spark deletes the shuffle files of a query as soon as the query is complete, not when
    the driver happens to collect its garbage. Blocks may be nested, and open in several threads at once."""
    key = spark.sparkContext.applicationId
    with _cleaning:
        held = _under_way.setdefault(key, [0, spark.conf.get(_CLEANUP, "false")])
        held[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleaning:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(_CLEANUP, _under_way.pop(key)[1])
