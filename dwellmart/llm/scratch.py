"""Intermediate tables that go when they are no longer needed.

Steps that hand tables on to one another fill the shared folder and, with their shuffle files, the
disks of the executors. A table written here leaves no shuffle files behind (Spark deletes them when
the write is complete), and its owner drops it once everything made from it is stored. A lost executor
costs repeated tasks of the running write only, since what that write reads is still there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from dwellmart.session import scratch_root
from dwellmart.sources.files import Files

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    def __init__(self, spark: SparkSession):
        self._spark, self._files = spark, Files(spark)
        self._stored: dict[int, tuple[DataFrame, str]] = {}

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        """The frame, stored in the scratch folder and read back: its lineage ends there."""
        path = f"{scratch_root(self._spark)}/{name}-{uuid.uuid4().hex}"
        before = self._spark.conf.get(_CLEANUP, "false")
        self._spark.conf.set(_CLEANUP, "true")
        try:
            frame.write.parquet(path)
        finally:
            self._spark.conf.set(_CLEANUP, before)
        table = self._spark.read.schema(frame.schema).parquet(path)
        self._stored[id(table)] = (table, path)
        return table

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables that ``write`` returned; None and what has been dropped are passed over."""
        for table in tables:
            _, path = self._stored.pop(id(table), (None, None))
            if path:
                self._files.delete(path)

    def drop_all_but(self, *tables: DataFrame) -> None:
        kept = {id(table) for table in tables}
        self.drop(*[table for key, (table, _) in list(self._stored.items()) if key not in kept])
