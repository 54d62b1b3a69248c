"""Which drops of a landing zone are complete, how many records they hold, and which are loaded.

For every drop there is one small file for each of the two facts, written once and never changed. The record of
a drop is in the landing zone, in a folder that readers of the zone skip; what is loaded is kept below
the root of the warehouse it was loaded into. Counts are taken from the stored drop, after the job that
wrote it has ended, so repeated tasks can't count twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from dwellmart.fixed_values import RAW_SCHEMA
from dwellmart.sources.files import Files, at_once

LANDED = "drop STRING, rows LONG"
LOADED = "drop STRING, run STRING"
DONE = "_SUCCESS"  # Spark's own mark in a folder that is written completely


class Ledger:
    def __init__(self, spark: SparkSession, zone: str, loads: str):
        """``loads`` is the folder that keeps what was loaded, one for each warehouse."""
        self.spark = spark
        self.zone = zone.rstrip("/")
        self.landed_folder = f"{self.zone}/_ledger"
        self.loads = loads
        self.files = Files(spark)

    def path_of(self, drop: str) -> str:
        return f"{self.zone}/{drop}"

    def landed(self) -> dict[str, int]:
        """The records of every drop in the ledger."""
        return {row["drop"]: row["rows"] for row in self.read_landed().collect()}

    def read_landed(self) -> DataFrame:
        return self._read(self.landed_folder, LANDED)

    def read_loaded(self) -> DataFrame:
        return self._read(self.loads, LOADED)

    def _read(self, folder: str, layout: str) -> DataFrame:
        if not self.files.exists(folder):
            return self.spark.createDataFrame([], layout)
        return self.spark.read.schema(layout).json(folder)

    def knows(self, drop: str) -> bool:
        return self.files.exists(f"{self.landed_folder}/{drop}.json")

    def record(self, drop: str) -> None:
        """Count a complete drop and note it, unless that has been done."""
        if self.knows(drop):
            return
        rows = self.spark.read.schema(RAW_SCHEMA).option("recursiveFileLookup", "true").json(self.path_of(drop)).count()
        self.files.write_text(f"{self.landed_folder}/{drop}.json", json.dumps({"drop": drop, "rows": rows}))

    def complete_drops(self) -> list[str]:
        """Every drop of the zone that is written completely, in order of name: single files, and folders with
        the mark of a job that has ended."""
        names = [name for name in self.files.names(self.zone) if not name.startswith(("_", ".")) and not name.endswith(".unfinished")]
        whole = []
        for name in names:
            inside = self.files.names(self.path_of(name))
            if inside == [name] or DONE in inside:  # the listing of a file is the file itself
                whole.append(name)
        return whole

    def waiting(self) -> list[str]:
        """Complete drops that no run has loaded, whatever their time stamp, so late ones are among them."""
        loaded = {name.removesuffix(".json") for name in self.files.names(self.loads)}
        return [drop for drop in self.complete_drops() if drop not in loaded]

    def rows_of(self, drops: Iterable[str]) -> int:
        landed = self.landed()
        return sum(landed[drop] for drop in drops)

    def mark_loaded(self, drops: Sequence[str], run: str) -> None:
        new = [drop for drop in drops if not self.files.exists(f"{self.loads}/{drop}.json")]
        text = [json.dumps({"drop": drop, "run": run}) for drop in new]
        at_once(self.files.write_text, [(f"{self.loads}/{drop}.json", line) for drop, line in zip(new, text)])
