"""The star schema as Parquet tables of the Spark catalog."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from dwellmart.fixed_values import NULLABLE_TABLE_COLUMNS, TABLES
from dwellmart.session import configure
from dwellmart.sources.files import Files, at_once

# A merge under way is written down in a hidden file of the table's folder, which readers skip.
MERGE_NOTE = "_merge-"
# Likewise what is known of each file: sums of its rows by key, see ``note_files``.
FILE_NOTES = "_notes"
_VARCHAR = re.compile(r"VARCHAR\(\d+\)")  # a length is checked on writing; readers know no such type


def _quoted(path: str) -> str:
    escaped = path.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


class Warehouse:
    """Six tables in one database.

    Every full load fills a folder of its own below ``root``. A manifest, one small file, names the folder
    of the load that is published; there is a new one for each load, and the newest counts. Readers of
    this class resolve it, so all six tables switch at once, and a load that fails changes nothing. The tables
    of the catalog, for readers of other tools, are pointed to the same folder afterwards.
    """

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark = spark
        self.database = database
        self.root = root.rstrip("/")
        self.version = 0  # moves on with every change, so remembered results can be told apart
        self._ranges: dict[str, tuple[int, list[tuple[str, int | None, int | None]]]] = {}
        self._staged: str | None = None  # the folder of a load that isn't published yet

    # -- catalog -----------------------------------------------------------------------------

    def name_of(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def bootstrap(self) -> None:
        """Create the database if absent; drop all tables; create them empty."""
        self.attach(self.new_folder())

    def prepare(self) -> None:
        """Create the database and the tables if absent, leaving those there are but for completing what
        was cut off: pointing the catalog to the published load, and merges."""
        published = self.published()
        folder = published or self.new_folder()
        self._point_catalog_to(folder)
        if published is None:
            self._publish(folder)
        for table in TABLES:
            self.complete_merges(table)

    def _create_database(self) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.database}` "
            f"LOCATION {_quoted(f'{self.root}/{self.database}')}"
        )

    def new_folder(self) -> str:
        return f"{self.root}/load-{uuid.uuid4().hex}"

    def attach(self, folder: str) -> None:
        """Publish the star stored in ``folder``, dropping earlier definitions."""
        self._create_database()
        for table in TABLES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name_of(table)}")
        self._point_catalog_to(folder)
        self._publish(folder)

    def stage(self) -> Warehouse:
        """An empty star in a new folder, under a database of its own, for a full load."""
        staged = Warehouse(self.spark, f"{self.database}_{uuid.uuid4().hex}", self.root)
        staged._staged = staged.new_folder()
        staged._point_catalog_to(staged._staged)
        return staged

    def publish(self, staged: Warehouse) -> None:
        """Take over the files of a staged star; its database goes, its files stay."""
        self._publish(staged.folder())
        self._point_catalog_to(staged.folder())
        staged.discard()

    def _point_catalog_to(self, folder: str) -> None:
        self._create_database()
        files = Files(self.spark)
        for table, columns in TABLES.items():
            files.make_folder(f"{folder}/{table}")
            name, location = self.name_of(table), _quoted(f"{folder}/{table}")
            if self.spark.catalog.tableExists(name):
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION {location}")
                self.spark.catalog.refreshTable(name)
            else:
                self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION {location}")

    def discard(self) -> None:
        """Forget the tables and the database. The tables are external, so no file is deleted."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")

    # -- manifests ---------------------------------------------------------------------------

    @property
    def _manifests(self) -> str:
        return f"{self.root}/manifests-{self.database}"

    def _published_loads(self) -> list[str]:
        """The manifests, oldest first."""
        return [name for name in Files(self.spark).names(self._manifests) if name.endswith(".json")]

    def _publish(self, folder: str) -> None:
        names = self._published_loads()
        number = int(names[-1].removesuffix(".json")) + 1 if names else 1
        Files(self.spark).write_text(f"{self._manifests}/{number:012}.json", json.dumps({"folder": folder}))
        self.version += 1

    def published(self) -> str | None:
        """The folder of the load that the newest manifest names."""
        names = self._published_loads()
        if not names:
            return None
        return json.loads(Files(self.spark).read_text(f"{self._manifests}/{names[-1]}"))["folder"]

    def folder(self) -> str:
        """The folder whose tables this object reads and writes."""
        found = self._staged or self.published()
        if found is None:
            raise FileNotFoundError(f"nothing is published below {self._manifests}")
        return found

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the loads of all but the newest ``keep`` manifests, and what loads that failed have left below
        the root; returns the folders deleted. No load may be running, nor may a reader still use one of
        those loads. Folders that a manifest of another database names stay."""
        if keep < 1:
            raise ValueError("the published load must be kept")
        files = Files(self.spark)
        old = self._published_loads()[:-keep]
        for name in old:
            files.delete(f"{self._manifests}/{name}")
        used = set()
        for folder in files.names(self.root):
            if folder.startswith("manifests-"):
                for name in files.names(f"{self.root}/{folder}"):
                    used.add(json.loads(files.read_text(f"{self.root}/{folder}/{name}"))["folder"].rsplit("/", 1)[-1])
        gone = [name for name in files.names(self.root) if name.startswith(("load-", "merge-")) and name not in used]
        at_once(files.delete, [(f"{self.root}/{name}",) for name in gone])
        return gone

    def location_of(self, table: str) -> str:
        return f"{self.folder()}/{table}"

    def rejects_folder(self) -> str:
        """Where a load puts the rows it sets aside unless told otherwise: beside the listing facts."""
        return f"{self.folder()}/rejected"

    # -- reading and writing -----------------------------------------------------------------

    def table(self, table: str) -> DataFrame:
        """A table of the load that is published now."""
        return self._stored(self.spark, self.folder(), table)

    @staticmethod
    def _stored(spark: SparkSession, folder: str, table: str) -> DataFrame:
        return spark.read.schema(_VARCHAR.sub("STRING", TABLES[table])).parquet(f"{folder}/{table}")

    def append(self, table: str, rows: DataFrame) -> None:
        """Append rows; text over the column's length fails the write."""
        ordered = rows.select(*self.table(table).columns)
        ordered.write.insertInto(self.name_of(table))
        self.version += 1

    def stored_files(self, table: str, names: Sequence[str]) -> DataFrame:
        """The rows of some files of a table; the others aren't opened."""
        folder = self.location_of(table)
        return self.spark.read.schema(self.table(table).schema).parquet(*[f"{folder}/{name}" for name in names])

    def note_files(self, table: str, keys: Sequence[str], sums: Sequence[Column]) -> None:
        """For every file that has no notes yet, sum its rows by each of some integer keys; the sums are
        named. One scan of the new files. Files never change, so notes stay true; those of a file that a
        merge has replaced are passed over."""
        folder = f"{self.location_of(table)}/{FILE_NOTES}"
        self.spark.catalog.refreshTable(self.name_of(table))
        noted = {row["file"] for row in self._notes(table).select("file").distinct().collect()}
        new = [name for name in self._file_names(table) if name not in noted]
        if new:
            rows = self.stored_files(table, new).withColumn("file", F.col("_metadata.file_name"))
            found = rows.groupingSets([[F.col("file"), F.col(key)] for key in keys], "file", *keys).agg(
                reduce(lambda rest, key: F.when(F.grouping(key) == 0, key).otherwise(rest), keys, F.lit(None)).alias("kind"),
                F.coalesce(*keys).alias("key"), *sums,
            )
            found.drop(*keys).coalesce(1).write.mode("append").parquet(folder)
        self.version += 1

    def _notes(self, table: str) -> DataFrame:
        folder = f"{self.location_of(table)}/{FILE_NOTES}"
        if not Files(self.spark).exists(folder):
            return self.spark.createDataFrame([], "file STRING, kind STRING, key INT")
        return self.spark.read.parquet(folder)

    def noted_sums(self, table: str, key: str) -> tuple[DataFrame, list[str]]:
        """The notes by one key of the files that are in the table now, and the files without any."""
        notes, names = self._notes(table), self._file_names(table)
        noted = {row["file"] for row in notes.select("file").distinct().collect()}
        here = self.spark.createDataFrame([(name,) for name in names], "file STRING")
        of_key = notes.where(F.col("kind") == key).join(F.broadcast(here), "file", "left_semi")
        return of_key, [name for name in names if name not in noted]

    def between(self, table: str, column: str, low: int, high: int) -> DataFrame:
        """The rows of a table with a column from low to high; files known to hold none aren't opened."""
        known = self._ranges.get(table)
        if known is None or known[0] != self.version:
            known = self._ranges[table] = (self.version, self._file_ranges(table, column))
        names = [name for name, least, most in known[1] if least is None or (least <= high and low <= most)]
        rows = self.table(table) if len(names) == len(known[1]) else self.stored_files(table, names) if names else self.table(table).limit(0)
        return rows.where(F.col(column).between(low, high))

    def _file_names(self, table: str) -> list[str]:
        return [path.rsplit("/", 1)[1] for path in self.table(table).inputFiles()]

    def _file_ranges(self, table: str, column: str) -> list[tuple[str, int | None, int | None]]:
        """Every file with the least and largest value of a key, None where it has no notes."""
        ends = self._notes(table).where(F.col("kind") == column).groupBy("file").agg(F.min("key"), F.max("key"))
        noted = {name: (low, high) for name, low, high in ends.collect()}
        return [(name, *noted.get(name, (None, None))) for name in self._file_names(table)]

    def replace_files(self, table: str, names: Sequence[str], rows: DataFrame) -> None:
        """Put rows, which may be read from these very files, in the place of some files of a table.

        The rows are written to a folder of their own, under the table's types and lengths. Then the
        files to come and to go are noted, the new ones are moved in, the old ones are deleted, and
        the note goes. Up to the note a failure changes nothing; from there on ``prepare`` completes
        what was cut off. Between moving and deleting, a reader can see old and new rows side by side.
        """
        merge = uuid.uuid4().hex
        folder, staged = self.location_of(table), f"{self.root}/merge-{merge}"
        passing = f"`{self.database}`.`merge_{merge}`"
        self.spark.sql(f"CREATE TABLE {passing} ({TABLES[table]}) USING parquet LOCATION {_quoted(staged)}")
        try:
            rows.select(*self.table(table).columns).write.insertInto(passing)
        finally:
            self.spark.sql(f"DROP TABLE {passing}")
        files = Files(self.spark)
        new = [name for name in files.names(staged) if not name.startswith(("_", "."))]
        note = {"staged": staged, "new": new, "old": list(names)}
        files.write_text(f"{folder}/{MERGE_NOTE}{merge}", json.dumps(note))
        self.complete_merges(table)
        self.version += 1

    def complete_merges(self, table: str) -> None:
        """Finish the merges noted in a table's folder, from wherever they were cut off."""
        files, folder = Files(self.spark), self.location_of(table)
        notes = [name for name in files.names(folder) if name.startswith(MERGE_NOTE) and "." not in name]
        for name in notes:
            note = json.loads(files.read_text(f"{folder}/{name}"))
            at_once(files.move, [(f"{note['staged']}/{new}", f"{folder}/{new}") for new in note["new"]])
            at_once(files.delete, [(f"{folder}/{old}",) for old in note["old"]])
            files.delete(note["staged"])
            files.delete(f"{folder}/{name}")
        if notes:
            self.spark.catalog.refreshTable(self.name_of(table))
            self.version += 1

    def from_footers(self, table: str, *aggregates: Column) -> Row | None:
        """Plain count, min and max of a table, answered from the Parquet footers.

        No column is read. Spark does this in its newer Parquet reader only, which a session of
        its own switches on. None for an empty table.
        """
        rows = self.table(table)
        if rows.isEmpty():
            return None
        footers = self.spark.newSession()
        footers.conf.set("spark.sql.sources.useV1SourceList", "")
        footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        stored = footers.read.schema(rows.schema).parquet(self.location_of(table))
        return stored.agg(*aggregates).first()

    def largest(self, table: str, column: str) -> int:
        """The largest id in use, 0 in an empty table."""
        found = self.from_footers(table, F.max(column))
        return found[0] if found else 0

    def null_count(self, table: str) -> int:
        """Nulls over all columns of a table that must not be null."""
        nullable = NULLABLE_TABLE_COLUMNS.get(table, [])
        needed = [column for column in self.table(table).columns if column not in nullable]
        found = self.from_footers(table, F.count("*"), *[F.count(column) for column in needed])
        return found[0] * len(needed) - sum(found[1:]) if found else 0

    def query(self, text: str, **parameters) -> DataFrame:
        """Ad-hoc SQL over the tables by their plain names; values go in as ``:name``.

        The names are views of a session of its own, all over one load, so they neither meet those of
        other threads nor change between two tables.
        """
        session, folder = configure(self.spark.newSession()), self.folder()
        for table in TABLES:
            self._stored(session, folder, table).createOrReplaceTempView(table)
        return session.sql(text, args=parameters or None)


def append_jdbc(rows: DataFrame, url: str, table: str, connections: int = 8, **options: str) -> None:
    """Append a frame to a table of an external database, over a bounded number of connections.

    The database's JDBC driver has to be on the class path.
    """
    writer = rows.write.format("jdbc").mode("append").options(**options)
    writer.options(url=url, dbtable=table, numPartitions=connections, batchsize=10_000).save()
