"""The file operations that jobs need besides Spark's own reading and writing.

They go through the Hadoop file system of the path, so they work wherever Spark reads and writes.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

CALLS_AT_ONCE = 16


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._configuration = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        found = self._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self._configuration), found

    def exists(self, path: str) -> bool:
        system, found = self._open(path)
        return system.exists(found)

    def names(self, folder: str) -> list[str]:
        """Names of the files and folders in a folder, in order; none if it is absent."""
        system, found = self._open(folder)
        if not system.exists(found):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(found))

    def make_folder(self, path: str) -> None:
        """Create a folder that may be there already."""
        system, found = self._open(path)
        system.mkdirs(found)

    def delete(self, path: str) -> None:
        """Remove a file, or a folder with all that is in it; what is absent is no error."""
        system, found = self._open(path)
        system.delete(found, True)

    def move(self, path: str, to: str) -> None:
        """Rename a file. One that has been moved before is no error."""
        system, found = self._open(path)
        target = self._open(to)[1]
        if system.exists(found):
            if not system.rename(found, target):
                raise OSError(f"cannot move {path} to {to}")
        elif not system.exists(target):
            raise FileNotFoundError(path)

    def write_text(self, path: str, text: str) -> None:
        """Create a file that is either complete or absent: it gets its name after its content."""
        unfinished = f"{path}.unfinished"
        system, found = self._open(unfinished)
        out = system.create(found, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(unfinished, path)

    def read_text(self, path: str) -> str:
        system, found = self._open(path)
        stream = system.open(found)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def at_once(call, arguments: Iterable[tuple]) -> None:
    """The same call for every tuple of arguments, several at a time; the first error is raised."""
    with ThreadPoolExecutor(max_workers=CALLS_AT_ONCE) as pool:
        for _ in pool.map(lambda given: call(*given), list(arguments)):
            pass
