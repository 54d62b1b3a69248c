"""Sends this package to the executors, as ``--py-files`` would."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


@functools.cache
def _sent(application_id: str) -> None:
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    SparkSession.getActiveSession().sparkContext.addPyFile(str(archive))


def ship(spark: SparkSession) -> SparkSession:
    """The session, whose executors can import the package from now on."""
    _sent(spark.sparkContext.applicationId)
    return spark
