"""Sends this package to the Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import cohortlab

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """What `spark-submit --py-files` does, for a session that was made without it:
    workers import the operators' functions by name, wherever the driver found the
    package. Once per application; nothing to do where the package is in an archive already.
    """
    sc, folder = spark.sparkContext, Path(cohortlab.__file__).parent
    if sc.applicationId in _shipped or not folder.is_dir():
        return
    path = Path(tempfile.mkdtemp(prefix="cohortlab-")) / "cohortlab.zip"  # the driver serves it to the executors
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(folder.rglob("*.py")):
            archive.write(file, file.relative_to(folder.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)
