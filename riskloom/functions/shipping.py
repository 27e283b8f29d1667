"""The library on the executors, for the operators that run Python there."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this library once per application, so that tasks import it instead of unpickling it."""
    if spark.sparkContext.applicationId not in _shipped:
        root = Path(__file__).parents[1]
        folder = Path(tempfile.mkdtemp(prefix="riskloom-package-"))
        shutil.copytree(root, folder / "in" / root.name, ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(str(folder / root.name), "zip", folder / "in"))
        shutil.rmtree(folder / "in")
        _shipped.add(spark.sparkContext.applicationId)
