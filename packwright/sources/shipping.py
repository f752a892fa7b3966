"""Make the package importable in Python workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers of this application, once.

    Functions that run in Python workers are found there by module name, and a worker need
    not see the driver's folders.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    if package.parent.suffix != ".zip":
        folder = tempfile.mkdtemp(prefix="packwright-")
        archive = shutil.make_archive(f"{folder}/packwright", "zip", package.parent, package.name)
        context.addPyFile(archive)
    _shipped.add(context.applicationId)
