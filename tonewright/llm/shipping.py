"""Sends this package to the Python workers of a session that was started elsewhere."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the session once, so that executors can import it wherever they are."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="tonewright-")  # the driver's; executors fetch the file from it
    shutil.copytree(
        package, f"{folder}/files/{package.name}", ignore=shutil.ignore_patterns("__pycache__")
    )
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", f"{folder}/files"))
    _SENT.add(context.applicationId)
