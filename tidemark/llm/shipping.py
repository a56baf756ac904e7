"""The package's code on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parents[1]
_ARCHIVE = "tidemark-code.zip"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that their Python can import it."""
    context = spark.sparkContext
    if _ARCHIVE in context._python_includes:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), _ARCHIVE)
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, f"{_PACKAGE.name}/{file.relative_to(_PACKAGE)}")
    context.addPyFile(archive)
