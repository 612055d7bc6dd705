"""Lets Python workers import this package."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import lakelayers

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the application's Python files, once, as ``--py-files`` would do.

    The driver serves the archive to the executors; nothing else reads its temporary folder.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(lakelayers.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="lakelayers-")) / "lakelayers-code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
