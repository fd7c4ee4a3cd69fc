"""Sending this package to Python workers that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package's source to the application's files, once."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="agorascope-")) / f"{package.name}-source.zip"
        with zipfile.ZipFile(target, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(target))
        _SHIPPED.add(context.applicationId)
    return spark
