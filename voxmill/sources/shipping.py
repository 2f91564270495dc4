"""Send this package to the Python workers, which need it for the HTML helper."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application: zip the package and add it to the job's Python files."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="voxmill-ship-")) / package.name
    archive = shutil.make_archive(
        str(target), "zip", root_dir=package.parent, base_dir=package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
