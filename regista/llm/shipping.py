"""Makes this package importable in Python workers, however the session was started."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import regista

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hands the package to Spark's own file distribution once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(regista.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="regista-"), "regista_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("regista", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
