"""Makes this package importable in Python workers, wherever the session runs."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import ordermill

_shipped: set[str] = set()


def ready(spark: SparkSession) -> None:
    """Hands the package's source to the session's workers through Spark, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.abspath(ordermill.__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="ordermill-source-"), "ordermill.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "ordermill")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
