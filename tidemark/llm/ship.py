"""Sends this package to the executors, which need not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's modules to what each executor's Python can import; once for each Spark application.

    The archive is made in a folder of the driver's own; addPyFile() hands it to the executors over Spark's own channel.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), "tidemark_llm_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _SENT.add(context.applicationId)
