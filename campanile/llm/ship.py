"""Give the executors' Python workers this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import campanile

#: Bytes of the blocks of rows that executors and their Python workers pass on, unless the session names others.
BLOCK_KEY, BLOCK_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once per Spark context."""
    context = spark.sparkContext
    if any(os.path.basename(f).startswith("campanile-") for f in context._python_includes):
        return
    root = os.path.dirname(os.path.abspath(campanile.__file__))
    handle, path = tempfile.mkstemp(prefix="campanile-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("campanile", os.path.relpath(full, root)))
    context.addPyFile(path)


def bound_blocks(spark: SparkSession) -> None:
    """Bound the blocks by bytes: one of 10,000 long texts, Spark's own bound, is held several times by an executor.

    This stays set in the session, as the blocks are cut when a query runs.
    """
    if spark.conf.get(BLOCK_KEY, None) is None:
        spark.conf.set(BLOCK_KEY, BLOCK_BYTES)
