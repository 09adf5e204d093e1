"""Sends this package to the executors, so that Python functions of it run wherever the driver found it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 256
_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add a zip of the package to the session's Python files, once for each application. Arrow batches hold whole texts here and their size can be set for a session only, so a session that has not set BATCH gets BATCH_ROWS rows a batch."""
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tamis-code-"), "tamis_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("tamis", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(path)
    _sent.add(app)
