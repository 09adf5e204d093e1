"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder if everything runs in one process, else an error, since executors would not see each other's files. The session's settings stay as they are."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local-cluster") or not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = f"file://{tempfile.mkdtemp(prefix='tamis-')}"
    return _own[app]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: made once, however often it is read, and still there if executors are lost."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
