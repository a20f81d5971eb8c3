"""Cutting the lineage of iterative plans, and the folder that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; only where that is unset, in local mode as in tests, a new folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="graphshed-")
        spark.sparkContext.setCheckpointDir(found)
        return found
    return known.get()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses, as plain file operations take it."""
    top = shared_folder(spark)
    if "://" in top and not top.startswith("file://"):
        raise ValueError(f"plain files are needed, not {top}")
    return f"{top.removeprefix('file://').removeprefix('file:').rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from the checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
