"""What several operators need: tables, the shared folder, partition counts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphshed.plans.lineage import cut, shared_folder

__all__ = ["BATCH_ROWS", "cut", "each", "fresh_dir", "partitions", "remove", "shared_folder", "small_batches", "table", "unused"]

#: Rows of an Arrow batch. Batches of whole texts lie outside the JVM's heap, twice or more for each task, so Spark's 10,000 rows are too many.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batch size to BATCH_ROWS, unless it is lower already."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named table with these columns only (all, if none are named)."""
    small_batches(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of working files, in whatever file system it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(columns: Iterable[str], name: str) -> str:
    """The name, with as many underscores before it as it needs to be none of the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def each(column: pa.Array, slice_rows: int = 64) -> Iterator:
    """A column's values as Python objects, a few rows at a time: a batch of long texts is never unpacked whole."""
    for begin in range(0, len(column), slice_rows):
        yield from column.slice(begin, slice_rows).to_pylist()
