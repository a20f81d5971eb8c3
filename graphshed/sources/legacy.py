"""Reading a store in the old layout of flat files, to import it.

``node.crd`` has eight bytes for every id: latitude and longitude, each with
the bias of the codecs, all zero where there is no node. ``way.idx`` has five
bytes for every id: where in ``way.data`` the way stands, zero where there is
none; there, two bytes with the number of nodes, then five for each.
``relation/AAA/BBB/CCC`` are JSON documents. Numbers are big endian. Partitions
are ranges of ids.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphshed.functions.codecs import BIAS
from graphshed.model import Store
from graphshed.sources import relation_json

#: Ids of a range that one task reads, and of a batch.
RANGE, BATCH = 4_000_000, 100_000
# File names and bytes of an entry.
NODE_CRD, WAY_IDX, WAY_DATA, RELATIONS = "node.crd", "way.idx", "way.data", "relation"
NODE_BYTES, POINTER_BYTES = 8, 5


def number(data: np.ndarray) -> np.ndarray:
    """Rows of bytes as numbers."""
    out = np.zeros(len(data), np.int64)
    for column in data.T:
        out = out << 8 | column
    return out


def _entries(path: str, first: int, last: int, width: int) -> np.ndarray:
    """The bytes of the entries of ids from first up to last, a row for each; what lies behind the file's end is zero."""
    with open(path, "rb") as f:
        f.seek(first * width)
        data = f.read((last - first) * width)
    return np.frombuffer(data[: len(data) // width * width], np.uint8).reshape(-1, width)


def _ranges(spark: SparkSession, path: str, width: int) -> DataFrame:
    """(first, last): ranges of the ids that a file has entries for, in partitions of their own."""
    ids = os.path.getsize(path) // width
    count = max(1, -(-ids // RANGE))
    first = F.col("id") * RANGE
    return spark.range(0, count, 1, count).select(first.alias("first"), F.least(first + RANGE, F.lit(ids)).alias("last"))


def nodes(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder}/{NODE_CRD}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            for at in range(row["first"], row["last"], BATCH):
                data = _entries(path, at, min(at + BATCH, row["last"]), NODE_BYTES)
                there = np.flatnonzero(data.any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(at + there), pa.array(number(data[there, :4]) - BIAS), pa.array(number(data[there, 4:]) - BIAS)], ["id", "lat_e7", "lon_e7"])

    return _ranges(spark, path, NODE_BYTES).mapInArrow(run, "id bigint, lat_e7 bigint, lon_e7 bigint")


def ways(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder}/{WAY_IDX}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = np.memmap(f"{folder}/{WAY_DATA}", np.uint8, "r") if os.path.getsize(f"{folder}/{WAY_DATA}") else np.empty(0, np.uint8)
        for row in (r for batch in batches for r in batch.to_pylist()):
            for at in range(row["first"], row["last"], BATCH):
                places = number(_entries(path, at, min(at + BATCH, row["last"]), POINTER_BYTES))
                there = np.flatnonzero(places)
                if not len(there):
                    continue
                begin = places[there]
                counts = number(np.stack((data[begin], data[begin + 1]), axis=1))
                ends = np.cumsum(counts)
                # Of all nodes of the batch the byte that each begins at.
                starts = np.repeat(begin + 2 - (ends - counts) * POINTER_BYTES, counts) + np.arange(ends[-1]) * POINTER_BYTES
                refs = number(np.stack([data[starts + k] for k in range(POINTER_BYTES)], axis=1))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(refs))
                yield pa.RecordBatch.from_arrays([pa.array(at + there), lists], ["id", "nodes"])

    return _ranges(spark, path, POINTER_BYTES).mapInArrow(run, "id bigint, nodes array<bigint>")


def relations(spark: SparkSession, folder: str) -> DataFrame:
    texts = spark.read.option("recursiveFileLookup", "true").text(f"{folder}/{RELATIONS}", wholetext=True)
    return texts.select(relation_json.decode(F.col("value")).alias("r")).select("r.id", "r.members", "r.tags")


def read(spark: SparkSession, folder: str) -> Store:
    """The store; its files must be mounted wherever tasks run."""
    folder = folder.removeprefix("file://").rstrip("/")
    return Store(nodes(spark, folder), ways(spark, folder), relations(spark, folder))
