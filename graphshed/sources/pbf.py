"""Reading the binary graph format: length-prefixed blobs of delta-coded numbers.

Kept are node coordinates, way node lists, and relation members and tags; the
rest of the file is skipped. Partitions are runs of blobs.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from graphshed.model import MEMBERS, TAGS

SCHEMA = f"elem_type string, id bigint, lat_e7 bigint, lon_e7 bigint, nodes array<bigint>, members {MEMBERS}, tags {TAGS}"
NAMES = ["elem_type", "id", "lat_e7", "lon_e7", "nodes", "members", "tags"]
#: Bytes of blobs that one partition reads, about.
PART_BYTES = 32 << 20


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message: numbers for varints, bytes for what has a length."""
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        if key & 7 == 0:
            value, at = varint(data, at)
        elif key & 7 == 2:
            n, at = varint(data, at)
            value, at = data[at : at + n], at + n
        else:
            n = {1: 8, 5: 4}[key & 7]
            value, at = data[at : at + n], at + n
        yield key >> 3, value


def packed(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        value, at = varint(data, at)
        out.append(value)
    return out


def signed(value: int) -> int:
    """Zigzag code."""
    return (value >> 1) ^ -(value & 1)


def plain(value: int) -> int:
    """A two's complement number of 64 bits."""
    return value - (1 << 64) if value >> 63 else value


def deltas(data: bytes) -> list[int]:
    out, now = [], 0
    for value in packed(data):
        now += signed(value)
        out.append(now)
    return out


def blobs(path: str) -> Iterator[tuple[str, int, int]]:
    """(kind, offset, size) of a file's blobs, from their headers alone."""
    end = os.path.getsize(path)
    with open(path, "rb") as f:
        at = 0
        while at < end:
            f.seek(at)
            n = struct.unpack(">I", f.read(4))[0]
            head = dict(fields(f.read(n)))
            yield head[1].decode(), at + 4 + n, head[3]
            at += 4 + n + head[3]


def unpack(blob: bytes) -> bytes:
    found = dict(fields(blob))
    if 1 in found:
        return found[1]
    if 3 in found:
        return zlib.decompress(found[3])
    raise ValueError("unsupported blob compression")


def block(data: bytes) -> Iterator[tuple]:
    """Rows of SCHEMA of a block."""
    strings, groups, granularity, lat0, lon0 = [], [], 100, 0, 0
    for number, value in fields(data):
        if number == 1:
            strings = [s.decode() for k, s in fields(value) if k == 1]
        elif number == 2:
            groups.append(value)
        elif number == 17:
            granularity = value
        elif number == 19:
            lat0 = plain(value)
        elif number == 20:
            lon0 = plain(value)

    def e7(offset: int, value: int) -> int:
        nano = offset + granularity * value
        return nano // 100 if nano >= 0 else -(-nano // 100)

    for group in groups:
        for number, value in fields(group):
            if number == 1:
                node = dict(fields(value))
                yield "node", signed(node[1]), e7(lat0, signed(node[8])), e7(lon0, signed(node[9])), None, None, None
            elif number == 2:
                dense = dict(fields(value))
                for i, lat, lon in zip(deltas(dense[1]), deltas(dense[8]), deltas(dense[9])):
                    yield "node", i, e7(lat0, lat), e7(lon0, lon), None, None, None
            elif number == 3:
                way = dict(fields(value))
                yield "way", plain(way[1]), None, None, deltas(way.get(8, b"")), None, None
            elif number == 4:
                rel = dict(fields(value))
                kinds = ("node", "way", "relation")
                members = [
                    {"type": kinds[t], "ref": ref, "role": strings[role]}
                    for role, ref, t in zip(packed(rel.get(8, b"")), deltas(rel.get(9, b"")), packed(rel.get(10, b"")))
                ]
                tags = [{"k": strings[k], "v": strings[v]} for k, v in zip(packed(rel.get(2, b"")), packed(rel.get(3, b"")))]
                yield "relation", plain(rel[1]), None, None, None, members, tags


class _Blobs(InputPartition):
    def __init__(self, path: str, places: list[tuple[int, int]]):
        self.path, self.places = path, places


class BlockReader(DataSourceReader):
    def __init__(self, paths: list[str], schema):
        self.paths, self.schema = paths, schema

    def partitions(self):
        parts: list[_Blobs] = []
        for path in self.paths:
            total = PART_BYTES
            for kind, at, size in blobs(path):
                if kind != "OSMData":
                    continue
                if total >= PART_BYTES:
                    parts.append(_Blobs(path, []))
                    total = 0
                parts[-1].places.append((at, size))
                total += size
        return parts or [_Blobs(path, []) for path in self.paths[:1]]

    def read(self, partition: _Blobs):
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(self.schema)
        with open(partition.path, "rb") as f:
            for at, size in partition.places:
                f.seek(at)
                rows = list(block(unpack(f.read(size))))
                if rows:
                    columns = dict(zip(NAMES, zip(*rows)))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[x.name], x.type) for x in kind], schema=kind)


class BlockSource(DataSource):
    """Format ``graph_pbf``: option ``path``, one per line."""

    @classmethod
    def name(cls) -> str:
        return "graph_pbf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BlockReader:
        return BlockReader([p.removeprefix("file://") for p in self.options["path"].split("\n") if p], schema)


def read(spark: SparkSession, *paths: str) -> DataFrame:
    """The elements of binary files."""
    spark.dataSource.register(BlockSource)
    return spark.read.format("graph_pbf").option("path", "\n".join(paths)).load()
