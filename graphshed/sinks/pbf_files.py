"""Writing the binary graph format: length-prefixed blobs of delta-coded numbers, what ``sources.pbf`` reads.

Every task writes files of its own, a header and blocks of one element type of
at most BLOCK_ROWS elements, so nothing passes through the driver but names.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphshed.model import MEMBERS, TAGS, Store

#: Fixed value: elements that a block may have.
BLOCK_ROWS = 8000
KINDS = ("node", "way", "relation")


def varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def zigzag(value: int) -> int:
    return value << 1 if value >= 0 else (-value << 1) - 1


def number(field: int, value: int) -> bytes:
    return varint(field << 3) + varint(value)


def sized(field: int, data: bytes) -> bytes:
    return varint(field << 3 | 2) + varint(len(data)) + data


def deltas(values: list[int]) -> bytes:
    return b"".join(varint(zigzag(b - a)) for a, b in zip([0, *values], values))


def blob(kind: str, data: bytes) -> bytes:
    body = number(2, len(data)) + sized(3, zlib.compress(data))
    head = sized(1, kind.encode()) + number(3, len(body))
    return struct.pack(">I", len(head)) + head + body


class Strings(dict):
    """Texts of a block to their numbers; 0 is no text."""

    def __missing__(self, text: str) -> int:
        self[text] = found = len(self) + 1
        return found


def block(rows: list[dict]) -> bytes:
    """A block of elements of one type. Coordinates are in units of 100 nanodegrees, the format's own."""
    strings = Strings()
    kind = rows[0]["elem_type"]
    if kind == "node":
        dense = sized(1, deltas([r["id"] for r in rows])) + sized(8, deltas([r["lat_e7"] for r in rows])) + sized(9, deltas([r["lon_e7"] for r in rows]))
        group = sized(2, dense)
    elif kind == "way":
        group = b"".join(sized(3, number(1, r["id"]) + sized(8, deltas(r["nodes"]))) for r in rows)
    else:
        group = b""
        for r in rows:
            tags = r["tags"] or []
            members = r["members"] or []
            whole = number(1, r["id"]) + sized(2, b"".join(varint(strings[t["k"]]) for t in tags)) + sized(3, b"".join(varint(strings[t["v"]]) for t in tags))
            whole += sized(8, b"".join(varint(strings[m["role"]]) for m in members)) + sized(9, deltas([m["ref"] for m in members])) + sized(10, b"".join(varint(KINDS.index(m["type"])) for m in members))
            group += sized(4, whole)
    table = sized(1, b"") + b"".join(sized(1, s.encode()) for s in strings)
    return sized(1, table) + sized(2, group)


def write(store: Store, folder: str) -> DataFrame:
    """Writes a store below a folder; returns the list (file, elements). Files of tasks that ran twice aren't in it."""
    null = F.lit(None)
    empty = {"lat_e7": "bigint", "lon_e7": "bigint", "nodes": "array<bigint>", "members": MEMBERS, "tags": TAGS}
    parts = [table.select(F.lit(kind).alias("elem_type"), "id", *(F.col(c) if c in table.columns else null.cast(k).alias(c) for c, k in empty.items())) for kind, table in zip(KINDS, (store.nodes, store.ways, store.relations))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        path, n = f"{folder}/{uuid.uuid4().hex}.pbf", 0
        with open(f"{path}.part", "wb") as f:
            f.write(blob("OSMHeader", sized(4, b"OsmSchema-V0.6") + sized(4, b"DenseNodes")))
            for batch in batches:
                rows = batch.to_pylist()
                for at in range(0, len(rows), BLOCK_ROWS):
                    f.write(blob("OSMData", block(rows[at : at + BLOCK_ROWS])))
                n += len(rows)
        os.replace(f"{path}.part", path)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["file", "elements"])

    written = [p.sortWithinPartitions("id").mapInArrow(run, "file string, elements bigint") for p in parts]
    listed = f"{folder}-list"
    written[0].unionAll(written[1]).unionAll(written[2]).write.parquet(listed)
    return parts[0].sparkSession.read.parquet(listed)
