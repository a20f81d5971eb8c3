"""Publishing files: written under another name, given a time, renamed, then named in a state."""

from __future__ import annotations

import gzip
import io
import itertools
import os
import shutil
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from graphshed.sources.xml import dicts, document, head, member_head, render, root


def write_document(rows: Iterator[dict], path: str, change: bool, modified: float | None = None) -> None:
    """One XML file, packed if its name ends in .gz, visible only when whole."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    part = f"{path}.part"
    with gzip.open(part, "wt", encoding="utf-8") if path.endswith(".gz") else open(part, "w", encoding="utf-8") as f:
        for line in document(rows, change):
            f.write(line + "\n")
    if modified is not None:
        os.utime(part, (modified, modified))
    os.replace(part, path)


def write_xml(elements: DataFrame, path: str, change: bool = True, modified: float | None = None) -> None:
    """The elements in order of pos as one file."""
    write_xml_files(elements.withColumn("_file", F.lit(path)), {path: path}, "_file", change, modified)


#: Elements, and bytes of text, from which a task begins a new segment of a file.
SEGMENT_ROWS, SEGMENT_BYTES = 20_000, 4 << 20
#: How hard packed files are packed.
LEVEL = 4
_SEGMENTS = "key string, task int, part string, at long, size long, elements long, first string, last string"


class _Segment:
    """Elements that follow each other in a file, without the tags around them: as text or, of a packed file, as a gzip member without its header."""

    def __init__(self, out, packed: bool, first: str | None):
        self.out, self.at, self.first, self.elements, self.bytes, self.sum = out, out.tell(), first, 0, 0, 0
        self.packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15) if packed else None
        self.texts: list[str] = []

    def write(self, text: str) -> None:
        self.texts.append(text)
        if len(self.texts) >= 500:
            self.flush()

    def flush(self) -> None:
        data = "".join(self.texts).encode()
        self.texts = []
        self.bytes += len(data)
        if self.packer:
            self.sum = zlib.crc32(data, self.sum)
            data = self.packer.compress(data)
        self.out.write(data)

    def close(self) -> int:
        """The bytes written."""
        self.flush()
        if self.packer:
            self.out.write(self.packer.flush() + struct.pack("<II", self.sum, self.bytes & 0xFFFFFFFF))
        return self.out.tell() - self.at


def segments(rows: Iterator[dict], path: str, packed: bool, change: bool, most: int) -> Iterator[tuple]:
    """Writes the segments of elements in order; yields (offset, bytes, elements, first block, last block) of each, the blocks null where the one open before goes on."""
    block, now = None, None
    with open(path, "wb") as out:
        for e in rows:
            action = e["action"] if change else None
            if now is None or now.elements >= most or now.bytes >= SEGMENT_BYTES or (block is None and action is not None):
                if now:
                    yield now.at, now.close(), now.elements, now.first, block
                block = block if action is None else action
                now = _Segment(out, packed, block)
            elif action is not None and action != block:
                now.write(f"</{block}>\n<{action}>\n")
                block = action
            now.write(render(e) + "\n")
            now.elements += 1
        if now:
            yield now.at, now.close(), now.elements, now.first, block


def put_together(path: str, own: list, change: bool, modified: float | None) -> None:
    """A file of its segments, with the tags around them; visible only when whole."""
    packed, block, pos = path.endswith(".gz"), None, 0

    def tags(text: str) -> None:
        now = _Segment(body := io.BytesIO(), packed, None)
        now.write(text)
        size = now.close()
        out.write((member_head(size, pos, change, block) if packed else b"") + body.getvalue())

    with open(f"{path}.part", "wb") as out:
        tags(head(change) + "\n")
        for s in own:
            if s["first"] is not None and s["first"] != block:
                tags((f"</{block}>\n" if block else "") + f"<{s['first']}>\n")
                block = s["first"]
            if packed:
                out.write(member_head(s["size"], pos, change, block))
            with open(s["part"], "rb") as f:
                f.seek(s["at"])
                left = s["size"]
                while left:
                    data = f.read(min(left, 1 << 20))
                    out.write(data)
                    left -= len(data)
            pos, block = pos + s["elements"], block if s["last"] is None else s["last"]
        tags((f"</{block}>\n" if block else "") + f"</{root(change)}>\n")
    if modified is not None:
        os.utime(f"{path}.part", (modified, modified))
    os.replace(f"{path}.part", path)


def write_xml_files(elements: DataFrame, paths: dict[str, str], by: str, change: bool = True, modified: float | None = None) -> None:
    """The elements of each value of ``by`` in order of pos as one file, by the value's path; values without elements get a file without any.

    Tasks render ranges of pos, row by row as Spark hands them over in order,
    into files of their own; then one task for each file puts these together,
    which copies bytes only. The driver gets the list of segments. The folders
    must be mounted wherever tasks run.
    """
    spark, mine, most = elements.sparkSession, uuid.uuid4().hex, SEGMENT_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def rows() -> Iterator[dict]:
            for batch in batches:
                yield from dicts(batch)

        for key, own in itertools.groupby(rows(), lambda r: r[by]):
            folder = f"{paths[key]}.{mine}.parts"
            os.makedirs(folder, exist_ok=True)
            part = f"{folder}/{uuid.uuid4().hex}"
            found = [(key, task, part, *s) for s in segments(own, part, paths[key].endswith(".gz"), change, most)]
            yield pa.RecordBatch.from_pylist([dict(zip(names, s)) for s in found], schema=kind)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                put_together(paths[key], own, change, modified)
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.string())], ["key"])

    fields = StructType.fromDDL(_SEGMENTS)
    names, kind = fields.names, to_arrow_schema(fields)
    wanted = elements.where(F.col(by).isin(list(paths)))
    try:
        listed = wanted.repartitionByRange(by, "pos").sortWithinPartitions(by, "pos").mapInArrow(run, fields).collect()
        files: dict[str, list] = {}
        for s in sorted(listed, key=lambda s: (s.task, s.at)):
            files.setdefault(s.key, []).append(s)
        if files:
            spark.createDataFrame(list(files.items()), StructType.fromDDL(f"key string, own array<struct<{_SEGMENTS}>>")).repartition(len(files), "key").mapInArrow(finish, "key string").collect()
        for key in paths.keys() - files.keys():
            write_document(iter(()), paths[key], change, modified)
    finally:
        for path in paths.values():
            shutil.rmtree(f"{path}.{mine}.parts", ignore_errors=True)


def publish_state(folder: str, sequence: int, state_file: str, original: str | None = None) -> None:
    """Puts a sequence's state beside its file and lets ``state.txt`` name it; doing so again changes nothing."""
    target = os.path.join(folder, state_file)
    os.makedirs(os.path.dirname(target), exist_ok=True)
    if not os.path.exists(target):
        if original:
            shutil.copy2(original, f"{target}.part")
        else:
            with open(f"{target}.part", "w", encoding="utf-8") as f:
                f.write(f"sequenceNumber={sequence}\n")
        os.replace(f"{target}.part", target)
    link = os.path.join(folder, "state.txt")
    fresh = f"{link}.new"
    if os.path.lexists(fresh):
        os.remove(fresh)
    os.symlink(state_file, fresh)
    os.replace(fresh, link)


__all__ = ["publish_state", "render", "write_document", "write_xml", "write_xml_files"]
