"""Reading snapshot and change XML, and writing it.

``read`` gives the elements of a file in document order, with the action of
the block around each. Entities are unescaped; unknown attributes, comments
and ``bounds`` are ignored, any other unknown element is an error. One task
parses one file as a stream; of packed files that ``sinks.files`` wrote, whose
members say where they begin, several tasks parse a run of members each.
"""

from __future__ import annotations

import gzip
import io
import os
import struct
import xml.parsers.expat
from collections.abc import Iterator
from xml.sax.saxutils import quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from graphshed.model import ELEMENT

#: Small, as an element's context is copied from the chunk.
CHUNK = 1 << 16
#: Parsed rows that are handed over together, at least.
ROWS = 1000
#: Fixed value: the name of a gzip member's extra field, which has the member's bytes, the elements before it and whether it is of a change file, then the block that is open where it begins.
MARK, EXTRA = b"GS", struct.Struct("<QQB")
#: Bytes of members that one task reads, about.
PIECE_BYTES = 2 << 20
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def e7(text: str | None) -> int:
    """Degrees in a text as an integer of 1e-7: rounded half away from zero, clamped; a missing one is 0."""
    value = float(text or 0) * 1e7
    rounded = int(abs(value) + 0.5) * (1 if value >= 0 else -1)
    return max(_INT_MIN, min(_INT_MAX, rounded))


class Parser:
    """Elements of one document, pushed by expat and pulled as finished rows."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.pos, self.action, self.open = 0, None, None
        self.fresh = False
        self.expat = xml.parsers.expat.ParserCreate()
        self.expat.buffer_text = True
        self.expat.StartElementHandler, self.expat.EndElementHandler = self._start, self._end
        # Told of text and comments: an element is fresh until something follows its start.
        self.expat.DefaultHandler = self._other

    def _other(self, data: str) -> None:
        self.fresh = False

    def feed(self, data: bytes, last: bool = False) -> list[tuple]:
        self.expat.Parse(data, last)
        rows, self.rows = self.rows, []
        return rows

    def _start(self, name: str, a: dict[str, str]) -> None:
        self.fresh = False
        if name == "nd":  # the most frequent one
            self.open["nodes"].append(int(a.get("ref", 0)))
        elif name in ("create", "modify", "delete"):
            self.action = name
        elif name in ("node", "way", "relation"):
            number = lambda k: int(a[k]) or None if a.get(k) else None
            self.open = {
                "pos": self.pos, "action": self.action, "elem_type": name, "id": int(a.get("id", 0)),
                "lat_e7": e7(a.get("lat")) if name == "node" else None, "lon_e7": e7(a.get("lon")) if name == "node" else None,
                "nodes": [] if name == "way" else None, "members": [] if name == "relation" else None, "tags": None if name == "node" else [],
                "version": number("version"), "timestamp": a.get("timestamp"), "uid": number("uid"), "user": a.get("user"), "changeset": number("changeset"), "bbox": None,
            }
            self.fresh = True
        elif name == "member":
            self.open["members"].append({"type": a.get("type", ""), "ref": int(a.get("ref", 0)), "role": a.get("role", "")})
        elif name == "tag":
            self.open["tags"] = (self.open["tags"] or []) + [{"k": a.get("k", ""), "v": a.get("v", "")}]
        elif name == "bbox":
            self.open["bbox"] = {side: e7(a.get(side)) for side in ("minlat", "maxlat", "minlon", "maxlon")}
        elif name not in ("osm", "osmChange", "bounds"):
            raise ValueError(f"unsupported element: {name}")

    def _end(self, name: str) -> None:
        if name in ("node", "way", "relation"):
            # A node closed in its own tag has null tags, one with an end tag an empty list.
            if name == "node" and self.open["tags"] is None and (not self.fresh or (self.expat.GetInputContext() or b"").startswith(b"</node")):
                self.open["tags"] = []
            self.rows.append(tuple(self.open.values()))
            self.open = None
            self.pos += 1


def elements(stream, pos: int = 0, before: str = "", after: str = "") -> Iterator[list[tuple]]:
    """Batches of rows of an open file, or of a part of one: elements before it, and what opens and closes it."""
    parser = Parser()
    parser.pos = pos
    parser.feed(before.encode())
    while data := stream.read(CHUNK):
        if rows := parser.feed(data):
            yield rows
    if rows := parser.feed(after.encode(), True):
        yield rows


def gathered(batches: Iterator[list[tuple]]) -> Iterator[list[tuple]]:
    """The same rows in batches of at least ROWS, but for the last."""
    held: list[tuple] = []
    for rows in batches:
        held += rows
        if len(held) >= ROWS:
            yield held
            held = []
    if held:
        yield held


def open_file(path: str):
    """A local or mounted file, unpacked if its name ends in .gz."""
    path = path.removeprefix("file://")
    return gzip.open(path, "rb") if path.endswith(".gz") else open(path, "rb")


class _File(InputPartition):
    """A file, or a run of its members."""

    def __init__(self, path: str, at: int = 0, size: int | None = None, pos: int = 0, before: str = "", after: str = ""):
        self.path, self.at, self.size, self.pos, self.before, self.after = path, at, size, pos, before, after

    def elements(self) -> Iterator[list[tuple]]:
        if self.size is None:
            with open_file(self.path) as f:
                yield from elements(f)
            return
        with open(self.path.removeprefix("file://"), "rb") as f:
            f.seek(self.at)
            data = f.read(self.size)
        yield from elements(gzip.GzipFile(fileobj=io.BytesIO(data)), self.pos, self.before, self.after)


def member_head(size: int, pos: int, change: bool, block: str | None) -> bytes:
    """The header of a gzip member of so many bytes after it."""
    own = (block or "").encode()
    n = EXTRA.size + len(own)
    extra = MARK + struct.pack("<H", n) + EXTRA.pack(12 + 4 + n + size, pos, change) + own
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra


def members(path: str) -> list[tuple[int, int, bool, str]]:
    """(offset, elements before, of a change file, open block) of a file's members; none if not all say so."""
    found, at = [], 0
    if not path.endswith(".gz") or not os.path.exists(path):
        return []
    end = os.path.getsize(path)
    with open(path, "rb") as f:
        while at < end:
            f.seek(at)
            head = f.read(256)
            if head[:4] != b"\x1f\x8b\x08\x04" or head[12:14] != MARK or len(head) < 16 + EXTRA.size:
                return []
            size, pos, change = EXTRA.unpack_from(head, 16)
            found.append((at, pos, bool(change), head[16 + EXTRA.size : 16 + int.from_bytes(head[14:16], "little")].decode()))
            at += max(size, 16)
    return found if at == end else []


def root(change: bool) -> str:
    return "osmChange" if change else "osm"


def pieces(path: str, size: int | None = None) -> list[_File]:
    """What tasks read of a file: runs of members of about that size, or the whole."""
    plain, least = path.removeprefix("file://"), PIECE_BYTES if size is None else size
    every = members(plain)
    begins = []
    for i, (at, *_) in enumerate(every):
        if not begins or at - every[begins[-1]][0] >= least:
            begins.append(i)
    if len(begins) < 2:
        return [_File(path)]
    out = []
    for a, b in zip(begins, [*begins[1:], None]):
        at, pos, change, block = every[a]
        before = f"<{root(change)}>" + (f"<{block}>" if block else "") if a else ""
        end, after = os.path.getsize(plain), ""
        if b is not None:
            end, _, _, block = every[b]
            after = (f"</{block}>" if block else "") + f"</{root(change)}>"
        out.append(_File(path, at, end - at, pos, before, after))
    return out


class ElementReader(DataSourceReader):
    def __init__(self, schema: StructType, paths: list[str]):
        self.schema, self.paths = schema, paths

    def partitions(self):
        return [piece for p in self.paths for piece in pieces(p)]

    def read(self, partition: _File):
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(self.schema)
        names = [f.strip().split(" ")[0] for f in _fields(ELEMENT)]
        for rows in gathered(partition.elements()):
            columns = dict(zip(names, zip(*rows)), file=[partition.path] * len(rows))
            yield pa.RecordBatch.from_arrays([pa.array(columns[x.name], x.type) for x in kind], schema=kind)


def _fields(ddl: str) -> list[str]:
    """Top-level fields of a schema text."""
    out, depth, now = [], 0, ""
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(now)
            now = ""
        else:
            now += c
    return [*out, now]


class ElementSource(DataSource):
    """Format ``graph_xml``: option ``paths``, one per line. Columns as model.ELEMENT, and ``file``."""

    @classmethod
    def name(cls) -> str:
        return "graph_xml"

    def schema(self) -> str:
        return f"{ELEMENT}, file string"

    def reader(self, schema: StructType) -> ElementReader:
        return ElementReader(schema, [p for p in self.options.get("paths", self.options.get("path", "")).split("\n") if p])


def read(spark: SparkSession, *paths: str) -> DataFrame:
    """The elements of snapshot or change files."""
    spark.dataSource.register(ElementSource)
    return spark.read.format("graph_xml").option("paths", "\n".join(paths)).load()


def parse(texts: DataFrame, text_col: str = "xml") -> DataFrame:
    """The elements of documents held in a text column: the other columns, then those of model.ELEMENT."""
    others = [c for c in texts.columns if c != text_col]
    names = [f.strip().split(" ")[0] for f in _fields(ELEMENT)]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields if f.name != text_col)
    schema = texts.sparkSession.createDataFrame([], f"{kept}, {ELEMENT}" if kept else ELEMENT).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = to_arrow_schema(schema)
        for batch in batches:
            rest = [batch.column(batch.schema.get_field_index(c)) for c in others]
            for i, text in enumerate(batch.column(batch.schema.get_field_index(text_col))):
                for rows in gathered(elements(io.BytesIO(text.as_py().encode()))) if text.as_py() else ():
                    own = [pa.repeat(c[i], len(rows)) for c in rest]
                    yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, kind.field(n).type) for n, c in zip(names, zip(*rows)))], schema=kind)

    return texts.mapInArrow(run, schema)


def _plain(column: pa.Array) -> list:
    """A column's values as Python objects; numbers and lists of numbers without a scalar for each."""
    kind, n = column.type, len(column)
    if column.null_count == n:
        return [None] * n
    if pa.types.is_integer(kind) and not column.null_count or pa.types.is_string(kind):
        return column.to_numpy(zero_copy_only=False).tolist()
    if pa.types.is_list(kind) and pa.types.is_integer(kind.value_type):
        at = column.offsets.to_numpy().tolist()
        values = column.values.slice(at[0], at[-1] - at[0])
        if not values.null_count:
            values = values.to_numpy().tolist()
            lists = [values[a - at[0] : b - at[0]] for a, b in zip(at, at[1:])]
            return lists if not column.null_count else [x if there else None for x, there in zip(lists, column.is_valid().to_pylist())]
    return column.to_pylist()


def dicts(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's rows, unpacked a few at a time."""
    names = batch.schema.names
    for at in range(0, batch.num_rows, ROWS):
        for row in zip(*map(_plain, batch.slice(at, ROWS).columns)):
            yield dict(zip(names, row))


def _quoted(name: str, value) -> str:
    if isinstance(value, int) or isinstance(value, str) and value.isalnum():
        return f' {name}="{value}"'
    return f" {name}={quoteattr(str(value), {chr(10): '&#10;', chr(13): '&#13;', chr(9): '&#9;'})}"


def degrees(value: int) -> str:
    """An integer of 1e-7 degrees as shortest decimal text, which reads back as the same integer."""
    sign, value = ("-", -value) if value < 0 else ("", value)
    whole, part = divmod(value, 10_000_000)
    return f"{sign}{whole}" + (f".{part:07d}".rstrip("0") if part else "")


def render(e: dict) -> str:
    """An element as XML: attributes id, version, timestamp, uid, user, changeset, lat and lon; then nd or member, tag and bbox."""
    kind = e["elem_type"]
    out = f"<{kind}" + _quoted("id", e["id"]) + "".join(_quoted(a, e[a]) for a in ("version", "timestamp", "uid", "user", "changeset") if e[a] is not None)
    if kind == "node":
        out += f' lat="{degrees(e["lat_e7"])}" lon="{degrees(e["lon_e7"])}"'
    inner = [f'<nd ref="{n}"/>' for n in e["nodes"] or []]
    inner += ["<member" + _quoted("type", m["type"]) + _quoted("ref", m["ref"]) + _quoted("role", m["role"]) + "/>" for m in e["members"] or []]
    inner += ["<tag" + _quoted("k", t["k"]) + _quoted("v", t["v"]) + "/>" for t in e["tags"] or []]
    if e["bbox"] is not None:
        inner.append("<bbox" + "".join(_quoted(s, degrees(e["bbox"][s])) for s in ("minlat", "minlon", "maxlat", "maxlon")) + "/>")
    if kind == "node" and not inner and e["tags"] is None:
        return out + "/>"
    return out + ">" + "".join(inner) + f"</{kind}>"


def render_rows(elements_df: DataFrame) -> DataFrame:
    """The elements with ``xml``, each as XML of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(map(render, dicts(batch)), pa.string())], [*batch.schema.names, "xml"])

    return elements_df.mapInArrow(run, StructType([*elements_df.schema.fields, StructField("xml", StringType())]))


def head(change: bool) -> str:
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<{root(change)} version="0.6">'


def document(rows: Iterator[dict], change: bool) -> Iterator[str]:
    """Lines of a document. A block is opened where the action differs from the last one; a null action opens none."""
    yield head(change)
    block = None
    for e in rows:
        if change and e["action"] is not None and e["action"] != block:
            if block:
                yield f"</{block}>"
            block = e["action"]
            yield f"<{block}>"
        yield render(e)
    if block:
        yield f"</{block}>"
    yield f"</{root(change)}>"


def render_documents(elements_df: DataFrame, by: list[str], change: bool = True) -> DataFrame:
    """(by..., xml): the rows of each key as one document, in order of pos. A key's rows make one file, so they go to one task."""
    schema = ", ".join(f"`{c}` {elements_df.schema[c].dataType.simpleString()}" for c in by) + ", xml string"

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = (r for batch in table.sort_by("pos").to_batches() for r in dicts(batch))
        return pa.table({c: pa.array([v.as_py()], v.type) for c, v in zip(by, key)} | {"xml": pa.array(["\n".join(document(rows, change)) + "\n"])})

    return elements_df.groupBy(*by).applyInArrow(run, schema)
