"""WARC archives: one gzip member for each record, written and read as streams.

``write`` deduplicates equal payloads (the row with the smallest id is the
response, others revisit it) and writes archives under the shared folder
through pyarrow's filesystems; ``read`` opens them again and checks every
digest. The list of finished archives is written as a table, so archives left
by a lost or repeated task are never read.

Defined results: null payloads count as empty; null urls are written as
``about:blank``; rows with equal id and payload are all of one kind; rows
without id are revisits if an equal payload has an id; an empty table gives no
archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphshed.llm import bloom
from graphshed.llm.common import cut, each, fresh_dir

CHUNK = 1 << 16
#: Plain bytes after which a task begins another archive.
ARCHIVE_BYTES = 256 << 20

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = "record_id string, target string, record_type string, refers_to string, payload_bytes long, payload_digest string, digest_ok boolean, archive string, record long"
_RECORD_KINDS = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int64()]
_RECORD_NAMES = [x.split()[0] for x in RECORDS.split(", ")]


def bare_digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def identity(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(urn: str | None) -> str | None:
    """The id in a record's identity."""
    found = None if urn is None else urn.strip("<>").rpartition(":")[2]
    return None if found == "none" else found


def record(page_id, url: str | None, payload: bytes | None, size: int, sha1: bytes, refers_to: int | None = None) -> bytes:
    """A response or, without a payload, a revisit record in plain bytes. A revisit keeps the HTTP headers, with the length of the payload it leaves out."""
    digest, revisit = bare_digest(sha1), payload is None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {identity(page_id)}",
        f"WARC-Target-URI: {urllib.parse.quote(url or 'about:blank', safe=';/?:@&=+$,#%[]!*()~')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{bare_digest(hashlib.sha1(block).digest())}",
        *([f"WARC-Refers-To: {identity(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """Data as one gzip member."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damaged(ValueError):
    """An archive that breaks off or whose records don't frame."""


class Reader:
    """Records of an archive in order, one gzip member at a time.

    The plain bytes of a record are taken as they are inflated; never more than
    a header and a chunk or two are held.
    """

    def __init__(self, stream):
        self.stream, self.raw = stream, b""

    def __iter__(self) -> Iterator[tuple[dict[str, str], dict[str, str], int, bool]]:
        """(WARC headers, HTTP headers, payload bytes in the record, whether the digests hold)"""
        while self.raw or self._fill():
            yield self._record(_Member(self))

    def _fill(self) -> bool:
        self.raw = self.stream.read(CHUNK)
        return bool(self.raw)

    @staticmethod
    def _headers(lines: list[bytes]) -> dict[str, str]:
        pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
        return {name.strip().lower(): value.strip() for name, _, value in pairs}

    def _record(self, member: _Member):
        lines = member.until_blank()
        if not lines[0].startswith(b"WARC/"):
            raise Damaged("a member does not begin with a record")
        head = self._headers(lines[1:])
        left = int(head["content-length"])
        block, payload, n = hashlib.sha1(), hashlib.sha1(), 0
        http: dict[str, str] | None = None
        before = b""
        while left:
            part = member.some(left)
            left -= len(part)
            block.update(part)
            if http is None:
                before += part
                top, found, part = before.partition(b"\r\n\r\n")
                if not found:
                    continue
                http = self._headers(top.split(b"\r\n")[1:])
            payload.update(part)
            n += len(part)
        if member.some(5, exact=False) != b"\r\n\r\n" or member.some(1, exact=False):
            raise Damaged("a record does not end with its member")
        good = head.get("warc-block-digest") == f"sha1:{bare_digest(block.digest())}"
        if head["warc-type"] == "response":
            good = good and head.get("warc-payload-digest") == f"sha1:{bare_digest(payload.digest())}"
        return head, http or {}, n, good


class _Member:
    """Plain bytes of the gzip member that a reader has reached."""

    def __init__(self, reader: Reader):
        self.reader, self.inflate, self.plain = reader, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        """Inflates another chunk; False at the member's end."""
        while not self.inflate.eof:
            if not self.reader.raw and not self.reader._fill():
                raise Damaged("the archive breaks off")
            out = self.inflate.decompress(self.reader.raw, CHUNK)
            self.reader.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if out:
                self.plain += out
                return True
        return False

    def until_blank(self) -> list[bytes]:
        while b"\r\n\r\n" not in self.plain:
            if not self._more():
                raise Damaged("a header does not end")
        top, _, self.plain = self.plain.partition(b"\r\n\r\n")
        return top.split(b"\r\n")

    def some(self, most: int, exact: bool = True) -> bytes:
        """The next plain bytes, at most so many. With exact at least one; else all up to the count or the end."""
        while len(self.plain) < (1 if exact else most) and self._more():
            pass
        if exact and not self.plain:
            raise Damaged("a block is shorter than its content length")
        part, self.plain = self.plain[:most], self.plain[most:]
        return part


def counted(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(key, first, n): of every digest the smallest id and the number of rows, by an aggregation summed before the shuffle."""
    return cut(pages.where(F.octet_length("payload") >= least_bytes).groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")))


@dataclass
class Filters:
    """Of the digests that occur more than once; of the rows that are the first of theirs; of the digests that occur once and yet pass the first filter."""

    bits: int
    repeated: np.ndarray
    first: np.ndarray
    mistaken: np.ndarray | None = None

    @classmethod
    def of(cls, digests: DataFrame, several: DataFrame) -> Filters | None:
        """None if there are too many repeated digests."""
        bits = bloom.bits_for(several.count())
        if bits is None:
            return None
        firsts = several.select(F.struct("key", F.col("first").alias("page_id")).alias("row"))
        made = cls(bits, bloom.build(several, "key", bits), bloom.build(firsts, "row", bits))
        sent = digests.sparkSession.sparkContext.broadcast(made.repeated)

        def mistaken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(bloom.passing(sent.value, batch.column(1)))).select([0])

        once = digests.where("n = 1").select("key", bloom.probes("key", bits).alias("probes")).mapInArrow(mistaken, "key string")
        made.mistaken = bloom.build(once, "key", bits)
        return made


class Archives:
    """Writes records to archives in a folder; gives out an archive's name, records and bytes when it is finished."""

    def __init__(self, top: str, archive_bytes: int):
        from pyarrow import fs

        self.place, self.folder = fs.FileSystem.from_uri(top)
        self.place.create_dir(self.folder, recursive=True)
        self.archive_bytes, self.out = archive_bytes, None

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name, self.records, self.plain, self.size = f"{uuid.uuid4().hex}.warc.gz", 0, 0, 0
            self.out = self.place.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        packed = member(data)
        self.out.write(packed)
        self.records, self.plain, self.size = self.records + 1, self.plain + len(data), self.size + len(packed)

    def finished(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """The archive, if it is full or the last one."""
        if self.out is not None and (last or self.plain >= self.archive_bytes):
            self.out.close()
            self.out = None
            yield pa.RecordBatch.from_arrays([pa.array([self.name]), pa.array([self.records], pa.int64()), pa.array([self.size], pa.int64())], ["archive", "records", "bytes"])


LISTED = "archive string, records long, bytes long"


def write(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives and returns their list: (archive, records, bytes).

    Pages whose digest occurs once are written where they lie. Only those that
    a Bloom filter of the repeated digests lets through are joined with these,
    and of them only the rows that may be a first one carry their payload.
    """
    spark = pages.sparkSession
    top = fresh_dir(spark, "warc")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("key", F.sha2("payload", 256))
    digests = counted(slim, least_bytes)
    several = digests.where("n > 1").select("key", "first")
    filters = Filters.of(digests, several)
    sent = None if filters is None else spark.sparkContext.broadcast(filters)
    bits = bloom.LEAST_BITS if filters is None else filters.bits
    probed = slim.withColumn("row", F.struct("key", "page_id")).withColumns({"k": bloom.probes("key", bits), "r": bloom.probes("row", bits)}).drop("row")

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Archives of the pages whose digest is surely not repeated."""
        out = Archives(top, archive_bytes)
        for batch in batches:
            batch = batch.filter(pa.array(~bloom.passing(sent.value.repeated, batch.column(4))))
            for page_id, url, payload in zip(*(each(batch.column(i)) for i in range(3))):
                out.add(record(page_id, url, payload, len(payload), hashlib.sha1(payload).digest()))
                yield from out.finished()
        yield from out.finished(last=True)

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The other pages: what their records need, the payload only where it may be that of a response."""
        for batch in batches:
            batch = batch.filter(pa.array(bloom.passing(sent.value.repeated, batch.column(4))))
            may = (bloom.passing(sent.value.first, batch.column(5)) | bloom.passing(sent.value.mistaken, batch.column(4))).tolist()
            rows = [(page_id, url, key, len(payload), hashlib.sha1(payload).digest(), payload if first or len(payload) < least_bytes else None) for page_id, url, payload, key, first in zip(*(each(batch.column(i)) for i in range(4)), may)]
            if rows:
                _, url, key, size, sha1, payload = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(url, pa.string()), pa.array(key, pa.string()), pa.array(size, pa.int64()), pa.array(sha1, pa.binary()), pa.array(payload, pa.binary())],
                    ["page_id", "url", "key", "n", "sha1", "payload"],
                )

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Archives(top, archive_bytes)
        for batch in batches:
            for page_id, url, payload, size, sha1, first, revisit in zip(*(each(batch.column(i)) for i in range(7))):
                if payload is None and not revisit:
                    raise AssertionError("a response came without its payload")
                out.add(record(page_id, url, None if revisit else payload, size, sha1, first))
                yield from out.finished()
        yield from out.finished(last=True)

    kind = slim.schema["page_id"].dataType.simpleString()
    if sent is None:  # too many repeated digests for a filter: all pages are joined
        shared = slim.withColumns({"n": F.octet_length("payload").cast("long"), "sha1": F.unhex(F.sha1("payload"))})
    else:
        shared = probed.mapInArrow(others, f"page_id {kind}, url string, key string, n long, sha1 binary, payload binary")
    # The repartitioning gives the join an exchange of its own on this side, without which a hot digest can't be split.
    joined = shared.join(several.repartition("first"), "key", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    parts = joined.select("page_id", "url", "payload", "n", "sha1", F.when(revisit, F.col("first")).alias("first"), revisit.alias("revisit")).mapInArrow(decided, LISTED)
    if sent is not None:
        parts = parts.unionAll(probed.mapInArrow(alone, LISTED))
    listed = f"{top}-list"
    parts.write.parquet(listed)
    return spark.read.schema(LISTED).parquet(listed).withColumn("folder", F.lit(top))


def read(archives: DataFrame, tasks: int | None = None) -> DataFrame:
    """A row for each record of the listed archives (columns archive and folder), with its digests checked."""
    slim = archives.select("folder", "archive")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for folder, archive in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place, path = fs.FileSystem.from_uri(f"{folder.rstrip('/')}/{archive}")
                rows = []
                with place.open_input_stream(path, compression=None) as stream:
                    for i, (head, http, _, good) in enumerate(Reader(stream)):
                        kind = head["warc-type"]
                        rows.append((page_of(head["warc-record-id"]), head["warc-target-uri"], kind, page_of(head.get("warc-refers-to")), int(http["content-length"]), head["warc-payload-digest"].partition(":")[2], good, archive, i))
                        if len(rows) >= 4096:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return slim.repartition(tasks or max(1, archives.count())).mapInArrow(records, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _RECORD_KINDS)], _RECORD_NAMES)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records of the pages after writing and reading them; a broken digest raises."""
    found = read(write(pages, least_bytes))
    return found.select(
        F.col("record_id").cast("long").alias("page_id"),
        F.when(F.col("digest_ok"), F.col("payload_bytes")).otherwise(F.raise_error(F.concat(F.lit("broken digest in "), F.col("archive"))).cast("long")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )
