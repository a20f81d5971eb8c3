"""Bounded-space online best-fit packing of tokenised documents.

``tokenise`` cuts every document into pieces that fit a sequence, ``pack``
gives each piece a sequence and a place in it. Pieces arrive in an order fixed
by a hash, so a task that runs again gives the same places.

Defined results: null text counts as empty (its one piece is the end id);
repeated rows are packed once each; an empty table gives an empty table; other
columns of the input are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphshed.llm.common import each

#: Bits of a sequence id below the number of the partition that made it.
SEQUENCE_BITS = 36

#: Texts that a task remembers to number its repeated rows; beyond them numbers begin anew, which moves pieces between tasks only.
COPIES_MOST = 1_000_000

PIECES = "piece int, start long, length long, ids_crc32 long"


class BestFit:
    """A fixed number of open bins, listed by free space, with a bitset of the free spaces present.

    A piece goes to the open bin with the least sufficient space. Without one,
    a bin is opened; if too many are open, the fullest is closed first.
    """

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.present = 0  # bit f: some open bin has f free
        self.n_open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece; bins are numbered as they are opened."""
        fitting = self.present >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bins = self.by_free[free]
            found = bins.pop()
            if not bins:
                self.present ^= 1 << free
            self.n_open -= 1
        else:
            if self.n_open >= self.open_bins:
                self._close_fullest()
            free, found = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if not self.by_free[left]:
                self.present |= 1 << left
            self.by_free[left].append(found)
            self.n_open += 1
        return found, self.capacity - free

    def _close_fullest(self) -> None:
        free = (self.present & -self.present).bit_length() - 1
        bins = self.by_free[free]
        bins.pop()
        if not bins:
            self.present ^= 1 << free
        self.n_open -= 1


_encoders: dict[str, object] = {}


def byte_alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies write for bytes: printable ones stand for themselves, the others for code points from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str):
    """The byte-level BPE tokenizer of a tokenizers file, run by tiktoken, which gives the same ids several times faster; its special tokens are the file's added ones. One for each worker process."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that depend on what is around them aren't supported")
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        _encoders[path] = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[path]


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


class Copies(dict):
    """Numbers the rows of one id and text that a task meets: 0, 1, and so on, whatever the order of its rows."""

    def number(self, key, text: str) -> int:
        at = xxhash.xxh3_64_intdigest(f"{key}\0{text}".encode("utf-8", "replace"))
        if len(self) >= COPIES_MOST and at not in self:
            self.clear()
        found = self[at] = self.get(at, -1) + 1
        return found


def tokenise(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, added_tokens: bool = False, copies: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids][, _copy]) of every piece of every document. With ``added_tokens`` the file's added tokens have their own ids in texts, as in the tokenizers library by default; else they are ordinary text. With ``copies`` repeated rows are numbered, so that ``pack`` can deal them out."""
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer)
        encode = partial(made.encode, allowed_special="all", disallowed_special=()) if added_tokens else made.encode_ordinary
        met = Copies()
        for batch in batches:
            rows: list[tuple] = []
            origin: list[int] = []
            kept: list[np.ndarray] = []
            numbers = []
            keys = batch.column(0).to_pylist()
            for i, text in enumerate(each(batch.column(1))):
                numbers.append(met.number(keys[i], text) if copies else 0)
                ids = np.array([*encode(text), end_id], "<u4")
                for k, (start, length) in enumerate(cut_points(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows.append((k, start, length, zlib.crc32(part.tobytes())))
                    origin.append(i)
                    if with_ids:
                        kept.append(part)
            columns = [np.array(c) for c in zip(*rows)] if rows else [np.array([], int)] * 4
            arrays = [batch.column(0).take(pa.array(origin, pa.int32())), pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([k.astype("<i4") for k in kept], pa.list_(pa.int32())))
                names.append("ids")
            if copies:
                arrays.append(pa.array(numbers, pa.int32()).take(pa.array(origin, pa.int32())))
                names.append("_copy")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return slim.mapInArrow(pieces, f"id {id_type}, {PIECES}" + ", ids array<int>" * with_ids + ", _copy int" * copies).withColumnRenamed("id", id_col)


def pack(pieces: DataFrame, capacity: int = 1024, open_bins: int = 2048, id_col: str = "doc_id") -> DataFrame:
    """The pieces with sequence_id and offset.

    Each partition packs its share by itself; partitions are dealt by a hash of
    the piece (with the number of a repeated row, where ``_copy`` has it) and
    read in the order of that hash. Memory: the open bins.
    """
    copy = F.col("_copy") if "_copy" in pieces.columns else F.lit(0)
    order = F.xxhash64(F.col(id_col), F.col("piece"), F.col("ids_crc32"), copy, F.lit(17))
    dealt = pieces.withColumn("_order", order).repartition("_order").sortWithinPartitions("_order", id_col, "piece", "ids_crc32").drop("_order", "_copy")
    at = dealt.columns.index("length")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(capacity, open_bins)
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(at).to_pylist()]
            sequence = pa.array([base + b for b, _ in placed], pa.int64())
            offset = pa.array([o for _, o in placed], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sequence, offset], [*batch.schema.names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return dealt.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, open_bins: int = 2048, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """Tokenised, cut and packed documents, a row for each piece."""
    return pack(tokenise(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids, added_tokens, copies=True), capacity, open_bins, id_col)
