"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are normalised to words; every window of ``window`` consecutive words of
a benchmark item (a shorter item is one window) is a key of an automaton over
word numbers. A document is scanned once; each occurrence marks its words as
hit, and word positions lead back to code points of the original text.

The benchmark goes to the workers in groups of at most ``group_words`` words
(or one longer item), each broadcast apart: as many scans follow each other as
there are groups, so the driver holds one group at a time and no worker more
than one bounded automaton.

Defined results: null or wordless texts have no words and are clean; items
without words are never found; the windows of items without id are hit as any
others, but belong to no item that could be named or counted; items with one id count as one item;
repeated documents get equal rows; an empty benchmark leaves all clean; only
the named columns of the documents are read, the others are passed on if
``keep`` is set (one named like ``found_col`` is replaced).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphshed.llm.common import each, unused

#: Words stay, A-Z becomes lower case, all else that is ASCII becomes a space.
_WORDS = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

FOUND = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<struct<first:long,last:long>>"
_FOUND_NAMES = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


class Windows:
    """The windows of some items as an automaton over word numbers."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.numbers = _Numbers()
        self.keys: list[set[str]] = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for item, text in items:
            words = [self.numbers.add(w) for w in words_of(text)]
            width = min(window, len(words))
            for i in range(len(words) - width + 1 if words else 0):
                key = tuple(words[i : i + width])
                at = self.automaton.get(key, None)
                if at is None:
                    at = (len(self.keys), width)
                    self.keys.append(set())
                    self.automaton.add_word(key, at)
                if item is not None:
                    self.keys[at[0]].add(item)
        if self.keys:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(first word, last word, key) of all occurrences."""
        if not self.keys or not words:
            return []
        numbers = tuple(map(self.numbers.__getitem__, words))
        return [(end - width + 1, end, key) for end, (key, width) in self.automaton.iter(numbers)]


class _Numbers(dict):
    """Words of the benchmark to numbers from 1; any other word is 0."""

    def add(self, word: bytes) -> int:
        if word not in self:
            self[word] = len(self) + 1
        return self[word]

    def __missing__(self, word: bytes) -> int:
        return 0


_built: dict[str, Windows] = {}


def _windows(key: str, sent, window: int) -> Windows:
    """One automaton for each worker process and group; the last one only is kept."""
    key = f"{window} {key}"
    if key not in _built:
        _built.clear()
        _built[key] = Windows(sent.value if sent is not None else [], window)
    return _built[key]


def item_groups(benchmark: DataFrame, group_words: int, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[str | None, str]]]:
    """The items in groups of bounded size: (id as text, text), read from Spark row by row."""
    slim = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    group, total = [], 0
    for row in slim.toLocalIterator():
        n = len(words_of(row.text))
        if group and total + n > group_words:
            yield group
            group, total = [], 0
        group.append((row.id, row.text))
        total += n
    if group:
        yield group


def word_spans(text: str, ranges: list[tuple[int, int]]) -> list[dict]:
    """Code point ranges (end exclusive) of ranges of words."""
    data = text.encode()
    isword = np.frombuffer(data.translate(_WORDS), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], isword, [False]))))
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
    return [{"first": int(chars[edges[2 * a]]), "last": int(chars[edges[2 * b + 1]])} for a, b in ranges]


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching inclusive ranges as one, in order."""
    merged: list[list[int]] = []
    for a, b in sorted(ranges):
        if merged and a <= merged[-1][1] + 1:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    return [(a, b) for a, b in merged]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: float = 0.05, group_words: int = 200_000, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, found_col: str = "found") -> DataFrame:
    """For every document: words, hit words, items found, whether it is contaminated, and the spans.

    A document is contaminated if a word is hit and the hit words are at least
    the given share of its words. ``keep`` passes on all columns of the
    documents, with the results in one struct column.
    """
    source = docs.drop(found_col) if keep else docs.select(id_col, text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    text_at = source.columns.index(text_col)
    names_in = source.columns
    n_fields = len(names_in)
    per_mille = round(share * 1000)
    ranges_col, items_col = unused(names_in, "_ranges"), unused(names_in, "_items")
    context = docs.sparkSession.sparkContext
    # A broadcast value leaves the driver's Python; of the groups only the one being read is held.
    groups = [(hashlib.sha256(repr(items).encode()).hexdigest(), context.broadcast(items)) for items in item_groups(benchmark, group_words)] or [("none", None)]

    def scan(key: str, sent, first: bool, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = _windows(key, sent, window)
            for batch in batches:
                texts = batch.column(text_at)
                before = [None] * len(texts) if first else list(zip(batch.column(n_fields).to_pylist(), batch.column(n_fields + 1).to_pylist()))
                out = []
                for text, was in zip(each(texts), before):
                    words = words_of(text or "")
                    hits = windows.scan(words)
                    ranges = merge([(a, b) for a, b, _ in hits] + (list(zip(was[0][::2], was[0][1::2])) if was else []))
                    found = set(was[1] if was else ()).union(*(windows.keys[k] for k in {k for _, _, k in hits}))
                    out.append((ranges, found, text if ranges else None, len(words)))
                columns = list(batch.columns[:n_fields])
                if not last:
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([[x for r in ranges for x in r] for ranges, *_ in out], pa.list_(pa.int64())), pa.array([sorted(f) for _, f, *_ in out], pa.list_(pa.string()))], [*names_in, ranges_col, items_col])
                    continue
                rows = []
                for ranges, found, text, n in out:
                    n_hit = sum(b - a + 1 for a, b in ranges)
                    names = sorted(found)
                    rows.append((n, n_hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), n_hit > 0 and 1000 * n_hit >= per_mille * n, names, word_spans(text, ranges) if ranges else []))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))
                results = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)]
                if keep:
                    yield pa.RecordBatch.from_arrays([*columns, pa.StructArray.from_arrays(results, _FOUND_NAMES)], [*names_in, found_col])
                else:
                    yield pa.RecordBatch.from_arrays([columns[0], *results], [id_col, *_FOUND_NAMES])

        return run

    out = source
    for i, (key, sent) in enumerate(groups):
        last = i == len(groups) - 1
        if not last:
            schema = f"{fields}, `{ranges_col}` array<long>, `{items_col}` array<string>"
        elif keep:
            schema = f"{fields}, `{found_col}` struct<{FOUND.replace(' long', ':long').replace(' string', ':string').replace(' boolean', ':boolean').replace(' array', ':array')}>"
        else:
            schema = f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, {FOUND}"
        out = out.mapInArrow(scan(key, sent, i == 0, last), schema)
    return out
