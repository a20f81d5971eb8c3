"""Document fingerprints: a Merkle tree over paragraphs and sections.

The leaves are paragraphs (lines), hashed whole; a section ends after a
paragraph whose hash says so, so an insertion moves no later section; the root
hashes the sections. Equal roots mean equal texts; unequal branches lead to
the paragraphs that differ.

A fingerprint is the tree, written as ``root:count:section;section...``: of
each section its hash and ``/paragraph`` for its paragraphs, which are their
hash followed by those of the runs of words they fall into; ``count`` is the
number of runs. The likeness of two texts and the paragraphs that differ are
read from their fingerprints without the texts, by descending into branches
that aren't in both. A fingerprint grows with its text.

Defined results: null text counts as empty, the empty text has a root and no
runs; two texts without words are alike (1), one of them and another are not
(0); texts of the same words in the same runs are alike (1), as equal ones are;
repeated rows, also of one id, are ordered by their text; rows without id come
last; the only row of a table is its own next one; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphshed.llm.common import each, partitions
from graphshed.llm.hashing import WordHashes, mix

#: One paragraph in so many ends a section, one word in so many a run; runs and sections are also cut at a length.
SECTION_EVERY, SECTION_MOST = 8, 64
RUN_EVERY, RUN_MOST = 4, 16
#: Bytes of a node's hash, of a run's.
NODE, RUN = 16, 5

_MULTIPLIER = 0x9E3779B97F4A7C15


def node(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=NODE).digest()


def tree(paragraphs: list[bytes]) -> tuple[bytes, list[bytes], list[list[bytes]]]:
    """(root, section hashes, paragraph hashes of each section)."""
    sections: list[list[bytes]] = [[]]
    for paragraph in paragraphs:
        leaf = node(b"\0", paragraph)
        sections[-1].append(leaf)
        if leaf[0] % SECTION_EVERY == 0 or len(sections[-1]) >= SECTION_MOST:
            sections.append([])
    if not sections[-1]:
        sections.pop()
    branches = [node(b"\1", *leaves) for leaves in sections]
    return node(b"\2", *branches), branches, sections


def differing(a: str, b: str) -> tuple[list[int], list[int]]:
    """Numbers of the paragraphs of either text that the other lacks."""
    make = Fingerprints()
    return changed(make.of(a), make.of(b))


def changed(a: str, b: str) -> tuple[list[int], list[int]]:
    """Numbers of the paragraphs of either fingerprint's text that the other lacks, found by descending only into branches the other lacks."""
    (root_a, _, rest_a), (root_b, _, rest_b) = a.split(":"), b.split(":")
    if root_a == root_b:
        return [], []
    sections_a, sections_b = ([_nodes(section) for section in rest.split(";")] for rest in (rest_a, rest_b))

    def missing(own, others):
        known, here = {branch for branch, *_ in others}, {branch for branch, *_ in own}
        there = {x for branch, *leaves in others if branch not in here for x in leaves}
        out, at = [], 0
        for branch, *leaves in own:
            if branch not in known:
                out += [at + i for i, x in enumerate(leaves) if x not in there]
            at += len(leaves)
        return out

    return missing(sections_a, sections_b), missing(sections_b, sections_a)


def _nodes(section: str) -> list[str]:
    """The hash of a written section and those of its paragraphs."""
    return [part[: 2 * NODE] for part in section.split("/")]


def _runs(sections: Iterable[str]) -> list[str]:
    """The hashes of the runs of written sections, in order."""
    return [part[i : i + 2 * RUN] for section in sections for part in section.split("/")[1:] for i in range(2 * NODE, len(part), 2 * RUN)]


class Fingerprints:
    """Makes fingerprints; keeps word hashes and powers between texts."""

    def __init__(self):
        self.words = WordHashes()
        self.powers = np.array([pow(_MULTIPLIER, i, 1 << 64) for i in range(RUN_MOST)], np.uint64)

    def runs(self, paragraphs: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """(hashes of the runs of words, number of runs up to the end of each paragraph); a run ends with a word whose hash says so, with its paragraph, or at RUN_MOST words, in texts of all lengths."""
        ends: list[int] = []
        words: list[bytes] = []
        for paragraph in paragraphs:
            words += paragraph.split()
            ends.append(len(words))
        if not words:
            return np.empty(0, np.uint64), [0] * len(ends)
        h = self.words.of(words)
        last = (h >> np.uint64(40)) % np.uint64(RUN_EVERY) == 0
        closing = np.array(ends[:-1], int)
        last[closing[closing > 0] - 1] = True
        last[-1] = True
        starts = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1))
        lengths = np.diff(np.concatenate((starts, [len(h)])))
        if lengths.max() > RUN_MOST:
            starts = np.concatenate([np.arange(s, s + n, RUN_MOST) for s, n in zip(starts, lengths)])
            lengths = np.diff(np.concatenate((starts, [len(h)])))
        places = np.arange(len(h)) - np.repeat(starts, lengths)
        sums = np.add.reduceat(mix(h) * self.powers[places], starts)
        return mix(sums), np.searchsorted(starts, ends).tolist()

    def of(self, text: str) -> str:
        paragraphs = text.encode().split(b"\n")
        root, branches, sections = tree(paragraphs)
        hashes, upto = self.runs(paragraphs)
        runs = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :RUN].tobytes().hex()
        cuts = [0, *(2 * RUN * n for n in upto)]
        written, at = [], 0
        for branch, leaves in zip(branches, sections):
            parts = [leaf.hex() + runs[cuts[i] : cuts[i + 1]] for i, leaf in enumerate(leaves, at)]
            written.append("/".join((branch.hex(), *parts)))
            at += len(leaves)
        return f"{root.hex()}:{len(hashes)}:{';'.join(written)}"


def likeness(a: str, b: str) -> float:
    """Share of runs of words in common, each counted as often as it occurs; sections of both are skipped. 1 only for equal roots or the same runs in order."""
    (root_a, count_a, rest_a), (root_b, count_b, rest_b) = a.split(":"), b.split(":")
    if root_a == root_b:
        return 1.0
    n_a, n_b = int(count_a), int(count_b)
    if not n_a or not n_b:
        return 1.0 if n_a == n_b else 0.0
    sections_a, sections_b = rest_a.split(";"), rest_b.split(";")
    mine, other = Counter(sections_a), Counter(sections_b)
    runs_a, runs_b = _runs((mine - other).elements()), _runs((other - mine).elements())
    common = n_a - len(runs_a) + (Counter(runs_a) & Counter(runs_b)).total()
    if common < max(n_a, n_b):
        return common / (n_a + n_b - common)
    return 1.0 if _runs(sections_a) == _runs(sections_b) else n_a / (n_a + 1)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the beginning of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def id_ranges(slim: DataFrame, count: int) -> tuple[np.ndarray, list[int], dict[int, int | None]]:
    """(bounds, blocks, first ids): ids that part the rows into about ``count`` blocks of about equal size, the blocks that have rows in order, and the largest id of each.

    Two aggregations over the ids alone; the driver gets a few numbers for each
    block, whose count is a parameter.
    """
    shares = [i / count for i in range(1, count)]
    found = slim.select(F.percentile_approx("id", shares, 100 * count).alias("ids")).first().ids if shares else []
    bounds = np.array(sorted(set(found or [])), np.int64)
    first = {r.block: r.first for r in slim.select("id", _block(bounds)("id").alias("block")).groupBy("block").agg(F.max("id").alias("first")).collect()}
    return bounds, sorted(first), first


def _block(bounds: np.ndarray):
    """Number of the block of an id: 0 has the largest ids, the last one the rows without id."""

    @F.pandas_udf("int")
    def block(ids: pd.Series) -> pd.Series:
        return pd.Series(_block_numbers(ids, bounds))

    return block


def _block_numbers(ids: pd.Series, bounds: np.ndarray) -> np.ndarray:
    out = np.full(len(ids), len(bounds) + 1, np.int32)
    known = ids.notna().to_numpy()
    out[known] = len(bounds) - np.searchsorted(bounds, ids[known].to_numpy(np.int64), "left")
    return out


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count: int | None = None) -> DataFrame:
    """(block, ahead, id, text), each block sorted by descending id and in one partition, followed by the row that comes next in the whole table (ahead = 1).

    Blocks are ranges of ids. The row that begins a block is dealt to the block
    before it as well, the first row of all to the last block; texts are
    shuffled once.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bounds, used, first = id_ranges(slim.select("id"), count or 8 * partitions(docs.sparkSession))
    before = {b: used[i - 1] for i, b in enumerate(used)}

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        rows = []
        for i, b in zip(ids, _block_numbers(ids, bounds)):
            rows.append([2 * int(b)])
            if (first[b] is None and pd.isna(i)) or i == first[b]:
                rows[-1].append(2 * before[b] + 1)
        return pd.Series(rows)

    dealt = slim.withColumn("place", F.explode(places("id"))).select((F.col("place") / 2).cast("int").alias("block"), (F.col("place") % 2).alias("ahead"), "id", "text")
    return dealt.repartition("block").sortWithinPartitions("block", "ahead", F.col("id").desc_nulls_last(), "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every document its fingerprint, that of its edited text (see ``edited``), how alike they and the next document's are, and the numbers of the paragraphs that the edited text has no longer, read from the two trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprints()
        held = None  # the row that waits for the next one: (id, text, fingerprint)
        for batch in batches:
            rows = []
            for ahead, key, text in zip(*(each(batch.column(i)) for i in (1, 2, 3))):
                if ahead and held is None:
                    continue
                own = make.of(text)
                if held is not None:
                    was, before, fingerprint = held
                    turned = edited(before, text)
                    other = make.of(turned)
                    rows.append((was, len(before), hashlib.sha256(turned.encode()).hexdigest(), fingerprint, other, likeness(fingerprint, other), likeness(fingerprint, own), changed(fingerprint, other)[0]))
                held = None if ahead else (key, text, own)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _RESULT_KINDS)], _RESULT_NAMES)

    return in_order(docs, id_col, text_col).mapInArrow(run, f"id long, {RESULT}").withColumnRenamed("id", id_col)


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, lost_paragraphs array<int>"
_RESULT_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.int32())]
_RESULT_NAMES = ["id", *(x.split()[0] for x in RESULT.split(", "))]
