"""N-gram Jaccard join of whole texts, exact, by set-relation skipping.

A document's set are its distinct runs of ``words`` words, as 64-bit hashes.
Documents of equal sets are one class. Classes are indexed by the prefixes of
their sets: two sets that link share a token there. Lists of the same classes
become one, in which a class has its first position of all of them: the first
token that two linked sets share is in one of these lists, so nothing is lost,
and a class's sketch travels once for each of its neighbourhoods and not for
each token. An index list is ordered
by set size and the token's position, and entries equal in both are a block:
blocks whose sizes or positions rule a link out are skipped whole. Of what is
left a parity sketch (its distance never exceeds the sets' difference, so
nothing that links is lost) makes a set's list of possible answers. The list
of a set that is highly similar to one already gone through is derived from
that one's: only what is near the similar set, by their distance more, can be
near this one.

Of the possible answers in a list only a spanning forest of the nearest is
verified, on the sets themselves, as components are asked for and not links:
once verified links connect two sets, no pair between the two sides is looked
at again. Lists in which a pair failed are gone through again with what is
known, until no list has a pair left to try. So components are those of all
links, and work follows the number of sets, not of pairs. Results are exact up
to collisions of 64-bit hashes of shingles and of sets.

Defined results: texts without words, null or empty, have the empty set and
stay alone; fewer words than a run make one run of the whole sequence;
repeated rows and equal texts share a component; rows without id take part and
get the component's smallest id, if there is one; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphshed.llm import bloom, components
from graphshed.llm.common import cut, each, fresh_dir, remove, unused
from graphshed.llm.hashing import LOWER, WordHashes, mix, shingles

#: Buckets in which shingles are counted, to put frequent ones last in every set, and the count from which a task reports its own for sure.
COUNTERS, REPORTED = 1 << 22, 64
#: Tokens counted at least so often have their entries dealt to SALTS tasks before they are sorted.
HOT_COUNT, SALTS = 100_000, 64
#: Bits of a parity sketch: a power of two, at least CELLS for each token that linked sets may differ in, within limits.
CELLS, SKETCH_LEAST, SKETCH_MOST = 8, 256, 8192
#: Lists of up to so many entries, at least, become one with lists of the same classes.
NAMED_MOST = 20_000
#: Lists longer than this are dealt to several tasks, in pairs of parts.
LIST_MOST = 3000
#: Lists up to this length are compared as a square.
SMALL_LIST = 48
#: Possible answers from which a set's list serves those similar to it.
SERVED = 8
#: Sizes of index bands, each this many times as large as the last at most (a power of the least size ratio).
BAND_STEPS = 4
#: Pairs for each set of a list that are tried at once after the first round.
TRIES = 6


@dataclass(frozen=True)
class Measure:
    """Runs of so many words; sets link when 100 * intersection >= percent * union."""

    words: int = 3
    percent: int = 90

    def least_partner(self, n):
        return -(-self.percent * n // 100)

    def prefix(self, n: int) -> int:
        """Tokens of a set of n that go into the index; none if only an equal set can link."""
        if self.difference(n + 100 * n // self.percent) < 1:
            return 0
        return n - self.least_partner(n) + 1

    def difference(self, both):
        """Largest symmetric difference of linked sets whose sizes add up to ``both``."""
        return both * (100 - self.percent) // (100 + self.percent)

    def overlap(self, both):
        """Smallest intersection of such sets."""
        return -(-both * self.percent // (100 + self.percent))

    def links(self, both: int, n: int, m: int) -> bool:
        return 100 * both >= self.percent * (n + m - both) and both > 0


class Sets:
    """Texts to sorted distinct shingle hashes; keeps word hashes between texts."""

    def __init__(self, measure: Measure):
        self.measure, self.hashes = measure, WordHashes()

    def of(self, text: str | bytes) -> np.ndarray:
        data = text.encode() if isinstance(text, str) else text
        return np.unique(shingles(self.hashes.of(data.translate(LOWER).split()), self.measure.words))


def class_of(tokens: np.ndarray) -> int:
    """The number of a set, signed as in a long column."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes(), 5)).astype(np.int64))


def sketch_of(tokens: np.ndarray, measure: Measure) -> bytes:
    """Parities of the set's tokens in cells, about as many as the difference of linked sets needs."""
    wanted = CELLS * measure.difference(2 * len(tokens))
    bits = min(SKETCH_MOST, max(SKETCH_LEAST, 1 << (wanted - 1).bit_length()))
    cells = np.bincount((tokens >> np.uint64(20)) % np.uint64(bits), minlength=bits) & 1
    return np.packbits(cells.astype(np.uint8)).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the shortest one's length: a parity of fewer cells is that of the cells that fall together."""
    width = min(map(len, sketches))
    if len(set(map(len, sketches))) == 1:
        return np.frombuffer(b"".join(sketches), np.uint64).reshape(-1, width // 8)
    rows = np.empty((len(sketches), width // 8), np.uint64)
    for i, sketch in enumerate(sketches):
        rows[i] = np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, width // 8), axis=0)
    return rows


def frequencies(slim: DataFrame, measure: Measure) -> tuple[np.ndarray, np.ndarray]:
    """For each counter a level (0 for all but the frequent, growing with the logarithm of the count) and whether it is hot.

    Every row is counted. A task rounds counts below REPORTED up or down at
    random (by the counter and its own number), so that sums are right on
    average and few are reported. Levels only order tokens: they change no
    result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, totals = Sets(measure), np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for text in each(batch.column(1)):
                # A set's tokens in one cell count once, which is one less now and then.
                totals[sets.of(text) % np.uint64(COUNTERS)] += 1
        cells = np.arange(COUNTERS, dtype=np.uint64)
        chance = mix(cells * np.uint64(0x9E3779B97F4A7C15) ^ mix(np.uint64([TaskContext.get().partitionId() + 1]))) >> np.uint64(58)
        totals = np.where((totals < REPORTED) & (chance < totals), REPORTED, np.where(totals < REPORTED, 0, totals))
        seen = np.flatnonzero(totals)
        for at in range(0, len(seen), 1 << 16):
            part = seen[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(totals[part].astype(np.int64))], ["cell", "n"])

    sums = cut(slim.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")))
    usual = max(float(REPORTED), (sums.agg(F.sum("n")).first()[0] or 0) / COUNTERS)
    # Below that the level is 0.
    frequent = sums.where((F.col("n") >= 2 * usual) | (F.col("n") >= HOT_COUNT)).toArrow()
    totals = np.zeros(COUNTERS)
    totals[frequent["cell"].to_numpy()] = frequent["n"].to_numpy()
    return np.floor(np.log2(totals / usual / 2 + 1)).clip(0, 60).astype(np.uint8), totals >= HOT_COUNT


INDEX = "id {kind}, n long, class long, prefix array<long>, sketch binary"


def index(slim: DataFrame, measure: Measure, levels: np.ndarray) -> DataFrame:
    """(id, n, class, prefix, sketch) of every row of (id, text); class, prefix and sketch are null for the empty set."""
    sent = slim.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, level = Sets(measure), sent.value
        for batch in batches:
            rows = []
            for text in each(batch.column(1)):
                tokens = sets.of(text)
                n = len(tokens)
                if not n:
                    rows.append((0, None, None, None))
                    continue
                p = measure.prefix(n)
                prefix = None
                if p:
                    own = level[tokens % np.uint64(COUNTERS)]
                    # A bijection of the token, so that the order within a level isn't that of the counters.
                    order = np.lexsort((tokens * np.uint64(0x9E3779B97F4A7C15), own))[:p]
                    prefix = tokens[order].view(np.int64)
                rows.append((n, class_of(tokens), prefix, sketch_of(tokens, measure) if p else None))
            n, number, prefix, sketch = zip(*rows) if rows else ([],) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(number, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                ["id", "n", "class", "prefix", "sketch"],
            )

    return slim.mapInArrow(run, INDEX.format(kind=slim.schema["id"].dataType.simpleString()))


POSTINGS = "token long, n int, class long, pos int"
_POSTING_NAMES = ["token", "n", "class", "pos"]


def postings(indexed: DataFrame, hot: np.ndarray) -> DataFrame:
    """The prefixes as index entries, with the salt that deals out hot tokens (0 for all others). Of the rows of a class only the first that a task meets is given out."""
    sent = indexed.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            parts = []
            for n, number, prefix in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if number in seen:
                    continue
                if len(seen) > 2_000_000:
                    seen.clear()
                seen.add(number)
                tokens = prefix.values.to_numpy()
                salt = np.where(sent.value[tokens.view(np.uint64) % np.uint64(COUNTERS)], 1 + number % SALTS, 0).astype(np.int32)
                parts.append((tokens, np.full(len(tokens), n, np.int32), np.full(len(tokens), number, np.int64), np.arange(len(tokens), dtype=np.int32), salt))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], [*_POSTING_NAMES, "salt"])

    return indexed.where("prefix is not null").select("n", "class", "prefix").mapInArrow(run, POSTINGS + ", salt int")


def named(token: np.ndarray, number: np.ndarray) -> np.ndarray:
    """For each entry of whole lists, sorted by token, a name of its list that depends on the list's classes only. If two lists get one name by chance, they are gone through as one."""
    begin = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    sums = np.add.reduceat(mix(number.view(np.uint64)), begin)
    return np.repeat(mix(sums).view(np.int64), np.diff(np.append(begin, len(token))))


def shared(entries: DataFrame, measure: Measure) -> DataFrame:
    """The distinct entries with another class of a fitting size in their list, and all distinct ones of hot tokens; lists of the same classes are one, with the first positions.

    Entries come sorted by token, size and class; only neighbours are compared,
    so a list of any length passes through, those beyond NAMED_MOST and those
    of hot tokens, which are in SALTS tasks, under their token.
    """
    most = NAMED_MOST

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        rest = None  # the last distinct entry, not yet given out, and whether it fits the one before
        for batch in batches:
            token, n, number, pos, salt = (batch.column(i).to_numpy() for i in range(5))
            fits_first = False
            if rest is not None:
                token, n, number, pos, salt = (np.concatenate(([r], x)) for r, x in zip(rest[0], (token, n, number, pos, salt)))
                fits_first = rest[1]
            fresh = np.concatenate(([True], (token[1:] != token[:-1]) | (number[1:] != number[:-1])))
            token, n, number, pos, salt = token[fresh], n[fresh], number[fresh], pos[fresh], salt[fresh]
            if not len(token):
                continue
            fits = (token[1:] == token[:-1]) & (measure.least_partner(n[1:].astype(np.int64)) <= n[:-1])
            before = np.concatenate(([fits_first], fits))
            keep = before[:-1] | fits | (salt[:-1] > 0)
            rest = ((token[-1], n[-1], number[-1], pos[-1], salt[-1]), bool(before[-1]))
            if keep.any():
                yield tuple(x[:-1][keep] for x in (token, n, number, pos, salt))
        if rest is not None and (rest[1] or rest[0][4] > 0):
            yield tuple(np.array([x]) for x in rest[0])

    def out(own, token, n, number, pos, salt) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.where(own, token, named(token, number)), n, number, pos)], _POSTING_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = long = None  # entries of the last token, whose list may go on, and the last token whose list was too long to be held
        for part in kept(batches):
            if held is not None:
                part = tuple(map(np.concatenate, zip(held, part)))
            token, n, number, pos, salt = part
            last = int(np.searchsorted(token, token[-1]))
            own = (salt > 0) | (token == long)
            if own[-1] or len(token) - last > most:
                own[last:], long, held, end = True, token[-1], None, len(token)
            else:
                held, end = tuple(x[last:] for x in part), last
            if end:
                yield out(own[:end], *(x[:end] for x in part))
        if held is not None:
            yield out(held[4] > 0, *held)

    found = entries.repartition("token", "salt").sortWithinPartitions("token", "n", "class").mapInArrow(run, POSTINGS)
    return found.groupBy("token", "class").agg(F.min("n").alias("n"), F.min("pos").alias("pos")).select(*_POSTING_NAMES)


def banded(entries: DataFrame, measure: Measure) -> DataFrame:
    """The entries with the band of their list part. A set near its band's upper end is in the next band too, so that every two sets of fitting sizes meet in a band."""
    width = BAND_STEPS * float(np.log(100 / measure.percent))
    band = F.floor(F.log(F.col("n").cast("double")) / width).cast("int")
    # A little further than the largest partner, against rounding.
    above = F.floor((F.log(F.col("n").cast("double")) + width / BAND_STEPS + 1e-9) / width).cast("int")
    return entries.withColumn("band", F.explode(F.array_distinct(F.array(band, above))))


def parted(lists: DataFrame) -> DataFrame:
    """The entries with part numbers: lists longer than LIST_MOST are cut into parts by class, and every two parts meet."""
    long = lists.groupBy("token", "band").count().where(F.col("count") > LIST_MOST)
    long = cut(long.select("token", "band", F.ceil(F.col("count") * 2 / LIST_MOST).cast("int").alias("parts")))
    if long.isEmpty():
        return lists.withColumns({"one": F.lit(0), "two": F.lit(0)})
    own = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(F.least(own, other).alias("one"), F.greatest(own, other).alias("two")))
    dealt = lists.join(long, ["token", "band"], "left")
    return dealt.withColumn("pair", F.explode(F.coalesce(pairs, F.array(F.struct(F.lit(0).alias("one"), F.lit(0).alias("two")))))).select(*lists.columns, "pair.one", "pair.two")


class List:
    """Entries of one list part, by size and position, in blocks of those equal in both."""

    def __init__(self, measure: Measure, n, number, pos, sketch, root=None, failed: dict[int, list[int]] | None = None):
        order = np.lexsort((number, pos, n))
        self.measure = measure
        self.n, self.number, self.pos, self.sketch = n[order].astype(np.int64), number[order], pos[order].astype(np.int64), sketch[order]
        self.root = self.number if root is None else root[order]
        self.failed = failed or {}
        m = len(order)
        # All distances at once where that is little.
        self.square = self._square() if m <= SMALL_LIST else None
        self.idle = self.square is not None and not (self.square >= 0).any()
        if self.square is not None:
            return
        self.edge = np.flatnonzero(np.concatenate(([True], (self.n[1:] != self.n[:-1]) | (self.pos[1:] != self.pos[:-1]), [True])))
        self.block = np.repeat(np.arange(len(self.edge) - 1), np.diff(self.edge))
        self.block_n, self.block_pos = self.n[self.edge[:-1]], self.pos[self.edge[:-1]]
        self.open: dict[int, np.ndarray] = {}
        self.served = np.full(m, -1)  # the entry whose list an entry's is derived from
        self.rows: dict[int, tuple[int, np.ndarray]] = {}  # of such entries the distances of a range of entries

    def _fitting(self, block: int) -> np.ndarray:
        """The entries that a block's may link with by size and position; other blocks are skipped whole."""
        found = self.open.get(block)
        if found is None:
            if len(self.open) >= 64:
                self.open.clear()
            n, pos = self.block_n[block], self.block_pos[block]
            a, b = np.searchsorted(self.block_n, (self.measure.least_partner(n), 100 * n // self.measure.percent + 1))
            other = self.block_n[a:b]
            fits = np.minimum(n - pos, other - self.block_pos[a:b]) >= self.measure.overlap(n + other)
            begin, end = self.edge[a:b][fits], self.edge[a + 1 : b + 1][fits]
            sizes = end - begin
            found = self.open[block] = np.repeat(begin - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum()) if len(sizes) else np.empty(0, np.int64)
        return found

    def _square(self) -> np.ndarray:
        """Sketch distances of all entries, -1 where linking is ruled out by sizes, positions, sketches or a common root."""
        n, m = self.n[:, None], self.n[None, :]
        both = n + m
        distance = np.bitwise_count(self.sketch[:, None] ^ self.sketch[None, :]).sum(axis=2, dtype=np.int64)
        left = np.minimum(n - self.pos[:, None], m - self.pos[None, :])
        sizes = (m >= self.measure.least_partner(n)) & (100 * n >= self.measure.percent * m)
        fits = sizes & (distance <= self.measure.difference(both)) & (left >= self.measure.overlap(both)) & (self.root[:, None] != self.root[None, :])
        return np.where(fits, distance, -1)

    def _distance(self, i: int, others) -> np.ndarray:
        return np.bitwise_count(self.sketch[i] ^ self.sketch[others]).sum(axis=1, dtype=np.int64)

    def _serve(self, i: int, distance: np.ndarray, at: np.ndarray) -> None:
        """Keeps what is needed to derive from entry i's list those of its possible answers."""
        radius = self.measure.difference(2 * self.n[i])
        a, b = np.searchsorted(self.n, (self.measure.least_partner(self.n[i] - radius), 100 * (self.n[i] + radius) // self.measure.percent + 1))
        self.rows[i] = (int(a), self._distance(i, slice(a, b)))
        similar = at[(distance <= radius) & (np.abs(self.n[at] - self.n[i]) <= radius)]
        self.served[similar[self.served[similar] < 0]] = i

    def near(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(entries, distances) of those that entry i may link with."""
        if self.square is not None:
            at = np.flatnonzero(self.square[i] >= 0)
            distance = self.square[i, at]
        else:
            at, by = self._fitting(self.block[i]), int(self.served[i])
            most = self.measure.difference(self.n[i] + self.n[at])
            if by >= 0:
                # By the triangle inequality; what is far from the similar set needs no look.
                first, known = self.rows[by]
                near = known[at - first] <= known[i - first] + most
                at, most = at[near], most[near]
            distance = self._distance(i, at)
            fits = distance <= most
            at, distance = at[fits], distance[fits]
            if by < 0 and i not in self.rows and len(at) >= SERVED:
                self._serve(i, distance, at)
            own = self.root[at] != self.root[i]
            at, distance = at[own], distance[own]
        failed = self.failed.get(int(self.number[i]))
        if failed:
            left = ~np.isin(self.number[at], failed)
            at, distance = at[left], distance[left]
        return at, distance

    def forest(self) -> tuple[list[tuple[int, int]], np.ndarray]:
        """(pairs, near): pairs of entries that span what may be connected, the nearest first (Prim's algorithm; entries of one root count as connected), and which entries have a near one at all."""
        m = len(self.n)
        pairs: list[tuple[int, int]] = []
        if self.idle:
            return pairs, np.zeros(m, bool)
        far = np.iinfo(np.int64).max
        best, parent = np.full(m, far), np.full(m, -1)
        done, has = np.zeros(m, bool), np.zeros(m, bool)
        same: dict[int, list[int]] = {}
        for i, root in enumerate(self.root.tolist()):
            same.setdefault(root, []).append(i)
        for start in range(m):
            if done[start]:
                continue
            todo = start
            while todo >= 0:
                if parent[todo] >= 0:
                    pairs.append((int(parent[todo]), int(todo)))
                own = same[int(self.root[todo])]
                done[own], best[own] = True, far
                for i in own:
                    at, distance = self.near(i)
                    if not len(at):
                        continue
                    has[i] = True
                    nearer = ~done[at] & (distance < best[at])
                    at = at[nearer]
                    best[at], parent[at] = distance[nearer], i
                todo = int(best.argmin())
                if best[todo] == far:
                    todo = -1
        return pairs, has

    def pairs(self, again: bool) -> np.ndarray:
        """Pairs of classes to verify, the smaller number first. After the first round also the TRIES nearest of each entry.

        In the first round every entry that has a near one is also given out
        with itself: whatever is tried later is among these.
        """
        found, has = self.forest()
        if not again:
            found += [(i, i) for i in np.flatnonzero(has).tolist()]
        elif found:
            for i in range(len(self.n)):
                at, distance = self.near(i)
                if len(at) > TRIES:
                    at = at[np.argsort(distance, kind="stable")[:TRIES]]
                found += [(i, int(k)) for k in at]
        if not found:
            return np.empty((0, 2), np.int64)
        return np.unique(np.sort(self.number[np.array(found)], axis=1), axis=0)


def two_may_link(measure: Measure, n: list[int], pos: list[int], sketch: list[bytes]) -> bool:
    """What a List says of two entries with sketches of one length."""
    both, left = n[0] + n[1], min(n[0] - pos[0], n[1] - pos[1])
    if 100 * min(n) < measure.percent * max(n) or left < measure.overlap(both):
        return False
    return (int.from_bytes(sketch[0]) ^ int.from_bytes(sketch[1])).bit_count() <= measure.difference(both)


PAIRS = "token long, band int, one int, two int, x long, y long"
_KEYS = ["token", "band", "one", "two"]


def candidates(lists: DataFrame, measure: Measure, failed: DataFrame | None = None) -> DataFrame:
    """Pairs to verify of every list part (columns of _KEYS, class, n, pos, sketch and, after the first round, root); ``failed`` has the pairs (_KEYS, x, y) that a part has tried in vain."""
    again = failed is not None
    columns = [*_KEYS, "n", "class", "pos", "sketch", *(["root"] if again else [])]
    rows = lists.select(*columns)
    if again:
        # A failed pair comes as a row without size.
        null = F.lit(None)
        rows = rows.unionAll(failed.select(*_KEYS, null.cast("int"), F.col("x"), null.cast("int"), null.cast("binary"), F.col("y")))

    def of_list(key, parts) -> pa.RecordBatch | None:
        columns = [np.concatenate([p[i] for p in parts]) for i in range(len(parts[0]))]
        entry = columns[0] >= 0
        if entry.sum() < 2:
            return None
        n, number, pos = (c[entry] for c in columns[:3])
        sketches = columns[3][entry].tolist()
        if not again and len(n) == 2 and len(sketches[0]) == len(sketches[1]) and not two_may_link(measure, n.tolist(), pos.tolist(), sketches):
            return None
        root = columns[4][entry] if again else None
        known: dict[int, list[int]] = {}
        if again:
            for x, y in zip(columns[1][~entry].tolist(), columns[4][~entry].tolist()):
                known.setdefault(x, []).append(y)
                known.setdefault(y, []).append(x)
        found = List(measure, n, number, pos, folded(sketches), root, known).pairs(again)
        if not len(found):
            return None
        return pa.RecordBatch.from_arrays([*(pa.array(np.full(len(found), k), t) for k, t in zip(key, (pa.int64(), pa.int32(), pa.int32(), pa.int32()))), pa.array(found[:, 0]), pa.array(found[:, 1])], [*_KEYS, "x", "y"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)])
            own = [batch.column(4).fill_null(-1).to_numpy(zero_copy_only=False), batch.column(5).to_numpy(), batch.column(6).fill_null(-1).to_numpy(zero_copy_only=False), np.array([*batch.column(7).to_pylist(), None], object)[:-1]]
            if again:
                own.append(batch.column(8).to_numpy())
            edges = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [batch.num_rows]))
            for a, b in zip(edges[:-1], edges[1:]):
                key = tuple(keys[:, a].tolist())
                if key != held:
                    if parts and (out := of_list(held, parts)) is not None:
                        yield out
                    held, parts = key, []
                parts.append([x[a:b] for x in own])
        if parts and (out := of_list(held, parts)) is not None:
            yield out

    return rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(run, PAIRS)


def texts_of(slim: DataFrame, wanted: DataFrame, measure: Measure) -> DataFrame:
    """(class, data): the packed text of one row of each wanted class (class, id).

    Rows are picked by a Bloom filter of the ids before their texts are looked
    at, or by a join, if there are too many for a filter; what is let through
    too many is dropped by the join with the classes.
    """
    bits = bloom.bits_for(wanted.count())
    if bits is None:
        words = None
        probed = slim.join(wanted.select(F.struct("id").alias("key")), F.struct("id") == F.col("key"), "left_semi").select("text", F.array().cast("array<long>").alias("probes"))
    else:
        words = slim.sparkSession.sparkContext.broadcast(bloom.build(wanted, "id", bits))
        probed = slim.select("text", bloom.probes("id", bits).alias("probes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, packer = Sets(measure), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column(0) if words is None else batch.column(0).filter(pa.array(bloom.passing(words.value, batch.column(1))))
            rows = [(class_of(tokens), packer.compress(t.encode())) for t in each(texts) if len(tokens := sets.of(t))]
            if rows:
                number, data = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(data, pa.binary())], ["class", "data"])

    found = probed.mapInArrow(run, "class long, data binary")
    return found.join(wanted.select("class"), "class", "left_semi").dropDuplicates(["class"])


#: Sets that a task keeps while it verifies pairs.
KEPT_SETS = 256


class Recent(dict):
    """The sets of the last classes whose texts were unpacked."""

    def __init__(self, measure: Measure):
        super().__init__()
        self.sets, self.unpacker = Sets(measure), zstandard.ZstdDecompressor()

    def of(self, number: int, data: pa.Scalar) -> np.ndarray:
        found = self.pop(number, None)
        if found is None:
            if len(self) >= KEPT_SETS:
                del self[next(iter(self))]
            found = self.sets.of(self.unpacker.decompress(data.as_py()))
        self[number] = found
        return found


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def verified(pairs: DataFrame, texts: DataFrame, measure: Measure) -> DataFrame:
    """(x, y, links) of pairs of classes, from their whole sets."""
    left, right = (texts.select(F.col("class").alias(c), F.col("data").alias(f"data_{c}")) for c in "xy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Recent(measure)
        for batch in batches:
            x, y = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            links = []
            for i, (one, two) in enumerate(zip(x, y)):
                a, b = sets.of(one, batch.column(2)[i]), sets.of(two, batch.column(3)[i])
                links.append(measure.links(common(a, b), len(a), len(b)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(links, pa.bool_())], ["x", "y", "links"])

    return pairs.join(left, "x").join(right, "y").select("x", "y", "data_x", "data_y").mapInArrow(run, "x long, y long, links boolean")


def _connected(indexed: DataFrame, slim: DataFrame, measure: Measure, hot: np.ndarray, folder: str) -> DataFrame:
    """(node, root) of all classes with a verified link. Leaves (id, n, class) of all rows in the folder, in place of the index."""
    spark = slim.sparkSession
    shared(postings(indexed, hot), measure).write.parquet(f"{folder}/entries")
    entries = spark.read.schema(POSTINGS).parquet(f"{folder}/entries")
    # The rows of a class are summed up before the shuffle, then the join.
    classes = indexed.where("prefix is not null").groupBy("class").agg(F.min("id").alias("id"), F.min("sketch").alias("sketch"))
    known = classes.join(entries.select("class").distinct(), "class", "left_semi")
    known.write.parquet(f"{folder}/classes")
    known = spark.read.parquet(f"{folder}/classes")
    # The prefixes, most of the index, have been read for the last time.
    indexed.select("id", "n", "class").write.parquet(f"{folder}/rows")
    remove(spark, f"{folder}/index")
    lists = parted(banded(entries, measure).join(known.select("class", "sketch"), "class"))
    tried = cut(candidates(lists, measure))
    ends = cut(tried.where("x = y").select(F.col("x").alias("class")).distinct())
    tried = tried.where("x <> y")
    texts_of(slim, cut(ends.join(known.select("class", "id"), "class")), measure).write.parquet(f"{folder}/texts")
    texts = spark.read.schema("class long, data binary").parquet(f"{folder}/texts")
    links = failed = in_vain = None
    while True:
        fresh = tried.select("x", "y").distinct()
        if failed is not None:
            fresh = fresh.join(failed, ["x", "y"], "left_anti")
        fresh = cut(fresh)
        if not fresh.isEmpty():
            answers = cut(verified(fresh, texts, measure))
            new_links = answers.where("links").select(F.col("x").alias("u"), F.col("y").alias("v"))
            new_failed = answers.where("not links").select("x", "y")
            links = new_links if links is None else links.unionAll(new_links)
            failed = cut(new_failed if failed is None else failed.unionAll(new_failed))
            links = cut(components.connect(links).where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
        if failed is None:
            break
        # Only lists in which a pair failed, now or before in another list, may have other pairs to try.
        new_in_vain = cut(tried.join(failed, ["x", "y"], "left_semi").select(*_KEYS, "x", "y"))
        if new_in_vain.isEmpty():
            break
        open_lists = cut(new_in_vain.select(*_KEYS).distinct())
        in_vain = new_in_vain if in_vain is None else cut(in_vain.unionAll(new_in_vain))
        roots = links.select(F.col("u").alias("class"), F.col("v").alias("root"))
        rest = lists.join(open_lists, _KEYS, "left_semi").join(cut(roots), "class", "left").withColumn("root", F.coalesce("root", "class"))
        tried = cut(candidates(rest, measure, in_vain.join(open_lists, _KEYS, "left_semi")))
    if links is None:
        return spark.createDataFrame([], "node long, root long")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


def join(docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every document n_shingles and component_id, the smallest id that links lead to."""
    spark = docs.sparkSession
    measure = Measure(words, percent)
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    folder = fresh_dir(spark, "setjoin")
    levels, hot = frequencies(slim, measure)
    index(slim, measure, levels).write.parquet(f"{folder}/index")
    indexed = spark.read.parquet(f"{folder}/index")
    roots = _connected(indexed, slim, measure, hot, folder)
    rows = spark.read.schema(indexed.select("id", "n", "class").schema).parquet(f"{folder}/rows").join(cut(roots.select(F.col("node").alias("class"), "root")), "class", "left").withColumn("root", F.coalesce("root", "class")).select("id", "n", "root")
    least = cut(rows.where("root is not null").groupBy("root").agg(F.min("id").alias("least")))
    out = rows.join(least, "root", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))
    out = cut(out)
    remove(spark, folder)
    return out


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns, of each component only the one with the smallest id.

    Most rows pass a Bloom filter of the ids that go, without a shuffle; the
    others, and rows of ids that occur more than once, are decided by a join,
    as all rows are if there are too many such ids for a filter. Rows without
    id stay if no row of their component has one; of rows with one id and text
    one stays.
    """
    spark = docs.sparkSession
    found = join(docs, words, percent, id_col, text_col).select(F.col(id_col).alias("id"), "component_id")
    gone = found.where(~F.col("id").eqNullSafe(F.col("component_id"))).select("id")
    several = found.groupBy("id").count().where("count > 1").select("id")
    unsure = cut(gone.unionAll(several).distinct())
    bits = bloom.bits_for(unsure.count())
    columns = docs.columns
    key, text = unused(columns, "_key"), unused(columns, "_text")
    kept = found.where(F.col("id").eqNullSafe(F.col("component_id")) | (F.col("id").isNull() & F.col("component_id").isNull())).select(F.struct("id").alias(key)).distinct()

    def one(rows: DataFrame) -> DataFrame:
        # In a struct a null id is equal to itself.
        keyed = rows.withColumn(key, F.struct(F.col(id_col).alias("id")))
        return keyed.join(cut(kept), key, "left_semi").withColumn(text, F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))).dropDuplicates([key, text]).select(*columns)

    if bits is None:
        return one(docs)
    sent = spark.sparkContext.broadcast(bloom.build(unsure, "id", bits))
    probed = docs.withColumn(unused(columns, "_probes"), bloom.probes(id_col, bits))

    def rows(which: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = bloom.passing(sent.value, batch.column(len(columns))) == which
                yield batch.select(range(len(columns))).filter(pa.array(mask))

        return probed.mapInArrow(run, docs.schema)

    return rows(False).unionByName(one(rows(True)))
