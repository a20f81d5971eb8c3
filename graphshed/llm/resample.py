"""Importance resampling of documents towards labelled good text.

Hashed unigrams and bigrams are counted in all documents (raw) and in the good
ones (target), for each language apart, so that the labelled sample's mix of
languages weighs nothing. A document's log weight is the sum over its n-grams of the log
ratio of the two models; Gumbel noise, fixed by id and text, is added, and the
documents with the largest sums are the sample: top-k without replacement in
proportion to the weights.

The sample's size follows from the weights: the expected number of documents
that the target model explains, the sum of min(1, share * weight * e**LENIENCY),
where share is the labelled share of good documents.

Tokens are words and runs of signs in lower case. A token equal to the one
before is written as one sign of repetition, and words in capitals are
preceded by one for capitals, so that both show up as n-grams.

Defined results: null text counts as empty and has weight 1 (log weight 0);
repeated rows have equal sums and stay or go together, so more than k rows can
stay; with no labelled good document all weights are 1 and all rows stay; an
empty table gives an empty table; a null language is one of its own. The
LANGUAGES languages with the most documents have a model each, all others one
together. ``select`` passes on all columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphshed.llm.common import cut, each
from graphshed.llm.hashing import WordHashes, mix

BUCKETS = 1 << 14
#: Good documents that the target model is counted from, at most (those of the smallest hash).
TARGET_ROWS = 10_000
#: Pseudo-count of each bucket that draws the target model to the raw one: rare n-grams, whose counts are those of a few documents, say little.
PRIOR = 60.0
#: Languages with models of their own, at most: those with the most documents (of equal ones the first by name).
LANGUAGES = 64
SEED = 23
#: Nats by which a document's weight may fall short and it still counts as explained: rather a bad document too many than a good one lost.
LENIENCY = 1.0

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_SALT = np.uint64(0x2545F4914F6CDD1D)


class Features:
    """Texts to buckets of n-grams; keeps token hashes between texts."""

    def __init__(self):
        self.words = WordHashes()
        self.capitals = np.uint64(self.words[b"\0capitals"])
        self.again = np.uint64(self.words[b"\0again"])

    def tokens(self, text: str) -> np.ndarray:
        """Hashes of the token stream."""
        found = _TOKEN.findall(text)
        if not found:
            return np.empty(0, np.uint64)
        h = self.words.of([t.lower().encode("utf-8", "replace") for t in found])
        upper = np.fromiter((len(t) > 1 and t.isupper() for t in found), bool, len(found))
        same = np.concatenate(([False], h[1:] == h[:-1]))
        h = np.where(same, self.again, h)
        if upper.any():
            h = np.insert(h, np.flatnonzero(upper), self.capitals)
        return h

    def buckets(self, text: str) -> np.ndarray:
        """Buckets of all unigrams (lower half) and bigrams (upper half)."""
        h = self.tokens(text)
        half = np.uint64(BUCKETS // 2)
        one = mix(h) % half
        two = mix(h[:-1] * _SALT ^ h[1:]) % half + half
        return np.concatenate((one, two)).astype(np.int32)


@dataclass
class Weights:
    """Log ratio of each bucket by slot, the slots of languages, and the labelled share of good documents."""

    ratios: dict[int, np.ndarray]
    slots: dict[str | None, int]
    share: float

    def of(self, lang: str | None) -> np.ndarray:
        return self.ratios.get(self.slots.get(lang, LANGUAGES), _NO_RATIOS)


_NO_RATIOS = np.zeros(BUCKETS)


def language_slots(texts: DataFrame) -> dict[str | None, int]:
    """A slot for each of the LANGUAGES languages with the most rows; null is one of them like any other."""
    most = texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("lang")).limit(LANGUAGES)
    return {row.lang: i for i, row in enumerate(most.collect())}


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log(target / raw) of each bucket, unigrams and bigrams as models of their own; 0 without a target."""
    out = np.zeros(BUCKETS)
    for part in (slice(0, BUCKETS // 2), slice(BUCKETS // 2, BUCKETS)):
        if target[part].sum():
            expected = raw[part] * (target[part].sum() / raw[part].sum())
            out[part] = np.log((target[part] + PRIOR) / (expected + PRIOR))
    return out


def language(docs: DataFrame, lang_col: str | None):
    """The language column, or null where the documents have none."""
    return (F.col(lang_col) if lang_col in docs.columns else F.lit(None)).cast("string").alias("lang")


def fit(docs: DataFrame, labels: DataFrame, target_rows: int = TARGET_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", label_col: str = "quality") -> Weights:
    """Counts the models: raw over every document, target over labelled good ones.

    What the driver gets are two numbers for each of BUCKETS buckets of at most
    LANGUAGES + 1 slots.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("good")).where("id is not null and good in (0, 1)")
    n, good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("good"), F.lit(0))).first()
    chosen = known.where("good = 1").select("id").distinct().orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(target_rows).withColumn("chosen", F.lit(True))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), language(docs, lang_col))
    slots = language_slots(texts)
    # At most target_rows ids.
    marked = texts.join(F.broadcast(chosen), "id", "left").select("text", "lang", F.col("chosen").isNotNull().alias("target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for text, lang, target in zip(*(each(batch.column(i)) for i in range(3))):
                own = totals.setdefault(slots.get(lang, LANGUAGES), np.zeros((2, BUCKETS), np.int64))
                counts = np.bincount(features.buckets(text), minlength=BUCKETS)
                own[0] += counts
                if target:
                    own[1] += counts
        for number, own in totals.items():
            seen = np.flatnonzero(own[0])
            yield pa.RecordBatch.from_arrays([pa.array((number * BUCKETS + seen).astype(np.int32)), pa.array(own[0][seen]), pa.array(own[1][seen])], ["cell", "raw", "target"])

    sums = marked.mapInArrow(count, "cell int, raw long, target long").groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros((2, (LANGUAGES + 1) * BUCKETS))
    at = sums["cell"].to_numpy()
    raw[at], target[at] = sums["raw"].to_numpy(), sums["target"].to_numpy()
    raw, target = raw.reshape(-1, BUCKETS), target.reshape(-1, BUCKETS)
    ratios = {i: log_ratios(raw[i], target[i]) for i in range(LANGUAGES + 1) if raw[i].any()}
    return Weights(ratios, slots, good / n if good else 1.0)


def gumbel(key: str, text: str) -> float:
    """Standard Gumbel noise fixed by a document's id and text."""
    bits = xxhash.xxh3_64_intdigest(f"{key}\0{text}".encode("utf-8", "replace"), SEED)
    u = (bits / 2.0**64) * (1 - 2.0**-52) + 2.0**-53
    return -np.log(-np.log(u))


#: Steps of a unit in which sums are compared, and the largest sum in steps.
STEP, MOST = 1 << 20, 1 << 44


def _scored(weights: Weights, places: tuple[int, int, int | None], least: int | None):
    """Adds log_weight and steps to batches, or keeps the rows with at least so many steps."""
    id_at, text_at, lang_at = places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            langs = batch.column(lang_at).to_pylist() if lang_at is not None else [None] * batch.num_rows
            rows = [(weights.of(lang)[features.buckets(t or "")].sum(), gumbel(str(i), t or "")) for i, t, lang in zip(each(batch.column(id_at)), each(batch.column(text_at)), langs)]
            w, noise = np.array(rows, float).reshape(-1, 2).T
            noisy = w + noise
            steps = np.clip(np.floor(noisy * STEP), -MOST, MOST - 1).astype(np.int64)
            if least is None:
                yield pa.RecordBatch.from_arrays([batch.column(id_at), pa.array(w), pa.array(noisy), pa.array(steps)], ["id", "log_weight", "noisy", "steps"])
            else:
                yield batch.filter(pa.array(steps >= least))

    return run


def score(docs: DataFrame, weights: Weights, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """(id, log_weight, noisy, steps) of every document."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), language(docs, lang_col))
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(_scored(weights, (0, 1, 2), None), f"id {kind}, log_weight double, noisy double, steps long")


def sample_size(scored: DataFrame, share: float) -> int:
    """Expected number of documents that the target model explains."""
    expected = scored.agg(F.sum(F.least(F.lit(1.0), F.exp(F.least(F.lit(0.0), F.col("log_weight") + float(np.log(share)) + LENIENCY))))).first()[0]
    return int(np.ceil((expected or 0.0) - 1e-6))


def kth_largest(scored: DataFrame, k: int, column: str = "steps") -> int:
    """The k-th largest value of a column of integers in [-MOST, MOST), exact, by counting ranges of values three times.

    Each count has at most 2**15 rows, summed before the shuffle.
    """
    low, width = -MOST, 2 * MOST
    while width > 1:
        part = max(1, width >> 15)
        inside = scored.where((F.col(column) >= low) & (F.col(column) < low + width))
        counts = sorted(((r.part, r.n) for r in inside.groupBy(F.floor((F.col(column) - low) / F.lit(part)).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
        for at, n in counts:
            if n >= k:
                low, width = low + at * part, part
                break
            k -= n
        else:
            return -MOST
    return low


def threshold(scored: DataFrame, share: float, k: int | None = None) -> int:
    """Steps that the sample's documents have at least."""
    k = sample_size(scored, share) if k is None else k
    return kth_largest(scored, k) if k > 0 else MOST


def sample(docs: DataFrame, labels: DataFrame, k: int | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """(id, log_weight, key) of the sampled documents."""
    names = {"id_col": id_col, "text_col": text_col, "lang_col": lang_col}
    weights = fit(docs, labels, **names)
    scored = cut(score(docs, weights, **names))
    kept = scored.where(F.col("steps") >= threshold(scored, weights.share, k))
    return kept.select(F.col("id").alias(id_col), "log_weight", F.col("noisy").alias("key"))


def select(docs: DataFrame, labels: DataFrame, k: int | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """The sampled documents with all their columns. Texts are scored a third time rather than shuffled to be joined."""
    names = {"id_col": id_col, "text_col": text_col, "lang_col": lang_col}
    weights = fit(docs, labels, **names)
    least = threshold(cut(score(docs, weights, **names)), weights.share, k)
    at = docs.columns.index
    places = at(id_col), at(text_col), at(lang_col) if lang_col in docs.columns else None
    return docs.mapInArrow(_scored(weights, places, least), docs.schema)
