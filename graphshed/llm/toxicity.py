"""Toxicity: a convolutional text classifier in numpy.

A word's embedding is the sum of rows of one table, at the hashes of the word
and of its first letters; filters of several widths run over the sequence of
embeddings, the largest answer of each filter goes to a logistic layer. Rows
begin with the word's smoothed log-odds in one dimension, which training then
moves with all others.

The classifier is fitted on at most ``toxic_rows`` and ``clean_rows`` labelled
documents (those with the smallest hash of their id; documented bounds, the
only rows ever sent to the driver); every whole text is scored where it lies.
Scores see the text only. One in CALIBRATION of the fitting rows is not trained
on: where the scores' scale lies and the thresholds by language, used for the
column ``flagged``, are chosen on these rows.

Defined results: null text counts as empty and gets the score of no words;
repeated rows get equal rows; rows without id are held out; with no labelled
row of either class the score is the base rate; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphshed.llm.common import each

TOXIC_ROWS, CLEAN_ROWS = 1500, 3000
#: One in so many fitting rows, by a hash of the id, is for calibration only.
CALIBRATION = 5
SLOTS = 1 << 18
DIM, FILTERS, WIDTHS = 8, 6, (1, 2, 3)
#: Letters of the beginnings that are hashed besides the whole word.
STEMS = (4, 5, 6)
EPOCHS, RATE, BATCH = 6, 0.05, 16
#: Pseudo-counts that draw a rare word's log-odds to zero.
PRIOR = 20.0

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def slots_of(word: str) -> list[int]:
    """Table rows of a word: of itself and of its beginnings."""
    parts = ["=" + word] + [f"{n}" + word[:n] for n in STEMS if len(word) >= n]
    return [xxhash.xxh3_64_intdigest(p.encode()) % SLOTS for p in parts]


PER_WORD = 1 + len(STEMS)


class Vocabulary:
    """Word to PER_WORD slots (filled up with the empty row SLOTS), cached up to a bound."""

    def __init__(self, most: int = 400_000):
        self.known: dict[str, tuple] = {}
        self.most = most

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        rows = []
        for w in words:
            row = known.get(w)
            if row is None:
                found = slots_of(w)
                row = known[w] = tuple(found + [SLOTS] * (PER_WORD - len(found)))
            rows.append(row)
        return np.array(rows, np.int32).reshape(-1, PER_WORD)


@dataclass
class Model:
    table: np.ndarray  # (SLOTS + 1, DIM); the last row is zero
    kernels: list[np.ndarray]  # for each width (width * DIM, FILTERS)
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, slots: np.ndarray) -> tuple[np.ndarray, list]:
        """Largest answer of each filter, and where it stands. Texts are padded with zeros to the widest filter."""
        x = self.table[slots].sum(axis=1) if len(slots) else np.zeros((0, DIM), np.float32)
        pad = max(WIDTHS) - len(x)
        if pad > 0:
            x = np.concatenate((x, np.zeros((pad, DIM), np.float32)))
        tops, places = [], []
        for width, kernel, bias in zip(WIDTHS, self.kernels, self.biases):
            answers = bias + sum(x[i : len(x) - width + 1 + i] @ kernel[i * DIM : (i + 1) * DIM] for i in range(width))
            at = answers.argmax(axis=0)
            tops.append(np.maximum(answers[at, np.arange(FILTERS)], 0))
            places.append(at)
        return np.concatenate(tops), [x, places]

    def logit(self, slots: np.ndarray) -> float:
        return float(self.pooled(slots)[0] @ self.weights + self.bias)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(slots: list[np.ndarray], toxic: np.ndarray, seed: int = 7) -> Model:
    """Fits the model by stochastic gradient descent on the logistic loss."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (SLOTS + 1, DIM)).astype(np.float32)
    n_toxic = int(toxic.sum())
    share = (n_toxic + 0.5) / (len(toxic) + 1)
    counts = np.zeros((2, SLOTS + 1))
    for s, y in zip(slots, toxic):
        counts[int(y), np.unique(s)] += 1
    odds = np.log((counts[1] + PRIOR * share) / (counts[0] + PRIOR * (1 - share))) - np.log(share / (1 - share))
    table[:, 0] = odds
    table[SLOTS] = 0
    kernels = [rng.normal(0, 0.1, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w, kernel in zip(WIDTHS, kernels):
        kernel[np.arange(w) * DIM] += 1 / w
    model = Model(table, kernels, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.full(FILTERS * len(WIDTHS), 0.1, np.float32), float(np.log(share / (1 - share))))
    if not 0 < n_toxic < len(toxic):
        model.weights[:] = 0
        return model
    # Both classes weigh the same in a step's average, so that the bias settles between them.
    weight = np.where(toxic, 0.5 / share, 0.5 / (1 - share))
    model.bias = -2.0
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch)
        order = rng.permutation(len(slots))
        for start in range(0, len(order), BATCH):
            batch = order[start : start + BATCH]
            g_weights, g_bias = np.zeros_like(model.weights), 0.0
            g_kernels, g_biases = [np.zeros_like(k) for k in kernels], [np.zeros_like(b) for b in model.biases]
            moved: list[tuple[np.ndarray, np.ndarray]] = []
            for i in batch:
                tops, (x, places) = model.pooled(slots[i])
                error = (sigmoid(tops @ model.weights + model.bias) - toxic[i]) * weight[i] / len(batch)
                g_weights += error * tops
                g_bias += error
                back = error * model.weights * (tops > 0)
                for j, (width, at) in enumerate(zip(WIDTHS, places)):
                    g = back[j * FILTERS : (j + 1) * FILTERS]
                    g_biases[j] += g
                    for k in range(width):
                        rows = x[at + k]
                        g_kernels[j][k * DIM : (k + 1) * DIM] += rows.T * g
                        inside = at + k < len(slots[i])
                        if inside.any():
                            moved.append((slots[i][(at + k)[inside]], (kernels[j][k * DIM : (k + 1) * DIM] * g).T[inside]))
            model.weights -= rate * 4 * g_weights
            model.bias -= rate * 4 * g_bias
            for j in range(len(WIDTHS)):
                kernels[j] -= rate * g_kernels[j]
                model.biases[j] -= rate * g_biases[j]
            for rows, g in moved:
                np.subtract.at(table, rows.ravel(), rate * np.repeat(g, PER_WORD, axis=0))
            table[SLOTS] = 0
    return model


def calibrate(model: Model, slots: list[np.ndarray], toxic: np.ndarray, langs: list[str], at: float = 0.3) -> None:
    """Scales the output so that ``at`` lies where the given rows are told apart best, and sets each language's threshold the same way.

    The scale is common to all languages, as a score may not depend on the language column.
    """
    logits = np.array([model.logit(s) for s in slots])

    def cut(z: np.ndarray, y: np.ndarray) -> float:
        """The middle of the best gap by balanced accuracy."""
        order = np.argsort(z)
        z, y = z[order], y[order]
        missed = np.concatenate(([0], np.cumsum(y))) / max(1, y.sum())
        false = 1 - np.concatenate(([0], np.cumsum(~y))) / max(1, (~y).sum())
        cost = missed + false
        best = np.flatnonzero(cost <= cost.min() + 1e-12)
        edges = np.concatenate(([z[0] - 2], z, [z[-1] + 2]))
        gaps = edges[best + 1] - edges[best]
        k = best[gaps.argmax()]
        return float((edges[k] + edges[k + 1]) / 2)

    if toxic.any() and not toxic.all():
        shift = float(np.log(at / (1 - at))) - cut(logits, toxic)
        model.bias += shift
        logits += shift
        for lang in sorted({x for x in langs if x}):
            own = np.array([x == lang for x in langs])
            if toxic[own].any() and not toxic[own].all():
                model.thresholds[lang] = float(sigmoid(cut(logits[own], toxic[own])))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))


def fitting_rows(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic"):
    """The bounded sample of labelled documents: (id, text, lang, label), the same for the same rows."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where(F.col("label").isin(0, 1) & ~held_out("id")).groupBy("id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("id", F.lit(11)), "id"]
    chosen = known.where("label = 1").orderBy(*order).limit(toxic_rows).unionAll(known.where("label = 0").orderBy(*order).limit(clean_rows))
    # At most toxic_rows + clean_rows ids.
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang"))
    rows = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min(F.struct("text", "lang")).alias("t"), F.max("label").alias("label")).select("id", "t.text", "t.lang", "label").toArrow()
    return rows.sort_by("id")


def fit(docs: DataFrame, labels: DataFrame, **bounds: int) -> Model:
    rows = fitting_rows(docs, labels, **bounds)
    vocabulary = Vocabulary()
    slots = [vocabulary.of(words_of(t)) for t in rows["text"].to_pylist()]
    toxic = rows["label"].to_numpy().astype(bool)
    for_calibration = np.array([xxhash.xxh3_64_intdigest(str(i), 5) % CALIBRATION == 0 for i in rows["id"].to_pylist()], bool)
    # With too few rows of a class to part, all are for both.
    if min((toxic & for_calibration).sum(), (~toxic & for_calibration).sum()) < 5:
        mine, other = np.ones((2, len(toxic)), bool)
    else:
        mine, other = ~for_calibration, for_calibration
    model = train([s for s, own in zip(slots, mine) if own], toxic[mine])
    calibrate(model, [s for s, own in zip(slots, other) if own], toxic[other], [lang for lang, own in zip(rows["lang"].to_pylist(), other) if own])
    return model


class Scorer:
    """Scores whole texts: each word's share in every filter is a row of numbers worked out once."""

    def __init__(self, model: Model, most: int = 50_000):
        self.model, self.most = model, most
        self.taps = sum(WIDTHS) * FILTERS
        self.kernel = np.concatenate([k.reshape(w, DIM, FILTERS).transpose(1, 0, 2).reshape(DIM, w * FILTERS) for w, k in zip(WIDTHS, model.kernels)], axis=1)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.shares = np.zeros((1024, self.taps), np.float32)

    def numbers(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            self.clear()
            known = self.known
        fresh = list(dict.fromkeys(w for w in words if w not in known))
        if fresh:
            begin = len(known)
            known.update((w, begin + i) for i, w in enumerate(fresh))
            rows = np.full((len(fresh), PER_WORD), SLOTS, np.int32)
            for row, w in zip(rows, fresh):
                found = slots_of(w)
                row[: len(found)] = found
            while len(known) > len(self.shares):
                self.shares = np.concatenate((self.shares, np.zeros_like(self.shares)))
            self.shares[begin : len(known)] = self.model.table[rows].sum(axis=1) @ self.kernel
        return np.fromiter(map(known.__getitem__, words), np.int32, len(words))

    def score(self, text: str) -> float:
        numbers = self.numbers(words_of(text))
        rows = self.shares[numbers]
        pad = max(WIDTHS) - len(rows)
        if pad > 0:
            rows = np.concatenate((rows, np.zeros((pad, self.taps), np.float32)))
        tops, at = [], 0
        for width, bias in zip(WIDTHS, self.model.biases):
            n = len(rows) - width + 1
            answers = rows[:n, at : at + FILTERS]
            for i in range(1, width):
                answers = answers + rows[i : n + i, at + i * FILTERS : at + (i + 1) * FILTERS]
            tops.append(np.maximum(answers.max(axis=0) + bias, 0))
            at += width * FILTERS
        return float(sigmoid(np.concatenate(tops) @ self.model.weights + self.model.bias))


_scorers: dict[str, Scorer] = {}


def scorer(key: str, model: Model) -> Scorer:
    """One for each worker process; the last one only is kept."""
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(model)
    return _scorers[key]


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """For every document held_out, score, predicted (by the one threshold) and flagged (by that of its language)."""
    spark = docs.sparkSession
    # SLOTS * DIM numbers, whatever the table's size.
    sent = spark.sparkContext.broadcast(model)
    key = xxhash.xxh3_64_hexdigest(model.table.tobytes() + np.float64(model.bias).tobytes())
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(lang_col).alias("lang"), held_out(id_col).alias("held_out"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scorer(key, sent.value)
        limits = sent.value.thresholds
        for batch in batches:
            scores = np.array([own.score(t) for t in each(batch.column(1))], float)
            flagged = [s >= limits.get(lang, threshold) for s, lang in zip(scores, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32)), pa.array(flagged, pa.bool_())],
                ["id", "held_out", "score", "predicted", "flagged"],
            )

    return slim.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int, flagged boolean").withColumnRenamed("id", id_col)
