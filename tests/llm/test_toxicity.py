"""The classifier: held-out accuracy, equal scores by both ways of computing them, odd rows."""

import math
import random
import re
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from graphshed.llm import toxicity

CLEAN = [f"clean{i}" for i in range(300)]
STEMS = ["vexto", "grumbi", "idiot"]


def corpus(n=900):
    r = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        words = [r.choice(CLEAN) for _ in range(r.randrange(3, 150))]
        bad = i % 6 == 0
        if bad:
            for _ in range(r.randrange(1, 4)):
                words.insert(r.randrange(len(words)), r.choice(STEMS) + r.choice(["", "lar", "mos", "ten", f"{r.randrange(99)}"]))
        docs.append((i, " ".join(words).title() + ".", r.choice(["en", "de"])))
        labels.append((i, int(bad)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs + [(2000, None, None), (2001, "", "en"), (2002, "clean1 " * 60_000, "en"), (None, "idiot", "en"), (7, docs[7][1], "de")], "doc_id long, text string, lang string")
    lab = spark.createDataFrame([*labels, (5, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit(df, lab)
    rows = toxicity.score(df, model).collect()
    assert len(rows) == len(docs) + 5
    truth = dict(labels)
    wrong = 0
    for r in rows:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        wrong += r.held_out and r.doc_id in truth and r.predicted != truth[r.doc_id]
    assert wrong <= 5
    by = {r.doc_id: r.score for r in rows}
    assert by[2000] == by[2001] < 0.3 and by[2002] < 0.3 and by[None] > 0.3
    vocabulary, scorer = toxicity.Vocabulary(), toxicity.Scorer(model)
    for _, text, _ in docs[:50] + [(0, "", ""), (0, "one", ""), (0, "one two", "")]:
        a = toxicity.sigmoid(model.logit(vocabulary.of(toxicity.words_of(text))))
        assert np.isclose(a, scorer.score(text), atol=1e-4)


def test_labels_of_held_out_rows_are_never_used(spark):
    docs, labels = corpus(200)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    scores = [sorted(toxicity.score(df, toxicity.fit(df, spark.createDataFrame(x, "doc_id long, toxic int"))).collect()) for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_no_labels_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(df, toxicity.fit(df, none)).count() == 1
    assert toxicity.score(df.limit(0), toxicity.fit(df, none)).count() == 0


def plain_score(model, text):
    """The network's answer from its numbers, word by word and filter by filter."""
    words = re.findall(r"\w+", text.lower())
    rows = []
    for w in words:
        parts = ["=" + w] + [f"{n}{w[:n]}" for n in (4, 5, 6) if len(w) >= n]
        rows.append(sum(model.table[xxhash.xxh3_64_intdigest(p.encode()) % toxicity.SLOTS].astype(float) for p in parts))
    while len(rows) < 3:
        rows.append(np.zeros(toxicity.DIM))
    z, at = model.bias, 0
    for width, kernel, bias in zip((1, 2, 3), model.kernels, model.biases):
        for f in range(toxicity.FILTERS):
            answers = [bias[f] + np.concatenate(rows[i : i + width]) @ kernel[:, f] for i in range(len(rows) - width + 1)]
            z += max(0, *answers) * model.weights[at]
            at += 1
    return 1 / (1 + math.exp(-z))


def test_scores_by_definition_and_clashing_columns(spark):
    docs, labels = corpus(300)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(df, lab)
    clashing = df.withColumns({c: F.lit("own") for c in ("score", "held_out", "predicted", "flagged", "id", "label")})
    rows = toxicity.score(clashing, toxicity.fit(clashing, lab.withColumn("text", F.lit("no"))))
    assert rows.columns == ["doc_id", "held_out", "score", "predicted", "flagged"]
    texts = {i: t for i, t, _ in docs}
    assert all(abs(r.score - plain_score(model, texts[r.doc_id])) < 1e-4 for r in rows.collect())


def test_calibration_rows_are_not_trained_on(spark, monkeypatch):
    """Turning the labels of the calibration rows moves the scale and thresholds only."""
    docs, labels = corpus(900)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    seen = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda slots, toxic, *rest: seen.append(len(slots)) or train(slots, toxic, *rest))
    own = lambda i: xxhash.xxh3_64_intdigest(str(i), 5) % toxicity.CALIBRATION == 0
    turned = [(i, 1 - y if own(i) else y) for i, y in labels]
    a, b = (toxicity.fit(df, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert np.array_equal(a.table, b.table) and np.array_equal(a.weights, b.weights) and a.bias != b.bias
    fitting = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 != 2]
    assert seen == [sum(not own(i) for i in fitting)] * 2 and 0 < seen[0] < len(fitting)
