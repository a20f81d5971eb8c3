"""Importance resampling: the models, the top-k and what stays."""

import collections
import math
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from graphshed.llm import resample
from graphshed.llm.common import cut

GOOD = [f"word{i}" for i in range(60)]


def corpus(n=400):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        kind = i % 8
        words = [r.choice(GOOD) for _ in range(r.randrange(5, 120))]
        if kind == 0:
            text = " ".join(w + r.choice(["***", "%%%", "&&&"]) for w in words)
        elif kind == 1:
            text = " ".join(w.upper() + "!!" for w in words)
        else:
            text = " ".join(words)
        rows.append((i, text, kind))
        if i % 3 == 0:
            labels.append((i, int(kind > 1)))
    return rows, labels


def test_models_count_every_document(spark):
    rows, labels = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, kind int").repartition(5)
    weights = resample.fit(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    features = resample.Features()
    raw, target = np.zeros(resample.BUCKETS), np.zeros(resample.BUCKETS)
    good = {i for i, q in labels if q}
    for i, text, _ in rows:
        for b, n in collections.Counter(features.buckets(text).tolist()).items():
            raw[b] += n
            target[b] += n * (i in good)
    assert weights.slots == {None: 0} and list(weights.ratios) == [0]
    assert np.allclose(weights.of(None), resample.log_ratios(raw, target))
    assert weights.share == sum(q for _, q in labels) / len(labels)


def test_selection(spark):
    rows, labels = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, kind int")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    kept = {r.doc_id for r in resample.sample(df, lab).collect()}
    good = {i for i, _, k in rows if k > 1}
    assert len(good - kept) <= 3 and len(kept - good) <= 3
    whole = resample.select(df.withColumn("id", F.lit("x")), lab)
    assert whole.columns == ["doc_id", "text", "kind", "id"] and {r.doc_id for r in whole.collect()} == kept
    ten = [r.key for r in resample.sample(df, lab, k=10).collect()]
    every = sorted((r.noisy for r in resample.score(df, resample.fit(df, lab)).collect()), reverse=True)
    assert sorted(ten, reverse=True) == every[:10]


def test_the_mix_of_languages_weighs_nothing(spark):
    """Labels that hold one language only: the other's good documents stay, though the target has none of their words."""
    r = random.Random(5)
    docs, labels = [], []
    for i in range(600):
        lang = "aa" if i % 3 else "bb"
        words = " ".join(f"{lang}{r.randrange(40)}" for _ in range(80))
        docs.append((i, words.upper() + "!!" if i % 10 == 0 else words, lang))
        if i % 2 and (lang == "aa" or i % 15 == 0):
            labels.append((i, int(i % 10 != 0)))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    kept = {x.doc_id for x in resample.sample(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert len({i for i, *_ in docs if i % 10} - kept) <= 6


def plain_sample(rows, labels, buckets_of):
    """The sample by the definition, in plain Python: {id: (log weight, key)}."""
    known = [(i, q) for i, q in labels]
    good = {i for i, q in known if q}
    half, models = resample.BUCKETS // 2, {}
    for i, text, lang in rows:
        raw, target = models.setdefault(lang, (collections.Counter(), collections.Counter()))
        for b in buckets_of(text):
            raw[b] += 1
            target[b] += i in good
    log_weight, key = {}, {}
    for i, text, lang in rows:
        raw, target = models[lang]
        total = 0.0
        for b in buckets_of(text):
            inside = [c for c in raw if (c < half) == (b < half)]
            t_sum, r_sum = sum(target[c] for c in inside), sum(raw[c] for c in inside)
            if t_sum:
                total += math.log((target[b] + resample.PRIOR) / (raw[b] * t_sum / r_sum + resample.PRIOR))
        u = xxhash.xxh3_64_intdigest(f"{i}\0{text}".encode(), resample.SEED) / 2**64 * (1 - 2**-52) + 2**-53
        log_weight[i], key[i] = total, total - math.log(-math.log(u))
    share = len(good) / len(known)
    k = math.ceil(sum(min(1, share * math.exp(w + resample.LENIENCY)) for w in log_weight.values()) - 1e-6)
    least = sorted(key.values())[-k]
    return {i: (log_weight[i], key[i]) for i in key if key[i] >= least}


def plain_buckets(text):
    """Hashed unigrams and bigrams of words and signs, repetitions and capitals marked."""
    mask, half = 2**64 - 1, resample.BUCKETS // 2

    def mix(x):
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & mask
        return x ^ x >> 29

    number = lambda word: xxhash.xxh3_64_intdigest(word)
    found, before = [], None
    for token in re.findall(r"\w+|[^\w\s]+", text):
        own = number(token.lower().encode())
        if len(token) > 1 and token.isupper():
            found.append(number(b"\0capitals"))
        found.append(number(b"\0again") if own == before else own)
        before = own
    pairs = [(a * 0x2545F4914F6CDD1D & mask) ^ b for a, b in zip(found, found[1:])]
    return [mix(x) % half for x in found] + [mix(x) % half + half for x in pairs]


def test_sample_by_definition(spark):
    """Log weights, keys, the size of the sample and its rows, against plain Python that shares no code with the operator."""
    rows, labels = corpus(120)
    langs = ["tr", "cs", None, ""]  # of one slot, when names were hashed
    rows = [(i, text, langs[i // 8 % 4]) for i, text, _ in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = plain_sample(rows, labels, plain_buckets)
    got = {r.doc_id: (r.log_weight, r.key) for r in resample.sample(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert got.keys() == want.keys() and 0 < len(got) < 120
    assert all(np.allclose(got[i], want[i], atol=1e-6) for i in want)


def test_languages_have_models_of_their_own(spark, monkeypatch):
    rows = [(i, f"w{i % 5} x", lang) for i, lang in enumerate([None, "", "tr", "cs", "ja", "uk"] * 3 + ["tr"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert resample.fit(df, none).slots == {"tr": 0, None: 1, "": 2, "cs": 3, "ja": 4, "uk": 5}
    monkeypatch.setattr(resample, "LANGUAGES", 2)
    assert resample.fit(df, none).slots == {"tr": 0, None: 1}


def test_kth_largest(spark):
    r = random.Random(1)
    values = [r.randrange(-resample.MOST, resample.MOST) for _ in range(500)] + [5] * 40 + [-resample.MOST, resample.MOST - 1]
    df = cut(spark.createDataFrame([(v,) for v in values], "steps long"))
    order = sorted(values, reverse=True)
    for k in (1, 2, 250, len(values)):
        assert resample.kth_largest(df, k) == order[k - 1]
    assert resample.kth_largest(df, len(values) + 5) == -resample.MOST


def test_odd_rows(spark):
    rows, labels = corpus(80)
    odd = [(None, "word1 word2", 9), (900, None, 9), (901, "", 9), (902, "word1 " * 50_000, 9), (3, rows[3][1], 3)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, kind int")
    lab = spark.createDataFrame([*labels, (None, 1), (5, None), (3, 1), (3, 1)], "doc_id long, quality int")
    scored = {r.id: r.log_weight for r in resample.score(df, resample.fit(df, lab)).collect()}
    assert scored[900] == scored[901] == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert resample.sample(df, none).count() == df.count()
    assert resample.sample(df.limit(0), lab).count() == 0


def test_token_stream():
    f = resample.Features()
    assert f.tokens("a a A b")[1] == f.again and len(f.tokens("AB ab")) == 3
    assert len(f.buckets("")) == 0 and len(f.buckets("one")) == 1 and len(f.buckets("one two")) == 3
