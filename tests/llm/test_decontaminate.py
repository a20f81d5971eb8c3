"""Decontamination against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from graphshed.llm import decontaminate

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(text, items, window):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        w = words(other)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            for i in range(len(own) - n + 1):
                if own[i : i + n] == w[k : k + n]:
                    hit.update(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
    return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(own)


def data():
    r = random.Random(6)
    text = lambda n: " ".join(r.choice(["the", "of", "É", "x9", "and", "to", "in"]) + str(r.randrange(4)) for _ in range(n))
    items = [(i, text(r.randrange(14, 40))) for i in range(12)] + [(2, text(15)), (50, "Short item"), (51, "one"), (52, None), (53, " !! "), (54, "a a a a a a a a a a a a a a a a"), (None, "no item has this name"), (None, None)]
    docs = [None, "", "...", "SHORT-ITEM", "a " * 30, "so short, item and one" + " pad" * 40, "so short, item" + " pad" * 37, "\u00a0one\x00two 日本", "x No item, has this NAME y"]
    for _ in range(60):
        item = r.choice(items[:12])[1].split()
        a = r.randrange(len(item))
        cut = item[a : a + r.randrange(30)]
        docs.append(text(r.randrange(300)) + "  " + ", ".join(cut).upper().lower() + ". " + text(r.randrange(100)))
    docs.append(text(40_000) + " " + items[0][1])
    return items, docs


@pytest.mark.parametrize("group_words", [1_000_000, 40])
def test_against_plain_python(spark, group_words):
    items, docs = data()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)] + [(None, docs[4], "x")], "doc_id long, text string, spans string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")
    rows = decontaminate.decontaminate(df, bench, group_words=group_words).collect()
    assert len(rows) == len(docs) + 1
    for r in rows:
        text = docs[4 if r.doc_id is None else r.doc_id]
        assert tuple(r)[1:6] == expected(text, items, 13), r.doc_id
        found = [w for a, b in r.spans for w in words(text[a:b])]
        assert len(found) == r.n_hit
    kept = decontaminate.decontaminate(df, bench, group_words=group_words, keep=True)
    assert kept.columns == [*df.columns, "found"]
    assert {r.doc_id: r.found.contaminated for r in kept.collect()} == {r.doc_id: r.contaminated for r in rows}


def test_empty(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert decontaminate.decontaminate(docs, bench).first().contaminated is False
    assert decontaminate.decontaminate(docs.limit(0), bench.union(spark.createDataFrame([(1, "a b")], bench.schema))).count() == 0
    assert decontaminate.decontaminate(docs.withColumn("text", F.lit(None).cast("string")), bench).first().n_words == 0
