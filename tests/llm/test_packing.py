"""Packing against the tokenizers library and plain rules."""

import random
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from graphshed.llm import packing

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
TEXTS = [None, "", " ", "Hello, world's don't  \n\n tabs\t\u00a0x", "Ça été 日本語 🙂🙂 ñandú\u0301", "<|endoftext|> is text", "a" * 5000, "word " * 3000, "\x00\x01 \x7f\u2028", "12345678901234567890 " * 200, "  leading\r\n and trailing   "]


def ids_of(texts):
    """As the contract has it: added tokens in texts are themselves."""
    tokenizer = Tokenizer.from_file(PATH)
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def test_pieces_and_places(spark):
    r = random.Random(4)
    texts = TEXTS + [" ".join(f"w{r.randrange(999)}" for _ in range(r.randrange(1, 900))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x"), (None, "no id", "x")], "doc_id long, text string, length string")
    rows = packing.pack_documents(df, PATH, with_ids=True, added_tokens=True).collect()
    want = {i: ids for i, ids in enumerate(ids_of(texts))} | {None: ids_of(["no id"])[0]}
    pieces, places = {}, {}
    for x in rows:
        ids = want[x.doc_id]
        assert x.ids == ids[x.start : x.start + x.length]
        assert x.ids_crc32 == zlib.crc32(np.array(x.ids, "<u4").tobytes())
        pieces.setdefault(x.doc_id, []).append((x.piece, x.start, x.length))
        places.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for i, own in pieces.items():
        copies = 2 if i == 3 else 1
        own = sorted(own)[::copies]
        n = len(want[i])
        assert [p for p, *_ in own] == list(range(len(own)))
        assert sum(length for *_, length in own) == n and all(length == 1024 for *_, length in own[1:])
        assert (len(own) == 1) == (n <= 1024)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(x.length for x in rows)
    assert len(places) <= 1.2 * -(-total // 1024) + 8


def test_bounded_best_fit():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 4, 10)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0)]
    bins = packing.BestFit(10, 2)
    assert [bins.place(n)[0] for n in (6, 8, 9)] == [0, 1, 2]  # the fullest, bin 1, was closed
    assert bins.place(2)[0] == 0
    assert bins.n_open <= 2


def test_many_pieces_fill_well():
    r = random.Random(2)
    bins = packing.BestFit(1024, 2048)
    lengths = [r.randrange(1, 1025) for _ in range(60_000)]
    for n in lengths:
        bins.place(n)
    assert bins.made <= 1.04 * sum(lengths) / 1024


def test_repeats_give_the_same_places(spark):
    df = spark.createDataFrame([(i, f"text {i} " * (i % 300)) for i in range(400)], "doc_id long, text string")
    one = packing.pack_documents(df, PATH).collect()
    two = packing.pack_documents(df.repartition(7), PATH).collect()
    assert sorted(one) == sorted(two)


def test_empty(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string").withColumn("piece", F.lit(1)), PATH).count() == 0


def test_queries_give_added_tokens_their_ids(spark, tmp_path):
    from graphshed.llm import queries

    texts = TEXTS + ["a <|endoftext|> b", "<|endoftext|><|endoftext|>  x\n <|endoftext|> ", "<|endoftext"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = Tokenizer.from_file(PATH)
    got = {(x.doc_id, x.start, x.length): x.ids_crc32 for x in queries.op2_best_fit_packing(spark, str(tmp_path)).collect()}
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert want[len(TEXTS)] == [64, 220, 50256, 275, 2]
    assert got == {(i, s, n): zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) for i, ids in enumerate(want) for s, n in packing.cut_points(len(ids), 1024)}


def test_repeated_rows_are_dealt_out(spark):
    """A third of all rows repeat one id and text: they go to all tasks, and none is lost."""
    df = spark.createDataFrame([(-1 if i % 3 == 0 else i, "the same text" if i % 3 == 0 else f"text {i}") for i in range(3000)], "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = packing.pack_documents(df, PATH).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == 3000
    shares = [sum(x.doc_id == -1 and x.sequence_id >> packing.SEQUENCE_BITS == part for x in rows) for part in range(4)]
    assert sum(shares) == 1000 and max(shares) < 400
