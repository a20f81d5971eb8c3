"""The pipeline stage by stage against plain Python, on a small corpus."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from graphshed.llm import pii, spans
from tests.llm.test_decontaminate import expected
from tests.llm.test_packing import ids_of
from tests.llm.test_setjoin import brute


def tables(spark, folder):
    r = random.Random(12)
    words = [f"w{i}" for i in range(500)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, text(30)) for i in range(5)]
    docs, labels = [], []
    for i in range(300):
        body = text(r.randrange(20, 200))
        if i % 9 == 0:
            body = body.upper().replace(" ", "!! ")
        elif i % 9 == 1:
            body += " " + items[i % 5][1]
        elif i % 9 == 2:
            body += " mail joe.doe@site.org or +44 20 7946 0958 now"
        elif i % 9 == 3 and docs:
            body = docs[-1][1] + r.choice(["", " end", " other end here"])
        docs.append((i, body, "en", "src", len(body)))
        if i % 2:
            labels.append((i, int(i % 9 != 0), 0))
    docs += [(400, None, "en", "src", None), (401, "", None, None, 0), (5, docs[5][1], "en", "src", len(docs[5][1])), (None, text(40), "en", "src", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    docs, items = tables(spark, folder)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "packing"]
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns, outputs = now.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        outputs[name] = now.collect()
        if name != "packing":
            assert now.columns == columns
    good = {i for i, t, *_ in docs if i is None or i % 9 or i > 300}
    kept = {x.doc_id for x in outputs["quality"]}
    assert len(good - kept) <= 3 and len(kept - good) <= 3
    rows = [(x.doc_id, x.text) for x in outputs["quality"]]
    want = {i for i, _, c in brute(rows, 5, 80) if i == c}
    assert sorted((x.doc_id for x in outputs["near_duplicates"]), key=str) == sorted(want, key=str)
    clean = [x.doc_id for x in outputs["near_duplicates"] if not expected(x.text, items, 13)[4]]
    assert sorted((x.doc_id for x in outputs["decontamination"]), key=str) == sorted(clean, key=str) and len(clean) < len(want)
    before = {x.doc_id: x.text for x in outputs["decontamination"]}
    changed = 0
    for x in outputs["pii"]:
        plain = before[x.doc_id]
        if plain is not None:
            plain = plain.replace("joe.doe@site.org", "[email]").replace("+44 20 7946 0958", "[phone]")
        assert x.text == plain
        assert x.n_chars == (len(plain) if plain is not None else None)
        changed += plain != before[x.doc_id]
    assert changed > 10 and "@" not in "".join(x.text or "" for x in outputs["pii"])
    texts = {x.doc_id: x.text for x in outputs["pii"]}
    total = {}
    for x in outputs["packing"]:
        total[x.doc_id] = total.get(x.doc_id, 0) + x.length
    assert total == dict(zip(texts, map(len, ids_of(texts.values()))))
    whole = corpus_pipeline.run(spark, folder).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(whole, key=str) == sorted(((x.doc_id, x.piece, x.ids_crc32) for x in outputs["packing"]), key=str)


def test_clashing_columns(spark, tmp_path):
    """Columns named like any that the stages use are passed on as they are; null and huge texts, ties and repeated rows too."""
    folder = str(tmp_path)
    tables(spark, folder)
    names = ["spans", "base_spans", "found", "_key", "_text", "_probes", "_email", "_own_spans", "_ranges", "id", "n", "class", "prefix", "sketch", "root", "score", "ids", "piece"]
    now = spark.read.parquet(f"{folder}/documents.parquet")
    now = now.unionByName(spark.createDataFrame([(900, "word " * 60_000, "en", "src", 300_000)] * 2, now.schema)).withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in names})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, folder)
        if name == "packing":
            assert out.count() >= now.count()
            break
        assert out.columns == now.columns
        out.write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        rows = now.collect()
        assert rows and all(r[c] == f"{c} {'none' if r.doc_id is None else r.doc_id}" for r in rows for c in names)


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_spans_add_up(spark):
    df = spark.createDataFrame([("a1bb22ccc333",)], "t string")
    found = df.select(spans.find(F.col("t"), "n", "[0-9]+").alias("s")).first().s
    assert [(x.start, x.stop, x.match) for x in found] == [(1, 2, "1"), (4, 6, "22"), (9, 12, "333")]
    assert pii.BASE_KINDS == ("email", "ip", "card", "phone")
