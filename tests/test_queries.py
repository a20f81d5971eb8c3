"""Queries on tables that are larger, or hold larger numbers, than the stand-ins'."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from graphshed.plans import queries
from graphshed.plans import testmap as T
from graphshed.sources import xml


def test_numbers_beyond_five_bytes(spark, tmp_path):
    """Numbers of more than five bytes have more digits and come back; none is an error."""
    keys = [0, 1, 15_061, 15_062, 150_000, 9_000_000, -1, None]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    found = {r.id: (r.hex, r.back) for r in entry.queries()["codec_bytes5"](spark, str(tmp_path)).collect()}
    wanted = {k: (f"{k * 73000001 & (1 << 64) - 1:010X}", k * 73000001) for k in keys if k is not None}
    assert found == wanted | {None: (None, None)}


def test_paths_of_long_numbers(spark, tmp_path):
    """A path has the first nine digits, however long the number is."""
    keys = [0, 1, 126_278, 126_279, 9_000_000, 10**10, None]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    found = {r.id: r.path for r in entry.queries()["relation_path"](spark, str(tmp_path)).collect()}
    digits = {k: f"{k * 7919:09d}" for k in keys if k is not None}
    assert found == {k: f"{d[:3]}/{d[3:6]}/{d[6:9]}" for k, d in digits.items()} | {None: None}


def test_snapshot_documents_stay_small(spark, tmp_path):
    """More rows make more documents, not longer ones; a long element has a document of its own, and all come back."""
    n = 30_000
    one = F.lit(1)
    spark.range(n).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 40).alias("o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(n).select(F.col("id").alias("l_orderkey"), one.alias("l_linenumber"), F.col("id").alias("l_partkey"), one.cast("bigint").alias("l_suppkey"), F.lit(None).cast("timestamp").alias("l_shipdate"), F.lit(1.0).alias("l_extendedprice")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).select(F.col("id").alias("c_custkey"), F.lit(0).alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, 0)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0,)], "r_regionkey int").write.parquet(f"{tmp_path}/region.parquet")
    texts = [r.xml for r in queries._snapshot_xml(T.Tables(spark, str(tmp_path))).collect()]
    assert max(sum(text.count(f"<{kind} ") for kind in ("node", "way", "relation")) for text in texts) <= 3 * queries.DOCUMENT_IDS
    # Customers have 750 orders each.
    assert max(text.count("<member ") for text in texts) == 750
    run = entry.queries()
    assert sorted(r.id for r in run["scan_nodes"](spark, str(tmp_path)).collect()) == list(range(n))
    assert {(r.id, r.nodes) for r in run["scan_ways"](spark, str(tmp_path)).collect()} == {(i, str(i)) for i in range(n)}
    assert {r.id: r.n_members for r in run["scan_relations"](spark, str(tmp_path)).collect()} == {T.CUSTOMERS + i: 750 for i in range(40)} | {T.NATIONS: 41, T.REGIONS: 1}


def test_long_documents_are_parsed_in_pieces(spark):
    """Chunks end anywhere, also within a letter; rows are the same as of the whole."""
    text = '<osmChange version="0.6"><create>' + "".join(f'<node id="{i}" lat="1" lon="2"><tag k="é" v="日本{i}"/></node>\n<node id="{i}" lat="1" lon="2"/><node id="{i}" lat="1" lon="2"></node>' for i in range(3000)) + "</create></osmChange>"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "n int, xml string")
    found = [(r.n, r.pos, r.id, r.tags if r.tags is None else [tuple(t) for t in r.tags]) for r in xml.parse(df).orderBy("pos").collect()]
    assert found == [(1, 3 * i + k, i, ([("é", f"日本{i}")], None, [])[k]) for i in range(3000) for k in range(3)]
