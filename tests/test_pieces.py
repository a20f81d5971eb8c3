"""Files that several tasks write and read."""

import gzip

import pytest
from pyspark.sql import functions as F

from graphshed.model import ELEMENT
from graphshed.sinks import files
from graphshed.sources import xml

N = 3000
ACTIONS = [None, "create", "create", None, "modify", "delete", "delete"]


def rows(spark):
    """Rows with runs of actions, of which the first and some others have none."""
    names = F.array(*(F.lit(a) for a in ACTIONS))
    own = spark.range(N).select(F.col("id").alias("pos"), F.get(names, (F.col("id") / 250).cast("int") % len(ACTIONS)).alias("action"))
    wanted = {c.split(" ")[0]: c.split(" ", 1)[1] for c in xml._fields(ELEMENT.replace(", ", ","))}
    values = {"elem_type": F.lit("way"), "id": F.col("pos") * 3, "nodes": F.array("pos", F.col("pos") + 1), "tags": F.array(F.struct(F.lit("é").alias("k"), F.lit("<").alias("v")))}
    return own.select(*(F.col(c) if c in own.columns else values.get(c, F.lit(None)).cast(k).alias(c) for c, k in wanted.items()))


@pytest.mark.parametrize("change", [True, False])
def test_written_and_read_in_pieces(spark, tmp_path, change, monkeypatch):
    """The text is that of one stream, the rows those of the whole file, and a task has a part of them."""
    wanted = [r.asDict(recursive=True) for r in rows(spark).orderBy("pos").collect()]
    text = "\n".join(xml.document(iter(wanted), change)) + "\n"
    monkeypatch.setattr(files, "SEGMENT_ROWS", 100)
    whole, plain = str(tmp_path / "a" / "w.osc.gz"), str(tmp_path / "a" / "w.osc")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for path in (whole, plain):
            files.write_xml(rows(spark).repartition(5), path, change, modified=1000.0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    with gzip.open(whole, "rt", encoding="utf-8") as f:
        assert f.read() == text
    assert open(plain, encoding="utf-8").read() == text
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["w.osc", "w.osc.gz"]
    read = [r for batch in xml._File(plain).elements() for r in batch]
    for size in (1, 500, 3000):
        found = xml.pieces(whole, size)
        assert len(found) > 2
        assert [r for piece in found for batch in piece.elements() for r in batch] == read
    assert xml.pieces(whole, 1 << 30)[0].size is None and len(xml.pieces(plain, 1)) == 1
    assert len(read) == N and [r[0] for r in read] == list(range(N))


def test_other_packed_files_are_read_whole(spark, tmp_path):
    path = tmp_path / "x.osc.gz"
    path.write_bytes(gzip.compress(b"<osmChange><create>") + gzip.compress(b'<node id="1" lat="1" lon="2"/></create></osmChange>'))
    assert len(xml.pieces(str(path), 1)) == 1
    assert [(r.id, r.action) for r in xml.read(spark, str(path)).collect()] == [(1, "create")]


def test_a_long_file_has_many_tasks(spark, tmp_path):
    """Packed text of several megabytes is not left to one task, neither as a table nor as a stream."""
    path = str(tmp_path / "000" / "000" / "001.osc.gz")
    noise = F.array(F.struct(F.lit("k").alias("k"), F.concat(*(F.sha2(F.concat("pos", F.lit(f" {i}")), 512) for i in range(40))).alias("v")))
    files.write_xml(rows(spark).limit(2000).withColumn("tags", noise).repartition(4), path)
    assert xml.read(spark, path).rdd.getNumPartitions() > 1
    assert [r.pos for r in xml.read(spark, path).select("pos").orderBy("pos").collect()] == list(range(2000))
