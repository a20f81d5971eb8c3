"""Following numbered change files: the store, the split outputs, bounded catch-up and replay."""

import os

import pytest
from pyspark.sql import functions as F

from graphshed import tool
from graphshed.sinks import files
from graphshed.sources import replication, xml
from graphshed.streaming import replicate

WEST = "west\n1\n -20 -10\n -10 -10\n -10 10\n -20 10\nEND\nEND\n"
INNER = "inner\n1\n -15 -5\n -5 -5\n -5 5\n -15 5\nEND\nEND\n"

DIFFS = [
    '<create><node id="1" lat="0" lon="-12"/><node id="2" lat="0" lon="50"/><way id="10"><nd ref="1"/><nd ref="2"/></way></create>',
    '<modify><node id="1" lat="0" lon="-9.95"/></modify><create><relation id="20"><member type="way" ref="10" role=""/></relation></create>',
    '<delete><node id="2" lat="0" lon="50"/></delete><modify><node id="1" lat="0" lon="40"/></modify>',
]


@pytest.fixture
def place(spark, tmp_path):
    diffs, polygons = tmp_path / "diffs", tmp_path / "polygons"
    for n, body in enumerate(DIFFS, 1):
        path = diffs / f"{replication.path_of(n)}.osc"
        os.makedirs(path.parent, exist_ok=True)
        path.write_text(f'<osmChange version="0.6">{body}</osmChange>')
        files.publish_state(str(diffs), n, f"{replication.path_of(n)}.state.txt")
    os.makedirs(polygons / "west" / "pass")
    (polygons / "west.poly").write_text(WEST)
    (polygons / "west" / "pass" / "inner.poly").write_text(INNER)
    t = tool.Tool(spark, str(tmp_path / "store"))
    t.init()
    return t, str(diffs), tool.split_of(spark, str(polygons), str(tmp_path / "out")), tmp_path


def output(spark, tmp_path, name, n):
    path = f"{tmp_path}/out/{name}/minute/{replication.path_of(n)}.osc.gz"
    return [(r.elem_type, r.id, r.action) for r in xml.read(spark, path).orderBy("pos").collect()]


def test_follow_split_and_replay(spark, place):
    t, diffs, split, top = place
    done = []
    replicate.follow(t.snapshots, diffs, f"{top}/checkpoint", most=1, split=split, on_batch=done.append)
    assert done == [1] and t.snapshots.current() == 1
    replicate.follow(t.snapshots, diffs, f"{top}/checkpoint", most=1, split=split, on_batch=done.append)
    assert done == [1]
    replicate.follow(t.snapshots, diffs, f"{top}/checkpoint", split=split, on_batch=done.append)
    assert done == [1, 2, 3] and t.snapshots.current() == 3
    assert replication.read_state(f"{top}/out/west/minute/state.txt") == 3
    # 1: node 1 and the way are inside both; 2: node 1 moves into the first one's buffer; 3: it moves away.
    assert output(spark, top, "west", 1) == [("node", 1, "create"), ("way", 10, "create")]
    assert output(spark, top, "west/pass/inner", 1) == [("node", 1, "create"), ("way", 10, "create")]
    assert output(spark, top, "west", 2) == [("node", 1, "delete"), ("relation", 20, "create")]
    # The inner polygon has the node's new place, but what came out above is kept or deleted there first.
    assert output(spark, top, "west/pass/inner", 2)[0][:2] == ("node", 1)
    assert output(spark, top, "west", 3) == [("node", 1, "delete")]
    nodes = {r.id: r.lon_e7 for r in t.snapshots.read().nodes.collect()}
    assert nodes == {1: 400_000_000}
    # The last sequence again, as after a crash before its offset was written: nothing changes.
    again = xml.read(spark, f"{diffs}/{replication.path_of(3)}.osc")
    replicate.step(t.snapshots, again, 3, split)
    assert {r.id: r.lon_e7 for r in t.snapshots.read().nodes.collect()} == nodes
    assert output(spark, top, "west", 3) == [("node", 1, "delete")]
    assert t.snapshots.versions() == ([0], [1, 2, 3])
    t.snapshots.write(t.snapshots.read(), 3)
    t.snapshots.forget(keep=1)
    assert t.snapshots.versions() == ([3], [])
    assert {r.id: r.lon_e7 for r in t.snapshots.read().nodes.collect()} == nodes


def files_of(folder):
    return {(top, n): os.stat(os.path.join(top, n)).st_mtime_ns for top, _, names in os.walk(folder) for n in names}


def test_a_sequence_writes_its_own_rows_only(spark, tmp_path):
    """The base's files stay as they are; the delta has the touched ids; many deltas become a base; all versions read alike."""
    n = 5000
    nodes = spark.range(n).select("id", (F.col("id") * 10).alias("lat_e7"), F.col("id").alias("lon_e7"))
    ways = spark.range(100).select("id", F.array(F.col("id"), F.col("id") + 1).alias("nodes"))
    relations = tool.empty(spark).relations
    snapshots = replicate.Snapshots(spark, str(tmp_path), deltas_most=3)
    snapshots.init(tool.Store(nodes, ways, relations))
    before = files_of(snapshots.path(0))
    assert snapshots.written == {"nodes": n, "ways": 100, "relations": 0}
    model = {i: i * 10 for i in range(n)}
    for sequence in range(1, 6):
        body = f'<modify><node id="{sequence}" lat="0" lon="{sequence}"/><node id="7" lat="0" lon="{sequence}"/></modify><delete><node id="{100 + sequence}" lat="0" lon="0"/></delete><create><node id="{n + sequence}" lat="0" lon="0"/></create>'
        path = tmp_path / f"{sequence}.osc"
        path.write_text(f'<osmChange version="0.6">{body}</osmChange>')
        replicate.step(snapshots, xml.read(spark, str(path)), sequence)
        for i in (sequence, 7, n + sequence):
            model[i] = 0
        del model[100 + sequence]
        assert spark.read.parquet(f"{snapshots.delta_path(sequence)}/nodes").count() == 4
        assert spark.read.parquet(f"{snapshots.delta_path(sequence)}/ways").count() == 0
        assert snapshots.written["nodes"] - n == 4 * sequence + n * (sequence >= 4)
        assert {r.id: r.lat_e7 for r in snapshots.read().nodes.collect()} == model
        assert snapshots.read().ways.count() == 100
    assert files_of(snapshots.path(0)) == before
    assert snapshots.versions() == ([0, 4], [1, 2, 3, 4, 5])
    assert snapshots.read(2).nodes.where("id in (101, 102, 103)").count() == 1
    snapshots.forget(keep=2)
    assert snapshots.versions() == ([4], [5])
    with pytest.raises(FileNotFoundError):
        snapshots.read(2)


def test_follow_an_address(spark, place, tmp_path):
    """Change files come over HTTP, broken off once, and are applied once each."""
    import functools
    import gzip
    import http.server
    import threading

    t, diffs, split, top = place
    served, asked = tmp_path / "served", []
    for n in (1, 2, 3):
        path = replication.path_of(n)
        os.makedirs(os.path.dirname(served / path), exist_ok=True)
        with open(f"{diffs}/{path}.osc", "rb") as f:
            (served / f"{path}.osc.gz").write_bytes(gzip.compress(f.read()))
        files.publish_state(str(served), n, f"{path}.state.txt")

    class Handler(http.server.SimpleHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            asked.append(self.path)
            if self.path.endswith("002.osc.gz") and asked.count(self.path) == 1:
                self.send_error(503)
                return
            super().do_GET()

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(Handler, directory=str(served)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    address = f"http://127.0.0.1:{server.server_port}/"
    try:
        replicate.follow(t.snapshots, address, f"{top}/checkpoint", most=1, split=split)
        assert t.snapshots.current() == 1
        replicate.follow(t.snapshots, address, f"{top}/checkpoint", split=split)
        replicate.follow(t.snapshots, address, f"{top}/checkpoint", split=split)
    finally:
        server.shutdown()
    assert t.snapshots.current() == 3
    assert {r.id: r.lon_e7 for r in t.snapshots.read().nodes.collect()} == {1: 400_000_000}
    assert output(spark, top, "west", 3) == [("node", 1, "delete")]
    assert asked.count("/000/000/002.osc.gz") == 2 and asked.count("/000/000/001.osc.gz") == 1


def test_listing(spark, place):
    _, diffs, *_ = place
    assert [r.sequence for r in replication.listing(spark, diffs).collect()] == [1, 2, 3]


def test_latest_positions(spark, tmp_path):
    schema = "id bigint, pos bigint, action string, lat_e7 bigint, lon_e7 bigint"
    for n, rows in enumerate([[(1, 0, "create", 1, 1), (2, 1, "create", 5, 5)], [(1, 2, "modify", 9, 9)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in{n}")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in*")
    q = replicate.latest_positions(stream).writeStream.outputMode("complete").format("memory").queryName("last_places").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.id, r.pos, r.lat_e7) for r in spark.table("last_places").where(F.col("pos").isNotNull()).collect()} == {(1, 2, 9), (2, 1, 5)}
