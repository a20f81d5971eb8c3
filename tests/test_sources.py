"""Files: change and snapshot XML, the binary format, polygons, states, publishing."""

import gzip
import os
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from graphshed import tool
from graphshed.functions import codecs, coords, geometry
from graphshed.operators import graph, polyfilter
from graphshed.operators import store as ops
from graphshed.sinks import files, pbf_files
from graphshed.sources import pbf, poly, relation_json, replication, xml
from graphshed.streaming import replicate

CHANGE = """<?xml version="1.0"?>
<osmChange version="0.6"><bounds minlat="1"/>
<!-- a comment -->
<modify><node id="1" version="2" lat="17.9031745" lon="-62.8363074" user="a &lt;b&gt; &quot;c&quot;" uid="0"/>
<node id="2" lat="1" lon="2"></node><node id="3"><tag k="n&amp;m" v="x'y"/></node></modify>
<delete><node id="4"/><way id="5"/></delete>
<modify><way id="6"><nd ref="1"/><nd ref="2"/><nd ref="1"/><bbox minlat="1" minlon="-2" maxlat="3.5" maxlon="4"/></way>
<relation id="7"><member type="way" ref="6" role="a&amp;b"/><member type="node" ref="1" role=""/><tag k="t" v="1"/><tag k="t" v="2"/></relation></modify>
</osmChange>"""


@pytest.fixture
def change_file(tmp_path):
    path = tmp_path / "c.osc.gz"
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(CHANGE)
    return str(path)


def test_change_xml(spark, change_file):
    rows = xml.read(spark, change_file).orderBy("pos").collect()
    assert [(r.pos, r.action, r.elem_type, r.id) for r in rows] == [(0, "modify", "node", 1), (1, "modify", "node", 2), (2, "modify", "node", 3), (3, "delete", "node", 4), (4, "delete", "way", 5), (5, "modify", "way", 6), (6, "modify", "relation", 7)]
    assert (rows[0].lat_e7, rows[0].lon_e7, rows[0].user, rows[0].uid, rows[0].version) == (179031745, -628363074, 'a <b> "c"', None, 2)
    assert rows[0].tags is None and rows[1].tags == [] and rows[2].tags[0].v == "x'y"
    assert (rows[3].lat_e7, rows[3].lon_e7) == (0, 0)
    assert rows[4].nodes == [] and rows[5].nodes == [1, 2, 1]
    assert tuple(rows[5].bbox) == (10000000, 35000000, -20000000, 40000000)
    assert [tuple(m) for m in rows[6].members] == [("way", 6, "a&b"), ("node", 1, "")] and len(rows[6].tags) == 2


def test_xml_round_trip(spark, change_file, tmp_path):
    rows = xml.read(spark, change_file).drop("file")
    out = str(tmp_path / "sub" / "d.osc.gz")
    files.write_xml(rows, out, modified=1000.0)
    assert os.path.getmtime(out) == 1000.0
    text = gzip.open(out, "rt", encoding="utf-8").read()
    assert text.count("<modify>") == 2 and text.count("<delete>") == 1
    assert xml.read(spark, out).drop("file").orderBy("pos").collect() == rows.orderBy("pos").collect()


def test_blocks_open_only_when_the_action_changes():
    row = lambda a: {"action": a, "elem_type": "way", "id": 1, "nodes": [], "members": None, "tags": [], "bbox": None} | dict.fromkeys(("version", "timestamp", "uid", "user", "changeset"))
    text = "".join(xml.document([row(a) for a in ("create", "create", "modify", "modify", None, "delete", "create")], True))
    assert [w for w in ("create", "modify", "delete") for _ in range(text.count(f"<{w}>"))] == ["create", "create", "modify", "delete"]
    with pytest.raises(ValueError):
        xml.Parser().feed(b"<osm><other/></osm>", True)


def test_degrees():
    for value in (0, 1, -1, 10, 179031745, -628363074, 1800000000, -1800000000):
        assert xml.e7(xml.degrees(value)) == value
    assert xml.e7("500") == 2**31 - 1 and xml.e7("0.00000005") == 1 and xml.e7("-0.00000005") == -1


def _field(number, value):
    if isinstance(value, int):
        return _int(number << 3) + _int(value)
    return _int(number << 3 | 2) + _int(len(value)) + value


def _int(value):
    out = b""
    while value > 127:
        out += bytes([value & 127 | 128])
        value >>= 7
    return out + bytes([value])


def _zig(values, delta=True):
    out, last = b"", 0
    for v in values:
        d = v - last if delta else v
        out += _int((d << 1) ^ (d >> 63) if d >= 0 else ((-d) << 1) - 1)
        last = v
    return out


def test_pbf(spark, tmp_path):
    strings = _field(1, b"") + _field(1, b"outer") + _field(1, b"k") + _field(1, b"v")
    dense = _field(8, _zig([179031745, -5])) + _field(1, _zig([10, 12])) + _field(9, _zig([-628363074, 7]))
    way = _field(1, 20) + _field(8, _zig([10, 12, 10]))
    rel = _field(1, 30) + _field(2, _int(2)) + _field(3, _int(3)) + _field(8, _int(1) + _int(0)) + _field(9, _zig([20, 10])) + _field(10, _int(1) + _int(0))
    data = _field(1, strings) + _field(2, _field(2, dense)) + _field(2, _field(3, way) + _field(4, rel))
    out = b""
    for kind, body in ((b"OSMHeader", _field(1, b"")), (b"OSMData", _field(2, len(data)) + _field(3, zlib.compress(data)))):
        head = _field(1, kind) + _field(3, len(body))
        out += struct.pack(">I", len(head)) + head + body
    path = tmp_path / "x.pbf"
    path.write_bytes(out)
    rows = {(r.elem_type, r.id): r for r in pbf.read(spark, str(path)).collect()}
    assert (rows["node", 10].lat_e7, rows["node", 10].lon_e7) == (179031745, -628363074)
    assert (rows["node", 12].lat_e7, rows["node", 12].lon_e7) == (-5, 7)
    assert rows["way", 20].nodes == [10, 12, 10]
    assert [tuple(m) for m in rows["relation", 30].members] == [("way", 20, "outer"), ("node", 10, "")]
    assert [tuple(t) for t in rows["relation", 30].tags] == [("k", "v")]
    t = tool.Tool(spark, str(tmp_path / "store"))
    t.init()
    t.import_(str(path))
    assert t.read("node", 12).first().found and not t.read("node", 11).first().found
    assert [r.ref for r in t.read("relation_full", 30).collect()] == [30, 20, 10]
    assert t.check().count() == 0


def test_pbf_written_and_read(spark, tmp_path):
    """Numbers of all sizes and signs, empty lists, roles and tags, in several files."""
    nodes = [(i, (-1) ** i * i * 7919 % 900_000_000, (-1) ** (i // 2) * i * 104_729) for i in range(1, 17_000)]
    ways = [(5, [1, 900, 3, 3]), (6, []), (10**12, [10**13, 1])]
    relations = [(-(i + 1) if i % 2 else i, [("way", 5, "outer"), ("node", -7, ""), ("relation", 10**12, "é")][: i % 4], [("k", "v"), ("é", "outer")][: i % 3]) for i in range(30)]
    store = tool.Store(
        spark.createDataFrame(nodes, "id bigint, lat_e7 bigint, lon_e7 bigint").repartition(3),
        spark.createDataFrame(ways, "id bigint, nodes array<bigint>"),
        spark.createDataFrame(relations, "id bigint, members array<struct<type:string,ref:bigint,role:string>>, tags array<struct<k:string,v:string>>"),
    )
    written = pbf_files.write(store, str(tmp_path / "out")).collect()
    assert sum(r.elements for r in written) == len(nodes) + len(ways) + len(relations)
    rows = pbf.read(spark, *(r.file for r in written)).collect()
    assert sorted((r.id, r.lat_e7, r.lon_e7) for r in rows if r.elem_type == "node") == nodes
    assert sorted((r.id, r.nodes) for r in rows if r.elem_type == "way") == ways
    found = sorted((r.id, [tuple(m) for m in r.members], [tuple(t) for t in r.tags]) for r in rows if r.elem_type == "relation")
    assert found == sorted(relations)


def test_old_layout(spark, tmp_path):
    """Flat files with gaps, ways out of order and freed places, relations in folders."""
    nodes = {1: (0, 0), 2: (-900_000_000, 1_800_000_000), 70_000: (5, -7)}
    ways = {3: [1, 2, 2], 9: [70_000, 2**39], 4: [2]}
    (tmp_path / "relation" / "000" / "000").mkdir(parents=True)
    data = bytearray(8 * 70_001)
    for i, (lat, lon) in nodes.items():
        data[8 * i : 8 * i + 8] = struct.pack(">II", lat + 1_800_000_000, lon + 1_800_000_000)
    (tmp_path / "node.crd").write_bytes(data)
    index, body = bytearray(5 * 10), b"--way--"
    for i, refs in ways.items():
        index[5 * i : 5 * i + 5] = len(body).to_bytes(5, "big")
        body += struct.pack(">H", len(refs)) + b"".join(n.to_bytes(5, "big") for n in refs) + b"freed"
    (tmp_path / "way.idx").write_bytes(index)
    (tmp_path / "way.data").write_bytes(body)
    (tmp_path / "relation" / "000" / "000" / "012").write_text('{"id":12,"member":[{"ref":9,"role":"outer","type":"way"}],"tag":{"k":"v"}}')
    t = tool.Tool(spark, str(tmp_path / "store"))
    t.init()
    t.import_(str(tmp_path))
    s = t.snapshots.read()
    assert {r.id: (r.lat_e7, r.lon_e7) for r in s.nodes.collect()} == nodes
    assert {r.id: r.nodes for r in s.ways.collect()} == ways
    assert [(r.id, [tuple(m) for m in r.members], [tuple(x) for x in r.tags]) for r in s.relations.collect()] == [(12, [("way", 9, "outer")], [("k", "v")])]


def test_check_names_the_path(spark):
    """A shortest path down to the element that lacks something."""
    rel = lambda i, *members: (i, [(k, ref, "") for k, ref in members])
    relations = [rel(1, ("relation", 2), ("relation", 3)), rel(2, ("relation", 3)), rel(3, ("way", 5), ("relation", 1), ("node", 99)), rel(4, ("relation", 77))]
    store = tool.Store(
        spark.createDataFrame([(1, 0, 0)], "id bigint, lat_e7 bigint, lon_e7 bigint"),
        spark.createDataFrame([(5, [1, 98])], "id bigint, nodes array<bigint>"),
        spark.createDataFrame(relations, "id bigint, members array<struct<type:string,ref:bigint,role:string>>"),
    )
    found = {(r.rel_id, r.missing_type, r.missing_id): (r.elem_type, r.id, r.path) for r in ops.check(store).collect()}
    assert found[1, "node", 99] == ("relation", 3, [1, 3]) and found[2, "node", 99] == ("relation", 3, [2, 3])
    assert found[1, "node", 98] == ("way", 5, [1, 3]) and found[3, "node", 98] == ("way", 5, [3])
    assert found[4, "relation", 77] == ("relation", 4, [4]) and len(found) == 7


def test_deep_trees(spark):
    """A tree of any depth is read whole."""
    n = 130
    relations = [(i, [("relation", i + 1, "")]) for i in range(n)] + [(n, [("node", 1, "")])]
    store = tool.Store(*tool.empty(spark).__dict__.values())
    store.nodes = spark.createDataFrame([(1, 0, 0)], "id bigint, lat_e7 bigint, lon_e7 bigint")
    store.relations = spark.createDataFrame(relations, "id bigint, members array<struct<type:string,ref:bigint,role:string>>")
    tree = graph.relation_tree(store, spark.createDataFrame([(0,)], "id bigint")).collect()
    assert len(tree) == n + 2 and max(r.depth for r in tree) == n + 1 and all(r.found for r in tree)


def test_polygons(spark, tmp_path):
    text = "name\n1\n 0 0\n\t1e1  0\n 10 10\n 0 0\nEND\n!2\n 1 1\n 2 1\n 1 1\nEND\nEND\n"
    for path in ("a.poly", "a/b/c.poly", "z/d.poly"):
        os.makedirs(os.path.dirname(tmp_path / path), exist_ok=True)
        (tmp_path / path).write_text(text)
    tree = poly.tree(spark, str(tmp_path))
    names = [r.hier_name for r in tree.orderBy("seq").collect()]
    assert names == [".", "./a", "./a/b", "./a/b/c", "./z", "./z/d"]
    assert polyfilter.effective_parents([tuple(r) for r in tree.select("hier_name", "parent", "file").collect()]) == {"./a": None, "./a/b/c": "./a", "./z/d": None}
    rings = poly.rings(poly.read_texts(spark, tree))
    assert rings.where("poly = './a' and seq = 1").first().lon_e7 == 100000000
    assert rings.groupBy("poly").count().collect()[0]["count"] == 4
    assert poly.rings(poly.read_texts(spark, tree), honor_holes=True).where("hole").count() == 9
    with pytest.raises(ValueError):
        list(poly.sections("n\n1\n 0 0\n"))


def square(spark, *rings):
    return spark.createDataFrame([("p", r, i, x, y) for r, ring in enumerate(rings) for i, (x, y) in enumerate(ring)], "poly string, ring int, seq int, lon_e7 bigint, lat_e7 bigint")


def test_geometry(spark):
    a = [(0, 0), (100, 0), (100, 50), (50, 50), (50, 100), (0, 100)]
    rings = square(spark, a, [(x + 200, y) for x, y in a] + [(200, 0)])
    inside = [(0, 0), (50, 50), (100, 25), (25, 100), (50, 75), (1, 1), (225, 25), (300, 50)]
    outside = [(51, 51), (101, 0), (-1, 50), (150, 25), (25, 101)]
    points = spark.createDataFrame([(x, y) for x, y in inside + outside], "lon_e7 bigint, lat_e7 bigint")
    assert {tuple(r)[:2] for r in geometry.points_in(points, rings).collect()} == set(inside)
    boxes = {(60, 60, 70, 70): False, (60, 60, 60, 60): False, (10, 10, 10, 10): True, (40, 60, 40, 60): True, (-10, 400, -10, 400): True, (120, 130, 0, 100): False, (75, 75, 50, 50): True, (75, 75, -9, 400): True, (50, 50, 100, 150): True, (51, 60, 100, 150): False}
    rows = spark.createDataFrame([(i, *b) for i, b in enumerate(boxes)], "id int, minlat bigint, maxlat bigint, minlon bigint, maxlon bigint")
    boxed = rows.select("id", coords.box(*(F.col(s) for s in coords.SIDES)).alias("bbox"))
    found = {r.id for r in geometry.boxes_meeting(boxed, rings).collect()}
    assert found == {i for i, want in enumerate(boxes.values()) if want}
    wide = square(spark, [(-1_700_000_000, -800_000_000), (1_700_000_000, -800_000_000), (1_700_000_000, 800_000_000), (-1_700_000_000, 800_000_000)])
    assert geometry.points_in(points, wide).count() == len(inside + outside)


def test_codecs(spark):
    df = spark.createDataFrame([(0x1223456789,), (0,), (2**40 - 1,)], "v bigint").select("v", codecs.to_bytes(F.col("v"), 5).alias("h"))
    assert [r.h for r in df.collect()] == ["1223456789", "0000000000", "FFFFFFFFFF"]
    assert df.where(codecs.from_bytes(F.col("h")) != F.col("v")).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        spark.createDataFrame([(2**40,)], "v bigint").select(codecs.to_bytes(F.col("v"), 5)).collect()
    paths = spark.createDataFrame([(0,), (1234,), (123456789,), (789000000,), (1234567890,)], "v bigint").select(codecs.digit_path(F.col("v")).alias("p"))
    assert [r.p for r in paths.collect()] == ["000/000/000", "000/001/234", "123/456/789", "789/000/000", "1234/567/890"]
    names = spark.createDataFrame([("a/b.osc.gz",), ("b.osm",), ("c.osm.pbf",), ("d.txt",)], "v string").select(codecs.compact_path(F.col("v")).alias("p"))
    assert [r.p for r in names.collect()] == ["a/b", "b", "c", "d.txt"]


def test_states(spark, tmp_path):
    assert replication.sequence_of("#x\nsequenceNumber=42\ny=1") == 42
    for text in ("", "x=1", "sequenceNumber=a"):
        with pytest.raises(replication.StateIncorrect):
            replication.sequence_of(text)
    with pytest.raises(replication.StateNotFound):
        replication.read_state(str(tmp_path / "none"))
    rows = spark.createDataFrame([(3, 9, 5), (7, 9, 5), (7, 9, None)], "a bigint, b bigint, c bigint")
    assert [list(r.s) for r in rows.select(replication.pending(F.col("a"), F.col("b"), F.col("c")).alias("s")).collect()] == [[4, 5], [], [8, 9]]
    assert replication.path_of(1234567890) == "234/567/890"
    files.publish_state(str(tmp_path), 7, "000/000/007.state.txt")
    files.publish_state(str(tmp_path), 7, "000/000/007.state.txt")
    assert replication.read_state(str(tmp_path / "state.txt")) == 7
    replication.fetch(str(tmp_path / "state.txt"), str(tmp_path / "copy"))
    assert replication.read_state(str(tmp_path / "copy")) == 7


def test_relation_json(spark):
    rows = [(1, [("way", 2, "a")], None, None), (2, [], [], 3), (3, [("node", 1, "")], [("k", "v"), ("k", "w")], None)]
    df = spark.createDataFrame(rows, "id bigint, members array<struct<type:string,ref:bigint,role:string>>, tags array<struct<k:string,v:string>>, version bigint")
    texts = {r.id: r.j for r in df.select("id", relation_json.encode(df).alias("j")).collect()}
    assert texts[1] == '{"id":1,"member":[{"ref":2,"role":"a","type":"way"}],"tag":null}'
    assert texts[2] == '{"id":2,"member":[],"tag":{},"version":3}'
    assert texts[3] == '{"id":3,"member":[{"ref":1,"role":"","type":"node"}],"tag":{"k":"w"}}'


def test_file_types(spark):
    with pytest.raises(tool.NotSupportedFileType):
        tool.elements(spark, "x.pbf", change=True)
    with pytest.raises(tool.NotSupportedFileType):
        tool.elements(spark, "x.csv", change=False)


def test_one_writer(tmp_path):
    with replicate.single_writer(str(tmp_path)), pytest.raises(BlockingIOError), replicate.single_writer(str(tmp_path)):
        pass


def test_update_and_filter(spark, change_file, tmp_path):
    t = tool.Tool(spark, str(tmp_path / "store"))
    t.init()
    t.init()
    t.update(change_file)
    assert t.read("way", 6).first().nodes == [1, 2, 1] and not t.read("node", 4).first().found
    assert [tuple(r) for r in t.check().collect()] == []
    (tmp_path / "p.poly").write_text("p\n1\n -63 17\n -62 17\n -62 18\n -63 18\nEND\nEND\n")
    out = str(tmp_path / "f.osc")
    tool.filter_file(spark, change_file, out, t.snapshots.read(), str(tmp_path / "p.poly"))
    assert [(r.elem_type, r.id, r.action) for r in xml.read(spark, out).orderBy("pos").collect()] == [("node", 1, "modify"), ("way", 6, "modify"), ("relation", 7, "modify")]
