"""One query for each operator, over the driver's tables (see testmap)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphshed.functions import codecs, coords, geometry
from graphshed.model import BOX, MEMBERS, TAGS, Store, of_type
from graphshed.operators import bbox, graph, polyfilter
from graphshed.operators import store as ops
from graphshed.plans import testmap as T
from graphshed.plans.lineage import cut, fresh_folder
from graphshed.sinks import files, pbf_files
from graphshed.sources import pbf, poly, relation_json, replication, xml
from graphshed.streaming import replicate

def no_meta() -> dict:
    """Metadata columns without values."""
    return {c: F.lit(None).cast(k) for c, k in (("version", "bigint"), ("timestamp", "string"), ("uid", "bigint"), ("user", "string"), ("changeset", "bigint"))}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[T.Tables], DataFrame]) -> Callable:
    """Registers a query over tables under its own name."""
    QUERIES[f.__name__] = lambda spark, sf_dir: f(T.Tables(spark, sf_dir))
    return f


def sides(box="bbox") -> list:
    return [F.col(f"{box}.{s}").alias(s) for s in coords.SIDES]


# Sources and sinks

#: Ids of a snapshot document, and the nodes or members from which an element has one of its own.
DOCUMENT_IDS, LONG = 1000, 100


def _snapshot_xml(t: T.Tables) -> DataFrame:
    """(bucket, xml): the store as snapshot documents, written by our own renderer."""
    s = T.store(t)
    none = F.lit(None)
    meta = [c.alias(name) for name, c in no_meta().items()]
    tags = F.array(F.struct(F.lit("name").alias("k"), F.concat(F.lit('a<b & "c" é '), F.col("id").cast("string")).alias("v")))

    def rows(kind: str, table: DataFrame) -> DataFrame:
        have = {c: F.col(c) for c in table.columns}
        empty = {"lat_e7": "bigint", "lon_e7": "bigint", "nodes": "array<bigint>", "members": MEMBERS}
        return table.select(
            F.col("id").alias("pos"), none.cast("string").alias("action"), F.lit(kind).alias("elem_type"), "id",
            *(have.get(c, none.cast(k)).alias(c) for c, k in empty.items()),
            F.when(F.col("id") % 3 == 0, tags).alias("tags") if kind == "node" else tags.alias("tags"),
            *meta, none.cast(BOX).alias("bbox"),
        )

    every = rows("node", s.nodes).unionAll(rows("way", s.ways)).unionAll(rows("relation", s.relations))
    # A document is held whole, so it has a range of ids, and what is long is a document of its own: more rows make more documents.
    places = F.greatest(F.size("nodes"), F.size("members"))
    bucket = F.when(places > LONG, F.concat_ws(" ", "elem_type", "id")).otherwise(F.floor(F.col("id") / DOCUMENT_IDS).cast("string"))
    return xml.render_documents(every.withColumn("bucket", bucket), ["bucket"], change=False)


def _scanned(t: T.Tables, kind: str) -> DataFrame:
    return of_type(xml.parse(_snapshot_xml(t)), kind)


@query
def scan_nodes(t):
    return _scanned(t, "node").select("id", "lat_e7", "lon_e7", F.size(F.coalesce("tags", F.array().cast(TAGS))).cast("bigint").alias("n_tags"), F.get("tags", F.lit(0))["v"].alias("tag"))


@query
def scan_ways(t):
    return _scanned(t, "way").select("id", F.size("nodes").cast("bigint").alias("n_nodes"), F.concat_ws(",", "nodes").alias("nodes"))


@query
def scan_relations(t):
    shown = F.transform("members", lambda m: F.concat_ws(":", m["type"], m["ref"].cast("string"), m["role"]))
    return _scanned(t, "relation").select("id", F.size("members").cast("bigint").alias("n_members"), F.concat_ws(",", shown).alias("members"))


def _change_xml(t: T.Tables) -> DataFrame:
    full = T.changes(t).withColumns(no_meta())
    full = full.withColumn("tags", F.lit(None).cast(TAGS)).withColumn("bucket", F.floor(F.col("pos") / 2000))
    return xml.render_documents(full, ["bucket"], change=True)


@query
def scan_changes(t):
    found = xml.parse(_change_xml(t))
    return found.select("bucket", F.col("pos").alias("place"), "action", "elem_type", "id", "lat_e7", "lon_e7", F.concat_ws(",", "nodes").alias("nodes"), F.concat_ws(",", _refs()).alias("members"))


@query
def scan_pbf_projection(t):
    """What the binary source keeps of the store, written as binary files and read again: coordinates, node lists, members."""
    written = pbf_files.write(T.store(t), fresh_folder(t.spark, "pbf"))
    rows = pbf.read(t.spark, *(r.file for r in written.collect()))
    places, refs = F.coalesce(F.size("nodes"), F.size("members")), F.coalesce(F.get("nodes", F.lit(0)), F.get("members", F.lit(0))["ref"])
    node = F.col("elem_type") == "node"
    return rows.select("elem_type", "id", F.when(node, F.col("lat_e7")).otherwise(places.cast("bigint")).alias("a"), F.when(node, F.col("lon_e7")).otherwise(refs).alias("b"))


def _asked(t: T.Tables, step: int = 7) -> DataFrame:
    return t["part"].select((F.col("p_partkey") * step).cast("bigint").alias("id"))


@query
def lookup_node(t):
    return ops.lookup(T.nodes(t), _asked(t))


@query
def lookup_way(t):
    return ops.lookup(T.ways(t), _asked(t, 11)).select("id", "found", F.concat_ws(",", "nodes").alias("nodes"))


@query
def lookup_relation(t):
    ids = t["customer"].select((F.col("c_custkey") * 3 + T.CUSTOMERS).cast("bigint").alias("id"))
    return ops.lookup(T.relations(t), ids).select("id", "found", F.size("members").cast("bigint").alias("n_members"))


@query
def cache_lookup(t):
    kept = ops.cache(T.nodes(t), _asked(t))
    return ops.cached(kept, _asked(t))


@query
def relation_json_roundtrip(t):
    rel = T.relations(t).withColumn("tags", F.when(F.col("id") % 3 == 0, F.array(F.struct(F.lit("name").alias("k"), F.col("id").cast("string").alias("v")))))
    rel = rel.withColumn("version", F.when(F.col("id") % 2 == 0, F.col("id") % 9 + 1))
    back = rel.select(relation_json.encode(rel).alias("json")).select(relation_json.decode(F.col("json")).alias("r"))
    shown = F.transform("r.members", lambda m: F.concat_ws(":", m["type"], m["ref"].cast("string"), m["role"]))
    return back.select("r.id", F.concat_ws(",", shown).alias("members"), F.get("r.tags", F.lit(0))["v"].alias("name"), "r.version")


@query
def poly_rings(t):
    found = poly.rings(T.polygon_texts(t.spark))
    return found.groupBy("poly", "ring").agg(F.count(F.lit(1)).alias("n_points"), F.min("lon_e7").alias("minlon"), F.max("lat_e7").alias("maxlat"))


@query
def poly_coords(t):
    return poly.rings(T.polygon_texts(t.spark)).select("poly", F.col("ring").cast("bigint").alias("ring"), F.col("seq").cast("bigint").alias("seq"), "lon_e7", "lat_e7")


@query
def poly_tree_walk(t):
    """The tree as it is read from a folder of polygon files."""
    top = fresh_folder(t.spark, "polygons")
    for name, text in T.POLYGONS.items():
        os.makedirs(os.path.dirname(f"{top}/{name}"), exist_ok=True)
        with open(f"{top}/{name}.poly", "w", encoding="utf-8") as f:
            f.write(text)
    tree = poly.tree(t.spark, top)
    parents = polyfilter.effective_parents([tuple(r) for r in tree.select("hier_name", "parent", "file").collect()])
    rows = t.spark.createDataFrame(list(parents.items()), "hier_name string, above string")
    return tree.join(rows, "hier_name", "left").select("hier_name", "parent", F.regexp_replace("file", "^.*/polygons-[^/]+/", "").alias("file"), F.col("depth").cast("bigint").alias("depth"), "above")


@query
def state_parse(t):
    text = F.concat(F.lit("#now\nsequenceNumber="), F.col("event_id").cast("string"), F.lit("\ntimestamp=2020\n"))
    return replication.states(t["events"].select(text.alias("value"))).select("sequence")


@query
def diff_listing(t):
    return t["events"].select(F.col("event_id").alias("sequence"), F.concat(codecs.sequence_path(F.col("event_id")), F.lit(".osc.gz")).alias("file"))


@query
def xml_roundtrip(t):
    """All change rows with boxes through XML and back."""
    at = F.col("pos") % 1_000_000_000
    rows = T.changes(t).withColumns(no_meta())
    rows = rows.withColumn("tags", F.array().cast(TAGS)).withColumn("bbox", coords.box(at, at + 5, -at, at * 2)).withColumn("bucket", F.floor(F.col("pos") / 5000))
    back = xml.parse(xml.render_documents(rows, ["bucket"]))
    return back.select("elem_type", "id", "action", "lat_e7", "lon_e7", F.concat_ws(",", F.coalesce(F.col("nodes").cast("array<string>"), _refs(), F.array().cast("array<string>"))).alias("refs"), *sides())


def _refs():
    """type:ref of members."""
    return F.transform("members", lambda m: F.concat_ws(":", m["type"], m["ref"].cast("string")))


def _rendered(rows: DataFrame) -> DataFrame:
    """(id, xml) of snapshot elements, each as XML of its own."""
    none = F.lit(None)
    return xml.render_rows(rows.select("elem_type", "id", *(c if c in rows.columns else none.cast(k).alias(c) for c, k in (("version", "bigint"), ("timestamp", "string"), ("uid", "bigint"), ("user", "string"), ("changeset", "bigint"), ("lat_e7", "bigint"), ("lon_e7", "bigint"), ("nodes", "array<bigint>"), ("members", MEMBERS), ("tags", TAGS), ("bbox", BOX))))).select("id", "xml")


@query
def xml_render_node(t):
    rows = T.nodes(t).select(F.lit("node").alias("elem_type"), "id", (F.col("lat_e7") * 0 + F.col("id")).alias("lat_e7"), (-F.col("id") * 10000000).alias("lon_e7"))
    return _rendered(rows)


@query
def xml_render_way(t):
    return _rendered(T.ways(t).select(F.lit("way").alias("elem_type"), "id", "nodes"))


@query
def xml_render_relation(t):
    return _rendered(T.relations(t).select(F.lit("relation").alias("elem_type"), "id", "members"))


@query
def action_runs(t):
    rows = t["events"].select(F.col("event_id").alias("pos"), F.col("user_id"), F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "error", "delete").otherwise("modify").alias("action"))
    return ops.action_runs(rows, ["user_id"]).select("pos", "user_id", "action", F.col("run").cast("bigint").alias("run"))


# The store


@query
def apply_nodes(t):
    return ops.upsert(T.nodes(t), T.changes(t), "node")


@query
def apply_ways(t):
    return ops.upsert(T.ways(t), T.changes(t), "way").select("id", F.concat_ws(",", "nodes").alias("nodes"))


@query
def apply_relations(t):
    shown = F.transform("members", lambda m: F.concat_ws(":", m["type"], m["ref"].cast("string")))
    return ops.upsert(T.relations(t), T.changes(t), "relation").select("id", F.concat_ws(",", shown).alias("members"))


@query
def apply_deletes(t):
    gone = ops.latest(T.changes(t)).where("action = 'delete'")
    return gone.select("elem_type", "id", "pos")


@query
def apply_diff(t):
    return ops.counts(ops.apply(T.store(t), T.changes(t)))


@query
def latest_change(t):
    return ops.latest(T.changes(t)).select("elem_type", "id", "pos", "action")


@query
def store_counts(t):
    return ops.counts(T.store(t))


@query
def way_size_histogram(t):
    return ops.way_sizes(T.store(t)).select(F.col("n_nodes").cast("bigint").alias("n_nodes"), "n_ways")


@query
def sorted_input_check(t):
    rows = t["events"].select(F.col("event_id").alias("pos"), (F.col("user_id") * 13).alias("id"), F.floor(F.col("event_id") / 1000).alias("part"))
    return ops.unsorted(rows, F.col("part")).select("pos", "id", "before")


@query
def dangling_way_nodes(t):
    return ops.dangling_way_nodes(T.store(t, dangling=True)).select("way_id", F.col("pos").cast("bigint").alias("pos"), "node_id")


@query
def dangling_members(t):
    return ops.dangling_members(T.store(t, dangling=True)).select("rel_id", "type", "ref")


@query
def check_relations_from(t):
    return ops.check(T.store(t, dangling=True), T.NATIONS + 5).select("rel_id", "elem_type", "id", "missing_type", "missing_id", F.element_at("path", 1).alias("path_from"), F.element_at("path", -1).alias("path_to"))


# Graph


@query
def way_full(t):
    full = graph.way_full(T.store(t, dangling=True)).select("id", F.explode("nodes").alias("n"))
    return full.select("id", F.col("n.pos").cast("bigint").alias("pos"), F.col("n.id").alias("node_id"), "n.lat_e7", "n.lon_e7")


@query
def way_assemble(t):
    places = T.store(t).way_nodes()
    return graph.assemble(places, "way_id", "pos", "node_id").select("way_id", F.concat_ws(",", "items").alias("nodes"))


@query
def member_type_split(t):
    parts = graph.split_members(T.store(t).members())
    rows = [p.groupBy("type", "rel_id").agg(F.count(F.lit(1)).alias("n"), F.max("ref").alias("last")) for p in parts.values()]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


@query
def relation_full(t):
    """Everything that every region reaches, cycles and all."""
    s = T.store(t)
    found = graph.relation_members(s, s.relations.where(F.col("id") >= T.REGIONS).select("id"))
    return found.groupBy("root", "type").agg(F.count(F.lit(1)).alias("n"), F.sum("ref").cast("bigint").alias("refs"))


@query
def relation_tree(t):
    """The trees of all relations, level by level."""
    s = T.store(t)
    tree = graph.relation_tree(s, s.relations.select("id"))
    return tree.groupBy("depth", "type", "found").agg(F.count(F.lit(1)).alias("n"), F.sum("ref").cast("bigint").alias("refs")).withColumn("depth", F.col("depth").cast("bigint"))


@query
def seen_sets(t):
    touched = polyfilter.Touched(T.changes(t), T.store(t))
    sizes = [d.agg(F.lit(kind).alias("type"), F.countDistinct("id").alias("n"), F.coalesce(F.sum("id"), F.lit(0)).cast("bigint").alias("ids")) for kind, d in (("node", touched.nodes), ("way", touched.way_nodes.select("id").distinct()), ("relation", touched.rel_members.select("id").distinct()))]
    return sizes[0].unionAll(sizes[1]).unionAll(sizes[2])


# Functions


@query
def coord_to_e7(t):
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_extendedprice", coords.to_e7(F.col("l_extendedprice") / 1000 - F.col("l_quantity")).alias("e7")).groupBy("e7").agg(F.count(F.lit(1)).alias("n"))


@query
def e7_to_coord(t):
    return T.nodes(t).select("id", coords.to_degrees(F.col("lat_e7")).alias("lat"), coords.to_degrees(F.col("lon_e7")).alias("lon"))


def _boxed(t: T.Tables) -> DataFrame:
    """Two boxes for each node, one of them null for some."""
    lat, lon = F.col("lat_e7"), F.col("lon_e7")
    a = F.when(F.col("id") % 5 != 0, coords.box(lat, lat + F.col("id"), lon, lon + 2000000))
    b = F.when(F.col("id") % 7 != 0, coords.box(lon % 800000000 - 5, lon % 800000000 + 5, lat, lat + 10))
    return T.nodes(t).select("id", "lat_e7", "lon_e7", a.alias("a"), b.alias("b"))


@query
def bbox_degrees(t):
    return _boxed(t).select("id", coords.degrees(F.col("a")).alias("d")).select("id", "d.minlat", "d.maxlat", "d.minlon", "d.maxlon")


@query
def bbox_union_pair(t):
    return _boxed(t).where("a is not null and b is not null").select("id", coords.union(F.col("a"), F.col("b")).alias("bbox")).select("id", *sides())


@query
def bbox_union_null(t):
    return _boxed(t).select("id", coords.union(F.col("a"), F.col("b")).alias("bbox")).select("id", *sides())


@query
def bbox_expand_point(t):
    return _boxed(t).select("id", coords.expand(F.col("a"), F.col("lon_e7") % 900000000, F.col("lat_e7")).alias("bbox")).select("id", *sides())


@query
def bbox_to_ring(t):
    points = _boxed(t).where("a is not null").select("id", F.posexplode(coords.ring(F.col("a"))).alias("seq", "p"))
    return points.select("id", F.col("seq").cast("bigint").alias("seq"), "p.lon", "p.lat")


@query
def codec_bytes5(t):
    """Numbers as five bytes, those that don't fit with more digits."""
    shown = t["orders"].select(F.col("o_orderkey").cast("bigint").alias("id"), (F.col("o_orderkey") * 73000001).cast("bigint").alias("value")).withColumn("hex", codecs.to_hex(F.col("value"), 10))
    return shown.select("id", "hex", codecs.from_bytes(F.col("hex")).alias("back"))


@query
def codec_coord4(t):
    shown = T.nodes(t).select("id", codecs.coord_to_bytes(F.col("lon_e7")).alias("hex"))
    return shown.select("id", "hex", codecs.coord_from_bytes(F.col("hex")).alias("back"))


@query
def relation_path(t):
    return t["orders"].select(F.col("o_orderkey").cast("bigint").alias("id"), codecs.nine_digit_path(F.col("o_orderkey") * 7919).alias("path"))


@query
def sequence_path(t):
    return t["orders"].select(F.col("o_orderkey").cast("bigint").alias("id"), codecs.sequence_path(F.col("o_orderkey").cast("bigint") * 79193).alias("path"))


@query
def pending_sequences(t):
    """For each customer the sequences between what it has and what there is, up to a largest one."""
    rows = t["customer"].select(F.col("c_custkey").cast("bigint").alias("current"), (F.col("c_custkey") + F.col("c_nationkey")).cast("bigint").alias("remote"))
    return rows.select("current", F.explode(replication.pending(F.col("current"), F.col("remote"), F.lit(1000).cast("bigint"))).alias("sequence"))


# Geometry


def _rings(t: T.Tables) -> DataFrame:
    return cut(poly.rings(T.polygon_texts(t.spark)))


@query
def point_in_polygon(t):
    return geometry.points_in(T.nodes(t), _rings(t)).select("id", "poly")


@query
def point_in_buffer(t):
    return geometry.points_in(T.nodes(t), _rings(t), geometry.BUFFER).select("id", "poly")


def _test_boxes(t: T.Tables) -> DataFrame:
    """Boxes of all sizes, also points and lines."""
    lat, lon = F.col("lat_e7"), F.col("lon_e7")
    high, wide = F.when(F.col("id") % 4 < 2, F.col("id") % 97 * 3000000).otherwise(0), F.when(F.col("id") % 2 == 0, F.col("id") % 89 * 4000000).otherwise(0)
    return T.nodes(t).select("id", coords.box(lat, lat + high, lon, lon + wide).alias("bbox"))


@query
def bbox_intersects_polygon(t):
    return geometry.boxes_meeting(_test_boxes(t), _rings(t)).select("id", "poly")


@query
def bbox_gate(t):
    return geometry.gated(_test_boxes(t), _rings(t), geometry.BUFFER).select("id", "poly")


@query
def ways_in_poly(t):
    inside = geometry.points_in(T.nodes(t), _rings(t)).select(F.col("id").alias("node_id"), "poly")
    return T.store(t).way_nodes().select("way_id", "node_id").join(inside, "node_id").select("poly", "way_id").distinct()


@query
def relations_in_poly(t):
    s = T.store(t)
    return polyfilter.relations_meeting(s, geometry.points_in(s.nodes, _rings(t)).select("id", "poly"))


# Boxes, filter, hierarchy


@query
def bbox_nodes(t):
    return bbox.node_boxes(T.changes(t), T.store(t))


@query
def bbox_ways(t):
    return bbox.way_boxes(T.changes(t), T.store(t))


def _kept(t: T.Tables) -> tuple[DataFrame, Store]:
    """The change file and the store as tables of their own, as they are outside of these stand-ins."""
    s = T.store(t)
    return cut(T.changes(t)), Store(cut(s.nodes), cut(s.ways), cut(s.relations))


@query
def bbox_relations(t):
    changes, s = _kept(t)
    return bbox.relation_boxes(changes, s, cut(bbox.way_boxes(changes, s)))


def _annotated(t: T.Tables) -> tuple[DataFrame, Store]:
    changes, s = _kept(t)
    return cut(bbox.annotate(changes, s)), s


@query
def filter_split(t):
    changes, s = _annotated(t)
    return polyfilter.filter_changes(changes, s, _rings(t)).select("poly", "pos", "elem_type", "id", "action")


@query
def split_hierarchy(t):
    changes, s = _annotated(t)
    return polyfilter.hierarchy(changes, s, T.tree(t.spark), _rings(t)).select("poly", "pos", "elem_type", "id", "action")


@query
def split_summary(t):
    changes, s = _annotated(t)
    return polyfilter.hierarchy(changes, s, T.tree(t.spark), _rings(t)).groupBy("poly", "elem_type", "action").agg(F.count(F.lit(1)).alias("n"))


# Streaming


def _numbered(t: T.Tables) -> tuple[str, replicate.Snapshots]:
    """The change file as four numbered ones in a folder with a state, and a fresh store beside it."""
    top = fresh_folder(t.spark, "stream")
    rows = cut(T.changes(t).withColumns({**no_meta(), "tags": F.lit(None).cast(TAGS)}))
    half = t["events"].count() // 2
    ends = [half, T.WAY_POS, T.LATE_POS, 1 << 62]
    numbers = range(1, len(ends) + 1)
    # All files at once: the change file is gone through once, not for each.
    name = F.coalesce(*(F.when(F.col("pos") < end, F.lit(str(n))) for n, end in zip(numbers, ends)))
    files.write_xml_files(rows.withColumn("_file", name), {str(n): f"{top}/diffs/{replication.path_of(n)}.osc.gz" for n in numbers}, "_file")
    for n in numbers:
        files.publish_state(f"{top}/diffs", n, f"{replication.path_of(n)}.state.txt")
    snapshots = replicate.Snapshots(t.spark, os.path.join(top, "store"))
    os.makedirs(snapshots.folder)
    snapshots.init(T.store(t))
    return top, snapshots


@query
def stream_apply(t):
    """The store after a stream over four numbered change files."""
    top, snapshots = _numbered(t)
    replicate.follow(snapshots, f"{top}/diffs", f"{top}/checkpoint")
    return ops.counts(snapshots.read())


@query
def stream_replay(t):
    """Nodes after following up to a sequence, then the rest, then the last sequence once more as after a crash."""
    top, snapshots = _numbered(t)
    replicate.follow(snapshots, f"{top}/diffs", f"{top}/checkpoint", most=2)
    replicate.follow(snapshots, f"{top}/diffs", f"{top}/checkpoint")
    again = xml.read(t.spark, f"{top}/diffs/{replication.path_of(4)}.osc.gz")
    replicate.step(snapshots, again, 4)
    return snapshots.read().nodes.select("id", "lat_e7", "lon_e7")
