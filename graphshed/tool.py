"""The library's entry points in one place: a store to import into, update, read and check, and one-shot transforms.

    python -m graphshed.tool store --dir DIR [--import FILE|DIR] [--update FILE] [--read TYPE ID] [--check START]
    python -m graphshed.tool xml --source FILE --dest FILE (--bbox | --filter POLY) --store DIR
    python -m graphshed.tool split --source FILE --polygons DIR --store DIR --dest DIR --sequence N
    python -m graphshed.tool update --store DIR (--diffs DIR | --url-diffs ADDRESS) [--polygons DIR --dest DIR] [--max-state N]
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphshed.model import MEMBERS, Store, of_type
from graphshed.operators import bbox, graph, polyfilter
from graphshed.operators import store as ops
from graphshed.plans.lineage import cut
from graphshed.sinks import files
from graphshed.sources import legacy, pbf, poly, xml
from graphshed.streaming import replicate


class NotSupportedFileType(ValueError):
    """A file whose name has no known ending."""


def elements(spark: SparkSession, path: str, change: bool) -> DataFrame:
    """The elements of a file by its ending: .pbf, .osm, .osm.gz to import; .osm, .osc, also packed, to update with."""
    if not change and path.endswith(".pbf"):
        return pbf.read(spark, path)
    endings = (".osm", ".osm.gz", ".osc", ".osc.gz") if change else (".osm", ".osm.gz")
    if path.endswith(endings):
        return xml.read(spark, path)
    raise NotSupportedFileType(path)


def store_of(rows: DataFrame) -> Store:
    """A snapshot's elements as a store."""
    return Store(of_type(rows, "node").select("id", "lat_e7", "lon_e7"), of_type(rows, "way").select("id", "nodes"), of_type(rows, "relation").select("id", "members", "tags"))


def empty(spark: SparkSession) -> Store:
    tags = "array<struct<k:string,v:string>>"
    return Store(*(spark.createDataFrame([], s) for s in ("id bigint, lat_e7 bigint, lon_e7 bigint", "id bigint, nodes array<bigint>", f"id bigint, members {MEMBERS}, tags {tags}")))


class Tool:
    """A store in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.snapshots = spark, replicate.Snapshots(spark, folder)
        os.makedirs(folder, exist_ok=True)

    def init(self) -> None:
        """An empty store; does nothing to one that is there."""
        self.snapshots.init(empty(self.spark))

    def import_(self, path: str) -> None:
        """A snapshot file, or a folder with a store in the old layout."""
        with replicate.single_writer(self.snapshots.folder):
            loaded = legacy.read(self.spark, path) if os.path.isdir(path) else store_of(elements(self.spark, path, change=False))
            parts = {name: getattr(loaded, name).withColumn("elem_type", F.lit(name[:-1])) for name in replicate.TABLES}
            old = self.snapshots.read()
            fresh = Store(*(getattr(old, n).join(parts[n].select("id"), "id", "left_anti").unionByName(parts[n].drop("elem_type")) for n in replicate.TABLES))
            self.snapshots.write(fresh, self.snapshots.current() + 1)

    def update(self, path: str) -> None:
        with replicate.single_writer(self.snapshots.folder):
            replicate.step(self.snapshots, elements(self.spark, path, change=True), self.snapshots.current() + 1)

    def read(self, kind: str, number: int) -> DataFrame:
        """A node, way, relation, or the tree of a relation (relation_full)."""
        store, ids = self.snapshots.read(), self.spark.createDataFrame([(number,)], "id bigint")
        if kind == "relation_full":
            return graph.relation_tree(store, ids).orderBy("path")
        return ops.lookup(getattr(store, f"{kind}s"), ids)

    def check(self, start: int = 0) -> DataFrame:
        return ops.check(self.snapshots.read(), start)


def annotate_file(spark: SparkSession, source: str, dest: str, store: Store) -> None:
    files.write_xml(cut(bbox.annotate(elements(spark, source, change=True).drop("file"), store)), dest)


def filter_file(spark: SparkSession, source: str, dest: str, store: Store, polygon: str) -> None:
    """Keeps what is inside a polygon. Boxes are worked out first, also where the source has some: those of another store may differ."""
    rings = cut(poly.rings(spark.read.text(polygon, wholetext=True).select(F.lit("poly").alias("poly"), F.col("value").alias("text"))))
    rows = elements(spark, source, change=True).drop("file")
    boxed = bbox.annotate(rows, store)
    files.write_xml(cut(polyfilter.filter_changes(cut(boxed), store, rings).drop("poly")), dest)


def split_of(spark: SparkSession, polygons: str, dest: str) -> replicate.Split:
    tree = poly.tree(spark, polygons)
    return replicate.Split(tree, cut(poly.rings(poly.read_texts(spark, tree))), dest)


def print_rows(rows: DataFrame) -> None:
    """All rows as lines of JSON, read from Spark partition by partition."""
    for row in rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("line")).toLocalIterator():
        print(row.line)


def main(argv: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="graphshed")
    subs = top.add_subparsers(dest="what", required=True)
    a = subs.add_parser("store")
    a.add_argument("--dir", required=True)
    a.add_argument("--init", action="store_true")
    a.add_argument("--import", dest="source")
    a.add_argument("--update")
    a.add_argument("--read", nargs=2, metavar=("TYPE", "ID"))
    a.add_argument("--check", type=int)
    a = subs.add_parser("xml")
    for name in ("--source", "--dest", "--store"):
        a.add_argument(name, required=True)
    way = a.add_mutually_exclusive_group(required=True)
    way.add_argument("--bbox", action="store_true")
    way.add_argument("--filter", metavar="POLY")
    a = subs.add_parser("split")
    for name in ("--source", "--polygons", "--store", "--dest"):
        a.add_argument(name, required=True)
    a.add_argument("--sequence", type=int, required=True)
    a = subs.add_parser("update")
    a.add_argument("--store", required=True)
    way = a.add_mutually_exclusive_group(required=True)
    way.add_argument("--diffs")
    way.add_argument("--url-diffs")
    a.add_argument("--polygons")
    a.add_argument("--dest")
    a.add_argument("--max-state", type=int)
    given = top.parse_args(argv)
    spark = SparkSession.builder.appName("graphshed").getOrCreate()
    if given.what == "store":
        tool = Tool(spark, given.dir)
        tool.init()
        if given.source:
            tool.import_(given.source)
        if given.update:
            tool.update(given.update)
        if given.read:
            print_rows(tool.read(given.read[0], int(given.read[1])))
        if given.check is not None:
            print_rows(tool.check(given.check))
        print("rows written: " + ", ".join(f"{n} {name}" for name, n in tool.snapshots.written.items()))
        return
    tool = Tool(spark, given.store)
    tool.init()
    if given.what == "xml":
        if given.bbox:
            annotate_file(spark, given.source, given.dest, tool.snapshots.read())
        else:
            filter_file(spark, given.source, given.dest, tool.snapshots.read(), given.filter)
    elif given.what == "split":
        split, store = split_of(spark, given.polygons, given.dest), tool.snapshots.read()
        rows = cut(bbox.annotate(elements(spark, given.source, change=True).drop("file"), store))
        replicate.publish(polyfilter.hierarchy(rows, store, split.tree, split.rings), split, given.sequence)
    else:
        split = split_of(spark, given.polygons, given.dest) if given.polygons else None
        replicate.follow(tool.snapshots, given.diffs or given.url_diffs, os.path.join(given.store, "checkpoint"), given.max_state, split)


if __name__ == "__main__":
    main()
