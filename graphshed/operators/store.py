"""The element store: lookups, upserts and deletes, integrity checks.

Lookups are joins on id. A change file is applied as a whole: the last row of
an id decides, rows it touches leave the old table by an anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphshed.model import Store, of_type


def lookup(table: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, found, and the table's other columns as nulls where it isn't) for every row of ids."""
    there = table.withColumn("found", F.lit(True))
    return ids.join(there, "id", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def cache(table: DataFrame, touched: DataFrame) -> DataFrame:
    """The rows of a table that a set of ids needs; ids that the table lacks stay, as found = false."""
    return lookup(table, touched.select("id").distinct())


def cached(snapshot: DataFrame, ids: DataFrame) -> DataFrame:
    """Lookup in what ``cache`` kept. An id that was never asked for is an error; one that was and is missing is not."""
    known = snapshot.withColumn("known", F.lit(True))
    failed = F.raise_error(F.concat(F.lit("not cached: "), F.col("id").cast("string"))).cast("boolean")
    return ids.join(known, "id", "left").withColumn("found", F.when(F.col("known"), F.col("found")).otherwise(failed)).drop("known")


def latest(changes: DataFrame) -> DataFrame:
    """Of the rows of each element the one with the largest pos."""
    order = Window.partitionBy("elem_type", "id").orderBy(F.col("pos").desc())
    return changes.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def last_rows(table: DataFrame, changes: DataFrame, elem_type: str) -> DataFrame:
    """What a change file leaves of the ids it touches: the table's columns of the last row of each, and ``gone`` if that deletes."""
    last = latest(of_type(changes, elem_type))
    return last.select(*(F.col(c).cast(table.schema[c].dataType) for c in table.columns), (F.coalesce("action", F.lit("")) == "delete").alias("gone"))


def replaced(table: DataFrame, last: DataFrame) -> DataFrame:
    """The table with the rows of ``last`` (as ``last_rows`` gives them) in place of its own."""
    return table.join(last.select("id"), "id", "left_anti").unionByName(last.where("not gone").drop("gone"))


def upsert(table: DataFrame, changes: DataFrame, elem_type: str) -> DataFrame:
    """The table after a change file: touched ids go, the last row of each id comes in unless it deletes."""
    return replaced(table, last_rows(table, changes, elem_type))


def apply(store: Store, changes: DataFrame) -> Store:
    return Store(upsert(store.nodes, changes, "node"), upsert(store.ways, changes, "way"), upsert(store.relations, changes, "relation"))


def dangling_way_nodes(store: Store) -> DataFrame:
    """(way_id, pos, node_id) of places whose node is missing."""
    return store.way_nodes().join(store.nodes.select(F.col("id").alias("node_id")), "node_id", "left_anti").select("way_id", "pos", "node_id")


def dangling_members(store: Store) -> DataFrame:
    """(rel_id, pos, type, ref) of members that are missing from the table of their type."""
    there = store.nodes.select(F.lit("node").alias("type"), F.col("id").alias("ref"))
    there = there.unionAll(store.ways.select(F.lit("way"), "id")).unionAll(store.relations.select(F.lit("relation"), "id"))
    return store.members().join(there, ["type", "ref"], "left_anti").select("rel_id", "pos", "type", "ref")


def check(store: Store, start: int = 0) -> DataFrame:
    """(rel_id, elem_type, id, missing_type, missing_id, path): what the relations from ``start``'s thousand on reach that is missing.

    A relation is checked with all relations below it; ``elem_type`` and ``id``
    name the element that has the missing one, ``path`` the relations from
    ``rel_id`` down to it, by a shortest way.
    """
    from graphshed.operators.graph import closure

    roots = store.relations.where(F.col("id") >= start - start % 1000).select("id")
    reached = closure(roots, store, paths=True)
    members = dangling_members(store).select(F.col("rel_id").alias("rel"), "type", "ref")
    direct = reached.join(members, "rel").select(F.col("root").alias("rel_id"), F.lit("relation").alias("elem_type"), F.col("rel").alias("id"), F.col("type").alias("missing_type"), F.col("ref").alias("missing_id"), "path")
    ways = store.members().where("type = 'way'").select(F.col("rel_id").alias("rel"), F.col("ref").alias("way_id"))
    nodes = reached.join(ways, "rel").groupBy("root", "way_id").agg(F.min(F.struct(F.size("path").alias("n"), "path"))["path"].alias("path")).join(dangling_way_nodes(store), "way_id")
    return direct.unionAll(nodes.select(F.col("root"), F.lit("way"), "way_id", F.lit("node"), "node_id", "path")).distinct()


def counts(store: Store) -> DataFrame:
    """(elem_type, n, places): elements of each type, and nodes of ways or members of relations."""
    parts = (("node", store.nodes, F.lit(0)), ("way", store.ways, F.size("nodes")), ("relation", store.relations, F.size("members")))
    rows = [t.agg(F.lit(kind).alias("elem_type"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(places), F.lit(0)).cast("bigint").alias("places")) for kind, t, places in parts]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


def way_sizes(store: Store) -> DataFrame:
    """(n_nodes, n_ways)."""
    return store.ways.groupBy(F.size("nodes").alias("n_nodes")).agg(F.count(F.lit(1)).alias("n_ways"))


def unsorted(rows: DataFrame, parts: Column, order: str = "pos") -> DataFrame:
    """Rows whose id is smaller than the one before within a part of the input (a file, a block): bulk loads must be in order."""
    w = Window.partitionBy(parts).orderBy(order)
    return rows.withColumn("before", F.lag("id").over(w)).where("id < before")


def action_runs(changes: DataFrame, parts: list[str]) -> DataFrame:
    """The rows with ``run``, counted from 1: a new one begins where the action differs from the last action before; a null action begins none."""
    w = Window.partitionBy(*parts).orderBy("pos")
    before = F.last("action", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.col("action").isNotNull() & ~F.col("action").eqNullSafe(F.col("_before"))
    return changes.withColumn("_before", before).withColumn("run", F.sum(begins.cast("int")).over(w)).drop("_before")
