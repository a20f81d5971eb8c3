"""The driver's tables as a graph, a change file and polygons.

Parts are nodes, orders with their line items are ways, customers, nations and
regions are relations of three levels with one cycle (nation 0 has region 0 as
a member); events and all parts, orders, customers, nations and regions are the
rows of a change file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphshed.model import MEMBERS, Store

CUSTOMERS, NATIONS, REGIONS = 1_000_000_000, 2_000_000_000, 3_000_000_000
#: Positions of the parts of the change file.
WAY_POS, LATE_POS, CUSTOMER_POS, NATION_POS, REGION_POS = 1_000_000_000, 2_000_000_000, 3_000_000_000, 4_000_000_000, 5_000_000_000
#: Ids that no table has.
MISSING_NODE, MISSING_WAY, MISSING_RELATION = 9_000_000_001, 9_000_000_002, 9_000_000_003

#: Polygon texts by place in the tree, in degrees (lon lat): an L, two rings of which one reaches out of the place above, a hole, nested places, a place far away.
POLYGONS = {
    "./west": "west\n1\n -170 -60\n -20 -60\n -20 10\n -100 10\n -100 70\n -170 70\n -170 -60\nEND\nEND\n",
    "./west/inner/south": "south\n1\n -1.5E+02 -55\n -60 -55\n -60 -5\n -150 -5\n -150 -55\nEND\nEND\n",
    "./west/north": "north\n1\n -165 15\n -110 15\n -110 65\n -165 65\n -165 15\nEND\n2\n -40 -4\n 60 -4\n 60 5\n -40 5\n -40 -4\nEND\n!3\n -140 30\n -120 30\n -120 50\n -140 50\n -140 30\nEND\nEND\n",
    "./east": "east\n1\n 20 -70\n 170 -70\n 170 70\n 95 -20\n 20 70\n 20 -70\nEND\nEND\n",
}
#: The tree: (hier_name, parent, has a polygon).
TREE = [
    (".", None, False),
    ("./west", ".", True),
    ("./west/inner", "./west", False),
    ("./west/inner/south", "./west/inner", True),
    ("./west/north", "./west", True),
    ("./east", ".", True),
]


@dataclass
class Tables:
    """The driver's tables of one directory."""

    spark: SparkSession
    sf_dir: str

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def nodes(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("bigint")
    lat, lon = (key * 1103515245) % 1600000001 - 800000000, (key * 1664525013) % 3600000001 - 1800000000
    return t["part"].select(key.alias("id"), lat.alias("lat_e7"), lon.alias("lon_e7"))


def ways(t: Tables, dangling: bool = False) -> DataFrame:
    """Orders with the parts of their items in a fixed order; with dangling, some end in a node that is missing."""
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    lists = t["lineitem"].groupBy(F.col("l_orderkey").alias("id")).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["l_partkey"].cast("bigint")).alias("nodes"))
    out = t["orders"].select(F.col("o_orderkey").cast("bigint").alias("id")).join(lists, "id", "left").withColumn("nodes", F.coalesce("nodes", F.array().cast("array<bigint>")))
    if dangling:
        out = out.withColumn("nodes", F.when(F.col("id") % 1000 == 7, F.concat("nodes", F.array(F.lit(MISSING_NODE)))).otherwise(F.col("nodes")))
    return out


def _member(kind: str, ref: str, role: str):
    return F.struct(F.lit(kind).alias("type"), F.col(ref).cast("bigint").alias("ref"), F.lit(role).alias("role"))


def _related(rows: DataFrame, owners: DataFrame, key: str) -> DataFrame:
    """(id, members) from (key, member), members by ref; owners without any have an empty list."""
    lists = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("m.ref"), F.col("m")))).alias("x"))
    return owners.join(lists, key, "left").select(key, F.coalesce(F.transform("x", lambda x: x["m"]), F.array().cast(MEMBERS)).alias("members"))


def relations(t: Tables, dangling: bool = False) -> DataFrame:
    orders = t["orders"].select((F.col("o_custkey") + CUSTOMERS).cast("bigint").alias("id"), _member("way", "o_orderkey", "order").alias("m"))
    customers = t["customer"].select((F.col("c_custkey") + CUSTOMERS).cast("bigint").alias("id"))
    one = _related(orders, customers, "id")
    in_nation = t["customer"].select((F.col("c_nationkey") + F.lit(NATIONS)).cast("bigint").alias("id"), (F.col("c_custkey") + CUSTOMERS).alias("ref")).select("id", _member("relation", "ref", "customer").alias("m"))
    nation_ids = t["nation"].select((F.col("n_nationkey") + F.lit(NATIONS)).cast("bigint").alias("id"))
    cycle = nation_ids.where(F.col("id") == NATIONS).select("id", F.struct(F.lit("relation").alias("type"), F.lit(REGIONS).alias("ref"), F.lit("region").alias("role")).alias("m"))
    two = _related(in_nation.unionAll(cycle), nation_ids, "id")
    in_region = t["nation"].select((F.col("n_regionkey") + F.lit(REGIONS)).cast("bigint").alias("id"), (F.col("n_nationkey") + F.lit(NATIONS)).cast("bigint").alias("ref")).select("id", _member("relation", "ref", "nation").alias("m"))
    three = _related(in_region, t["region"].select((F.col("r_regionkey") + F.lit(REGIONS)).cast("bigint").alias("id")), "id")
    out = one.unionByName(two).unionByName(three)
    if dangling:
        extra = F.array(*(F.struct(F.lit(k).alias("type"), F.lit(ref).cast("bigint").alias("ref"), F.lit("lost").alias("role")) for k, ref in (("node", MISSING_NODE), ("way", MISSING_WAY), ("relation", MISSING_RELATION))))
        out = out.withColumn("members", F.when(F.col("id") % 500 == 3, F.concat("members", extra)).otherwise(F.col("members")))
    return out


def store(t: Tables, dangling: bool = False) -> Store:
    return Store(nodes(t), ways(t, dangling), relations(t, dangling))


def _element(elem_type: str, pos, action, id_, lat=None, lon=None, node_list=None, members=None) -> list:
    none = F.lit(None)
    return [
        pos.cast("bigint").alias("pos"),
        action.alias("action"),
        F.lit(elem_type).alias("elem_type"),
        id_.cast("bigint").alias("id"),
        (none if lat is None else lat).cast("bigint").alias("lat_e7"),
        (none if lon is None else lon).cast("bigint").alias("lon_e7"),
        (none if node_list is None else node_list).cast("array<bigint>").alias("nodes"),
        (none if members is None else members).cast(MEMBERS).alias("members"),
        none.cast("struct<minlat:bigint,maxlat:bigint,minlon:bigint,maxlon:bigint>").alias("bbox"),
    ]


def node_changes(t: Tables) -> DataFrame:
    """Events as node rows, which lie before the ways, and all nodes, which move after them. Deletes have no coordinates, so they stand at (0, 0)."""
    n = t["part"].count()
    action = F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "error", "delete").otherwise("modify")
    events = t["events"].select(F.col("event_id").alias("pos"), action.alias("action"), (F.col("user_id") * 13 % n).alias("id"), F.round(F.col("value") * 10000).cast("bigint").alias("shift"))
    moved = events.join(nodes(t), "id", "left")
    stays = F.col("action") != "delete"
    lat, lon = F.when(stays, F.col("lat_e7") + F.col("shift")).otherwise(0), F.when(stays, F.col("lon_e7") - F.col("shift")).otherwise(0)
    first = moved.select(*_element("node", F.col("pos"), F.col("action"), F.col("id"), lat, lon))
    late = nodes(t).select(*_element("node", F.col("id") + LATE_POS, F.lit("modify"), F.col("id"), F.col("lat_e7") + 1000000, F.col("lon_e7")))
    return first.unionAll(late)


def way_changes(t: Tables) -> DataFrame:
    """Every order with its nodes turned around; every seventieth as a delete without nodes."""
    gone = F.col("id") % 70 == 0
    rows = ways(t)
    node_list = F.when(gone, F.array().cast("array<bigint>")).otherwise(F.reverse("nodes"))
    return rows.select(*_element("way", F.col("id") + WAY_POS, F.when(gone, "delete").otherwise("modify"), F.col("id"), node_list=node_list))


def relation_changes(t: Tables) -> DataFrame:
    """All customers without their first order but with a node, then all nations and regions as they are."""
    n = t["part"].count()
    rel = relations(t)
    level = F.floor(F.col("id") / 1_000_000_000)
    key = F.col("id") % 1_000_000_000
    node = F.array(F.struct(F.lit("node").alias("type"), (key * 7 % n).cast("bigint").alias("ref"), F.lit("place").alias("role")))
    some = rel.where(level == 1).withColumn("members", F.concat(F.when(F.size("members") > 0, F.slice("members", F.lit(2), F.size("members"))).otherwise(F.col("members")), node))
    pos = {1: CUSTOMER_POS, 2: NATION_POS, 3: REGION_POS}
    parts = [some, rel.where(level == 2), rel.where(level == 3)]
    rows = [p.select(*_element("relation", key + pos[i], F.lit("modify"), F.col("id"), members=F.col("members"))) for i, p in enumerate(parts, 1)]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


def changes(t: Tables) -> DataFrame:
    return node_changes(t).unionAll(way_changes(t)).unionAll(relation_changes(t))


def polygon_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(POLYGONS.items()), "poly string, text string")


def tree(spark: SparkSession) -> DataFrame:
    rows = [(name, parent, f"{name}.poly" if has else None, name.count("/")) for name, parent, has in TREE]
    return spark.createDataFrame(rows, "hier_name string, parent string, file string, depth int")


