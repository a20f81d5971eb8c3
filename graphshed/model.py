"""Schemas of the node / way / relation graph and of its change files.

Coordinates are integers of 1e-7 degrees (``e7``). Tags are ordered pairs, null
where an element was written without content. Change rows keep the order of
their file in ``pos``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAGS = "array<struct<k:string,v:string>>"
MEMBERS = "array<struct<type:string,ref:bigint,role:string>>"
BOX = "struct<minlat:bigint,maxlat:bigint,minlon:bigint,maxlon:bigint>"
META = "version bigint, timestamp string, uid bigint, user string, changeset bigint"

NODE = f"id bigint, lat_e7 bigint, lon_e7 bigint, tags {TAGS}, {META}"
WAY = f"id bigint, nodes array<bigint>, tags {TAGS}, {META}"
RELATION = f"id bigint, members {MEMBERS}, tags {TAGS}, {META}"
#: An element of a snapshot or change file; what its type lacks is null.
ELEMENT = f"pos bigint, action string, elem_type string, id bigint, lat_e7 bigint, lon_e7 bigint, nodes array<bigint>, members {MEMBERS}, tags {TAGS}, {META}, bbox {BOX}"

# The types of elements and the actions of change rows.
ELEMENT_TYPES = ("node", "way", "relation")
ACTIONS = ("create", "modify", "delete")


@dataclass
class Store:
    """A snapshot of the graph.

    nodes (id, lat_e7, lon_e7), ways (id, nodes), relations (id, members) and
    whatever further columns they carry.
    """

    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame

    def way_nodes(self) -> DataFrame:
        """(way_id, pos, node_id), a row for each place in a way."""
        return self.ways.select(F.col("id").alias("way_id"), F.posexplode("nodes").alias("pos", "node_id"))

    def members(self) -> DataFrame:
        """(rel_id, pos, type, ref, role), a row for each place in a relation."""
        places = self.relations.select(F.col("id").alias("rel_id"), F.posexplode("members").alias("pos", "m"))
        return places.select("rel_id", "pos", "m.type", "m.ref", "m.role")


def of_type(elements: DataFrame, elem_type: str) -> DataFrame:
    return elements.where(F.col("elem_type") == elem_type)
