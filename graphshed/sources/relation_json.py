"""Relations as JSON documents: members under ``member``, tags as an object or null, absent metadata left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphshed.model import BOX

SCHEMA = f"id bigint, member array<struct<ref:bigint,role:string,type:string>>, tag map<string,string>, version bigint, timestamp string, uid bigint, user string, changeset bigint, bbox {BOX}"
META = ("version", "timestamp", "uid", "user", "changeset")


def encode(relations: DataFrame) -> Column:
    """The document of a row of a relation table."""
    member = F.transform("members", lambda m: F.struct(m["ref"].alias("ref"), m["role"].alias("role"), m["type"].alias("type")))
    # The last of equal keys stays, as in a map that is filled in order.
    pairs = F.map_from_entries(F.filter("tags", lambda t, i: ~F.exists(F.slice("tags", i + 2, F.size("tags")), lambda u: u["k"] == t["k"])))
    head = F.to_json(F.struct(F.col("id"), member.alias("member")))
    tag = F.when(F.col("tags").isNull(), F.lit("null")).otherwise(F.coalesce(F.to_json(pairs), F.lit("{}")))
    rest = F.to_json(F.struct(*(c for c in META if c in relations.columns), *(["bbox"] if "bbox" in relations.columns else [])))
    return F.concat(F.substr(head, F.lit(1), F.length(head) - 1), F.lit(',"tag":'), tag, F.when(rest != "{}", F.concat(F.lit(","), F.substr(rest, F.lit(2), F.length(rest) - 2))).otherwise(""), F.lit("}"))


def decode(json: Column) -> Column:
    """A struct (id, members, tags, version, ...); an object of tags comes as pairs in its order."""
    d = F.from_json(json, SCHEMA)
    members = F.transform(d["member"], lambda m: F.struct(m["type"].alias("type"), m["ref"].alias("ref"), m["role"].alias("role")))
    tags = F.transform(F.map_entries(d["tag"]), lambda t: F.struct(t["key"].alias("k"), t["value"].alias("v")))
    return F.struct(d["id"].alias("id"), members.alias("members"), tags.alias("tags"), *(d[c].alias(c) for c in META), d["bbox"].alias("bbox"))
