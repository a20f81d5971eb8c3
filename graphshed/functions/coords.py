"""Coordinates and boxes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

E7 = 10_000_000
INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def to_e7(degrees: Column) -> Column:
    """Degrees as an integer of 1e-7: rounded half away from zero, clamped to 32 bits."""
    return F.greatest(F.lit(INT_MIN), F.least(F.lit(INT_MAX), F.round(degrees * F.lit(1e7)))).cast("bigint")


def to_degrees(e7: Column) -> Column:
    return e7 * F.lit(1e-7)


def box(minlat: Column, maxlat: Column, minlon: Column, maxlon: Column) -> Column:
    """A box, null if there is no latitude."""
    parts = F.struct(minlat.cast("bigint").alias("minlat"), maxlat.cast("bigint").alias("maxlat"), minlon.cast("bigint").alias("minlon"), maxlon.cast("bigint").alias("maxlon"))
    return F.when(minlat.isNotNull(), parts)


def point_box(lat: Column, lon: Column) -> Column:
    return box(lat, lat, lon, lon)


def union(a: Column, b: Column) -> Column:
    """The smallest box around both; a null box adds nothing."""
    return box(F.least(a["minlat"], b["minlat"]), F.greatest(a["maxlat"], b["maxlat"]), F.least(a["minlon"], b["minlon"]), F.greatest(a["maxlon"], b["maxlon"]))


def expand(a: Column, lat: Column, lon: Column) -> Column:
    """The box grown to take in a point."""
    return union(a, point_box(lat, lon))


def degrees(a: Column) -> Column:
    return F.struct(*(to_degrees(a[c]).alias(c) for c in ("minlat", "maxlat", "minlon", "maxlon")))


def ring(a: Column) -> Column:
    """The box as a closed ring of five (lon, lat) points, counter-clockwise from the lower left."""
    corners = (("minlon", "minlat"), ("maxlon", "minlat"), ("maxlon", "maxlat"), ("minlon", "maxlat"), ("minlon", "minlat"))
    return F.array(*(F.struct(a[x].alias("lon"), a[y].alias("lat")) for x, y in corners))


def cover(lat: str = "lat_e7", lon: str = "lon_e7") -> list[Column]:
    """Aggregates for the box around points."""
    return [F.min(lat).alias("minlat"), F.max(lat).alias("maxlat"), F.min(lon).alias("minlon"), F.max(lon).alias("maxlon")]


def cover_boxes() -> list[Column]:
    """Aggregates for the box around the boxes in columns minlat to maxlon."""
    return [F.min("minlat").alias("minlat"), F.max("maxlat").alias("maxlat"), F.min("minlon").alias("minlon"), F.max("maxlon").alias("maxlon")]


SIDES = ("minlat", "maxlat", "minlon", "maxlon")
