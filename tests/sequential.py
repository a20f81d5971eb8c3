"""The box and filter rules row by row in plain Python, as a model for the set-based operators."""

import math

SIDE, BUFFER = 100_000_000, 1_000_000  # a square of 10 degrees around the origin


def distance(lat0, lat1, lon0, lon1):
    """Distance of a box from the square."""
    dx = max(lon0 - SIDE, -SIDE - lon1, 0)
    dy = max(lat0 - SIDE, -SIDE - lat1, 0)
    return math.hypot(dx, dy)


def grow(box, other):
    if box is None or other is None:
        return box or other
    return (min(box[0], other[0]), max(box[1], other[1]), min(box[2], other[2]), max(box[3], other[3]))


def point(lat, lon):
    return (lat, lat, lon, lon)


class Boxes:
    def __init__(self, nodes, ways, rels):
        self.nodes, self.ways, self.rels = nodes, ways, rels
        self.new = {"node": {}, "way": {}, "relation": {}}

    def node(self, i):
        box = self.new["node"].get(i)
        return grow(box, point(*self.nodes[i])) if i in self.nodes else box

    def way_list(self, nodes):
        box = None
        for i in nodes:
            box = grow(box, self.node(i))
        return box

    def way(self, i):
        return grow(self.new["way"].get(i), self.way_list(self.ways.get(i, ())))

    def members(self, members):
        box, todo, seen = None, list(members), set()
        while todo:
            kind, i = todo.pop()
            if kind == "relation":
                if i not in seen:
                    seen.add(i)
                    box = grow(box, self.new["relation"].get(i))
                    todo += self.rels.get(i, ())
            else:
                box = grow(box, self.node(i) if kind == "node" else self.way(i))
        return box

    def row(self, r):
        kind, i = r["elem_type"], r["id"]
        if kind == "node":
            box = grow(self.node(i), point(r["lat_e7"], r["lon_e7"]))
        elif kind == "way":
            box = grow(self.way(i), self.way_list(r["nodes"]))
        else:
            box = grow(self.members([("relation", i)]), self.members(r["members"]))
        if box is not None:
            self.new[kind][i] = grow(self.new[kind].get(i), box) if kind != "node" else grow(self.new[kind].get(i), box)
        return box


class Filter:
    """What one polygon's output has of each row: keep, delete or None."""

    def __init__(self, nodes, ways, rels):
        self.nodes, self.ways, self.rels = nodes, ways, rels
        self.seen = {0: set(), BUFFER: set()}

    def has(self, margin, kind, i, path=()):
        if (kind, i) in self.seen[margin]:
            return True
        if kind == "node":
            return i in self.nodes and distance(*point(*self.nodes[i])) <= margin
        if kind == "way":
            return any(self.has(margin, "node", n) for n in self.ways.get(i, ()))
        return any(k != "relation" and self.has(margin, k, m) or k == "relation" and m not in path and self.has(margin, k, m, (*path, m)) for k, m in self.rels.get(i, ()))

    def row(self, r, box):
        kind, i = r["elem_type"], r["id"]
        if kind == "node":
            here = distance(*point(r["lat_e7"], r["lon_e7"]))
            kept, near = here <= 0, here <= BUFFER or self.has(BUFFER, kind, i)
        else:
            parts = [("node", n) for n in r["nodes"]] if kind == "way" else r["members"]
            if box is None or distance(*box) > BUFFER:
                return None
            kept = any(self.has(0, *p, (p[1],)) if p[0] == "relation" else self.has(0, *p) for p in parts)
            near = kept or any(self.has(BUFFER, *p, (p[1],)) if p[0] == "relation" else self.has(BUFFER, *p) for p in parts) or self.has(BUFFER, kind, i)
        if not near:
            return None
        self.seen[BUFFER].add((kind, i))
        if kept:
            self.seen[0].add((kind, i))
        return r["action"] if kept else "delete"
