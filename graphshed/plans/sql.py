"""DuckDB SQL for the same rows as the queries, written on its own.

The stand-ins of testmap are common table expressions; each query names those
it needs.
"""

from __future__ import annotations

from graphshed.plans.testmap import CUSTOMER_POS, CUSTOMERS, LATE_POS, MISSING_NODE, MISSING_RELATION, MISSING_WAY, NATION_POS, NATIONS, POLYGONS, REGION_POS, REGIONS, TREE, WAY_POS


def _rings() -> list[tuple[str, int, int, str, str]]:
    """(poly, ring, seq, lon, lat) as texts, holes left out."""
    rows = []
    for name, text in POLYGONS.items():
        ring, seq, hole, inside = -1, 0, False, False
        for line in text.splitlines()[1:]:
            if line.strip() == "END":
                inside = False
            elif not inside:
                inside, hole, seq = True, line.startswith("!"), 0
                ring += not hole
            elif not hole:
                lon, lat = line.split()
                rows.append((name, ring, seq, lon, lat))
                seq += 1
    return rows


def _values(rows: list[tuple]) -> str:
    shown = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x + "'"
    return ", ".join("(" + ", ".join(map(shown, r)) + ")" for r in rows)


CTES = {
    "node": "SELECT p_partkey::BIGINT AS id, (p_partkey::BIGINT*1103515245) % 1600000001 - 800000000 AS lat_e7, (p_partkey::BIGINT*1664525013) % 3600000001 - 1800000000 AS lon_e7 FROM part",
    "way_nodes": "SELECT l_orderkey AS way_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS pos, l_partkey AS node_id FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)",
    "lost_nodes": f"SELECT * FROM way_nodes UNION ALL SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey), {MISSING_NODE} FROM orders WHERE o_orderkey % 1000 = 7",
    "member": f"""SELECT o_custkey + {CUSTOMERS} AS rel_id, 'way' AS type, o_orderkey AS ref, 'order' AS role FROM orders
        UNION ALL SELECT c_nationkey + {NATIONS}, 'relation', c_custkey + {CUSTOMERS}, 'customer' FROM customer
        UNION ALL SELECT n_regionkey + {REGIONS}, 'relation', n_nationkey + {NATIONS}, 'nation' FROM nation
        UNION ALL SELECT {NATIONS}, 'relation', {REGIONS}, 'region'""",
    "rel": f"SELECT c_custkey + {CUSTOMERS} AS id FROM customer UNION ALL SELECT n_nationkey + {NATIONS} FROM nation UNION ALL SELECT r_regionkey + {REGIONS} FROM region",
    "lost_member": f"SELECT rel_id, type, ref FROM member UNION ALL SELECT id, t, r FROM rel, (VALUES ('node', {MISSING_NODE}), ('way', {MISSING_WAY}), ('relation', {MISSING_RELATION})) x(t, r) WHERE id % 500 = 3",
    "nparts": "SELECT count(*) AS n FROM part",
    "node_row": f"""SELECT event_id AS pos, action, id, CASE WHEN action = 'delete' THEN 0 ELSE lat_e7 + shift END AS lat_e7, CASE WHEN action = 'delete' THEN 0 ELSE lon_e7 - shift END AS lon_e7
        FROM (SELECT event_id, CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'modify' END AS action, user_id * 13 % n AS id, round(value * 10000)::BIGINT AS shift FROM events, nparts) e LEFT JOIN node USING (id)
        UNION ALL SELECT id + {LATE_POS}, 'modify', id, lat_e7 + 1000000, lon_e7 FROM node""",
    "way_row": f"SELECT o_orderkey + {WAY_POS} AS pos, CASE WHEN o_orderkey % 70 = 0 THEN 'delete' ELSE 'modify' END AS action, o_orderkey AS id FROM orders",
    "way_row_node": "SELECT w.pos, w.id, -n.pos AS place, n.node_id FROM way_row w JOIN way_nodes n ON n.way_id = w.id WHERE w.action <> 'delete'",
    "rel_row": f"""SELECT CASE WHEN id < {NATIONS} THEN id - {CUSTOMERS} + {CUSTOMER_POS} WHEN id < {REGIONS} THEN id - {NATIONS} + {NATION_POS} ELSE id - {REGIONS} + {REGION_POS} END AS pos, 'modify' AS action, id
        FROM rel""",
    "rel_row_member": f"""SELECT pos, id, type, ref FROM (SELECT r.pos, r.id, m.type, m.ref, row_number() OVER (PARTITION BY r.id ORDER BY m.ref) AS k FROM rel_row r JOIN member m ON m.rel_id = r.id) x WHERE id >= {NATIONS} OR k > 1
        UNION ALL SELECT pos, id, 'node', (id - {CUSTOMERS}) * 7 % n FROM rel_row, nparts WHERE id < {NATIONS}""",
    "ring": f"SELECT poly, ring, seq, round(lon::DOUBLE * 1e7)::BIGINT AS lon_e7, round(lat::DOUBLE * 1e7)::BIGINT AS lat_e7 FROM (VALUES {_values(_rings())}) v(poly, ring, seq, lon, lat)",
    "edge": "SELECT * FROM (SELECT poly, ring, lon_e7 AS x1, lat_e7 AS y1, lead(lon_e7) OVER (PARTITION BY poly, ring ORDER BY seq) AS x2, lead(lat_e7) OVER (PARTITION BY poly, ring ORDER BY seq) AS y2 FROM ring) e WHERE x2 IS NOT NULL AND (x1 <> x2 OR y1 <> y2)",
    "tree": f"SELECT * FROM (VALUES {_values([(n, p, int(f)) for n, p, f in TREE])}) v(hier_name, parent, has)",
}

#: Rows (x, y) against edges e: the ray crosses, the point is on the edge, the square of the distance.
CROSSES = "((e.y1 > p.y) <> (e.y2 > p.y) AND CASE WHEN e.y2 > e.y1 THEN (p.x - e.x1)::HUGEINT * (e.y2 - e.y1) < (e.x2 - e.x1)::HUGEINT * (p.y - e.y1) ELSE (p.x - e.x1)::HUGEINT * (e.y2 - e.y1) > (e.x2 - e.x1)::HUGEINT * (p.y - e.y1) END)"
ON = "(p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) AND (p.x - e.x1)::HUGEINT * (e.y2 - e.y1) = (e.x2 - e.x1)::HUGEINT * (p.y - e.y1))"


def square(x: str, y: str) -> str:
    """Square of the distance of a point from the edge e."""
    t = f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, (({x} - e.x1)::DOUBLE * (e.x2 - e.x1)::DOUBLE + ({y} - e.y1)::DOUBLE * (e.y2 - e.y1)::DOUBLE) / ((e.x2 - e.x1)::DOUBLE * (e.x2 - e.x1)::DOUBLE + (e.y2 - e.y1)::DOUBLE * (e.y2 - e.y1)::DOUBLE)))"
    return f"(power(({x} - e.x1)::DOUBLE - {t} * (e.x2 - e.x1)::DOUBLE, 2) + power(({y} - e.y1)::DOUBLE - {t} * (e.y2 - e.y1)::DOUBLE, 2))"


def within(points: str, margin: int = 0) -> str:
    """(k, poly) of points (k, x, y) in polygons or within a margin of them."""
    close = " OR bool_or(close)" if margin else ""
    measure = f", bool_or({square('p.x', 'p.y')} <= {float(margin) ** 2}) AS close" if margin else ""
    return f"""SELECT k, poly FROM (SELECT p.k, e.poly, e.ring, count(*) FILTER (WHERE {CROSSES}) % 2 = 1 AS odd, bool_or({ON}) AS edge{measure}
        FROM ({points}) p, edge e GROUP BY p.k, e.poly, e.ring) r GROUP BY k, poly HAVING bool_or(odd) OR bool_or(edge){close}"""


def boxes_within(boxes: str, margin: int = 0) -> str:
    """(k, poly) of boxes (k, minlat, maxlat, minlon, maxlon) that meet polygons or come within a margin of them."""
    corners = [(x, y) for x in ("b.minlon", "b.maxlon") for y in ("b.minlat", "b.maxlat")]
    sides = [f"(e.x2 - e.x1)::HUGEINT * ({y} - e.y1) - ({x} - e.x1)::HUGEINT * (e.y2 - e.y1)" for x, y in corners]
    meets = f"(greatest(e.x1, e.x2) >= b.minlon AND least(e.x1, e.x2) <= b.maxlon AND greatest(e.y1, e.y2) >= b.minlat AND least(e.y1, e.y2) <= b.maxlat AND NOT ({' AND '.join(s + ' > 0' for s in sides)}) AND NOT ({' AND '.join(s + ' < 0' for s in sides)}))"
    if margin:
        ends = [f"(power(greatest(b.minlon - e.{x}, e.{x} - b.maxlon, 0)::DOUBLE, 2) + power(greatest(b.minlat - e.{y}, e.{y} - b.maxlat, 0)::DOUBLE, 2))" for x, y in (("x1", "y1"), ("x2", "y2"))]
        meets = f"({meets} OR least({', '.join([square(x, y) for x, y in corners] + ends)}) <= {float(margin) ** 2})"
    inside = within(f"SELECT k, minlon AS x, minlat AS y FROM ({boxes}) bb")
    return f"SELECT DISTINCT k, poly FROM (SELECT b.k, e.poly FROM ({boxes}) b, edge e WHERE {meets} UNION ALL {inside}) u"


def sql(names: str, body: str, recursive: str = "") -> str:
    """A query with the named common table expressions and what they build on."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order:
            return
        for other in CTES:
            if other != name and _mentions(CTES[name], other):
                need(other)
        order.append(name)

    for name in names.split():
        need(name)
    head = ", ".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order)
    both = ", ".join(x for x in (head, recursive) if x)
    return f"WITH {'RECURSIVE ' if recursive else ''}{both} {body}" if both else body


def _mentions(text: str, name: str) -> bool:
    import re

    return re.search(rf"(FROM|JOIN|,)\s+{name}\b", text) is not None


SHOWN = "string_agg(node_id::VARCHAR, ',' ORDER BY pos)"
BOX = "minlat, maxlat, minlon, maxlon"
COVER = "min(lat_e7) AS minlat, max(lat_e7) AS maxlat, min(lon_e7) AS minlon, max(lon_e7) AS maxlon"
COVER_BOXES = "min(minlat) AS minlat, max(maxlat) AS maxlat, min(minlon) AS minlon, max(maxlon) AS maxlon"
ASKED = "SELECT (p_partkey * {0})::BIGINT AS id FROM part"
LATEST = "SELECT elem_type, id, pos, action FROM (SELECT *, row_number() OVER (PARTITION BY elem_type, id ORDER BY pos DESC) AS k FROM (SELECT 'node' AS elem_type, id, pos, action FROM node_row UNION ALL SELECT 'way', id, pos, action FROM way_row UNION ALL SELECT 'relation', id, pos, action FROM rel_row) u) x WHERE k = 1"
ALL_ROWS = "node_row way_row rel_row"
SHOWN_MEMBERS = "coalesce(string_agg({0}.type || ':' || {0}.ref || ':' || {0}.role, ',' ORDER BY {0}.ref), '')"
#: (root, rel): what every relation reaches.
CLOSURE = "reach(root, rel) AS (SELECT id, id FROM rel UNION SELECT root, ref FROM reach JOIN member ON rel_id = rel AND type = 'relation')"

_BOXED = """SELECT id, lat_e7, lon_e7, CASE WHEN id % 5 <> 0 THEN lat_e7 END AS a1, CASE WHEN id % 5 <> 0 THEN lat_e7 + id END AS a2, CASE WHEN id % 5 <> 0 THEN lon_e7 END AS a3, CASE WHEN id % 5 <> 0 THEN lon_e7 + 2000000 END AS a4,
    CASE WHEN id % 7 <> 0 THEN lon_e7 % 800000000 - 5 END AS b1, CASE WHEN id % 7 <> 0 THEN lon_e7 % 800000000 + 5 END AS b2, CASE WHEN id % 7 <> 0 THEN lat_e7 END AS b3, CASE WHEN id % 7 <> 0 THEN lat_e7 + 10 END AS b4 FROM node"""
_UNION = "SELECT id, least(a1, b1) AS minlat, greatest(a2, b2) AS maxlat, least(a3, b3) AS minlon, greatest(a4, b4) AS maxlon FROM (" + _BOXED + ") x"
_TEST_BOXES = "SELECT id AS k, lat_e7 AS minlat, lat_e7 + CASE WHEN id % 4 < 2 THEN id % 97 * 3000000 ELSE 0 END AS maxlat, lon_e7 AS minlon, lon_e7 + CASE WHEN id % 2 = 0 THEN id % 89 * 4000000 ELSE 0 END AS maxlon FROM node"
_POINTS = "SELECT id AS k, lon_e7 AS x, lat_e7 AS y FROM node"

# What a node shows at a row: its stored point and the new points of earlier rows.
CTES["way_use"] = "SELECT DISTINCT pos, id, node_id FROM (SELECT pos, id, node_id FROM way_row_node UNION ALL SELECT w.pos, w.id, n.node_id FROM way_row w JOIN way_nodes n ON n.way_id = w.id) u"
CTES["way_box"] = f"""SELECT w.pos, w.id, b.minlat, b.maxlat, b.minlon, b.maxlon FROM way_row w LEFT JOIN (SELECT pos, {COVER} FROM (
    SELECT u.pos, n.lat_e7, n.lon_e7 FROM way_use u JOIN node n ON n.id = u.node_id
    UNION ALL SELECT u.pos, r.lat_e7, r.lon_e7 FROM way_use u JOIN node_row r ON r.id = u.node_id AND r.pos < u.pos) p GROUP BY pos) b USING (pos)"""
CTES["old_reach"] = "SELECT DISTINCT r.pos, c.rel FROM (SELECT pos, id FROM rel_row UNION SELECT pos, ref FROM rel_row_member WHERE type = 'relation') r JOIN closed c ON c.root = r.id"
CTES["closed"] = "SELECT root, rel FROM reach"
CTES["rel_use"] = "SELECT DISTINCT pos, type, ref FROM (SELECT pos, type, ref FROM rel_row_member WHERE type <> 'relation' UNION ALL SELECT o.pos, m.type, m.ref FROM old_reach o JOIN member m ON m.rel_id = o.rel WHERE m.type <> 'relation') u"
CTES["rel_node"] = "SELECT DISTINCT pos, node_id FROM (SELECT pos, ref AS node_id FROM rel_use WHERE type = 'node' UNION ALL SELECT u.pos, n.node_id FROM rel_use u JOIN way_nodes n ON n.way_id = u.ref WHERE u.type = 'way') x"
CTES["node_part"] = f"SELECT pos AS at, id, min(lat_e7) OVER w AS minlat, max(lat_e7) OVER w AS maxlat, min(lon_e7) OVER w AS minlon, max(lon_e7) OVER w AS maxlon FROM node_row WINDOW w AS (PARTITION BY id ORDER BY pos)"
CTES["rel_base"] = f"""SELECT pos, {COVER_BOXES} FROM (
    SELECT u.pos, n.lat_e7 AS minlat, n.lat_e7 AS maxlat, n.lon_e7 AS minlon, n.lon_e7 AS maxlon FROM rel_node u JOIN node n ON n.id = u.node_id
    UNION ALL SELECT u.pos, p.minlat, p.maxlat, p.minlon, p.maxlon FROM rel_node u ASOF JOIN node_part p ON p.id = u.node_id AND u.pos > p.at
    UNION ALL SELECT u.pos, b.minlat, b.maxlat, b.minlon, b.maxlon FROM rel_use u JOIN way_box b ON b.id = u.ref AND b.pos < u.pos WHERE u.type = 'way') x GROUP BY pos"""
for _n, _before in ((1, "rel_base"), (2, "rel_pass1"), (3, "rel_pass2"), (4, "rel_pass3")):
    CTES[f"rel_pass{_n}"] = f"""SELECT pos, {COVER_BOXES} FROM (SELECT pos, {BOX} FROM {_before}
        UNION ALL SELECT o.pos, b.minlat, b.maxlat, b.minlon, b.maxlon FROM old_reach o JOIN rel_row r ON r.id = o.rel AND r.pos < o.pos JOIN {_before} b ON b.pos = r.pos) x GROUP BY pos"""


def _recursive(names: str, body: str) -> str:
    """As sql(), with the closure of relations among the common table expressions."""
    text = sql(names, body)
    closed = "closed AS MATERIALIZED (SELECT root, rel FROM reach)"
    return text.replace(closed, f"{CLOSURE}, {closed}").replace("WITH ", "WITH RECURSIVE ", 1)


#: Change rows with their boxes, as the filter reads them.
CTES["boxed_row"] = f"""SELECT 'way' AS elem_type, w.pos, w.id, w.action, {BOX} FROM way_row w JOIN way_box b USING (pos)
    UNION ALL SELECT 'relation', r.pos, r.id, r.action, {BOX} FROM rel_row r LEFT JOIN rel_pass4 b USING (pos)"""
CTES["gate"] = boxes_within(f"SELECT pos AS k, {BOX} FROM boxed_row WHERE minlat IS NOT NULL", 1_000_000)
CTES["old_in"] = within(_POINTS)
CTES["old_near"] = within(_POINTS, 1_000_000)
CTES["new_in"] = within("SELECT pos AS k, lon_e7 AS x, lat_e7 AS y FROM node_row")
CTES["new_near"] = within("SELECT pos AS k, lon_e7 AS x, lat_e7 AS y FROM node_row", 1_000_000)


def _level(tag: str, names: str, source: str) -> dict[str, str]:
    """Common table expressions of the filter for one level of polygons: ``names`` is SQL for their names, ``source`` for (poly, pos, action) of their input rows."""
    out = {f"src{tag}": source}
    out[f"gt{tag}"] = f"SELECT g.poly, g.k AS pos FROM gate g JOIN src{tag} s ON s.poly = g.poly AND s.pos = g.k"
    for kind, old, new in (("in", "old_in", "new_in"), ("near", "old_near", "new_near")):
        t = f"{kind}{tag}"
        out[f"hn_{t}"] = f"""SELECT poly, id, min(hit) AS hit FROM (SELECT poly, k AS id, -1 AS hit FROM {old} WHERE poly IN ({names})
            UNION ALL SELECT n.poly, r.id, r.pos FROM {new} n JOIN node_row r ON r.pos = n.k JOIN src{tag} s ON s.poly = n.poly AND s.pos = r.pos) x GROUP BY poly, id"""
        out[f"hw_{t}"] = f"""SELECT poly, id, min(hit) AS hit FROM (SELECT h.poly, n.way_id AS id, h.hit FROM way_nodes n JOIN hn_{t} h ON h.id = n.node_id
            UNION ALL SELECT g.poly, w.id, w.pos FROM gt{tag} g JOIN way_row_node w ON w.pos = g.pos JOIN hn_{t} h ON h.poly = g.poly AND h.id = w.node_id AND h.hit < w.pos) x GROUP BY poly, id"""
        out[f"h0_{t}"] = f"""SELECT poly, id, min(hit) AS hit FROM (
            SELECT h.poly, m.rel_id AS id, h.hit FROM member m JOIN hn_{t} h ON m.type = 'node' AND h.id = m.ref
            UNION ALL SELECT h.poly, m.rel_id, h.hit FROM member m JOIN hw_{t} h ON m.type = 'way' AND h.id = m.ref
            UNION ALL SELECT g.poly, m.id, m.pos FROM gt{tag} g JOIN rel_row_member m ON m.pos = g.pos JOIN hn_{t} h ON m.type = 'node' AND h.poly = g.poly AND h.id = m.ref AND h.hit < m.pos
            UNION ALL SELECT g.poly, m.id, m.pos FROM gt{tag} g JOIN rel_row_member m ON m.pos = g.pos JOIN hw_{t} h ON m.type = 'way' AND h.poly = g.poly AND h.id = m.ref AND h.hit < m.pos) x GROUP BY poly, id"""
        # Relations are three levels deep with one cycle of two; more passes change nothing.
        for n in range(1, 7):
            out[f"h{n}_{t}"] = f"""SELECT poly, id, min(hit) AS hit FROM (SELECT poly, id, hit FROM h{n - 1}_{t}
                UNION ALL SELECT h.poly, m.rel_id, h.hit FROM member m JOIN h{n - 1}_{t} h ON m.type = 'relation' AND h.id = m.ref
                UNION ALL SELECT g.poly, m.id, m.pos FROM gt{tag} g JOIN rel_row_member m ON m.pos = g.pos JOIN h{n - 1}_{t} h ON m.type = 'relation' AND h.poly = g.poly AND h.id = m.ref AND h.hit < m.pos) x GROUP BY poly, id"""
        out[f"hit_{t}"] = f"SELECT 'node' AS type, poly, id, hit FROM hn_{t} UNION ALL SELECT 'way', poly, id, hit FROM hw_{t} UNION ALL SELECT 'relation', poly, id, hit FROM h6_{t}"
        out[f"any_{t}"] = f"""SELECT DISTINCT g.poly, g.pos FROM gt{tag} g JOIN (SELECT pos, 'node' AS type, node_id AS ref FROM way_row_node UNION ALL SELECT pos, type, ref FROM rel_row_member) m ON m.pos = g.pos
            JOIN hit_{t} h ON h.poly = g.poly AND h.type = m.type AND h.id = m.ref AND h.hit < g.pos"""
    out[f"out{tag}"] = f"""
        SELECT s.poly, r.pos, 'node' AS elem_type, r.id, CASE WHEN i.k IS NOT NULL THEN s.action ELSE 'delete' END AS action FROM src{tag} s JOIN node_row r ON r.pos = s.pos
            LEFT JOIN new_in i ON i.poly = s.poly AND i.k = s.pos LEFT JOIN new_near n ON n.poly = s.poly AND n.k = s.pos LEFT JOIN hn_near{tag} h ON h.poly = s.poly AND h.id = r.id AND h.hit < r.pos
            WHERE n.k IS NOT NULL OR h.id IS NOT NULL
        UNION ALL SELECT s.poly, b.pos, b.elem_type, b.id, CASE WHEN i.pos IS NOT NULL THEN s.action ELSE 'delete' END FROM src{tag} s JOIN boxed_row b ON b.pos = s.pos JOIN gt{tag} g ON g.poly = s.poly AND g.pos = s.pos
            LEFT JOIN any_in{tag} i ON i.poly = s.poly AND i.pos = s.pos LEFT JOIN any_near{tag} n ON n.poly = s.poly AND n.pos = s.pos
            LEFT JOIN hit_near{tag} h ON h.poly = s.poly AND h.type = b.elem_type AND h.id = b.id AND h.hit < s.pos
            WHERE i.pos IS NOT NULL OR n.pos IS NOT NULL OR h.id IS NOT NULL"""
    return out


_EVERY = "SELECT pos, action FROM node_row UNION ALL SELECT pos, action FROM boxed_row"
CTES |= _level("_f", "SELECT DISTINCT poly FROM ring", f"SELECT p.poly, r.pos, r.action FROM ({_EVERY}) r, (SELECT DISTINCT poly FROM ring) p")
CTES |= _level("_a", "'./west', './east'", f"SELECT p.poly, r.pos, r.action FROM ({_EVERY}) r, (VALUES ('./west'), ('./east')) p(poly)")
CTES |= _level("_b", "'./west/inner/south', './west/north'", "SELECT p.poly, r.pos, r.action FROM out_a r, (VALUES ('./west/inner/south'), ('./west/north')) p(poly) WHERE r.poly = './west'")

_HIERARCHY = "SELECT poly, pos, elem_type, id, action FROM out_a UNION ALL SELECT poly, pos, elem_type, id, action FROM out_b"

SQL = {
    "scan_nodes": sql("node", "SELECT id, lat_e7, lon_e7, CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS n_tags, CASE WHEN id % 3 = 0 THEN 'a<b & \"c\" é ' || id END AS tag FROM node"),
    "scan_ways": sql("way_nodes", f"SELECT o_orderkey AS id, count(node_id) AS n_nodes, coalesce({SHOWN}, '') AS nodes FROM orders LEFT JOIN way_nodes ON way_id = o_orderkey GROUP BY o_orderkey"),
    "scan_relations": sql("rel member", f"SELECT id, count(m.ref) AS n_members, {SHOWN_MEMBERS.format('m')} AS members FROM rel LEFT JOIN member m ON rel_id = id GROUP BY id"),
    "scan_changes": sql("node_row way_row way_row_node rel_row rel_row_member", """, r AS (SELECT pos, action, 'node' AS elem_type, id, lat_e7, lon_e7, '' AS nodes, '' AS members FROM node_row
        UNION ALL SELECT w.pos, w.action, 'way', w.id, NULL, NULL, coalesce(string_agg(n.node_id::VARCHAR, ',' ORDER BY n.place), ''), '' FROM way_row w LEFT JOIN way_row_node n USING (pos) GROUP BY w.pos, w.action, w.id
        UNION ALL SELECT r.pos, r.action, 'relation', r.id, NULL, NULL, '', coalesce(string_agg(m.type || ':' || m.ref, ',' ORDER BY m.type = 'node', m.ref), '') FROM rel_row r LEFT JOIN rel_row_member m USING (pos) GROUP BY r.pos, r.action, r.id)
        SELECT pos // 2000 AS bucket, row_number() OVER (PARTITION BY pos // 2000 ORDER BY pos) - 1 AS place, action, elem_type, id, lat_e7, lon_e7, nodes, members FROM r"""),
    "scan_pbf_projection": sql("node way_nodes rel member", """SELECT 'node' AS elem_type, id, lat_e7 AS a, lon_e7 AS b FROM node
        UNION ALL SELECT 'way', o_orderkey, count(node_id), min(node_id) FILTER (WHERE pos = 0) FROM orders LEFT JOIN way_nodes ON way_id = o_orderkey GROUP BY o_orderkey
        UNION ALL SELECT 'relation', id, count(ref), min(ref) FROM rel LEFT JOIN member ON rel_id = id GROUP BY id"""),
    "lookup_node": sql("node", f"SELECT a.id, n.lat_e7, n.lon_e7, n.id IS NOT NULL AS found FROM ({ASKED.format(7)}) a LEFT JOIN node n USING (id)"),
    "lookup_way": sql("way_nodes", f"SELECT a.id, o.o_orderkey IS NOT NULL AS found, CASE WHEN o.o_orderkey IS NULL THEN '' ELSE coalesce(w.nodes, '') END AS nodes FROM ({ASKED.format(11)}) a LEFT JOIN orders o ON o.o_orderkey = a.id LEFT JOIN (SELECT way_id, {SHOWN} AS nodes FROM way_nodes GROUP BY way_id) w ON w.way_id = a.id"),
    "lookup_relation": sql("rel member", f"SELECT a.id, r.id IS NOT NULL AS found, CASE WHEN r.id IS NOT NULL THEN coalesce(m.n, 0) END AS n_members FROM (SELECT c_custkey * 3 + {CUSTOMERS} AS id FROM customer) a LEFT JOIN rel r USING (id) LEFT JOIN (SELECT rel_id, count(*) AS n FROM member GROUP BY rel_id) m ON m.rel_id = a.id"),
    "cache_lookup": sql("node", f"SELECT a.id, n.lat_e7, n.lon_e7, n.id IS NOT NULL AS found FROM ({ASKED.format(7)}) a LEFT JOIN node n USING (id)"),
    "relation_json_roundtrip": sql("rel member", f"SELECT id, {SHOWN_MEMBERS.format('m')} AS members, CASE WHEN id % 3 = 0 THEN id::VARCHAR END AS name, CASE WHEN id % 2 = 0 THEN id % 9 + 1 END AS version FROM rel LEFT JOIN member m ON rel_id = id GROUP BY id"),
    "poly_rings": sql("ring", "SELECT poly, ring::INTEGER AS ring, count(*) AS n_points, min(lon_e7) AS minlon, max(lat_e7) AS maxlat FROM ring GROUP BY poly, ring"),
    "poly_coords": sql("ring", "SELECT poly, ring::BIGINT AS ring, seq::BIGINT AS seq, lon_e7, lat_e7 FROM ring"),
    "poly_tree_walk": sql("tree", """SELECT t.hier_name, t.parent, CASE WHEN has = 1 THEN substr(t.hier_name, 3) || '.poly' END AS file, (length(t.hier_name) - length(replace(t.hier_name, '/', '')))::BIGINT AS depth, CASE WHEN has = 1 THEN up.above END AS above
        FROM tree t LEFT JOIN up ON up.hier_name = t.hier_name AND up.done""", """up(hier_name, place, above, done) AS (SELECT hier_name, parent, NULL::VARCHAR, parent IS NULL FROM tree
        UNION ALL SELECT u.hier_name, CASE WHEN t.has = 1 THEN u.place ELSE t.parent END, CASE WHEN t.has = 1 THEN t.hier_name END, t.has = 1 OR t.parent IS NULL FROM up u JOIN tree t ON t.hier_name = u.place WHERE NOT u.done)"""),
    "state_parse": "SELECT event_id AS sequence FROM events",
    "diff_listing": "SELECT event_id AS sequence, printf('%03d/%03d/%03d.osc.gz', event_id // 1000000 % 1000, event_id // 1000 % 1000, event_id % 1000) AS file FROM events",
    "xml_roundtrip": sql("node_row way_row way_row_node rel_row rel_row_member", """, r AS (SELECT pos, 'node' AS elem_type, id, action, lat_e7, lon_e7, '' AS refs FROM node_row
        UNION ALL SELECT w.pos, 'way', w.id, w.action, NULL, NULL, coalesce(string_agg(n.node_id::VARCHAR, ',' ORDER BY n.place), '') FROM way_row w LEFT JOIN way_row_node n USING (pos) GROUP BY w.pos, w.id, w.action
        UNION ALL SELECT r.pos, 'relation', r.id, r.action, NULL, NULL, coalesce(string_agg(m.type || ':' || m.ref, ',' ORDER BY m.type = 'node', m.ref), '') FROM rel_row r LEFT JOIN rel_row_member m USING (pos) GROUP BY r.pos, r.id, r.action)
        SELECT elem_type, id, action, lat_e7, lon_e7, refs, pos % 1000000000 AS minlat, pos % 1000000000 + 5 AS maxlat, -(pos % 1000000000) AS minlon, pos % 1000000000 * 2 AS maxlon FROM r"""),
    "xml_render_node": sql("node", """SELECT id, '<node id="' || id || '" lat="' || CASE WHEN id = 0 THEN '0' ELSE rtrim(printf('%d.%07d', id // 10000000, id % 10000000), '0') END || '" lon="' || CASE WHEN id = 0 THEN '0' ELSE '-' || id END || '"/>' AS xml FROM node WHERE id % 10000000 <> 0 OR id = 0"""),
    "xml_render_way": sql("way_nodes", """SELECT o_orderkey AS id, '<way id="' || o_orderkey || '">' || coalesce(string_agg('<nd ref="' || node_id || '"/>', '' ORDER BY pos), '') || '</way>' AS xml FROM orders LEFT JOIN way_nodes ON way_id = o_orderkey GROUP BY o_orderkey"""),
    "xml_render_relation": sql("rel member", """SELECT id, '<relation id="' || id || '">' || coalesce(string_agg('<member type="' || type || '" ref="' || ref || '" role="' || role || '"/>', '' ORDER BY ref), '') || '</relation>' AS xml FROM rel LEFT JOIN member ON rel_id = id GROUP BY id"""),
    "action_runs": """SELECT pos, user_id, action, sum(CASE WHEN before IS DISTINCT FROM action THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY pos)::BIGINT AS run FROM (
        SELECT *, lag(action) OVER (PARTITION BY user_id ORDER BY pos) AS before FROM (SELECT event_id AS pos, user_id, CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'modify' END AS action FROM events) e) x""",
    "apply_nodes": sql("node " + ALL_ROWS, f"SELECT id, lat_e7, lon_e7 FROM node WHERE id NOT IN (SELECT id FROM node_row) UNION ALL SELECT r.id, r.lat_e7, r.lon_e7 FROM ({LATEST}) x JOIN node_row r USING (pos) WHERE x.elem_type = 'node' AND x.action <> 'delete'"),
    "apply_ways": sql("way_nodes way_row way_row_node", f"""SELECT o_orderkey AS id, coalesce({SHOWN}, '') AS nodes FROM orders LEFT JOIN way_nodes ON way_id = o_orderkey WHERE o_orderkey NOT IN (SELECT id FROM way_row) GROUP BY o_orderkey
        UNION ALL SELECT w.id, coalesce(string_agg(n.node_id::VARCHAR, ',' ORDER BY n.place), '') FROM way_row w LEFT JOIN way_row_node n USING (pos) WHERE w.action <> 'delete' GROUP BY w.id"""),
    "apply_relations": sql("rel member rel_row rel_row_member", """SELECT r.id, coalesce(string_agg(m.type || ':' || m.ref, ',' ORDER BY m.ref), '') AS members FROM rel r LEFT JOIN member m ON m.rel_id = r.id WHERE r.id NOT IN (SELECT id FROM rel_row) GROUP BY r.id
        UNION ALL SELECT r.id, coalesce(string_agg(m.type || ':' || m.ref, ',' ORDER BY m.type = 'node', m.ref), '') FROM rel_row r LEFT JOIN rel_row_member m USING (pos) GROUP BY r.id"""),
    "apply_deletes": sql(ALL_ROWS, f"SELECT elem_type, id, pos FROM ({LATEST}) x WHERE action = 'delete'"),
    "apply_diff": sql("node way_nodes member rel " + ALL_ROWS + " rel_row_member way_row_node", f"""SELECT 'node' AS elem_type, count(*) AS n, 0::BIGINT AS places FROM (SELECT id FROM node WHERE id NOT IN (SELECT id FROM node_row) UNION ALL SELECT id FROM ({LATEST}) x WHERE elem_type = 'node' AND action <> 'delete') a
        UNION ALL SELECT 'way', (SELECT count(*) FROM orders) - (SELECT count(*) FROM way_row WHERE action = 'delete'), (SELECT count(*) FROM way_nodes WHERE way_id NOT IN (SELECT id FROM way_row)) + (SELECT count(*) FROM way_row_node)
        UNION ALL SELECT 'relation', (SELECT count(*) FROM rel), (SELECT count(*) FROM member WHERE rel_id NOT IN (SELECT id FROM rel_row)) + (SELECT count(*) FROM rel_row_member)"""),
    "latest_change": sql(ALL_ROWS, LATEST),
    "store_counts": sql("way_nodes member rel", "SELECT 'node' AS elem_type, count(*) AS n, 0::BIGINT AS places FROM part UNION ALL SELECT 'way', (SELECT count(*) FROM orders), (SELECT count(*) FROM way_nodes) UNION ALL SELECT 'relation', (SELECT count(*) FROM rel), (SELECT count(*) FROM member)"),
    "way_size_histogram": "SELECT n_nodes, count(*) AS n_ways FROM (SELECT o_orderkey, count(l_orderkey) AS n_nodes FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey) x GROUP BY n_nodes",
    "sorted_input_check": "SELECT pos, id, before FROM (SELECT event_id AS pos, user_id * 13 AS id, lag(user_id * 13) OVER (PARTITION BY event_id // 1000 ORDER BY event_id) AS before FROM events) x WHERE id < before",
    "dangling_way_nodes": sql("lost_nodes", "SELECT way_id, pos, node_id FROM lost_nodes WHERE node_id NOT IN (SELECT p_partkey FROM part)"),
    "dangling_members": sql("lost_member rel", "SELECT rel_id, type, ref FROM lost_member WHERE CASE type WHEN 'node' THEN ref NOT IN (SELECT p_partkey FROM part) WHEN 'way' THEN ref NOT IN (SELECT o_orderkey FROM orders) ELSE ref NOT IN (SELECT id FROM rel) END"),
    "check_relations_from": sql("lost_member lost_nodes rel", """SELECT rel_id, elem_type, id, missing_type, missing_id, rel_id AS path_from, min(last) AS path_to FROM (
        SELECT c.root AS rel_id, 'relation' AS elem_type, c.rel AS id, m.type AS missing_type, m.ref AS missing_id, c.rel AS last FROM far c JOIN lost_member m ON m.rel_id = c.rel
            WHERE CASE m.type WHEN 'node' THEN m.ref NOT IN (SELECT p_partkey FROM part) WHEN 'way' THEN m.ref NOT IN (SELECT o_orderkey FROM orders) ELSE m.ref NOT IN (SELECT id FROM rel) END
        UNION ALL SELECT c.root, 'way', n.way_id, 'node', n.node_id, c.rel FROM far c JOIN lost_member m ON m.rel_id = c.rel AND m.type = 'way' JOIN lost_nodes n ON n.way_id = m.ref WHERE n.node_id NOT IN (SELECT p_partkey FROM part)) x GROUP BY ALL""",
        f"far(root, rel) AS (SELECT id, id FROM rel WHERE id >= {NATIONS + 5 - (NATIONS + 5) % 1000} UNION SELECT root, ref FROM far JOIN lost_member ON rel_id = rel AND type = 'relation')"),
    "way_full": sql("lost_nodes node", "SELECT way_id AS id, w.pos, w.node_id, n.lat_e7, n.lon_e7 FROM lost_nodes w LEFT JOIN node n ON n.id = w.node_id"),
    "way_assemble": sql("way_nodes", f"SELECT way_id, {SHOWN} AS nodes FROM way_nodes GROUP BY way_id"),
    "member_type_split": sql("member", "SELECT type, rel_id, count(*) AS n, max(ref) AS last FROM member GROUP BY type, rel_id"),
    "relation_full": sql("member rel", f"SELECT root, type, count(DISTINCT ref) AS n, sum(DISTINCT ref)::BIGINT AS refs FROM reach JOIN member ON rel_id = rel WHERE root >= {REGIONS} GROUP BY root, type", CLOSURE),
    "relation_tree": sql("member rel", """SELECT depth::BIGINT AS depth, type, found, count(*) AS n, sum(ref)::BIGINT AS refs FROM (SELECT depth, type, ref, CASE type WHEN 'way' THEN ref IN (SELECT o_orderkey FROM orders) ELSE ref IN (SELECT id FROM rel) END AS found FROM paths) x GROUP BY depth, type, found""",
        f"""paths(depth, type, ref, seen, again) AS (SELECT 0, 'relation', id, [id], false FROM rel
        UNION ALL SELECT p.depth + 1, m.type, m.ref, CASE WHEN m.type = 'relation' THEN list_append(p.seen, m.ref) ELSE p.seen END, m.type = 'relation' AND list_contains(p.seen, m.ref) FROM paths p JOIN member m ON m.rel_id = p.ref WHERE p.type = 'relation' AND NOT p.again)"""),
    "seen_sets": sql("node way_nodes member node_row way_row way_row_node rel_row rel_row_member", f"""SELECT 'node' AS type, count(DISTINCT id) AS n, sum(DISTINCT id)::BIGINT AS ids FROM (SELECT id FROM node_row UNION ALL SELECT node_id FROM way_row_node UNION ALL SELECT ref FROM rel_row_member WHERE type = 'node' UNION ALL SELECT n.node_id FROM way_nodes n WHERE n.way_id IN (SELECT id FROM ways_in)) u WHERE id IN (SELECT p_partkey FROM part)
        UNION ALL SELECT 'way', count(DISTINCT way_id), sum(DISTINCT way_id)::BIGINT FROM way_nodes WHERE way_id IN (SELECT id FROM ways_in)
        UNION ALL SELECT 'relation', count(DISTINCT rel_id), sum(DISTINCT rel_id)::BIGINT FROM member WHERE rel_id IN (SELECT id FROM rel_row)""",
        f"ways_in AS (SELECT id FROM way_row UNION SELECT m.ref FROM member m JOIN rel_row r ON r.id = m.rel_id WHERE m.type = 'way')"),
    "coord_to_e7": "SELECT e7, count(*) AS n FROM (SELECT round((l_extendedprice / 1000 - l_quantity) * 1e7)::BIGINT AS e7 FROM lineitem) x GROUP BY e7",
    "e7_to_coord": sql("node", "SELECT id, lat_e7 * 1e-7::DOUBLE AS lat, lon_e7 * 1e-7::DOUBLE AS lon FROM node"),
    "bbox_degrees": sql("node", f"SELECT id, a1 * 1e-7::DOUBLE AS minlat, a2 * 1e-7::DOUBLE AS maxlat, a3 * 1e-7::DOUBLE AS minlon, a4 * 1e-7::DOUBLE AS maxlon FROM ({_BOXED}) x"),
    "bbox_union_pair": sql("node", _UNION + " WHERE a1 IS NOT NULL AND b1 IS NOT NULL"),
    "bbox_union_null": sql("node", _UNION),
    "bbox_expand_point": sql("node", f"SELECT id, least(a1, lon_e7 % 900000000) AS minlat, greatest(a2, lon_e7 % 900000000) AS maxlat, least(a3, lat_e7) AS minlon, greatest(a4, lat_e7) AS maxlon FROM ({_BOXED}) x"),
    "bbox_to_ring": sql("node", f"SELECT id, seq::BIGINT AS seq, CASE WHEN seq IN (1, 2) THEN a4 ELSE a3 END AS lon, CASE WHEN seq IN (2, 3) THEN a2 ELSE a1 END AS lat FROM ({_BOXED}) x, (VALUES (0), (1), (2), (3), (4)) s(seq) WHERE a1 IS NOT NULL"),
    "codec_bytes5": "SELECT o_orderkey AS id, printf('%010X', o_orderkey * 73000001) AS hex, o_orderkey * 73000001 AS back FROM orders",
    "codec_coord4": sql("node", "SELECT id, printf('%08X', lon_e7 + 1800000000) AS hex, lon_e7 AS back FROM node"),
    "relation_path": "SELECT o_orderkey AS id, substr(d, 1, 3) || '/' || substr(d, 4, 3) || '/' || substr(d, 7, 3) AS path FROM (SELECT o_orderkey, lpad((o_orderkey * 7919)::VARCHAR, 9, '0') AS d FROM orders) x",
    "sequence_path": "SELECT o_orderkey AS id, printf('%03d/%03d/%03d', s // 1000000 % 1000, s // 1000 % 1000, s % 1000) AS path FROM (SELECT o_orderkey, o_orderkey * 79193 AS s FROM orders) x",
    "pending_sequences": "SELECT c_custkey AS current, unnest(generate_series(c_custkey + 1, least(c_custkey + c_nationkey, 1000))) AS sequence FROM customer",
    "point_in_polygon": sql("node edge", f"SELECT k AS id, poly FROM ({within(_POINTS)}) x"),
    "point_in_buffer": sql("node edge", f"SELECT k AS id, poly FROM ({within(_POINTS, 1_000_000)}) x"),
    "bbox_intersects_polygon": sql("node edge", f"SELECT k AS id, poly FROM ({boxes_within(_TEST_BOXES)}) x"),
    "bbox_gate": sql("node ring", f"SELECT b.k AS id, r.poly FROM ({_TEST_BOXES}) b, (SELECT poly, min(lon_e7) AS x1, max(lon_e7) AS x2, min(lat_e7) AS y1, max(lat_e7) AS y2 FROM ring GROUP BY poly) r WHERE b.maxlon >= r.x1 - 1000000 AND b.minlon <= r.x2 + 1000000 AND b.maxlat >= r.y1 - 1000000 AND b.minlat <= r.y2 + 1000000"),
    "ways_in_poly": sql("old_in way_nodes", "SELECT DISTINCT poly, way_id FROM way_nodes JOIN old_in ON k = node_id"),
    "relations_in_poly": sql("old_in way_nodes member rel", "SELECT DISTINCT poly, root AS rel_id FROM reach JOIN member ON rel_id = rel AND type = 'way' JOIN way_nodes ON way_id = ref JOIN old_in ON k = node_id", CLOSURE),
    "bbox_nodes": sql("node node_row", "SELECT r.pos, r.id, least(min(r.lat_e7) OVER w, n.lat_e7) AS minlat, greatest(max(r.lat_e7) OVER w, n.lat_e7) AS maxlat, least(min(r.lon_e7) OVER w, n.lon_e7) AS minlon, greatest(max(r.lon_e7) OVER w, n.lon_e7) AS maxlon FROM node_row r LEFT JOIN node n USING (id) WINDOW w AS (PARTITION BY r.id ORDER BY r.pos)"),
    "bbox_ways": sql("way_box", f"SELECT pos, id, {BOX} FROM way_box"),
    "bbox_relations": _recursive("rel_row rel_pass4", f"SELECT r.pos, r.id, {BOX} FROM rel_row r LEFT JOIN rel_pass4 USING (pos)"),
    "filter_split": _recursive("out_f", "SELECT poly, pos, elem_type, id, action FROM out_f"),
    "split_hierarchy": _recursive("out_a out_b", _HIERARCHY),
    "split_summary": _recursive("out_a out_b", f"SELECT poly, elem_type, action, count(*) AS n FROM ({_HIERARCHY}) x GROUP BY poly, elem_type, action"),
}
SQL["stream_apply"], SQL["stream_replay"] = SQL["apply_diff"], SQL["apply_nodes"]
