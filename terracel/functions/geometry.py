"""Planar geometry as column expressions on ``array<struct<x,y>>`` rings and lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# --- points and segments -----------------------------------------------------

def xy(x, y) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once: inside functions of arrays an expression is worked out for every mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def azimuth(x1, y1, x2, y2) -> Column:
    """Direction from north, clockwise, 0..360."""
    a = F.degrees(F.atan2(x2 - x1, y2 - y1))
    return F.when(a < 0, a + 360.0).otherwise(a)


def distance(x1, y1, x2, y2) -> Column:
    return F.hypot(x2 - x1, y2 - y1)


def turn(before: Column, after: Column) -> Column:
    """Change of azimuth wrapped to -180..180."""
    return F.pmod(after - before + 180.0, F.lit(360.0)) - 180.0


def project_fraction(px, py, x1, y1, x2, y2) -> Column:
    """Position 0..1 of the point on the segment that is closest to ``p``."""
    dx, dy = x2 - x1, y2 - y1
    t = ((px - x1) * dx + (py - y1) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    return F.least(F.greatest(F.coalesce(t, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def segment_distance(px, py, x1, y1, x2, y2) -> Column:
    t = project_fraction(px, py, x1, y1, x2, y2)
    return F.hypot(x1 + t * (x2 - x1) - px, y1 + t * (y2 - y1) - py)


def cross(ax, ay, bx, by) -> Column:
    return ax * by - ay * bx


def segments_cross(ax, ay, bx, by, cx, cy, dx, dy, eps: float = 1e-9) -> Column:
    """Closed segments AB and CD share a point (collinear touching included)."""
    def side(px, py, qx, qy, rx, ry):
        v = cross(qx - px, qy - py, rx - px, ry - py)
        return F.when(v > eps, 1).when(v < -eps, -1).otherwise(0)

    s1, s2 = side(ax, ay, bx, by, cx, cy), side(ax, ay, bx, by, dx, dy)
    s3, s4 = side(cx, cy, dx, dy, ax, ay), side(cx, cy, dx, dy, bx, by)
    boxes = (
        (F.least(ax, bx) <= F.greatest(cx, dx) + eps) & (F.least(cx, dx) <= F.greatest(ax, bx) + eps)
        & (F.least(ay, by) <= F.greatest(cy, dy) + eps) & (F.least(cy, dy) <= F.greatest(ay, by) + eps)
    )
    return boxes & (s1 * s2 <= 0) & (s3 * s4 <= 0)


def segment_gap(ax, ay, bx, by, cx, cy, dx, dy) -> Column:
    """Distance between two segments, 0 when they meet."""
    ends = F.least(
        segment_distance(ax, ay, cx, cy, dx, dy), segment_distance(bx, by, cx, cy, dx, dy),
        segment_distance(cx, cy, ax, ay, bx, by), segment_distance(dx, dy, ax, ay, bx, by),
    )
    return F.when(segments_cross(ax, ay, bx, by, cx, cy, dx, dy), 0.0).otherwise(ends)


def collinear_overlap(ax, ay, bx, by, cx, cy, dx, dy, tol: float) -> Column:
    """Length that CD shares with AB when both ends of the shared part lie within ``tol`` of AB's line."""
    n = F.hypot(bx - ax, by - ay)
    ux, uy = (bx - ax) / F.nullif(n, F.lit(0.0)), (by - ay) / F.nullif(n, F.lit(0.0))
    t1, t2 = (cx - ax) * ux + (cy - ay) * uy, (dx - ax) * ux + (dy - ay) * uy
    o1, o2 = cross(ux, uy, cx - ax, cy - ay), cross(ux, uy, dx - ax, dy - ay)
    flat = (F.abs(o1) <= tol) & (F.abs(o2) <= tol)
    shared = F.least(F.greatest(t1, t2), n) - F.greatest(F.least(t1, t2), F.lit(0.0))
    return F.when(flat, F.greatest(shared, F.lit(0.0))).otherwise(0.0)


def offset_point(x1, y1, x2, y2, d) -> Column:
    """Start of the segment moved ``d`` to the left of its direction."""
    n = F.nullif(F.hypot(x2 - x1, y2 - y1), F.lit(0.0))
    return xy(x1 - d * (y2 - y1) / n, y1 + d * (x2 - x1) / n)


def normal_vector(x1, y1, x2, y2) -> Column:
    """Unit vector to the left of the segment; zero for a zero length."""
    n = F.hypot(x2 - x1, y2 - y1)
    zero = F.lit(0.0)
    return xy(
        F.when(n > 0, -(y2 - y1) / F.nullif(n, zero)).otherwise(0.0),
        F.when(n > 0, (x2 - x1) / F.nullif(n, zero)).otherwise(0.0),
    )


def vertex_key(v: Column, tol: float) -> Column:
    """Integer key of a coordinate quantised to ``tol``."""
    return F.bround(v / F.lit(tol)).cast("long")


# --- rings and lines ---------------------------------------------------------

def box_ring(minx, miny, maxx, maxy) -> Column:
    """Counter-clockwise ring of a box, not closed."""
    return F.array(xy(minx, miny), xy(maxx, miny), xy(maxx, maxy), xy(minx, maxy))


def is_box(ring: Column) -> Column:
    """The open ring runs along its bounding box, from corner to corner."""
    def along(r, b):
        on = lambda e: ((e["x1"] == b["minx"]) | (e["x1"] == b["maxx"])) & ((e["y1"] == b["miny"]) | (e["y1"] == b["maxy"]))
        straight = lambda e: (e["x1"] == e["x2"]) != (e["y1"] == e["y2"])
        corners = (F.size(r) == 4) & (F.size(F.array_distinct(r)) == 4)
        return corners & F.forall(ring_edges(r), lambda e: on(e) & straight(e))

    return F.coalesce(let(ring, lambda r: let(ring_box(r), lambda b: along(r, b))), F.lit(False))


def open_ring(ring: Column) -> Column:
    """Ring without a repeated last vertex."""
    closed = (F.size(ring) > 1) & (F.element_at(ring, 1) == F.element_at(ring, -1))
    return F.when(closed, F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)


def close_ring(ring: Column) -> Column:
    """Ring whose last vertex repeats the first."""
    closed = F.element_at(ring, 1) == F.element_at(ring, -1)
    return F.when(closed, ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def _next(ring: Column) -> Column:
    return F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def signed_area(ring: Column) -> Column:
    """Shoelace area, positive for counter-clockwise rings; taken around the first vertex."""
    def around(r, o):
        return _sum(F.zip_with(r, _next(r), lambda p, q: cross(p["x"] - o["x"], p["y"] - o["y"], q["x"] - o["x"], q["y"] - o["y"])))

    return let(ring, lambda r: let(F.element_at(r, 1), lambda o: around(r, o))) / 2


def ring_area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def ring_perimeter(ring: Column) -> Column:
    return let(ring, lambda r: _sum(F.zip_with(r, _next(r), lambda p, q: F.hypot(q["x"] - p["x"], q["y"] - p["y"]))))


def line_length(line: Column) -> Column:
    head, tail = F.slice(line, F.lit(1), F.size(line) - 1), F.slice(line, F.lit(2), F.size(line) - 1)
    return _sum(F.zip_with(head, tail, lambda p, q: F.hypot(q["x"] - p["x"], q["y"] - p["y"])))


def ring_centroid(ring: Column) -> Column:
    """Area centroid; the vertex mean for (nearly) flat rings."""
    def moment(r, o, axis):
        return _sum(F.zip_with(r, _next(r), lambda p, q: (p[axis] - o[axis] + q[axis] - o[axis]) * cross(
            p["x"] - o["x"], p["y"] - o["y"], q["x"] - o["x"], q["y"] - o["y"])))

    mean = lambda r, axis: _sum(F.transform(r, lambda p: p[axis])) / F.size(r)

    def centre(r, o, a, axis):
        return F.when(F.abs(a) < 1e-9, mean(r, axis)).otherwise(o[axis] + moment(r, o, axis) / F.nullif(6 * a, F.lit(0.0)))

    # axis by axis, so that the other one is not worked out where one is read
    of = lambda axis: let(ring, lambda r: let(F.element_at(r, 1), lambda o: let(signed_area(r), lambda a: centre(r, o, a, axis))))
    return xy(of("x"), of("y"))


def ring_box(ring: Column) -> Column:
    lo = lambda a: F.array_min(F.transform(ring, lambda p: p[a]))
    hi = lambda a: F.array_max(F.transform(ring, lambda p: p[a]))
    return F.struct(lo("x").alias("minx"), lo("y").alias("miny"), hi("x").alias("maxx"), hi("y").alias("maxy"))


def orient(ring: Column, clockwise: bool) -> Column:
    """Ring in the wanted direction."""
    def turned(r):
        area = signed_area(r)
        return F.when(area > 0 if clockwise else area < 0, F.reverse(r)).otherwise(r)

    return let(ring, turned)


def rotate_ring(ring: Column, start: Column) -> Column:
    """Ring that starts at 0-based vertex ``start``."""
    turned = lambda r, at: F.concat(F.slice(r, at + 1, F.size(r) - at), F.slice(r, F.lit(1), at))
    return let(ring, lambda r: let(start, lambda at: turned(r, at)))


def start_vertex(ring: Column, rule: str, px: Column | None = None, py: Column | None = None) -> Column:
    """0-based start vertex by rule.

    ``sw se ne nw``: lowest or highest y, then lowest or highest x; ``north``: highest y, then
    lowest x; ``point``: closest to ``(px, py)``.  Ties go to the earliest vertex.
    """
    signs = {"sw": (1, 1), "se": (1, -1), "ne": (-1, -1), "nw": (-1, 1), "north": (-1, 1)}

    def key(p):
        if rule == "point":
            dx, dy = p["x"] - px, p["y"] - py
            return F.struct((dx * dx + dy * dy).alias("k"))
        sy, sx = signs[rule]
        return F.struct((p["y"] * sy).alias("ky"), (p["x"] * sx).alias("kx"))

    keyed = F.transform(ring, lambda p, i: F.struct(key(p).alias("k"), i.alias("i")))
    return F.array_min(keyed)["i"]


def point_in_ring(px, py, ring: Column) -> Column:
    """Crossing-count test; points on the boundary may fall on either side."""
    def hit(p, q):
        spans = (p["y"] > py) != (q["y"] > py)
        at = (q["x"] - p["x"]) * (py - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) + p["x"]
        return F.when(spans & (px < at), 1).otherwise(0)

    return let(ring, lambda r: F.aggregate(F.zip_with(r, _next(r), hit), F.lit(0), lambda a, v: a + v)) % 2 == 1


def ring_distance(px, py, ring: Column) -> Column:
    """Distance to the boundary."""
    return let(ring, lambda r: F.array_min(F.zip_with(r, _next(r), lambda p, q: segment_distance(px, py, p["x"], p["y"], q["x"], q["y"]))))


def covers(px, py, ring: Column, tol: float = 1e-9) -> Column:
    """Inside or on the boundary."""
    return point_in_ring(px, py, ring) | (ring_distance(px, py, ring) <= tol)


def drop_close_vertices(ring: Column, d: float) -> Column:
    """Vertices at least ``d`` from the last kept one; the last goes when it is near the first."""
    def far(p, q):
        return F.hypot(p["x"] - q["x"], p["y"] - q["y"]) >= d

    def keep(r):
        return F.aggregate(
            F.slice(r, F.lit(2), F.size(r) - 1), F.slice(r, 1, 1),
            lambda acc, p: F.when(far(F.element_at(acc, -1), p), F.concat(acc, F.array(p))).otherwise(acc),
        )

    def open_end(kept):
        near = (F.size(kept) > 1) & ~far(F.element_at(kept, 1), F.element_at(kept, -1))
        return F.when(near, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)

    return let(let(ring, keep), open_end)


# --- polygons against lines and polygons -------------------------------------

def ring_edges(ring: Column) -> Column:
    """Edges of a ring as ``array<struct<x1,y1,x2,y2>>``."""
    return let(ring, lambda r: F.zip_with(r, _next(r), lambda p, q: F.struct(
        p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))))


def _cuts(x1, y1, x2, y2, edges: Column, tol: float) -> Column:
    """Sorted positions 0..1 where the segment meets the edges or passes their corners."""
    def of_edge(e):
        dx, dy, ex, ey = x2 - x1, y2 - y1, e["x2"] - e["x1"], e["y2"] - e["y1"]
        solid = lambda den: F.when(F.abs(den) <= 1e-12 * (F.hypot(dx, dy) * F.hypot(ex, ey)), F.lit(None)).otherwise(den)
        at = lambda d: F.struct((cross(e["x1"] - x1, e["y1"] - y1, ex, ey) / d).alias("t"), (cross(e["x1"] - x1, e["y1"] - y1, dx, dy) / d).alias("u"))
        met = let(let(let(cross(dx, dy, ex, ey), solid), at), lambda m: F.when((m["t"] >= 0) & (m["t"] <= 1) & (m["u"] >= 0) & (m["u"] <= 1), m["t"]))
        n2 = F.nullif(dx * dx + dy * dy, F.lit(0.0))
        near = segment_distance(e["x1"], e["y1"], x1, y1, x2, y2) <= tol
        passed = let(((e["x1"] - x1) * dx + (e["y1"] - y1) * dy) / n2, lambda s: F.when((s >= 0) & (s <= 1) & near, s))
        return F.array(met, passed)

    inner = F.array_compact(F.flatten(F.transform(edges, of_edge)))
    return F.sort_array(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), inner)))


def _parts(cuts: Column) -> Column:
    pairs = let(cuts, lambda c: F.zip_with(
        F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    ))
    return F.filter(pairs, lambda p: p["b"] - p["a"] > 1e-12)


def length_in_ring(x1, y1, x2, y2, ring: Column, tol: float = 1e-6) -> Column:
    """Length of the segment inside the ring or on its boundary."""
    def share_in(r):
        parts = _parts(_cuts(x1, y1, x2, y2, ring_edges(r), tol))
        middle = lambda p: let((p["a"] + p["b"]) / 2, lambda m: xy(x1 + m * (x2 - x1), y1 + m * (y2 - y1)))
        inside = lambda p: let(middle(p), lambda c: covers(c["x"], c["y"], r, tol))
        return F.aggregate(F.filter(parts, inside), F.lit(0.0), lambda acc, p: acc + p["b"] - p["a"])

    share = let(ring, share_in)
    return share * F.hypot(x2 - x1, y2 - y1)


# --- along lines -------------------------------------------------------------

def along(line: Column, d: Column) -> Column:
    """Point at distance ``d`` from the start of a line, clamped to its ends."""
    head, tail = F.slice(line, F.lit(1), F.size(line) - 1), F.slice(line, F.lit(2), F.size(line) - 1)
    steps = F.zip_with(head, tail, lambda p, q: F.struct(
        p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"),
        F.hypot(q["x"] - p["x"], q["y"] - p["y"]).alias("len")))
    first = F.element_at(line, 1)
    start = F.struct(F.greatest(d, F.lit(0.0)).alias("left"), first["x"].alias("x"), first["y"].alias("y"))

    def walk(acc, s):
        f = F.when(s["len"] > 0, F.least(acc["left"] / F.nullif(s["len"], F.lit(0.0)), F.lit(1.0))).otherwise(1.0)
        done = acc["left"] <= 0
        return F.struct(
            F.greatest(acc["left"] - s["len"], F.lit(0.0)).alias("left"),
            F.when(done, acc["x"]).otherwise(s["x1"] + f * (s["x2"] - s["x1"])).alias("x"),
            F.when(done, acc["y"]).otherwise(s["y1"] + f * (s["y2"] - s["y1"])).alias("y"),
        )

    end = F.aggregate(steps, start, walk)
    return xy(end["x"], end["y"])


def upright(angle: Column) -> Column:
    """Angle turned to -90..90 so that text stands upright; near-vertical becomes 90."""
    a = F.pmod(angle + 180.0, F.lit(360.0)) - 180.0
    a = F.when(a == -180.0, 180.0).otherwise(a)
    a = F.when(a > 90, a - 180).otherwise(a)
    a = F.when(a <= -90, a + 180).otherwise(a)
    return F.when(F.abs(a) > 89.0, 90.0).otherwise(a)


def tangent_angle(line: Column, fraction, delta: float = 0.01) -> Column:
    """Upright direction of a line around a fraction of its length."""
    length, f = line_length(line), F.least(F.greatest(F.lit(fraction), F.lit(0.0)), F.lit(1.0))
    p = along(line, F.greatest(f - delta, F.lit(0.0)) * length)
    q = along(line, F.least(f + delta, F.lit(1.0)) * length)
    dx, dy = q["x"] - p["x"], q["y"] - p["y"]
    still = (F.abs(dx) < 1e-12) & (F.abs(dy) < 1e-12)
    return F.when(still, 0.0).otherwise(upright(F.degrees(F.atan2(dy, dx))))
