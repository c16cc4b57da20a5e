"""Cadastral operators: vertex and segment tables, neighbours, overlays, roads, descriptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.grid import box_pairs, cell, cover
from ..core.lineage import cut
from ..core.numbering import number_rows
from ..core.skew import exploded, salted_join
from ..functions import geometry as G
from .graph import chain_rings, thin_by_distance
from .overlay import covered_sums, feature_area, overlay_sums, ring_rows
from .spatial import BOX, ENDS, with_box
from .vertical import sample_raster

SLIVER = 0.5
AREA_TOLERANCE = 0.5
AREA_TOLERANCE_SHARE = 0.0001


def attach_registry(features: DataFrame, registry: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join of registry attributes; the key column is dropped."""
    return salted_join(features, registry, [key], [spread], "left").drop(key)


# --- vertices and segments ---------------------------------------------------

def segments(rings: DataFrame, poly_id: str, ring: str = "ring") -> DataFrame:
    """Consecutive vertices of each ring, the last closing to the first.

    ``seg_no`` from 1, end points, azimuth, length, label "i – j" and the azimuth before.
    No shuffle: neighbours come from the vertex array itself.
    """
    r = F.col(ring)
    n = F.size(r)
    at = lambda i: F.get(r, F.pmod(i, n))
    parts = F.transform(r, lambda p, i: F.struct(
        (i + 1).alias("seg_no"), at(i - 1).alias("_b"), p.alias("_p"), at(i + 1).alias("_q"), n.alias("_n")))
    s = exploded(rings.select(*[c for c in rings.columns if c != ring], F.explode(parts).alias("_s"))).select("*", "_s.*").drop("_s")
    bx, by, x1, y1, x2, y2 = (F.col(c) for c in ("_b.x", "_b.y", "_p.x", "_p.y", "_q.x", "_q.y"))
    label = F.format_string("%d – %d", F.col("seg_no"), F.when(F.col("seg_no") < F.col("_n"), F.col("seg_no") + 1).otherwise(1))
    return s.select(
        *[c for c in rings.columns if c != ring], "seg_no", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"),
        G.azimuth(x1, y1, x2, y2).alias("azimuth"), G.distance(x1, y1, x2, y2).alias("dist"), label.alias("label"),
        F.when(F.col("seg_no") > 1, G.azimuth(bx, by, x1, y1)).alias("azimuth_before"), (F.col("seg_no") == F.col("_n")).alias("is_last"),
    )


def line_segments(lines: DataFrame, line: str = "line") -> DataFrame:
    """Consecutive vertices of each line with the distance ``m`` at their start."""
    v = F.col(line)
    n = F.size(v)
    parts = F.transform(F.slice(v, F.lit(1), n - 1), lambda p, i: F.struct((i + 1).alias("seg_no"), p.alias("_p"), F.get(v, i + 1).alias("_q"),
                        G.line_length(F.slice(v, F.lit(1), i + 1)).alias("m")))
    keep = [c for c in lines.columns if c != line]
    return exploded(lines.select(*keep, F.explode(parts).alias("_s"))).select(
        *keep, "_s.seg_no", F.col("_s._p.x").alias("x1"), F.col("_s._p.y").alias("y1"), F.col("_s._q.x").alias("x2"), F.col("_s._q.y").alias("y2"), "_s.m")


def turn_side(segs: DataFrame) -> DataFrame:
    """Adds ``turn`` (-180..180) and ``side``: right when negative, left otherwise; null on the first."""
    d = G.turn(F.col("azimuth_before"), F.col("azimuth"))
    return segs.withColumn("turn", d).withColumn("side", F.when(d < 0, "à direita").when(d >= 0, "à esquerda"))


def number_vertices(rings: DataFrame, poly_id: str, tol: float = 0.01) -> DataFrame:
    """One number per quantised vertex in order of appearance: ``vx, vy, vertex_no, x, y``."""
    v = exploded(rings.select(F.col(poly_id).alias("_p"), F.posexplode("ring").alias("_i", "_v"))).select(
        "_p", "_i", "_v.x", "_v.y", G.vertex_key(F.col("_v.x"), tol).alias("vx"), G.vertex_key(F.col("_v.y"), tol).alias("vy"))
    first = v.groupBy("vx", "vy").agg(F.min(F.struct("_p", "_i", "x", "y")).alias("_f")).select(
        "vx", "vy", F.col("_f._p").alias("_p"), F.col("_f._i").alias("_i"), F.col("_f.x").alias("x"), F.col("_f.y").alias("y"))
    return number_rows(first, [], "_p", ["_i"], "vertex_no").drop("_p", "_i")


def number_vertices_ranked(
    perimeter: DataFrame, lots: DataFrame, roads: DataFrame, lot_rank: str, road_order: str, tol: float = 0.01
) -> DataFrame:
    """Vertex codes P-001...: perimeter clockwise from the north, then lots, then roads.

    Lot vertices go by lot rank, north to south, west to east; road vertices in line order.
    ``perimeter`` has ``part, ring``, lots ``lot_rank, ring``, roads ``road_order, line``.
    """
    key = lambda df: df.withColumn("vx", G.vertex_key(F.col("x"), tol)).withColumn("vy", G.vertex_key(F.col("y"), tol))
    cw = G.orient(F.col("ring"), True)
    ring = perimeter.select("part", cw.alias("ring")).select(
        "part", F.posexplode(G.rotate_ring(F.col("ring"), G.start_vertex(F.col("ring"), "north"))).alias("_i", "_v"))
    no = F.lit(0.0)
    per = key(ring.select(F.lit(0).alias("_sect"), F.col("part").cast("double").alias("_a"), F.col("_i").cast("double").alias("_b"), no.alias("_c"), "_v.x", "_v.y"))
    lot = key(lots.select(F.col(lot_rank).cast("double").alias("_a"), F.explode("ring").alias("_v")).select(
        F.lit(1).alias("_sect"), "_a", (-F.col("_v.y")).alias("_b"), F.col("_v.x").alias("_c"), "_v.x", "_v.y"))
    road = key(roads.select(F.col(road_order).cast("double").alias("_a"), F.posexplode("line").alias("_i", "_v")).select(
        F.lit(2).alias("_sect"), "_a", F.col("_i").cast("double").alias("_b"), no.alias("_c"), "_v.x", "_v.y"))
    all_ = per.unionByName(lot).unionByName(road)
    first = all_.groupBy("vx", "vy").agg(F.min(F.struct("_sect", "_a", "_b", "_c", "x", "y")).alias("_f")).select("vx", "vy", "_f.*")
    numbered = number_rows(first, ["_sect"], "_a", ["_b", "_c", "vx", "vy"], "_n")
    sizes = first.groupBy("_sect").agg(F.count(F.lit(1)).alias("_k"))  # three rows
    ahead = sizes.select(F.col("_sect").alias("_s2"), F.col("_k").alias("_k2"))
    shift = sizes.join(F.broadcast(ahead), F.col("_s2") < F.col("_sect"), "left").groupBy("_sect").agg(
        F.coalesce(F.sum("_k2"), F.lit(0)).alias("_shift"))
    out = numbered.join(F.broadcast(shift), "_sect").withColumn("vertex_no", F.col("_n") + F.col("_shift"))
    return out.select("vx", "vy", "x", "y", "vertex_no", F.format_string("P-%03d", F.col("vertex_no")).alias("code"), (F.col("_sect") == 0).alias("on_perimeter"))


def rotate_start(features: DataFrame, rule: str, px: str | None = None, py: str | None = None) -> DataFrame:
    """Rings rotated to their start vertex (see ``start_vertex``)."""
    at = G.start_vertex(F.col("ring"), rule, F.col(px) if px else None, F.col(py) if py else None)
    return features.withColumn("ring", G.rotate_ring(F.col("ring"), at))


# --- neighbours --------------------------------------------------------------

def edge_key(tol: float = 0.01) -> Column:
    """Unordered quantised end points of a segment."""
    p = F.struct(G.vertex_key(F.col("x1"), tol).alias("x"), G.vertex_key(F.col("y1"), tol).alias("y"))
    q = F.struct(G.vertex_key(F.col("x2"), tol).alias("x"), G.vertex_key(F.col("y2"), tol).alias("y"))
    return F.struct(F.least(p, q).alias("a"), F.greatest(p, q).alias("b"))


def shared_edges(segs: DataFrame, poly_id: str, tol: float = 0.01) -> DataFrame:
    """Adds ``copies`` (edge multiplicity) and ``neighbour``: lowest other polygon with the same edge."""
    keyed = segs.withColumn("_k", edge_key(tol))
    per = keyed.groupBy("_k", F.col(poly_id).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    low = per.groupBy("_k").agg(F.min("_p").alias("_m1"), F.sum("_n").alias("copies"))
    # the second lowest polygon serves the lowest one
    second = salted_join(per, low, ["_k"], ["_p"]).filter(F.col("_p") > F.col("_m1")).groupBy("_k").agg(F.min("_p").alias("_m2"))
    both = low.join(second, "_k", "left")
    out = salted_join(keyed, both, ["_k"], [poly_id, "seg_no"])
    return out.withColumn("neighbour", F.when(F.col(poly_id) != F.col("_m1"), F.col("_m1")).otherwise(F.col("_m2"))).drop("_k", "_m1", "_m2")


def segment_pairs(left: DataFrame, right: DataFrame, reach: float, size: float, spread: Sequence[str]) -> DataFrame:
    """Segment pairs whose boxes come within ``reach``; right columns get an ``r_`` prefix."""
    lo = lambda a, b: F.least(a, b)
    boxed = left.withColumns({"_l0": lo("x1", "x2"), "_l1": lo("y1", "y2"), "_l2": F.greatest("x1", "x2"), "_l3": F.greatest("y1", "y2")})
    r = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns]).withColumns(
        {"_r0": lo("r_x1", "r_x2"), "_r1": lo("r_y1", "r_y2"), "_r2": F.greatest("r_x1", "r_x2"), "_r3": F.greatest("r_y1", "r_y2")})
    out = box_pairs(boxed, r, [f"_l{i}" for i in range(4)], [f"_r{i}" for i in range(4)], size, spread, reach)
    return out.drop(*[f"_{s}{i}" for s in "lr" for i in range(4)])


def _gap() -> Column:
    return G.segment_gap(*[F.col(c) for c in ENDS], *[F.col(f"r_{c}") for c in ENDS])


def road_neighbour(segs: DataFrame, roads: DataFrame, poly_id: str, tol: float = 1.0, size: float = 10.0) -> DataFrame:
    """Edges without a neighbour that touch a road within ``tol``: ``poly_id, seg_no``."""
    lone = segs.filter(F.col("neighbour").isNull())
    pairs = segment_pairs(lone.select(poly_id, "seg_no", *ENDS), roads.select(*ENDS), tol, size, [poly_id, "seg_no"])
    return pairs.filter(_gap() <= tol).select(poly_id, "seg_no").distinct()


def best_neighbour(
    segs: DataFrame, lots: DataFrame, roads: DataFrame, poly_id: str, lot_id: str, road_name: str,
    buffer: float = 0.05, near: float = 1.0, min_overlap: float = 0.0, size: float = 10.0,
) -> DataFrame:
    """Lot and road beside each edge and the chosen ``kind`` (lot, road or null).

    Road: smallest mid-point distance, then longest overlap, among roads within ``buffer``;
    failing that the closest within ``near``.  Lot: longest overlap with another lot.  The lot
    wins when its overlap is at least the road's.
    """
    key = [poly_id, "seg_no"]
    e, r = [F.col(c) for c in ENDS], [F.col(f"r_{c}") for c in ENDS]
    base = segs.select(*key, *ENDS)
    rp = segment_pairs(base, roads.select(road_name, *ENDS), max(buffer, near), size, key)
    mx, my = (e[0] + e[2]) / 2, (e[1] + e[3]) / 2
    # a road is all its segments: distances combine by minimum, overlaps by sum
    road = (
        rp.withColumn("_gap", _gap())
        .withColumn("_mid", G.segment_distance(mx, my, *r))
        .withColumn("_ov", G.collinear_overlap(*e, *r, 1e-6))
        .groupBy(*key, F.col(f"r_{road_name}").alias("_name"))
        .agg(F.min("_gap").alias("_gap"), F.min("_mid").alias("_mid"), F.sum("_ov").alias("_ov"))
    )
    touching = (F.col("_gap") <= buffer) & (F.col("_ov") >= min_overlap)
    order = F.struct(F.round("_mid", 6).alias("m"), (-F.col("_ov")).alias("o"), F.col("_name").alias("n"))
    roads_best = road.groupBy(*key).agg(
        F.min(F.when(touching, order)).alias("_t"),
        F.min(F.when(F.col("_gap") <= near, F.struct(F.col("_gap").alias("g"), F.col("_name").alias("n"), F.col("_ov").alias("o")))).alias("_c"),
    ).select(
        *key, F.coalesce("_t.n", "_c.n").alias("road"), F.coalesce(-F.col("_t.o"), F.col("_c.o")).alias("road_overlap"))
    lot_edges = segments(lots.select(lot_id, "ring"), lot_id).select(lot_id, *ENDS)
    lp = segment_pairs(base, lot_edges, buffer, size, key).filter(F.col(f"r_{lot_id}") != F.col(poly_id))
    shared = lp.groupBy(*key, F.col(f"r_{lot_id}").alias("_lot")).agg(F.sum(G.collinear_overlap(*e, *r, 1e-6)).alias("_ov")).filter("_ov > 0")
    lots_best = shared.groupBy(*key).agg(F.min(F.struct((-F.round("_ov", 6)).alias("o"), F.col("_lot").alias("l"))).alias("_b")).select(
        *key, F.col("_b.l").alias("lot"), (-F.col("_b.o")).alias("lot_overlap"))
    out = base.join(roads_best, key, "left").join(lots_best, key, "left")
    ro, lo = F.coalesce("road_overlap", F.lit(0.0)), F.coalesce("lot_overlap", F.lit(0.0))
    return out.withColumn("kind", F.when(F.col("lot").isNotNull() & (lo >= ro), "lot").when(F.col("road").isNotNull(), "road"))


def access_roads(
    lots: DataFrame, roads: DataFrame, lot_id: str, road_name: str, min_overlap: float = 0.05,
    near: float = 1.0, size: float = 10.0,
) -> DataFrame:
    """Access roads per lot in order, with the corner-lot flag: ``lot_id, roads, corner``.

    Roads by length inside the lot or on its edge (at least ``min_overlap``); without any, by
    distance up to ``near``.  A corner lot has two different roads in front.
    """
    a = with_box(lots).select(lot_id, "ring", *BOX)
    r = roads.select(road_name, *ENDS).withColumns(
        {"_r0": F.least("x1", "x2"), "_r1": F.least("y1", "y2"), "_r2": F.greatest("x1", "x2"), "_r3": F.greatest("y1", "y2")})
    pairs = box_pairs(a, r, BOX, [f"_r{i}" for i in range(4)], size, [lot_id], near)
    e = [F.col(c) for c in ENDS]
    gap = F.array_min(F.transform(G.ring_edges(F.col("ring")), lambda o: G.segment_gap(*e, *[o[c] for c in ENDS])))
    inside = G.length_in_ring(*e, F.col("ring"))
    per = pairs.withColumn("_len", inside).withColumn("_gap", F.when(F.col("_len") > 0, 0.0).otherwise(gap)).groupBy(lot_id, road_name).agg(
        F.sum("_len").alias("_len"), F.min("_gap").alias("_gap"))
    # roads of one lot: bounded by what passes a lot
    by_len = F.array_sort(F.collect_list(F.when(F.col("_len") >= min_overlap, F.struct((-F.round("_len", 6)).alias("o"), F.col(road_name).alias("n")))))
    by_gap = F.array_sort(F.collect_list(F.when(F.col("_gap") <= near, F.struct(F.round("_gap", 6).alias("o"), F.col(road_name).alias("n")))))
    agg = per.groupBy(lot_id).agg(by_len.alias("_l"), by_gap.alias("_g"))
    names = F.transform(F.when(F.size("_l") > 0, F.col("_l")).otherwise(F.col("_g")), lambda s: s["n"])
    out = agg.select(lot_id, names.alias("roads")).filter(F.size("roads") > 0).withColumn(
        "corner", F.size(F.array_distinct(F.slice("roads", 1, 2))) >= 2)
    return exploded(out)  # lots with their rings would be broadcast to it


def along_line_distance(points: DataFrame, lines: DataFrame, point_id: str, line_id: str, role: str, reach: float) -> DataFrame:
    """Shortest distance along a line between its ``corner`` and ``front`` points: ``line_id, dist``.

    Points of both roles are projected on the line; the closest pair along it is found from
    neighbours in line order, not from all pairs.
    """
    from .flight import cells_along

    segs = line_segments(lines)
    laid = cells_along(segs, reach)
    keyed = points.withColumn("_cx", cell(F.col("x"), reach)).withColumn("_cy", cell(F.col("y"), reach))
    e = [F.col(c) for c in ENDS]
    near = salted_join(keyed, laid, [line_id, "_cx", "_cy"], [point_id]).withColumn("_d", G.segment_distance(F.col("x"), F.col("y"), *e))
    m = F.col("m") + G.project_fraction(F.col("x"), F.col("y"), *e) * F.hypot(e[2] - e[0], e[3] - e[1])
    proj = near.filter(F.col("_d") <= reach).groupBy(line_id, point_id, role).agg(F.min_by(m, F.struct("_d", m)).alias("m"))
    from pyspark.sql import Window

    before = Window.partitionBy(line_id, "_b").orderBy("m", role).rowsBetween(Window.unboundedPreceding, 0)
    # sliced along the line; each slice also sees the last of both roles before it
    sliced = proj.withColumn("_b", F.floor(F.col("m") / (reach * 64)))
    last = lambda r: F.max(F.when(F.col(role) == r, F.col("m")))
    ends = sliced.groupBy(line_id, "_b").agg(last("corner").alias("_lc"), last("front").alias("_lf"))
    carry = Window.partitionBy(line_id).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(line_id, "_b", F.max("_lc").over(carry).alias("_pc"), F.max("_lf").over(carry).alias("_pf"))
    seen = sliced.join(ends, [line_id, "_b"]).withColumn("_c", F.greatest(last("corner").over(before), "_pc")).withColumn(
        "_f", F.greatest(last("front").over(before), "_pf"))
    gap = F.when(F.col(role) == "corner", F.col("m") - F.col("_f")).otherwise(F.col("m") - F.col("_c"))
    return seen.groupBy(line_id).agg(F.min(gap).alias("dist")).filter(F.col("dist").isNotNull())


def frontage_vertex(
    lots: DataFrame, doors: DataFrame, lot_id: str, door_id: str, reach: float | None = None, size: float = 10.0, grow: float = 8.0,
    roads: DataFrame | None = None, road: str | None = None,
) -> DataFrame:
    """Rings turned to start at the frontage: the more northern end of the edge closest to the nearest door.

    With ``reach``, lots without a door that near go by their access road: ``roads`` are segments with a name in column
    ``road``, which ``lots`` has too, and the ring starts at the most northern (then most western) corner of the
    edges that the road of that name meets.  Lots without either keep their start.  Without ``reach`` the search
    widens until every lot has its nearest door.
    """
    from .spatial import points_near_polygons

    def nearest_door(asked, reach, size):
        near = points_near_polygons(doors.select(door_id, "x", "y"), asked.select(lot_id, "ring"), reach, size, door_id)
        return near.groupBy(lot_id).agg(F.min(F.struct("_d", door_id, "x", "y")).alias("_b")).select(
            lot_id, F.col("_b.x").alias("_dx"), F.col("_b.y").alias("_dy"))

    if reach is not None:
        door = nearest_door(lots, reach, size)
    else:
        open_, door, some = lots, None, not doors.filter(F.col("x").isNotNull() & F.col("y").isNotNull()).isEmpty()
        while True:
            found = cut(nearest_door(open_, size, size))
            door = found if door is None else door.unionByName(found)
            open_ = cut(open_.join(found.select(lot_id), lot_id, "left_anti").filter(F.size("ring") > 0))
            if not some or open_.isEmpty():
                break
            size *= grow
    r = F.col("ring")
    n = F.size(r)
    keyed = F.transform(G.ring_edges(r), lambda e, i: F.struct(
        # a corner is as far from both of its edges; rounding must not choose between them
        F.round(G.segment_distance(F.col("_dx"), F.col("_dy"), *[e[c] for c in ENDS]), 9).alias("d"), i.alias("i"),
        F.when(e["y1"] >= e["y2"], i).otherwise((i + 1) % n).alias("start")))
    start = F.array_min(keyed)["start"].cast("int")
    found = lots.join(door, lot_id, "left")
    if roads is None:
        by_road = F.lit(None).cast("int")
    else:
        bare = lots.join(door.select(lot_id), lot_id, "left_anti").filter(F.col(road).isNotNull())
        edges = segments(bare.select(lot_id, road, F.size("ring").alias("_size"), "ring"), lot_id).select(lot_id, road, "_size", "seg_no", *ENDS)
        met = segment_pairs(edges, roads.select(road, *ENDS), 0.0, size, [lot_id]).filter(F.col(road) == F.col(f"r_{road}"))
        met = met.filter(G.segments_cross(*[F.col(c) for c in ENDS], *[F.col(f"r_{c}") for c in ENDS]))
        corner = lambda x, y, i: F.struct((-F.col(y)).alias("s"), F.col(x).alias("x"), i.alias("i"))
        ends = met.select(lot_id, F.explode(F.array(corner("x1", "y1", F.col("seg_no") - 1), corner("x2", "y2", F.col("seg_no") % F.col("_size")))).alias("_c"))
        found = found.join(ends.groupBy(lot_id).agg(F.min("_c")["i"].cast("int").alias("_road_start")), lot_id, "left")
        by_road = F.col("_road_start")
    turned = F.when(F.col("_dx").isNotNull(), G.rotate_ring(r, start)).when(by_road.isNotNull(), G.rotate_ring(r, by_road)).otherwise(r)
    return found.withColumn("ring", turned).drop("_dx", "_dy", "_road_start")


def sorted_report(detail: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows of a report: those with a positive ``value``, ordered by ``keys`` (a distributed range sort)."""
    return detail.filter(F.col(value) > 0).orderBy(*keys)


# --- overlays ----------------------------------------------------------------

def overlay_area(props: DataFrame, uses: DataFrame, prop_id: str, use_id: str, size: float, attrs: Sequence[str] = ()) -> DataFrame:
    """Shared area of each property and use, slivers left out: ``prop_id, use_id, attrs, area``.  Parts and holes count (see ``overlay``)."""
    out = overlay_sums(props, uses, prop_id, use_id, size).filter(F.col("area") >= SLIVER)
    # a plain join: counting hot keys first would compute the areas twice; AQE splits a hot use
    return out.join(exploded(uses.select(use_id, *attrs)), use_id).select(prop_id, use_id, *attrs, "area") if attrs else out


def covered_area(props: DataFrame, uses: DataFrame, prop_id: str, use_id: str, size: float) -> DataFrame:
    """Area of each property under at least one use: ``prop_id, covered``; none for those only touched.  Parts and holes count."""
    return covered_sums(props, uses, prop_id, use_id, size).withColumnRenamed("area", "covered").filter("covered > 1e-9")


def land_use_closure(
    props: DataFrame, overlay: DataFrame, covered: DataFrame, prop_id: str, attrs: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Detail by class in hectares, closure check and overlap list.

    Detail gets a ``SEM_USO`` row for the uncovered part; differences up to
    max(0.5 m², 0.01 % of the area) count as zero.
    """
    ha = 10000.0
    total = exploded(feature_area(props, prop_id).withColumnRenamed("area", "total"))
    by_class = overlay.groupBy(prop_id, *attrs).agg(F.sum("area").alias("area"))
    sums = overlay.groupBy(prop_id).agg(F.sum("area").alias("used"))
    tol = F.greatest(F.lit(AREA_TOLERANCE), F.col("total") * AREA_TOLERANCE_SHARE)
    c = (
        total.join(sums, prop_id, "left").join(covered, prop_id, "left")
        .withColumn("used", F.coalesce("used", F.lit(0.0))).withColumn("covered", F.coalesce("covered", F.lit(0.0)))
        .withColumn("covered", F.when(F.col("used") > 0, F.col("covered")).otherwise(0.0))
        .withColumn("_tol", tol)
    )
    snap = lambda v: F.when(F.abs(v) <= F.col("_tol"), 0.0).otherwise(v)
    c = c.withColumn("gap", snap(F.col("total") - F.col("covered"))).withColumn("excess", snap(F.col("used") - F.col("total"))).withColumn(
        "overlap", F.greatest(F.col("used") - F.col("covered"), F.lit(0.0)))
    detail = by_class.join(total, prop_id).select(prop_id, "total", *attrs, "area")
    bare = c.filter(F.col("gap") > F.col("_tol")).select(prop_id, "total", *[F.lit("SEM_USO").alias(a) for a in attrs], F.col("gap").alias("area"))
    detail = detail.unionByName(bare).filter(F.col("area") > 0).select(
        prop_id, (F.col("total") / ha).alias("total_ha"), *attrs, (F.col("area") / ha).alias("area_ha"))
    check = c.select(prop_id, (F.col("total") / ha).alias("total_ha"), (F.col("used") / ha).alias("used_ha"), (F.col("gap") / ha).alias("gap_ha"),
                     (F.when(F.col("used") > 0, F.col("excess")).otherwise(0.0) / ha).alias("excess_ha"), (F.col("overlap") / ha).alias("overlap_ha"))
    overlaps = c.filter(F.col("overlap") > F.col("_tol")).select(
        prop_id, (F.col("total") / ha).alias("total_ha"), (F.col("used") / ha).alias("used_ha"), (F.col("overlap") / ha).alias("overlap_ha"))
    return detail, check, overlaps


def node_at_vertices(edges: DataFrame, key: str, tol: float, size: float) -> DataFrame:
    """Edges of each ``key`` cut at the vertices of that key that lie on them: ``key, x1, y1, x2, y2``, directed as before.

    Coordinates are snapped to a grid of ``tol``; a vertex within ``tol`` of the inside of an edge becomes one of its
    corners, so borders that are shared in part end up as equal pieces.
    """
    from .flight import cells_along

    snap = lambda c: G.vertex_key(F.col(c), tol) * F.lit(tol)
    e = edges.select(key, *[snap(c).alias(c) for c in ENDS]).filter("x1 <> x2 OR y1 <> y2").withColumn("eid", F.monotonically_increasing_id())
    e = cut(e)
    ends = [F.col(c) for c in ENDS]
    corners = e.select(key, F.col("x1").alias("x"), F.col("y1").alias("y")).distinct()
    corners = corners.withColumns({"_cx": cell(F.col("x"), size), "_cy": cell(F.col("y"), size)})
    near = cells_along(e, size).join(corners, [key, "_cx", "_cy"])
    t = G.project_fraction(F.col("x"), F.col("y"), *ends)
    on = G.segment_distance(F.col("x"), F.col("y"), *ends) <= tol
    off_ends = (F.hypot(F.col("x") - ends[0], F.col("y") - ends[1]) > tol) & (F.hypot(F.col("x") - ends[2], F.col("y") - ends[3]) > tol)
    cuts = near.filter(on & off_ends).select(key, "eid", t.alias("t"), "x", "y")
    first = e.select(key, "eid", F.lit(0.0).alias("t"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    last = e.select(key, "eid", F.lit(1.0).alias("t"), F.col("x2").alias("x"), F.col("y2").alias("y"))
    along = Window.partitionBy("eid").orderBy("t", "x", "y")
    steps = first.unionByName(cuts).unionByName(last).select(
        key, F.col("x").alias("x1"), F.col("y").alias("y1"), F.lead("x").over(along).alias("x2"), F.lead("y").over(along).alias("y2"))
    return steps.filter("x2 IS NOT NULL AND (x1 <> x2 OR y1 <> y2)")


def boundary_edges(features: DataFrame, poly_id: str, key: str, tol: float = 0.01, size: float = 10.0) -> DataFrame:
    """Edges of a coverage that are not shared inside their ``key`` group, with the inside on their left.

    Borders need not match edge by edge: edges are cut at the corners that lie on them, and pieces that two
    polygons run through in opposite directions cancel.  Polygons of a group must not overlap; they may have
    ``holes`` or ``parts``.
    """
    rings = ring_rows(features.withColumn("_fk", F.struct(poly_id, key)), "_fk")
    oriented = rings.select(F.col(f"_fk.{key}").alias(key), F.col(f"_fk.{poly_id}").alias(poly_id), "role", "ring")
    turned = oriented.withColumn("ring", F.when((G.signed_area(F.col("ring")) >= 0) == (F.col("role") > 0), F.col("ring")).otherwise(F.reverse("ring")))
    e = turned.select(key, F.explode(G.ring_edges(F.col("ring"))).alias("_e")).select(key, "_e.*")
    pieces = node_at_vertices(e, key, tol, size).withColumn("_k", edge_key(tol))
    a, b = G.xy(F.col("x1"), F.col("y1")), G.xy(F.col("x2"), F.col("y2"))
    net = pieces.groupBy(key, "_k").agg(F.sum(F.when(a < b, 1).otherwise(-1)).alias("_n"), F.min(F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))).alias("_e"))
    p, q = (F.when(F.col("_n") > 0, F.col(f"_e.{x}")).otherwise(F.col(f"_e.{y}")) for x, y in ("ab", "ba"))
    left = net.filter("_n <> 0").select(key, p.alias("_p"), q.alias("_q"))
    return left.select(key, F.col("_p.x").alias("x1"), F.col("_p.y").alias("y1"), F.col("_q.x").alias("x2"), F.col("_q.y").alias("y2"))


def dissolve(features: DataFrame, poly_id: str, key: str, tol: float = 0.01, size: float = 10.0) -> DataFrame:
    """Union of the polygons of each key in a coverage as ring vertices: ``key, ring_id, seq, x, y``."""
    return chain_rings(boundary_edges(features, poly_id, key, tol, size), key, tol)


# --- segments of a plan ------------------------------------------------------

def node_segments(lots: DataFrame, lot_id: str, snap: float = 0.05, size: float = 10.0) -> DataFrame:
    """Lot edges split where other lots' edges or corners meet them; each piece once.

    Ends are snapped to a grid of ``snap``; pieces carry ``x1, y1, x2, y2``.
    """
    s = segments(lots.select(lot_id, "ring"), lot_id).select(lot_id, "seg_no", *ENDS)
    snapped = s.withColumns({c: F.bround(F.col(c) / snap) * snap for c in ENDS}).filter("x1 <> x2 OR y1 <> y2")
    one = _unique_segments(snapped.select(*ENDS), snap).withColumn("sid", F.struct(*ENDS))
    pairs = segment_pairs(one.select("sid", *ENDS), one.select(*ENDS), snap, size, ["sid"])
    e = [F.col(c) for c in ENDS]
    cuts = G._cuts(*e, F.array(F.struct(*[F.col(f"r_{c}").alias(c) for c in ENDS]), F.struct(
        F.col("r_x2").alias("x1"), F.col("r_y2").alias("y1"), F.col("r_x1").alias("x2"), F.col("r_y1").alias("y2"))), snap / 2)
    at = pairs.select("sid", F.explode(cuts).alias("_t")).distinct()
    # cut positions of one edge: as many as lots meet it
    ts = at.groupBy("sid").agg(F.array_sort(F.collect_set(F.round("_t", 9))).alias("_ts"))
    pieces = ts.select("sid", F.explode(G._parts(F.col("_ts"))).alias("_p"))
    x1, y1, x2, y2 = (F.col(f"sid.{c}") for c in ENDS)
    point = lambda f, a, b: F.bround((a + F.col(f"_p.{f}") * (b - a)) / snap) * snap
    out = pieces.select(point("a", x1, x2).alias("x1"), point("a", y1, y2).alias("y1"), point("b", x1, x2).alias("x2"), point("b", y1, y2).alias("y2"))
    return _unique_segments(out.filter("x1 <> x2 OR y1 <> y2"), 0.001)


def _unique_segments(segs: DataFrame, tol: float) -> DataFrame:
    keyed = segs.withColumn("_k", edge_key(tol))
    return keyed.groupBy("_k").agg(F.min(F.struct(*ENDS)).alias("_e")).select("_e.*")


def merge_short_segments(segs: DataFrame, longest: float = 0.01, angle: float = 5.0, tol: float = 0.05, rounds: int = 5) -> DataFrame:
    """Tiny segments joined with an aligned neighbour at either end, up to ``rounds`` times.

    In a round each tiny segment picks its first aligned neighbour at both ends; when several
    want the same neighbour the lowest id wins and the others wait.
    """
    cur = cut(segs.select(*ENDS).withColumn("sid", F.struct(*ENDS)))
    e = [F.col(c) for c in ENDS]
    direction = F.pmod(F.degrees(F.atan2(e[3] - e[1], e[2] - e[0])), F.lit(180.0))
    vk = lambda x, y: F.struct(G.vertex_key(F.col(x), tol).alias("x"), G.vertex_key(F.col(y), tol).alias("y"))
    for _ in range(rounds):
        tiny = cur.filter(F.hypot(e[2] - e[0], e[3] - e[1]) <= longest)
        if tiny.isEmpty():
            break
        a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
        ends = cur.select("sid", direction.alias("_dir"), F.explode(F.array(
            F.struct(vk("x1", "y1").alias("v"), b.alias("far")), F.struct(vk("x2", "y2").alias("v"), a.alias("far")))).alias("_e"))
        ends = ends.select(F.col("sid").alias("_nid"), "_dir", F.col("_e.v").alias("_v"), F.col("_e.far").alias("_far"))
        asks = tiny.select("sid", direction.alias("_td"), F.explode(F.array(
            F.struct(F.lit(0).alias("end"), vk("x1", "y1").alias("v")), F.struct(F.lit(1).alias("end"), vk("x2", "y2").alias("v")))).alias("_e")).select(
            "sid", "_td", F.col("_e.end").alias("_end"), F.col("_e.v").alias("_v"))
        gap = F.abs(F.col("_dir") - F.col("_td"))
        aligned = F.least(gap, 180.0 - gap) <= angle
        cand = asks.join(ends, "_v").filter((F.col("sid") != F.col("_nid")) & aligned)
        picks = cand.groupBy("sid", "_end").agg(F.min(F.struct("_nid", "_far")).alias("_b"))
        # a neighbour serves one tiny segment per round; a tiny one that serves does not ask
        asked = picks.select("sid", "_end", F.col("_b._nid").alias("_nid"), F.col("_b._far").alias("_far"))
        owner = asked.select(F.col("_nid").alias("_m"), "sid").unionByName(asked.select(F.col("sid").alias("_m"), "sid")).groupBy("_m").agg(F.min("sid").alias("_owner"))
        owned = asked.join(owner.select(F.col("_m").alias("_nid"), F.col("_owner").alias("_o1")), "_nid").join(
            owner.select(F.col("_m").alias("sid"), F.col("_owner").alias("_o2")), "sid")
        good = owned.groupBy("sid").agg(
            F.min((F.col("_o1") == F.col("sid")) & (F.col("_o2") == F.col("sid"))).alias("_ok"),
            F.max(F.when(F.col("_end") == 0, F.col("_far"))).alias("_fa"), F.max(F.when(F.col("_end") == 1, F.col("_far"))).alias("_fb"),
        ).filter("_ok")
        own = F.struct(F.col("sid.x1").alias("x"), F.col("sid.y1").alias("y")), F.struct(F.col("sid.x2").alias("x"), F.col("sid.y2").alias("y"))
        made = cut(good.select("sid", F.coalesce("_fa", own[0]).alias("_p"), F.coalesce("_fb", own[1]).alias("_q")).filter(F.col("_p") != F.col("_q")))
        if made.isEmpty():
            break
        used = asked.join(made.select("sid"), "sid").select(F.col("_nid").alias("sid")).unionByName(made.select("sid")).distinct()
        fresh = made.select(F.col("_p.x").alias("x1"), F.col("_p.y").alias("y1"), F.col("_q.x").alias("x2"), F.col("_q.y").alias("y2"))
        cur = cut(cur.join(used, "sid", "left_anti").select(*ENDS).unionByName(fresh).withColumn("sid", F.struct(*ENDS)))
    return cur.select(*ENDS)


def drop_covered_segments(segs: DataFrame, angle: float = 5.0, line_tol: float = 0.4, sum_tol: float = 0.4, size: float = 10.0) -> DataFrame:
    """Segments covered end to end by two or more shorter ones on their line are dropped.

    The covering intervals of one segment are merged by a running maximum.
    """
    from pyspark.sql import Window

    s = segs.select(*ENDS).distinct().withColumn("sid", F.struct(*ENDS))
    pairs = segment_pairs(s, s.select(*ENDS), max(line_tol, sum_tol), size, ["sid"])
    e, r = [F.col(c) for c in ENDS], [F.col(f"r_{c}") for c in ENDS]
    n = F.hypot(e[2] - e[0], e[3] - e[1])
    ux, uy = (e[2] - e[0]) / n, (e[3] - e[1]) / n
    direct = lambda v: F.pmod(F.degrees(F.atan2(v[3] - v[1], v[2] - v[0])), F.lit(180.0))
    gap = F.abs(direct(e) - direct(r))
    mid_off = F.abs(((r[0] + r[2]) / 2 - (e[0] + e[2]) / 2) * -uy + ((r[1] + r[3]) / 2 - (e[1] + e[3]) / 2) * ux)
    t1, t2 = (r[0] - e[0]) * ux + (r[1] - e[1]) * uy, (r[2] - e[0]) * ux + (r[3] - e[1]) * uy
    lo, hi = F.least(t1, t2), F.greatest(t1, t2)
    shorter = F.hypot(r[2] - r[0], r[3] - r[1]) < n
    on = shorter & (F.least(gap, 180.0 - gap) <= angle) & (mid_off <= line_tol) & (hi >= -sum_tol) & (lo <= n + sum_tol)
    iv = pairs.filter(on).select("sid", n.alias("_n"), lo.alias("_lo"), hi.alias("_hi"))
    w = Window.partitionBy("sid").orderBy("_lo", "_hi")
    reach = F.max("_hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    run = iv.withColumn("_reach", reach).withColumn("_break", F.when(F.col("_lo") > F.col("_reach") + sum_tol, 1).otherwise(0))
    run = run.withColumn("_part", F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    cov = run.groupBy("sid", "_n").agg(F.count(F.lit(1)).alias("_c"), F.min("_lo").alias("_from"), F.max(F.when(F.col("_part") == 0, F.col("_hi"))).alias("_to"))
    gone = cov.filter((F.col("_c") >= 2) & (F.col("_from") <= sum_tol) & (F.col("_to") >= F.col("_n") - sum_tol)).select("sid")
    return s.join(gone, "sid", "left_anti").select(*ENDS)


def pick_edge(claims: DataFrame, segs: DataFrame, lot_id: str) -> DataFrame:
    """Edge for each claimed door: ``seq, lot_id, seg_no, dist, px, py``, in ``seq`` order within a lot.

    A door takes the closest edge of its lot that no other lot shares and no earlier door has taken; when none is
    left, the closest edge of all.  ``claims`` has ``seq, lot_id, x, y``; ``segs`` carries ``copies``.  A lot's first doors,
    as many as it has unshared edges, use them all up, so only these are served one after another, in one row
    of the lot; however many others there are, they are independent.
    """
    e = [F.col(c) for c in ENDS]
    d = G.segment_distance(F.col("x"), F.col("y"), *e)
    numbered = number_rows(claims.select("seq", lot_id, "x", "y"), [lot_id], "seq", ["x", "y"], "_nth")
    j = numbered.join(segs.select(lot_id, "seg_no", "copies", *ENDS), lot_id)
    near = j.groupBy("seq", lot_id, "x", "y", "_nth").agg(
        F.sort_array(F.collect_list(F.struct(d.alias("d"), F.col("seg_no").alias("seg_no"), (F.col("copies") > 1).alias("shared"), *e))).alias("_all"))
    near = near.withColumn("_free", F.filter("_all", lambda c: ~c["shared"]))
    rest = near.filter(F.col("_nth") > F.size("_free")).select("seq", lot_id, "x", "y", F.get("_all", F.lit(0)).alias("_b"))
    first = near.filter(F.col("_nth") <= F.size("_free")).groupBy(lot_id).agg(F.sort_array(F.collect_list(F.struct("_nth", "seq", "x", "y", "_free"))).alias("_doors"))
    kind = segs.schema["seg_no"].dataType.simpleString()
    none = F.array().cast(f"array<{kind}>")

    def serve(taken, door):
        free = F.filter(door["_free"], lambda c: ~F.array_contains(taken, c["seg_no"]))
        return F.concat(taken, F.array(F.get(free, F.lit(0))["seg_no"]))

    taken = F.aggregate("_doors", none, serve)
    served = first.withColumn("_taken", taken).select(lot_id, F.posexplode("_doors").alias("_i", "_d"), "_taken")
    own = F.get(F.filter("_d._free", lambda c: c["seg_no"] == F.get("_taken", F.col("_i"))), F.lit(0))
    served = served.select("_d.seq", lot_id, "_d.x", "_d.y", own.alias("_b"))
    best = rest.unionByName(served)
    b = [F.col(f"_b.{c}") for c in ENDS]
    t = G.project_fraction(F.col("x"), F.col("y"), *b)
    return best.select("seq", lot_id, F.col("_b.seg_no").alias("seg_no"), F.col("_b.d").alias("dist"),
                       (b[0] + t * (b[2] - b[0])).alias("px"), (b[1] + t * (b[3] - b[1])).alias("py"))


# --- roads and drainage ------------------------------------------------------

def drainage_arrows(
    segs: DataFrame, cells: DataFrame, size: float, seg_id: str, min_len: float = 20.0, offset: float = 0.4,
    wanted: int = 2, short: float = 30.0, medium: float = 60.0, caps: Sequence[int] = (3, 4, 5),
    spacing: float = 5.0, nodata: float | None = None,
) -> DataFrame:
    """Downhill arrows on road segments: ``seg_id, arrow, x, y, angle``.

    One to three arrows by length class, at the middle or spread over 20 % to 80 %, moved
    sideways; arrows closer than ``spacing`` to an earlier one are left out.
    """
    n = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    long_ = segs.withColumn("_len", n).filter(F.col("_len") >= min_len)
    ends = long_.select(seg_id, F.explode(F.array(
        F.struct(F.lit(1).alias("k"), F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.lit(2).alias("k"), F.col("x2").alias("x"), F.col("y2").alias("y")))).alias("_e")).select(seg_id, "_e.*")
    z = sample_raster(ends, cells, size, "z", nodata).groupBy(seg_id).agg(
        F.max(F.when(F.col("k") == 1, F.col("z"))).alias("_z1"), F.max(F.when(F.col("k") == 2, F.col("z"))).alias("_z2"))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    down = F.when(F.col("_z2") < F.col("_z1"), 1.0).otherwise(-1.0)
    base = F.when(F.col("_len") < short, F.least(F.lit(caps[0]), F.lit(1))).when(F.col("_len") < medium, F.least(F.lit(caps[1]), F.lit(2))).otherwise(F.least(F.lit(caps[2]), F.lit(3)))
    count = F.greatest(F.lit(1), F.least(F.lit(wanted), base))
    f = F.when(F.col("_k") == 1, 0.5).otherwise(0.2 + 0.6 * (F.col("arrow") - 1) / F.nullif(F.col("_k") - 1, F.lit(0)))
    arrows = (
        long_.join(z, seg_id).filter("_z1 IS NOT NULL AND _z2 IS NOT NULL").withColumn("_k", count)
        .withColumn("arrow", F.explode(F.sequence(F.lit(1), F.col("_k"))))
        .select(seg_id, "arrow", (F.col("x1") + f * dx - offset * dy / F.col("_len")).alias("x"), (F.col("y1") + f * dy + offset * dx / F.col("_len")).alias("y"),
                F.degrees(F.atan2(down * dy, down * dx)).alias("angle"), F.struct(seg_id, "arrow").alias("_id"), F.lit(0.0).alias("_s"))
    )
    if spacing <= 0:
        return arrows.drop("_id", "_s")
    return thin_by_distance(arrows, spacing, "_s", "_id").drop("_id", "_s")


def section_places(
    axes: DataFrame, axis_id: str, fractions: Sequence[float] = (0.2, 0.5, 0.8), spacing: float | None = None, most: int = 6,
    min_len: float = 0.0, min_gap: float = 0.0, by_segment: bool = False, delta: float = 0.02,
) -> DataFrame:
    """Where sections cross road axes: ``axis_id, part, fraction, mx, my, nx, ny`` (unit normal of the upright direction).

    Axes are lines ``x1, y1, x2, y2`` or bent ones (``line``, an array of vertices).  Places go by the share of the measured
    length, kept within 0.05 and 0.95: given ``fractions``, or with ``spacing`` as many as fit, ``most`` at most, evenly
    from 0.2 to 0.8.  ``by_segment`` takes every segment longer than 0.75 as an axis of its own (``part``).  Axes shorter
    than ``min_len`` have none, and a place nearer than ``min_gap`` to an earlier one of its axis is left out.  The
    direction is that between the points ``delta`` of the length before and behind.

    Measures are rows: each segment knows where it starts, and a place finds its segment by a range of measures.
    """
    if "line" in axes.columns:
        segs = line_segments(axes.select(axis_id, "line"))
    else:
        segs = axes.select(axis_id, F.lit(1).alias("seg_no"), *ENDS, F.lit(0.0).alias("m"))
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    segs = segs.select(axis_id, F.col("seg_no").cast("int").alias("seg_no"), *ENDS, F.col("m").cast("double").alias("m"), length.alias("_n")).filter("_n > 0")
    if by_segment:
        segs = segs.filter("_n > 0.75").withColumns({"part": F.col("seg_no"), "m": F.lit(0.0)})
    else:
        segs = segs.withColumn("part", F.lit(0))
    whole = segs.groupBy(axis_id, "part").agg(F.sum("_n").alias("_len")).filter(F.col("_len") >= min_len)
    if spacing:
        n = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.col("_len") / spacing).cast("int")))
        shares = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(n == 1, F.lit(0.2)).otherwise(0.2 + i * (F.lit(0.6) / (n - 1))))
    else:
        shares = F.array(*[F.lit(float(v)) for v in fractions])
    places = whole.select(axis_id, "part", "_len", F.posexplode(shares).alias("_i", "fraction"))
    f = F.greatest(F.lit(0.05), F.least(F.lit(0.95), F.col("fraction")))
    wanted = F.array(*[F.struct(F.lit(k).alias("k"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), f + k * delta)).alias("f")) for k in (-1, 0, 1)])
    asked = places.select(axis_id, "part", "_i", "fraction", "_len", F.explode(wanted).alias("_w")).withColumn("_s", F.col("_w.f") * F.col("_len"))
    # the last segment also takes what rounding leaves
    met = exploded(asked).join(segs, [axis_id, "part"]).filter((F.col("_s") >= F.col("m")) & ((F.col("_s") < F.col("m") + F.col("_n")) | (F.col("m") + F.col("_n") >= F.col("_len") * (1 - 1e-12))))
    t = F.least(F.lit(1.0), (F.col("_s") - F.col("m")) / F.col("_n"))
    at = F.struct(F.col("m").alias("m"), (F.col("x1") + t * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + t * (F.col("y2") - F.col("y1"))).alias("y"))
    of = lambda k: F.max(F.when(F.col("_w.k") == k, at)).alias(f"_p{k + 1}")
    found = met.groupBy(axis_id, "part", "_i", "fraction").agg(of(-1), of(0), of(1))
    angle = F.radians(G.upright(F.degrees(F.atan2(F.col("_p2.y") - F.col("_p0.y"), F.col("_p2.x") - F.col("_p0.x")))))
    out = found.select(axis_id, "part", "_i", "fraction", F.col("_p1.x").alias("mx"), F.col("_p1.y").alias("my"), (-F.sin(angle)).alias("nx"), F.cos(angle).alias("ny"))
    if min_gap > 0:
        # at most as many places as an axis may have
        row = F.struct("_i", "fraction", "mx", "my", "nx", "ny")
        apart = lambda kept, p: ~F.exists(kept, lambda k: F.hypot(k["mx"] - p["mx"], k["my"] - p["my"]) < min_gap)
        kind = out.select(row.alias("r")).schema["r"].dataType.simpleString()
        lists = out.groupBy(axis_id, "part").agg(F.sort_array(F.collect_list(row)).alias("_ps"))
        kept = F.aggregate("_ps", F.array().cast(f"array<{kind}>"), lambda acc, p: F.when(apart(acc, p), F.concat(acc, F.array(p))).otherwise(acc))
        out = lists.select(axis_id, "part", F.explode(kept).alias("_p")).select(axis_id, "part", "_p.*")
    return out.drop("_i")


def cross_sections(
    axes: DataFrame, kerbs: DataFrame, lots: DataFrame, axis_id: str, fractions: Sequence[float] = (0.2, 0.5, 0.8),
    span: float = 30.0, max_width: float = 20.0, equal: float = 0.05, size: float = 20.0, **places,
) -> DataFrame:
    """Widths across road axes: kerb-kerb, kerb-lot on both sides, lot-lot; a row per ``axis_id, part, fraction``.

    A section needs a kerb on both sides; widths above ``max_width`` are left out, so is a
    lot-lot width equal to the kerb-kerb one.  Kerbs are looked for up to half the span.  Places are those of
    ``section_places``, which takes the remaining options.
    """
    a = section_places(axes, axis_id, fractions, **places)
    at = [axis_id, "part", "fraction"]

    def hits(lines, reach, tag):
        probe = a.withColumns({"x1": F.col("mx") - reach * F.col("nx"), "y1": F.col("my") - reach * F.col("ny"),
                               "x2": F.col("mx") + reach * F.col("nx"), "y2": F.col("my") + reach * F.col("ny")})
        p = segment_pairs(probe, lines.select(*ENDS), 0.0, size, at)
        ex, ey = F.col("r_x2") - F.col("r_x1"), F.col("r_y2") - F.col("r_y1")
        den = G.cross(F.col("nx"), F.col("ny"), ex, ey)
        wx, wy = F.col("r_x1") - F.col("mx"), F.col("r_y1") - F.col("my")
        t = G.cross(wx, wy, ex, ey) / F.nullif(den, F.lit(0.0))
        u = G.cross(wx, wy, F.col("nx"), F.col("ny")) / F.nullif(den, F.lit(0.0))
        ok = (u >= -1e-9) & (u <= 1 + 1e-9) & (F.abs(t) <= reach)
        return p.withColumn("_t", F.when(ok, t)).groupBy(*at).agg(
            F.min(F.when(F.col("_t") > 0, F.col("_t"))).alias(f"{tag}_pos"), F.max(F.when(F.col("_t") < 0, F.col("_t"))).alias(f"{tag}_neg"))

    lot_edges = lots if "x1" in lots.columns else segments(lots, "lot_id")
    k = hits(kerbs, span / 2, "k").filter("k_pos IS NOT NULL AND k_neg IS NOT NULL").filter(F.col("k_pos") - F.col("k_neg") <= max_width)
    both = k.join(hits(lot_edges, span, "l"), at, "left")
    # lot hits only count when found on both sides
    pair = F.col("l_pos").isNotNull() & F.col("l_neg").isNotNull()
    limit = lambda w: F.when(pair & (w <= max_width), w)
    kk, ll = F.col("k_pos") - F.col("k_neg"), F.col("l_pos") - F.col("l_neg")
    return both.select(
        *at, kk.alias("kerb_kerb"), limit(F.abs(F.col("l_neg") - F.col("k_neg"))).alias("kerb_lot_neg"),
        limit(F.abs(F.col("l_pos") - F.col("k_pos"))).alias("kerb_lot_pos"), F.when(F.abs(ll - kk) > equal, limit(ll)).alias("lot_lot"))


# --- symbols -----------------------------------------------------------------

# fixed values: surveyed type -> layer
TYPE_LAYER = {
    "PA": "ELET_POSTE_ALTA_TENSAO_LUMINARIA", "PI": "ELET_POSTE_ALTA_TENSAO_LUMINARIA", "PFI": "ELET_POSTE_ALTA_TENSAO",
    "PVTEL": "INFRA_PVT", "PVT": "INFRA_PVT", "AEPVTEL": "INFRA_PVT",
    "PVA": "INFRA_PVAP", "PVAP": "INFRA_PVAP", "AEPVA": "INFRA_PVAP",
    "AEPVE": "INFRA_PVE", "ES": "INFRA_PVE", "PVE": "INFRA_PVE", "AEPVPD": "INFRA_PVE", "PV": "INFRA_PVE",
    "AEBO": "INFRA_BOCA_LOBO", "AEBO1": "INFRA_BOCA_LOBO", "AEBO2": "INFRA_BOCA_LOBO", "AEBO3": "INFRA_BOCA_LOBO",
    "AEBO.1": "INFRA_BOCA_LOBO", "AEBO.2": "INFRA_BOCA_LOBO", "BL1": "INFRA_BOCA_LOBO", "BL2": "INFRA_BOCA_LOBO", "BL3": "INFRA_BOCA_LOBO",
    "AEBL": "INFRA_BOCA_LOBO", "AEBL1": "INFRA_BOCA_LOBO", "AEBL2": "INFRA_BOCA_LOBO", "AEBL3": "INFRA_BOCA_LOBO",
    "AEBE": "INFRA_BOCA_LEAO", "AEBE1": "INFRA_BOCA_LEAO", "AEBE2": "INFRA_BOCA_LEAO", "AEBE3": "INFRA_BOCA_LEAO",
    "AEBE.1": "INFRA_BOCA_LEAO", "AEBE.2": "INFRA_BOCA_LEAO", "AEBE.3": "INFRA_BOCA_LEAO", "AEB": "INFRA_BOCA_LEAO",
    "ARVORE": "VEG_ARVORE_ISOLADA",
}

# fixed values: layer -> symbol
LAYER_SYMBOL = {
    "INFRA_PVE": "INFRA_PVE", "INFRA_PVAP": "INFRA_PVAP", "INFRA_PVT": "INFRA_PVT", "INFRA_BOCA_LOBO": "BOCA_LOBO",
    "INFRA_BOCA_LEAO": "BOCA_DE_LEAO", "ELET_POSTE_ALTA_TENSAO_LUMINARIA": "POSTE_ILUMI", "ELET_POSTE_ALTA_TENSAO": "POSTE_TENSAO",
    "MOB_MOBILIARIO_URBANO": "MOB_URBANO_PT_ONIBUS", "INFRA_BUEIRO": "COD119", "VEG_ARVORE_ISOLADA": "ARVORE",
}


def symbol_lookup(points: DataFrame, kind: str = "type", angle: str = "angle") -> DataFrame:
    """Layer and symbol of each surveyed point; unknown types drop out.

    Inlet symbols repeat by the trailing number of the type, 1 m apart along the direction; manholes
    are not turned.
    """
    as_map = lambda d: F.create_map(*[F.lit(v) for kv in d.items() for v in kv])
    out = points.withColumn("layer", F.try_element_at(as_map(TYPE_LAYER), F.col(kind))).withColumn(
        "symbol", F.try_element_at(as_map(LAYER_SYMBOL), F.col("layer"))).filter(F.col("symbol").isNotNull())
    turned = F.when(F.col("symbol").isin("INFRA_PVE", "INFRA_PVAP"), 0.0).otherwise(F.col(angle))
    last = F.regexp_extract(F.col(kind), r"(\d+)$", 1).try_cast("int")
    copies = F.when(F.col("symbol").contains("BOCA"), F.coalesce(last, F.lit(1))).otherwise(1)
    out = out.withColumn(angle, turned).withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>"))))
    return out.withColumn("x", F.col("x") + F.col("copy") * F.cos(F.radians(angle))).withColumn("y", F.col("y") + F.col("copy") * F.sin(F.radians(angle)))


# --- descriptions ------------------------------------------------------------

# fixed values: clauses of a parcel, perimeter or road description
START_CLAUSE = "Inicia-se a descrição deste perímetro no vértice {code}, de coordenadas N {n} m e E {e} m; "
ROAD_START_CLAUSE = "Inicia-se a descrição desta via no vértice {code}, de coordenadas N {n} m e E {e} m; "
NEXT_CLAUSE = "deste, segue {beside} com os seguintes azimutes e distâncias: {az} e {dist} m até o vértice {code}, de coordenadas N {n} m e E {e} m; "
CROSSING_CLAUSE = "deste, segue {beside} pela distância de {dist} m até o vértice {code}, de coordenadas N {n} m e E {e} m; "
LAST_CLAUSE = "por fim, segue {beside} com os seguintes azimutes e distâncias: {az} e {dist} m até o vértice {code}, ponto inicial da descrição deste perímetro. "
ROAD_LAST_CLAUSE = "por fim, segue {beside} com os seguintes azimutes e distâncias: {az} e {dist} m até o vértice {code}, ponto final desta via. "
ROAD_CROSSING_LAST_CLAUSE = "por fim, segue {beside} pela distância de {dist} m até o vértice {code}, ponto final desta via. "
SYNTHETIC_CLAUSE = "deste, segue confrontando com {beside}{ideal} com azimute {az} e distância {dist} m até o vértice {code}, definido pelas coordenadas E: {e} m e N: {n} m{end}"


def fill(template: str, **values: Column) -> Column:
    """A clause as a column: ``{name}`` parts come from the values."""
    import re

    parts = [values[p[1:-1]] if p.startswith("{") else F.lit(p) for p in re.split(r"(\{\w+\})", template) if p]
    return F.concat(*parts)


def neighbour_text(kind: str = "kind", lot: str = "lot", block: str = "block", road: str = "road", crossing: bool = False) -> Column:
    """What an edge borders on."""
    verb = "intersectando com a " if crossing else "confrontando com a "
    return (
        F.when(F.col(kind) == "lot", F.concat(F.lit("confrontando com o Lote "), F.col(lot).cast("string"), F.lit(" da Quadra "), F.col(block).cast("string")))
        .when(F.col(kind) == "road", F.concat(F.lit(verb), F.col(road)))
        .otherwise("confrontante não identificado")
    )


def describe(segs: DataFrame, poly_id: str, road: bool = False) -> DataFrame:
    """Description text per parcel, perimeter or road: ``poly_id, text``.

    Segments carry ``seg_no, is_last, azimuth, dist, beside, from_code, to_code`` and end points.
    Clauses of one feature are joined in order; a feature bounds its own text.
    """
    from ..functions.numbers import dms_text, number_text

    num = lambda c, d: number_text(F.col(c), d, grouped=False)
    v = dict(beside=F.col("beside"), az=dms_text(F.col("azimuth"), 2, deg_pad=3, carry=False, wrap=True, comma=True),
             dist=num("dist", 2), code=F.col("to_code"), n=num("y2", 3), e=num("x2", 3))
    start = fill(ROAD_START_CLAUSE if road else START_CLAUSE, code=F.col("from_code"), n=num("y1", 3), e=num("x1", 3))
    nxt, last = fill(NEXT_CLAUSE, **v), fill(ROAD_LAST_CLAUSE if road else LAST_CLAUSE, **v)
    if road:
        crossing = F.lower("beside").contains("intersectando")
        nxt = F.when(crossing, fill(CROSSING_CLAUSE, **v)).otherwise(nxt)
        last = F.when(crossing, fill(ROAD_CROSSING_LAST_CLAUSE, **v)).otherwise(last)
    clause = F.concat(F.when(F.col("seg_no") == 1, start).otherwise(""), F.when(F.col("is_last"), last).otherwise(nxt))
    per = segs.withColumn("_c", clause).groupBy(poly_id).agg(F.array_sort(F.collect_list(F.struct("seg_no", "_c"))).alias("_l"))
    return per.select(poly_id, F.array_join(F.transform("_l", lambda s: s["_c"]), "").alias("text"))


def owner_text(owner: Column, label: Column, from_road: Column) -> Column:
    """Neighbour wording of the synthetic description."""
    from ..functions.text import ascii_only, squeeze

    clean = F.nullif(squeeze(F.coalesce(owner, F.lit(""))), F.lit(""))
    lab = F.nullif(F.trim(ascii_only(F.replace(F.trim(label), F.lit("_"), F.lit(" ")))), F.lit(""))
    whole = F.lower(lab).isin("ada", "area de atuacao (ada)", "area de atuacao ada", "area de atuacao")
    return (
        F.when(from_road, "Estrada Municipal").when(clean.isNotNull(), F.concat(F.lit("propriedade de "), clean))
        .when(lab.isNull() | whole, "GLEBA").otherwise(F.concat(F.lit("propriedade "), lab))
    )


def describe_synthetic(segs: DataFrame, poly_id: str) -> DataFrame:
    """Short description: azimuth without seconds, ideal-line wording for open boundaries."""
    from ..functions.numbers import dms_text, number_text

    num = lambda c, d: number_text(F.col(c), d, grouped=False)
    clause = fill(
        SYNTHETIC_CLAUSE, beside=F.col("beside"), ideal=F.when(F.upper("beside") == "GLEBA", " por meio de Linha ideal").otherwise(""),
        az=dms_text(F.col("azimuth"), minutes_only=True, deg_pad=2, wrap=True), dist=num("dist", 2), code=F.col("to_code"), e=num("x2", 4), n=num("y2", 4),
        end=F.when(F.col("is_last"), ", ponto inicial da descrição, encerrando o perímetro descrito.").otherwise(";"))
    per = segs.withColumn("_c", clause).groupBy(poly_id).agg(F.array_sort(F.collect_list(F.struct("seg_no", "_c"))).alias("_l"))
    return per.select(poly_id, F.array_join(F.transform("_l", lambda s: s["_c"]), " ").alias("text"))
