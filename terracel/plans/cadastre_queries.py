"""Polygon, line, neighbour, overlay and description queries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..core.grid import pairs_within
from ..core.lineage import cut
from ..functions import geometry as G
from ..operators import cadastre as K
from ..operators import graph as H
from ..operators import spatial as S
from ..operators.flight import nearest_line
from .registry import query, rounded

_EDGES = """e AS (SELECT lot_id, block_id, 1 AS seg_no, minx AS x1, miny AS y1, maxx AS x2, miny AS y2 FROM {lots}
UNION ALL SELECT lot_id, block_id, 2, maxx, miny, maxx, maxy FROM {lots} UNION ALL SELECT lot_id, block_id, 3, maxx, maxy, minx, maxy FROM {lots}
UNION ALL SELECT lot_id, block_id, 4, minx, maxy, minx, miny FROM {lots})"""
_KEYED = _EDGES + """, k AS (SELECT *, least(x1, x2) AS ax, least(y1, y2) AS ay, greatest(x1, x2) AS bx, greatest(y1, y2) AS b_y FROM e)"""


def _lots(t):
    return S.with_ring(t.lots).select("lot_id", "block_id", "lot_name", "ring")


def _uses(t):
    return S.with_ring(t.uses).select("use_id", "use_type", "use_class", "ring")


def _segs(t):
    return K.segments(_lots(t), "lot_id")


@query("segments", f"""WITH {_EDGES} SELECT lot_id, seg_no, x1, y1, x2, y2, CAST(CASE seg_no WHEN 1 THEN 90 WHEN 2 THEN 0 WHEN 3 THEN 270 ELSE 180 END AS DOUBLE) AS azimuth,
CASE seg_no % 2 WHEN 1 THEN maxx - minx ELSE maxy - miny END AS dist, concat(seg_no, ' – ', CASE seg_no WHEN 4 THEN 1 ELSE seg_no + 1 END) AS label FROM e JOIN {{lots}} USING (lot_id)""")
def _(t):
    out = _segs(t).select("lot_id", "seg_no", "x1", "y1", "x2", "y2", "azimuth", "dist", "label")
    return rounded(out, azimuth=6)


@query("turn_side", f"""WITH {_EDGES} SELECT lot_id, seg_no, CASE WHEN seg_no > 1 THEN 'à direita' END AS side, CASE WHEN seg_no > 1 THEN CAST(-90 AS DOUBLE) END AS turn FROM e
UNION ALL SELECT lot_id, 10 + seg_no, CASE WHEN seg_no > 1 THEN 'à esquerda' END, CASE WHEN seg_no > 1 THEN CAST(90 AS DOUBLE) END FROM e""")
def _(t):
    # as the rule is coded: the azimuth falls along counter-clockwise rings, so they turn "right"
    cw = _lots(t).withColumn("ring", F.reverse("ring"))
    a = K.turn_side(_segs(t)).select("lot_id", "seg_no", "side", "turn")
    b = K.turn_side(K.segments(cw, "lot_id")).select("lot_id", (F.col("seg_no") + 10).alias("seg_no"), "side", "turn")
    return rounded(a.unionByName(b), turn=6)


@query("ring_measures", """SELECT use_id, round((maxx-minx)*(maxy-miny), 6) AS area, round(2*(maxx-minx)+2*(maxy-miny), 6) AS perimeter, round((minx+maxx)/2, 6) AS cx, round((miny+maxy)/2, 6) AS cy,
round(-(maxx-minx)*(maxy-miny), 6) AS cw_area, minx, maxy FROM {uses}""")
def _(t):
    r = F.col("ring")
    c, box = G.ring_centroid(r), G.ring_box(r)
    out = _uses(t).select("use_id", G.ring_area(r).alias("area"), G.ring_perimeter(r).alias("perimeter"), c["x"].alias("cx"), c["y"].alias("cy"),
                          G.signed_area(G.orient(r, True)).alias("cw_area"), box["minx"].alias("minx"), box["maxy"].alias("maxy"))
    return rounded(out, area=6, perimeter=6, cx=6, cy=6, cw_area=6)


@query("extent", """SELECT block_id, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM {lots} GROUP BY 1""")
def _(t):
    b = S.with_box(_lots(t))
    return b.groupBy("block_id").agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


@query("min_area", "SELECT use_id FROM {uses} WHERE (maxx-minx)*(maxy-miny) >= 100")
def _(t):
    return S.min_area(_uses(t), 100.0).select("use_id")


@query("close_ring", """SELECT lot_id, 5 AS closed_size, 4 AS opened_size, minx AS last_x FROM {lots}""")
def _(t):
    c = G.close_ring(F.col("ring"))
    return _lots(t).select("lot_id", F.size(c).alias("closed_size"), F.size(G.open_ring(c)).alias("opened_size"), F.element_at(c, -1)["x"].alias("last_x"))


@query("drop_close_vertices", "SELECT lot_id, 4 AS n, minx + maxx + maxx + minx AS sum_x FROM {lots}")
def _(t):
    near = F.transform("ring", lambda p: F.array(p, F.struct((p["x"] + 0.05).alias("x"), p["y"].alias("y")), F.struct((p["x"] + 0.09).alias("x"), p["y"].alias("y"))))
    r = G.drop_close_vertices(F.flatten(near), 0.1)
    return _lots(t).select("lot_id", F.size(r).alias("n"), F.aggregate(r, F.lit(0.0), lambda a, p: a + p["x"]).alias("sum_x"))


@query("rotate_start", """SELECT lot_id, maxx AS ne_x, maxy AS ne_y, minx AS north_x, maxy AS north_y, minx AS near_x, miny AS near_y, minx AS last_x FROM {lots}""")
def _(t):
    r = F.col("ring")
    ne = G.rotate_ring(r, G.start_vertex(r, "ne"))
    no = G.rotate_ring(r, G.start_vertex(r, "north"))
    pt = G.rotate_ring(r, G.start_vertex(r, "point", F.lit(-1e6), F.lit(-1e6)))
    f = lambda ring, i, a: F.element_at(ring, i)[a]
    return _lots(t).select("lot_id", f(ne, 1, "x").alias("ne_x"), f(ne, 1, "y").alias("ne_y"), f(no, 1, "x").alias("north_x"), f(no, 1, "y").alias("north_y"),
                           f(pt, 1, "x").alias("near_x"), f(pt, 1, "y").alias("near_y"), f(pt, -1, "x").alias("last_x"))


@query("number_vertices", f"""WITH {_EDGES}, f AS (SELECT x1, y1, min(lot_id*10 + seg_no) AS o FROM e GROUP BY 1, 2)
SELECT CAST(x1*100 AS BIGINT) AS vx, CAST(y1*100 AS BIGINT) AS vy, row_number() OVER (ORDER BY o) AS vertex_no FROM f""")
def _(t):
    return K.number_vertices(_lots(t), "lot_id").select("vx", "vy", "vertex_no")


@query("number_vertices_ranked", f"""WITH {_EDGES}, p AS (SELECT 0 AS s, CASE WHEN x = minx AND y = maxy THEN 0 WHEN x = maxx AND y = maxy THEN 1 WHEN x = maxx THEN 2 ELSE 3 END AS a, 0 AS b, 0 AS c, x, y FROM
(SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM {{lots}}) m, (SELECT unnest([0,1,2,3]) AS i) n, LATERAL (SELECT CASE WHEN i IN (0,3) THEN minx ELSE maxx END AS x, CASE WHEN i < 2 THEN miny ELSE maxy END AS y) q),
l AS (SELECT 1 AS s, lot_id AS a, -y1 AS b, x1 AS c, x1 AS x, y1 AS y FROM e), r AS (SELECT 2 AS s, road_id AS a, 0 AS b, 0 AS c, x1 AS x, y1 AS y FROM {{roads}} UNION ALL SELECT 2, road_id, 1, 0, x2, y2 FROM {{roads}}),
u AS (SELECT * FROM p UNION ALL SELECT * FROM l UNION ALL SELECT * FROM r), f AS (SELECT x, y, min({{'s': s, 'a': CAST(a AS DOUBLE), 'b': CAST(b AS DOUBLE), 'c': CAST(c AS DOUBLE)}}) AS o FROM u GROUP BY 1, 2)
SELECT x, y, row_number() OVER (ORDER BY o) AS vertex_no, printf('P-%03d', row_number() OVER (ORDER BY o)) AS code, o.s = 0 AS on_perimeter FROM f""".replace("{{'s'", "{'s'").replace("DOUBLE)}})", "DOUBLE)})").replace("{{lots}}", "{lots}").replace("{{roads}}", "{roads}"))
def _(t):
    b = t.lots.agg(*[f(c).alias(c) for f, c in ((F.min, "minx"), (F.min, "miny"), (F.max, "maxx"), (F.max, "maxy"))])
    per = S.with_ring(b).select(F.lit(0).alias("part"), "ring")
    roads = t.roads.select("road_id", F.array(G.xy(F.col("x1"), F.col("y1")), G.xy(F.col("x2"), F.col("y2"))).alias("line"))
    return K.number_vertices_ranked(per, _lots(t), roads, "lot_id", "road_id").select("x", "y", "vertex_no", "code", "on_perimeter")


# --- point and polygon joins -------------------------------------------------

@query("crop_points", """SELECT p.pid, s.sheet_id FROM (SELECT *, pid % 5 AS lote FROM {points}) p JOIN {sheets} s ON p.x BETWEEN s.minx AND s.maxx AND p.y BETWEEN s.miny AND s.maxy AND p.lote = s.lote WHERE p.classification = 2""")
def _(t):
    sheets = S.with_ring(t.sheets).select("sheet_id", "lote", "ring")
    pts = t.points.withColumn("lote", F.concat(F.lit("0"), (F.col("pid") % 5).cast("string")))
    return S.crop_points(pts, sheets, 100.0, "sheet_id", ["lote"]).filter("classification = 2").select("pid", "sheet_id")


@query("points_in_mask", """SELECT 'covers' AS mode, pid FROM {points} p JOIN {plots} l ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy
UNION SELECT 'within', pid FROM {points} p JOIN {plots} l ON x > minx AND x < maxx AND y > miny AND y < maxy
UNION SELECT 'grown', pid FROM {points} p JOIN {plots} l ON x BETWEEN minx-2 AND maxx+2 AND y BETWEEN miny-2 AND maxy+2 AND sqrt(greatest(minx-x, x-maxx, 0)**2 + greatest(miny-y, y-maxy, 0)**2) <= 2.000000001
UNION SELECT 'shrunk', pid FROM {points} p JOIN {plots} l ON x BETWEEN minx+0.999999999 AND maxx-0.999999999 AND y BETWEEN miny+0.999999999 AND maxy-0.999999999""")
def _(t):
    mask = S.with_ring(t.plots)
    out = None
    for tag, mode, buf in (("covers", "covers", 0.0), ("within", "within", 0.0), ("grown", "covers", 2.0 + 1e-9), ("shrunk", "covers", -1.0 + 1e-9)):
        part = S.points_in_mask(t.points, mask, 10.0, "pid", mode, buf).select(F.lit(tag).alias("mode"), "pid")
        out = part if out is None else out.unionByName(part)
    return out


@query("clip_lines", """WITH l AS (SELECT CAST(tile_id AS VARCHAR) AS path, pid AS seq, pid % 10 <> 0 AS is_point, x, y FROM {points})
SELECT path, seq, is_point FROM l WHERE NOT is_point OR EXISTS (SELECT 1 FROM {clips} s WHERE x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy)""")
def _(t):
    text = F.when(F.col("pid") % 10 == 0, "# note").otherwise(F.concat_ws(" ", F.col("x").cast("string"), F.col("y").cast("string"), F.col("z").cast("string")))
    lines = t.points.select(F.col("tile_id").cast("string").alias("path"), F.col("pid").alias("seq"), text.alias("value"))
    return S.clip_lines(lines, S.with_ring(t.clips), 100.0).select("path", "seq", "is_point")


@query("clip_counts", """SELECT CAST(tile_id AS VARCHAR) AS path, count(*) AS total, count(*) FILTER (EXISTS (SELECT 1 FROM {clips} s WHERE x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy)) AS kept FROM {points} GROUP BY 1""")
def _(t):
    lines = t.points.select(F.col("tile_id").cast("string").alias("path"), F.col("pid").alias("seq"), F.concat_ws(";", F.col("x").cast("string"), F.col("y").cast("string")).alias("value"))
    return S.clip_counts(lines, S.clip_lines(lines, S.with_ring(t.clips), 100.0))


@query("tiles_for_polygons", """SELECT s.sheet_id, f.fid, CASE WHEN f.fid IS NULL THEN 'no_tiles' ELSE 'ok' END AS status FROM {sheets} s LEFT JOIN {footprints} f
ON f.minx <= s.maxx + 50 AND s.minx - 50 <= f.maxx AND f.miny <= s.maxy + 50 AND s.miny - 50 <= f.maxy""")
def _(t):
    return S.tiles_for_polygons(S.with_ring(t.sheets), t.footprints, "sheet_id", "fid", 50.0, 100.0)


@query("containing_polygon", """SELECT event_id, coalesce(min(code), 'NONE') AS code FROM {track_points} LEFT JOIN {sheets} ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy AND lote = event_id % 5 GROUP BY 1""")
def _(t):
    pts = t.track_points.select("event_id", "x", "y", (F.col("event_id") % 5).cast("int").alias("k"))
    return S.containing_polygon(pts, S.with_ring(t.sheets), 100.0, "event_id", "code", ("k", "lote"), F.lit("NONE")).select("event_id", "code")


@query("admin_unit", """SELECT lot_id, code, CASE code WHEN 'NATION_00' THEN 'A' WHEN 'BRAZIL' THEN 'B' END AS district FROM {lots} l LEFT JOIN {sheets} s
ON (l.minx+l.maxx)/2 BETWEEN s.minx AND s.maxx AND (l.miny+l.maxy)/2 BETWEEN s.miny AND s.maxy""")
def _(t):
    return S.admin_unit(_lots(t), S.with_ring(t.sheets), 100.0, "lot_id", "code", {"NATION_00": "A", "BRAZIL": "B"})


@query("nearest_lot", """WITH d AS (SELECT cid, lot_id, sqrt(greatest(minx-x, x-maxx, 0)**2 + greatest(miny-y, y-maxy, 0)**2) AS d FROM {control_points} JOIN {lots} ON x BETWEEN minx-5 AND maxx+5 AND y BETWEEN miny-5 AND maxy+5)
SELECT cid, arg_min(lot_id, {'d': CASE WHEN d <= 0.2 THEN 0 ELSE round(d, 9) END, 'i': lot_id}) AS lot_id, round(min(CASE WHEN d <= 0.2 THEN 0 ELSE d END), 6) AS dist FROM d WHERE d <= 5 GROUP BY 1""")
def _(t):
    return rounded(S.nearest_lot(t.control_points, _lots(t), "cid", "lot_id"), dist=6)


@query("claim_lots")
def _(t):
    cand = S.lot_candidates(t.control_points, _lots(t), "cid", "lot_id", 0.2, 5.0, 10.0)
    return rounded(H.claim_lots(cand, "cid", "lot_id"), dist=6)


_LARGEST = """WITH o AS (SELECT lot_id, use_id, greatest(least(l.maxx, u.maxx)-greatest(l.minx, u.minx), 0)*greatest(least(l.maxy, u.maxy)-greatest(l.miny, u.miny), 0) AS area
FROM {lots} l JOIN {uses} u ON l.minx <= u.maxx AND u.minx <= l.maxx AND l.miny <= u.maxy AND u.miny <= l.maxy)
SELECT lot_id, arg_max(use_id, {'a': round(area, 6), 'i': -use_id}) AS use_id, round(max(area), 5) AS area FROM o WHERE area > 1e-6 GROUP BY 1"""


@query("largest_building", _LARGEST)
def _(t):
    return rounded(S.largest_building(_lots(t), _uses(t), "lot_id", "use_id", 20.0), area=5)


@query("largest_building_in_lot", _LARGEST)
def _(t):
    # with features of parts and holes, here of one part each
    parts = F.array(F.struct("ring", F.slice(F.array("ring"), 1, 0).alias("holes")))
    lots, uses = (f.withColumn("parts", parts).drop("ring") for f in (_lots(t), _uses(t)))
    return rounded(S.largest_building(lots, uses, "lot_id", "use_id", 20.0), area=5)


@query("largest_inner_building", """WITH c AS (SELECT lot_id, use_id, round((u.maxx-u.minx)*(u.maxy-u.miny), 6) AS area FROM {lots} l JOIN {uses} u ON (u.minx+u.maxx)/2 BETWEEN l.minx-1e-9 AND l.maxx+1e-9 AND (u.miny+u.maxy)/2 BETWEEN l.miny-1e-9 AND l.maxy+1e-9)
SELECT lot_id, max(area) AS area FROM c GROUP BY 1""")
def _(t):
    return rounded(S.largest_inner_building(_lots(t), _uses(t), "lot_id", "use_id", 20.0).select("lot_id", "area"), area=6)


@query("road_name_at", """WITH c AS (SELECT cid, road_name, abs(y - y1) AS d FROM {control_points} JOIN {roads} ON y1 BETWEEN y - 15 AND y + 15)
SELECT cid, arg_min(road_name, {'d': round(d, 9), 'n': road_name}) AS road_name, round(min(d), 6) AS dist FROM c GROUP BY 1""")
def _(t):
    return rounded(S.road_name_at(t.control_points, t.roads, "cid", "road_name").select("cid", "road_name", "dist"), dist=6)


@query("local_direction", """SELECT cid, CASE WHEN x < 1000 AND EXISTS (SELECT 1 FROM {roads} WHERE abs(y - y1) <= 3) THEN CAST(0 AS DOUBLE) END AS angle FROM {control_points}""")
def _(t):
    return S.local_direction(t.control_points, t.roads, "cid", 3.0, 0.001, None)


@query("footprint_overlaps", """SELECT a.fid AS a, b.fid AS b FROM {footprints} a JOIN {footprints} b ON a.fid < b.fid AND a.minx <= b.maxx + 1 AND b.minx - 1 <= a.maxx AND a.miny <= b.maxy + 1 AND b.miny - 1 <= a.maxy""")
def _(t):
    return S.footprint_overlaps(t.footprints, "fid", 10.0, 1.0)


@query("hull_overlaps", """SELECT a.fid AS a, b.fid AS b FROM {footprints} a JOIN {footprints} b ON a.fid < b.fid AND a.minx <= b.maxx AND b.minx <= a.maxx AND a.miny <= b.maxy AND b.miny <= a.maxy""")
def _(t):
    return S.footprint_overlaps(S.with_ring(t.footprints).select("fid", "ring"), "fid", 10.0, 0.0, "hull")


@query("clip_geometry_for", """WITH r AS (SELECT file_id, path, replace(upper(regexp_extract(replace(stem, '-', '_'), '(\\d\\d\\d+_[A-Z0-9]+_[A-Z0-9]+_[A-Z0-9]+_[A-Z0-9]+)', 1)), '_', '-') AS code, file_id % 800 AS minx FROM {file_paths}),
s AS (SELECT lot_id AS sheet_id, concat(2800 + lot_id % 90, '-', 1 + lot_id % 4, '-SE-A-I') AS code, minx, maxx FROM {lots})
SELECT file_id, sheet_id FROM r JOIN s ON s.code = CASE WHEN r.code LIKE '%-R0' THEN substr(r.code, 1, length(r.code)-3) ELSE r.code END AND r.minx <= s.maxx AND s.minx <= r.minx + 100""")
def _(t):
    code = F.concat((F.lit(2800) + F.col("lot_id") % 90).cast("string"), F.lit("_"), (F.lit(1) + F.col("lot_id") % 4).cast("string"), F.lit("_SE_A_I"))
    sheets = t.lots.select(F.col("lot_id").alias("sheet_id"), code.alias("code"), "minx", "maxx", F.lit(0.0).alias("miny"), F.lit(1.0).alias("maxy"))
    x = (F.col("file_id") % 800).cast("double")
    r = t.file_paths.select("file_id", "path", x.alias("minx"), (x + 100).alias("maxx"), F.lit(0.0).alias("miny"), F.lit(1.0).alias("maxy"))
    return S.clip_geometry_for(r, sheets).select("file_id", "sheet_id")


# --- neighbours --------------------------------------------------------------

@query("shared_edges", f"""WITH {_KEYED}, g AS (SELECT ax, ay, bx, b_y, count(*) AS copies, min(lot_id) AS m1, max(lot_id) AS m2 FROM k GROUP BY ALL)
SELECT lot_id, seg_no, copies, CASE WHEN copies = 1 THEN NULL WHEN lot_id = m1 THEN m2 ELSE m1 END AS neighbour FROM k JOIN g USING (ax, ay, bx, b_y)""")
def _(t):
    return K.shared_edges(_segs(t), "lot_id").select("lot_id", "seg_no", "copies", "neighbour")


@query("road_neighbour", f"""WITH {_KEYED}, g AS (SELECT *, count(*) OVER (PARTITION BY ax, ay, bx, b_y) AS copies FROM k)
SELECT DISTINCT lot_id, seg_no FROM g JOIN {{roads}} r ON g.copies = 1 AND r.y1 BETWEEN ay - 1 AND b_y + 1""")
def _(t):
    return K.road_neighbour(K.shared_edges(_segs(t), "lot_id"), t.roads, "lot_id").withColumn("seg_no", F.col("seg_no").cast("int"))


@query("best_neighbour", f"""WITH {_KEYED}, g AS (SELECT *, count(*) OVER (PARTITION BY ax, ay, bx, b_y) AS copies, min(lot_id) OVER (PARTITION BY ax, ay, bx, b_y) AS m1, max(lot_id) OVER (PARTITION BY ax, ay, bx, b_y) AS m2 FROM k),
r AS (SELECT lot_id, seg_no, arg_min(road_name, {{'d': round(abs((ay+b_y)/2 - r.y1), 6), 'n': road_name}}) AS road FROM g JOIN {{roads}} r ON r.y1 BETWEEN ay - 0.05 AND b_y + 0.05 WHERE ax = bx GROUP BY 1, 2)
SELECT lot_id, seg_no, CASE WHEN copies > 1 THEN CASE WHEN lot_id = m1 THEN m2 ELSE m1 END END AS lot, road, CASE WHEN copies > 1 THEN 'lot' WHEN road IS NOT NULL THEN 'road' END AS kind FROM g LEFT JOIN r USING (lot_id, seg_no)""".replace("{{'d'", "{'d'").replace("road_name}})", "road_name})").replace("{{roads}}", "{roads}"))
def _(t):
    return K.best_neighbour(_segs(t), _lots(t), t.roads, "lot_id", "lot_id", "road_name").select("lot_id", "seg_no", "lot", "road", "kind")


@query("access_roads", """SELECT lot_id, string_agg(road_name, '|' ORDER BY road_name) AS roads, count(*) >= 2 AS corner FROM {lots} JOIN {roads} ON y1 BETWEEN miny AND maxy GROUP BY 1""")
def _(t):
    out = K.access_roads(_lots(t), t.roads, "lot_id", "road_name")
    return out.select("lot_id", F.array_join("roads", "|").alias("roads"), "corner")


@query("along_line_distance", """WITH p AS (SELECT road_id, pid % 3 = 0 AS c, x FROM {points} JOIN {roads} ON y1 BETWEEN y - 2.000000001 AND y + 2.000000001)
SELECT a.road_id, round(min(abs(a.x - b.x)), 6) AS dist FROM p a JOIN p b ON a.road_id = b.road_id AND a.c AND NOT b.c GROUP BY 1""")
def _(t):
    lines = t.roads.select("road_id", F.array(G.xy(F.col("x1"), F.col("y1")), G.xy(F.col("x2"), F.col("y2"))).alias("line"))
    role = F.when(F.col("pid") % 3 == 0, "corner").otherwise("front")
    near = nearest_line(t.points, t.roads, 2.000000001, "pid", "road_id").select("pid", "road_id")
    pts = t.points.select("pid", "x", "y", role.alias("role")).join(near, "pid")
    return rounded(K.along_line_distance(pts, lines, "pid", "road_id", "role", 2.000000001), dist=6)


@query("frontage_vertex", """WITH d AS (SELECT lot_id, cid, x, y, minx, miny, maxx, maxy, sqrt(greatest(minx-x, x-maxx, 0)**2 + greatest(miny-y, y-maxy, 0)**2) AS d
  FROM {lots} JOIN {control_points} ON x BETWEEN minx-3 AND maxx+3 AND y BETWEEN miny-3 AND maxy+3),
n AS (SELECT * FROM d WHERE d <= 3 QUALIFY row_number() OVER (PARTITION BY lot_id ORDER BY round(d, 9), cid) = 1),
e AS (SELECT lot_id, minx, maxx, miny, maxy, greatest(minx-x, x-maxx, 0) AS ox, greatest(miny-y, y-maxy, 0) AS oy, x, y FROM n),
k AS (SELECT lot_id, minx, maxx, miny, maxy, round(sqrt(ox**2 + (y-miny)**2), 9) AS b, round(sqrt(oy**2 + (x-maxx)**2), 9) AS r, round(sqrt(ox**2 + (y-maxy)**2), 9) AS t, round(sqrt(oy**2 + (x-minx)**2), 9) AS l FROM e)
SELECT l.lot_id, CASE WHEN k.lot_id IS NULL THEN l.minx WHEN b <= least(r, t, k.l) THEN l.minx WHEN r <= least(t, k.l) OR t <= k.l THEN l.maxx ELSE l.minx END AS x,
CASE WHEN k.lot_id IS NULL THEN CASE WHEN EXISTS (SELECT 1 FROM {roads} q WHERE q.y1 BETWEEN l.miny AND l.maxy) THEN l.maxy ELSE l.miny END WHEN b <= least(r, t, k.l) THEN l.miny ELSE l.maxy END AS y
FROM {lots} l LEFT JOIN k ON k.lot_id = l.lot_id""")
def _(t):
    access = K.access_roads(_lots(t), t.roads, "lot_id", "road_name").select("lot_id", F.element_at("roads", 1).alias("road_name"))
    out = K.frontage_vertex(_lots(t).join(access, "lot_id", "left"), t.control_points, "lot_id", "cid", 3.0, roads=t.roads, road="road_name")
    return out.select("lot_id", F.element_at("ring", 1)["x"].alias("x"), F.element_at("ring", 1)["y"].alias("y"))


# --- overlays ----------------------------------------------------------------

_OV = """o AS (SELECT lot_id, use_id, use_type, use_class, (least(l.maxx, u.maxx)-greatest(l.minx, u.minx))*(least(l.maxy, u.maxy)-greatest(l.miny, u.miny)) AS area
FROM {lots} l JOIN {uses} u ON l.minx < u.maxx AND u.minx < l.maxx AND l.miny < u.maxy AND u.miny < l.maxy)"""
_COV = """xs AS (SELECT DISTINCT lot_id, x FROM (SELECT lot_id, unnest([minx, maxx]) AS x FROM {lots} UNION ALL SELECT lot_id, unnest([greatest(l.minx, u.minx), least(l.maxx, u.maxx)]) FROM {lots} l JOIN {uses} u ON l.minx < u.maxx AND u.minx < l.maxx AND l.miny < u.maxy AND u.miny < l.maxy) q),
ys AS (SELECT DISTINCT lot_id, y FROM (SELECT lot_id, unnest([miny, maxy]) AS y FROM {lots} UNION ALL SELECT lot_id, unnest([greatest(l.miny, u.miny), least(l.maxy, u.maxy)]) FROM {lots} l JOIN {uses} u ON l.minx < u.maxx AND u.minx < l.maxx AND l.miny < u.maxy AND u.miny < l.maxy) q),
xi AS (SELECT lot_id, x AS xa, lead(x) OVER (PARTITION BY lot_id ORDER BY x) AS xb FROM xs), yi AS (SELECT lot_id, y AS ya, lead(y) OVER (PARTITION BY lot_id ORDER BY y) AS yb FROM ys),
cells AS (SELECT xi.lot_id, xa, xb, ya, yb FROM xi JOIN yi USING (lot_id) WHERE xb IS NOT NULL AND yb IS NOT NULL),
cov AS (SELECT lot_id, sum((xb-xa)*(yb-ya)) AS covered FROM cells c WHERE EXISTS (SELECT 1 FROM {uses} u WHERE u.minx <= (xa+xb)/2 AND u.maxx >= (xa+xb)/2 AND u.miny <= (ya+yb)/2 AND u.maxy >= (ya+yb)/2) GROUP BY 1)"""


@query("overlay_area", f"""WITH {_OV} SELECT lot_id, use_id, use_type, use_class, round(area, 5) AS area FROM o WHERE area >= 0.5""")
def _(t):
    out = K.overlay_area(_lots(t), _uses(t), "lot_id", "use_id", 20.0, ["use_type", "use_class"])
    return rounded(out.select("lot_id", "use_id", "use_type", "use_class", "area"), area=5)


@query("covered_area", f"""WITH {_COV} SELECT lot_id, round(covered, 5) AS covered FROM cov""")
def _(t):
    return rounded(K.covered_area(_lots(t), _uses(t), "lot_id", "use_id", 20.0), covered=5)


def _closure(t):
    lots, uses = _lots(t), _uses(t)
    ov = K.overlay_area(lots, uses, "lot_id", "use_id", 20.0, ["use_type", "use_class"])
    return K.land_use_closure(lots, ov, K.covered_area(lots, uses, "lot_id", "use_id", 20.0), "lot_id", ["use_type", "use_class"])


_CLOSE = f"""{_OV}, {_COV}, b AS (SELECT * FROM o WHERE area >= 0.5), us AS (SELECT lot_id, sum(area) AS used FROM b GROUP BY 1),
c AS (SELECT lot_id, 250.0 AS total, coalesce(used, 0) AS used, CASE WHEN used > 0 THEN covered ELSE 0 END AS covered FROM {{lots}} LEFT JOIN us USING (lot_id) LEFT JOIN cov USING (lot_id)),
g AS (SELECT *, CASE WHEN abs(total - covered) <= 0.5 THEN 0 ELSE total - covered END AS gap FROM c)"""


@query("land_use_detail", f"""WITH {_CLOSE} SELECT lot_id, use_type, use_class, round(sum(area)/10000, 8) AS area_ha FROM b GROUP BY 1, 2, 3 UNION ALL SELECT lot_id, 'SEM_USO', 'SEM_USO', round(gap/10000, 8) FROM g WHERE gap > 0.5""")
def _(t):
    return rounded(_closure(t)[0].select("lot_id", "use_type", "use_class", "area_ha"), area_ha=8)


@query("land_use_check", f"""WITH {_CLOSE} SELECT lot_id, round(used/10000, 8) AS used_ha, round(gap/10000, 8) AS gap_ha, round(CASE WHEN used = 0 OR abs(used-total) <= 0.5 THEN 0 ELSE used - total END/10000, 8) AS excess_ha,
round(greatest(used - covered, 0)/10000, 8) AS overlap_ha FROM g""")
def _(t):
    out = _closure(t)[1].select("lot_id", "used_ha", "gap_ha", "excess_ha", "overlap_ha")
    return rounded(out, used_ha=8, gap_ha=8, excess_ha=8, overlap_ha=8)


@query("land_use_overlaps", f"""WITH {_CLOSE} SELECT lot_id, round((used - covered)/10000, 8) AS overlap_ha FROM g WHERE used - covered > 0.5""")
def _(t):
    return rounded(_closure(t)[2].select("lot_id", "overlap_ha"), overlap_ha=8)


# features with holes and several parts: lots with a yard in the middle, uses in two places of which one has a hole

def _box(minx, miny, maxx, maxy):
    return G.box_ring(*[F.col(c) + d for c, d in (("minx", minx), ("miny", miny), ("maxx", maxx), ("maxy", maxy))])


def _yards(t):
    """Clockwise hole in a counter-clockwise lot; every other lot has its hole in the other direction."""
    hole = _box(2, 5, -3, -10)
    hole = F.when(F.col("lot_id") % 2 == 0, F.reverse(hole)).otherwise(hole)
    return t.lots.select("lot_id", "block_id", F.array(F.struct(_box(0, 0, 0, 0).alias("ring"), F.array(hole).alias("holes"))).alias("parts"))


def _places(t):
    first = F.struct(_box(0, 0, 0, 0).alias("ring"), F.array(_box(1, 2, -1, -2)).alias("holes"))
    second = F.struct(_box(20, 30, 20, 30).alias("ring"), F.slice(F.array(_box(0, 0, 0, 0)), 1, 0).alias("holes"))
    return t.uses.select("use_id", "use_type", "use_class", F.array(first, second).alias("parts"))


# signed rectangles of both sides; their overlaps add up
_SIGNED = """lr AS (SELECT lot_id, 1 AS s, minx, miny, maxx, maxy FROM {lots} UNION ALL SELECT lot_id, -1, minx+2, miny+5, maxx-3, maxy-10 FROM {lots}),
ur AS (SELECT use_id, use_type, use_class, 1 AS s, minx, miny, maxx, maxy FROM {uses} UNION ALL SELECT use_id, use_type, use_class, -1, minx+1, miny+2, maxx-1, maxy-2 FROM {uses}
UNION ALL SELECT use_id, use_type, use_class, 1, minx+20, miny+30, maxx+20, maxy+30 FROM {uses}),
o AS (SELECT lot_id, use_id, use_type, use_class, sum(l.s*u.s*(least(l.maxx, u.maxx)-greatest(l.minx, u.minx))*(least(l.maxy, u.maxy)-greatest(l.miny, u.miny))) AS area
FROM lr l JOIN ur u ON l.minx < u.maxx AND u.minx < l.maxx AND l.miny < u.maxy AND u.miny < l.maxy GROUP BY ALL)"""
# cells between all borders that reach into a lot, each in or out of the lot and of some use
_SIGNED_COV = """q AS (SELECT l.lot_id, use_id, u.s, u.minx, u.miny, u.maxx, u.maxy FROM {lots} l JOIN ur u ON l.minx < u.maxx AND u.minx < l.maxx AND l.miny < u.maxy AND u.miny < l.maxy),
xs AS (SELECT DISTINCT lot_id, x FROM (SELECT lot_id, unnest([minx, minx+2, maxx-3, maxx]) AS x FROM {lots} UNION ALL SELECT lot_id, unnest([greatest(l.minx, q.minx), least(l.maxx, q.maxx)]) FROM {lots} l JOIN q USING (lot_id)) z),
ys AS (SELECT DISTINCT lot_id, y FROM (SELECT lot_id, unnest([miny, miny+5, maxy-10, maxy]) AS y FROM {lots} UNION ALL SELECT lot_id, unnest([greatest(l.miny, q.miny), least(l.maxy, q.maxy)]) FROM {lots} l JOIN q USING (lot_id)) z),
xi AS (SELECT lot_id, x AS xa, lead(x) OVER (PARTITION BY lot_id ORDER BY x) AS xb FROM xs), yi AS (SELECT lot_id, y AS ya, lead(y) OVER (PARTITION BY lot_id ORDER BY y) AS yb FROM ys),
cells AS (SELECT xi.lot_id, xa, xb, ya, yb, (xa+xb)/2 AS x, (ya+yb)/2 AS y FROM xi JOIN yi USING (lot_id) WHERE xb IS NOT NULL AND yb IS NOT NULL),
inl AS (SELECT c.* FROM cells c JOIN {lots} l USING (lot_id) WHERE NOT (x BETWEEN minx+2 AND maxx-3 AND y BETWEEN miny+5 AND maxy-10)),
hit AS (SELECT lot_id, xa, xb, ya, yb, use_id FROM inl c JOIN q USING (lot_id) WHERE x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy GROUP BY ALL HAVING sum(s) > 0),
cov AS (SELECT lot_id, sum((xb-xa)*(yb-ya)) AS covered FROM (SELECT DISTINCT lot_id, xa, xb, ya, yb FROM hit) z GROUP BY 1)"""


@query("overlay_area_parts", f"""WITH {_SIGNED} SELECT lot_id, use_id, use_type, round(area, 5) AS area FROM o WHERE area >= 0.5""")
def _(t):
    out = K.overlay_area(_yards(t), _places(t), "lot_id", "use_id", 20.0, ["use_type"])
    return rounded(out, area=5)


@query("covered_area_parts", f"""WITH {_SIGNED}, {_SIGNED_COV} SELECT lot_id, round(covered, 5) AS covered FROM cov""")
def _(t):
    return rounded(K.covered_area(_yards(t), _places(t), "lot_id", "use_id", 20.0), covered=5)


@query("land_use_check_parts", f"""WITH {_SIGNED}, {_SIGNED_COV}, us AS (SELECT lot_id, sum(area) AS used FROM o WHERE area >= 0.5 GROUP BY 1),
c AS (SELECT lot_id, 200.0 AS total, coalesce(used, 0) AS used, CASE WHEN used > 0 THEN coalesce(covered, 0) ELSE 0 END AS covered FROM {{lots}} LEFT JOIN us USING (lot_id) LEFT JOIN cov USING (lot_id))
SELECT lot_id, round(total/10000, 8) AS total_ha, round(used/10000, 8) AS used_ha, round(CASE WHEN abs(total - covered) <= 0.5 THEN 0 ELSE total - covered END/10000, 8) AS gap_ha,
round(greatest(used - covered, 0)/10000, 8) AS overlap_ha FROM c""")
def _(t):
    lots, uses = _yards(t), _places(t)
    ov = K.overlay_area(lots, uses, "lot_id", "use_id", 20.0, ["use_type", "use_class"])
    check = K.land_use_closure(lots, ov, K.covered_area(lots, uses, "lot_id", "use_id", 20.0), "lot_id", ["use_type", "use_class"])[1]
    return rounded(check.select("lot_id", "total_ha", "used_ha", "gap_ha", "overlap_ha"), total_ha=8, used_ha=8, gap_ha=8, overlap_ha=8)


@query("crop_points_parts", """SELECT pid, lot_id FROM {points} JOIN {lots} ON x BETWEEN minx AND maxx AND y BETWEEN miny AND maxy AND NOT (x > minx+2 AND x < maxx-3 AND y > miny+5 AND y < maxy-10)""")
def _(t):
    return S.crop_points(t.points, _yards(t), 20.0, "lot_id").select("pid", "lot_id")


@query("dissolve", f"""WITH {_KEYED}, g AS (SELECT block_id, ax, ay, bx, b_y FROM k GROUP BY ALL HAVING count(*) = 1),
a AS (SELECT block_id, round(sum((maxx-minx)*(maxy-miny)), 4) AS area FROM {{lots}} GROUP BY 1)
SELECT block_id, area, count(*) AS vertices, round(sum(bx - ax + b_y - ay), 4) AS perimeter FROM g JOIN a USING (block_id) GROUP BY ALL""")
def _(t):
    from pyspark.sql import Window
    v = K.dissolve(_lots(t), "lot_id", "block_id")
    w = Window.partitionBy("block_id", "ring_id").orderBy("seq")
    nx = F.coalesce(F.lead("x").over(w), F.first("x").over(w))
    ny = F.coalesce(F.lead("y").over(w), F.first("y").over(w))
    e = v.withColumn("nx", nx).withColumn("ny", ny)
    out = e.groupBy("block_id").agg(F.sum((F.col("x") * F.col("ny") - F.col("nx") * F.col("y")) / 2).alias("area"), F.count(F.lit(1)).alias("vertices"),
                                    F.sum(F.hypot(F.col("nx") - F.col("x"), F.col("ny") - F.col("y"))).alias("perimeter"))
    return rounded(out, area=4, perimeter=4)


@query("dissolve_uneven", f"""WITH {_KEYED}, g AS (SELECT block_id, ax, ay, bx, b_y FROM k GROUP BY ALL HAVING count(*) = 1)
SELECT block_id, area, perimeter FROM (SELECT block_id, round(sum(bx - ax + b_y - ay), 4) AS perimeter FROM g GROUP BY 1) p
JOIN (SELECT block_id, round(sum((maxx-minx)*(maxy-miny)), 4) AS area FROM {{lots}} GROUP BY 1) a USING (block_id)""")
def _(t):
    """Lots cut in three whose borders meet in the middle of each other's edges; their union is that of the lots."""
    third = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _box(*d).alias("ring")) for i, d in enumerate(((0, 0, -6, 0), (4, 0, 0, -15), (4, 10, 0, 0)))]))
    cut_lots = t.lots.select("lot_id", "block_id", third.alias("p")).select(F.struct("lot_id", "p.i").alias("part_id"), "block_id", "p.ring")
    v = K.dissolve(cut_lots, "part_id", "block_id")
    w = Window.partitionBy("block_id", "ring_id").orderBy("seq")
    e = v.withColumns({"nx": F.coalesce(F.lead("x").over(w), F.first("x").over(w)), "ny": F.coalesce(F.lead("y").over(w), F.first("y").over(w))})
    out = e.groupBy("block_id").agg(F.sum((F.col("x") * F.col("ny") - F.col("nx") * F.col("y")) / 2).alias("area"), F.sum(F.hypot(F.col("nx") - F.col("x"), F.col("ny") - F.col("y"))).alias("perimeter"))
    return rounded(out, area=4, perimeter=4)


# borders of lots as a net: lines run from one corner where three or more borders meet to the next
_NET = _KEYED + """, u AS (SELECT DISTINCT ax, ay, bx, b_y FROM k), d AS (SELECT ax AS x1, ay AS y1, bx AS x2, b_y AS y2 FROM u UNION ALL SELECT bx, b_y, ax, ay FROM u),
n AS (SELECT x1 AS x, y1 AS y, count(*) AS n FROM d GROUP BY 1, 2),
r AS (SELECT x1 AS fx, y1 AS fy, x2 AS gx, y2 AS gy, 0 AS seq, x1, y1, x2, y2 FROM d JOIN n ON n.x = x1 AND n.y = y1 WHERE n.n <> 2
  UNION ALL SELECT r.fx, r.fy, r.gx, r.gy, r.seq + 1, d.x1, d.y1, d.x2, d.y2 FROM r JOIN n ON n.x = r.x2 AND n.y = r.y2 AND n.n = 2
  JOIN d ON d.x1 = r.x2 AND d.y1 = r.y2 AND NOT (d.x2 = r.x1 AND d.y2 = r.y1)),
l AS (SELECT *, max(seq) OVER (PARTITION BY fx, fy, gx, gy) AS most FROM r),
keep AS (SELECT * FROM (SELECT fx, fy, gx, gy, x1 AS tx1, y1 AS ty1, x2 AS tx2, y2 AS ty2 FROM l WHERE seq = most) z WHERE (tx1, ty1, tx2, ty2) < (gx, gy, fx, fy))"""


@query("merge_chains", f"WITH RECURSIVE {_NET} SELECT fx, fy, gx, gy, CAST(seq AS BIGINT) AS seq, x1, y1, x2, y2 FROM l JOIN keep USING (fx, fy, gx, gy)")
def _(t):
    segs = _segs(t).select(F.lit(0).alias("net"), "x1", "y1", "x2", "y2")
    first = lambda a, b: F.col(f"line_id.{a}.{b}") * 0.01
    out = H.merge_chains(segs, "net").filter("NOT closed")
    return out.select(first("a", "x").alias("fx"), first("a", "y").alias("fy"), first("b", "x").alias("gx"), first("b", "y").alias("gy"), "seq", "x1", "y1", "x2", "y2")


@query("merge_lines", """SELECT count(*) AS lines, round(sum(2*(maxx-minx) + 2*(maxy-miny)), 4) AS total, max(2*(maxx-minx) + 2*(maxy-miny)) AS longest FROM {lots}""")
def _(t):
    segs = _segs(t).select(F.col("lot_id").alias("name"), "x1", "y1", "x2", "y2")
    m = H.merge_lines(segs, "name").select("line_id", "line_length").distinct()
    return m.agg(F.count(F.lit(1)).alias("lines"), F.round(F.sum("line_length"), 4).alias("total"), F.max("line_length").alias("longest"))


@query("components", """WITH n AS (SELECT o_orderkey AS node, min(o_orderkey) OVER (PARTITION BY o_custkey) AS comp, count(*) OVER (PARTITION BY o_custkey) AS k FROM orders)
SELECT node, comp FROM n WHERE k > 1""")
def _(t):
    # the orders of a customer form a chain, each linked to the next
    after = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return H.components(t.orders.select(F.col("o_orderkey").alias("a"), after.alias("b")).filter("b IS NOT NULL"))


# --- plan segments -----------------------------------------------------------

@query("node_segments", f"""WITH {_KEYED} SELECT DISTINCT ax, ay, bx, b_y AS by_ FROM k""")
def _(t):
    s = K.node_segments(_lots(t), "lot_id")
    return s.select(F.round(F.least("x1", "x2"), 4).alias("ax"), F.round(F.least("y1", "y2"), 4).alias("ay"), F.round(F.greatest("x1", "x2"), 4).alias("bx"), F.round(F.greatest("y1", "y2"), 4).alias("by_"))


@query("merge_short_segments", """SELECT count(*) AS segments, round(sum(maxx - minx), 3) AS total FROM {lots}""")
def _(t):
    long_ = t.lots.select("minx", F.col("miny").alias("y1"), F.col("maxx"))
    a = long_.select(F.col("minx").alias("x1"), "y1", (F.col("minx") + 5).alias("x2"), F.col("y1").alias("y2"))
    tiny = long_.select((F.col("minx") + 5).alias("x1"), "y1", (F.col("minx") + 5.008).alias("x2"), F.col("y1").alias("y2"))
    b = long_.select((F.col("minx") + 5.008).alias("x1"), "y1", F.col("maxx").alias("x2"), F.col("y1").alias("y2"))
    out = K.merge_short_segments(a.unionByName(tiny).unionByName(b), tol=0.001)
    return out.agg(F.count(F.lit(1)).alias("segments"), F.round(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))), 3).alias("total"))


@query("drop_covered_segments", """SELECT minx AS x1, miny AS y1, minx + 5 AS x2, miny AS y2 FROM {lots} UNION ALL SELECT minx + 5, miny, maxx, miny FROM {lots}""")
def _(t):
    seg = lambda a, b: t.lots.select(a.alias("x1"), F.col("miny").alias("y1"), b.alias("x2"), F.col("miny").alias("y2"))
    m, lo, hi = F.col("minx") + 5, F.col("minx"), F.col("maxx")
    return K.drop_covered_segments(seg(lo, hi).unionByName(seg(lo, m)).unionByName(seg(m, hi)))


@query("pick_edge")
def _(t):
    lots = _lots(t)
    claims = H.claim_lots(S.lot_candidates(t.control_points, lots, "cid", "lot_id", 0.2, 5.0, 10.0), "cid", "lot_id")
    doors = claims.join(t.control_points.select("cid", "x", "y"), "cid").select(F.col("cid").alias("seq"), "lot_id", "x", "y")
    out = K.pick_edge(doors, K.shared_edges(K.segments(lots, "lot_id"), "lot_id"), "lot_id")
    return rounded(out, dist=6, px=6, py=6)


@query("drainage_arrows", """WITH z AS (SELECT road_id, x1, x2, y1, (SELECT v FROM {dtm_cells} d WHERE d.row_i = floor(y1/10) AND d.col_i = floor(x1/10) AND v <> -9999) AS z1,
(SELECT v FROM {dtm_cells} d WHERE d.row_i = floor(y1/10) AND d.col_i = floor((x2-5)/10) AND v <> -9999) AS z2 FROM {roads})
SELECT road_id, a AS arrow, round(x1 + (0.2 + 0.6*(a-1))*(x2 - 5 - x1), 6) AS x, y1 + 0.4 AS y, CASE WHEN z2 < z1 THEN 0.0 ELSE 180.0 END AS angle FROM z, (SELECT unnest([1, 2]) AS a) q WHERE z1 IS NOT NULL AND z2 IS NOT NULL""".replace("THEN 0.0 ELSE 180.0 END", "THEN CAST(0 AS DOUBLE) ELSE CAST(180 AS DOUBLE) END"))
def _(t):
    roads = t.roads.withColumn("x2", F.col("x2") - 5)
    out = K.drainage_arrows(roads, t.dtm_cells, 10.0, "road_id", nodata=-9999.0)
    return rounded(out, x=6, y=6).withColumn("angle", F.abs("angle"))


@query("cross_sections", """WITH a AS (SELECT road_id, y1, f AS fraction FROM {roads}, (SELECT unnest([0.2, 0.5, 0.8]) AS f) q), l AS (SELECT DISTINCT miny AS y FROM {lots} UNION SELECT DISTINCT maxy FROM {lots})
SELECT road_id, CAST(fraction AS DOUBLE) AS fraction, CAST(8 AS DOUBLE) AS kerb_kerb, min(y - y1) FILTER (y > y1) - max(y - y1) FILTER (y < y1) AS gap FROM a LEFT JOIN l ON abs(y - y1) <= 40 GROUP BY ALL""")
def _(t):
    axes = t.roads.select("road_id", "x1", "y1", "x2", "y2")
    kerb = lambda d: axes.select(F.col("x1"), (F.col("y1") + d).alias("y1"), "x2", (F.col("y2") + d).alias("y2"))
    # kerbs 4 m on both sides of each axis; the axes are 10 m apart
    out = K.cross_sections(axes, kerb(4.0).unionByName(kerb(-4.0)), K.segments(_lots(t), "lot_id"), "road_id", span=40.0, max_width=100.0)
    gap = F.col("kerb_kerb") + (F.col("lot_lot") - F.col("kerb_kerb"))
    return rounded(out.select("road_id", "fraction", "kerb_kerb", gap.alias("gap")), kerb_kerb=6, gap=6)


@query("section_places", """WITH s AS (SELECT road_id, x1, y1, CAST(f AS DOUBLE) AS fraction, CAST(f AS DOUBLE) * 604 AS s FROM {roads}, (SELECT unnest([0.2, 0.4, 0.6, 0.8]) AS f) q)
SELECT road_id, round(fraction, 6) AS fraction, round(x1 + CASE WHEN s < 300 THEN s WHEN s < 304 THEN 300 ELSE s - 4 END, 6) AS mx, round(y1 + CASE WHEN s < 300 THEN 0 WHEN s < 304 THEN s - 300 ELSE 4 END, 6) AS my FROM s""")
def _(t):
    """Axes with a step in the middle; four places by spacing."""
    at = lambda dx, dy: G.xy(F.col("x1") + dx, F.col("y1") + dy)
    axes = t.roads.select("road_id", F.array(at(0, 0), at(300, 0), at(300, 4), at(600, 4)).alias("line"))
    out = K.section_places(axes, "road_id", spacing=150.0)
    return rounded(out.select("road_id", "fraction", "mx", "my"), fraction=6, mx=6, my=6)


@query("symbol_lookup", """SELECT p_partkey, CAST(i AS INT) AS copy, CASE p_partkey % 5 WHEN 0 THEN 'POSTE_ILUMI' WHEN 1 THEN 'BOCA_LOBO' WHEN 2 THEN 'INFRA_PVE' ELSE 'BOCA_LOBO' END AS symbol,
CAST(p_size + i AS DOUBLE) AS x, CASE p_partkey % 5 WHEN 2 THEN 0 ELSE 0 END AS angle FROM part, (SELECT unnest([0, 1, 2]) AS i) q WHERE p_partkey % 5 <> 4 AND i < CASE p_partkey % 5 WHEN 1 THEN 2 WHEN 3 THEN 3 ELSE 1 END""".replace("CASE p_partkey % 5 WHEN 2 THEN 0 ELSE 0 END AS angle", "CAST(0 AS DOUBLE) AS angle"))
def _(t):
    kind = F.element_at(F.array(*[F.lit(v) for v in ("PA", "BL2", "PVE", "AEBO3", "NADA")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    angle = F.when(F.col("p_partkey") % 5 == 2, 33.0).otherwise(0.0)
    pts = t.part.select("p_partkey", kind.alias("type"), F.col("p_size").cast("double").alias("x"), F.lit(0.0).alias("y"), angle.alias("angle"))
    return K.symbol_lookup(pts).select("p_partkey", "copy", "symbol", "x", "angle")


# --- thinning, groups, hulls -------------------------------------------------

@query("thin_by_distance")
def _(t):
    pts = t.points.select("pid", "x", "y", "z", F.col("classification").alias("cls"))
    return H.thin_by_distance(pts, 50.0, "z", "pid", ["cls"], 100).select("cls", "pid", "z")


@query("conflict_groups")
def _(t):
    edges = S.footprint_overlaps(t.footprints, "fid", 10.0)
    return H.conflict_groups(t.footprints, edges, "fid", ("minx", "miny"))


@query("sorted_report", """SELECT n_name AS holder, c_mktsegment AS use_class, round(sum(c_acctbal), 2) AS amount FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2 HAVING sum(c_acctbal) > 0""")
def _(t):
    totals = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        F.col("n_name").alias("holder"), F.col("c_mktsegment").alias("use_class")).agg(F.sum("c_acctbal").alias("amount"))
    return rounded(K.sorted_report(totals, ["holder", "use_class"], "amount"), amount=2)


@query("thin_by_distance_valid", """SELECT classification AS cls, count(*) AS points, CAST(0 AS BIGINT) AS too_close, CAST(0 AS BIGINT) AS left_out FROM {points} GROUP BY 1""")
def _(t):
    # what thinning promises: accepted points keep their distance, every other point is close to one of them
    pts = t.points.select("pid", "x", "y", "z", F.col("classification").alias("cls"))
    taken = cut(H.thin_by_distance(pts, 50.0, "z", "pid", ["cls"]))
    spots = taken.select("cls", F.col("pid").alias("_pid"), F.col("x").alias("_x"), F.col("y").alias("_y"))
    near = pairs_within(pts, spots, 50.0, ("x", "y"), ("_x", "_y"), ["pid"], keys=["cls"]).filter("_d < 50")
    seen = near.groupBy("cls", "pid").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("pid") == F.col("_pid")).alias("own"))
    all_ = pts.join(seen, ["cls", "pid"], "left")
    return all_.groupBy("cls").agg(
        F.count(F.lit(1)).alias("points"), F.count_if(F.col("own") & (F.col("n") > 1)).alias("too_close"), F.count_if(F.col("n").isNull()).alias("left_out"))


@query("conflict_groups_valid", """SELECT count(*) AS nodes, CAST(0 AS BIGINT) AS conflicts FROM {footprints}""")
def _(t):
    edges = cut(S.footprint_overlaps(t.footprints, "fid", 10.0))
    groups = cut(H.conflict_groups(t.footprints, edges, "fid", ("minx", "miny")))
    side = lambda c: groups.select(F.col("fid").alias(c), F.col("grp").alias(f"_{c}"))
    inside = edges.join(side("a"), "a").join(side("b"), "b").agg(F.count_if(F.col("_a") == F.col("_b")).alias("conflicts"))
    return groups.agg(F.count(F.lit(1)).alias("nodes")).crossJoin(F.broadcast(inside))  # one row each


@query("convex_hull", """WITH d AS (SELECT DISTINCT point_source_id, x, y FROM {points}), e AS (SELECT point_source_id, max(x + y) AS ne, min(x + y) AS sw, max(x - y) AS se, min(x - y) AS nw, min(x) AS minx, max(y) AS maxy FROM d GROUP BY 1)
SELECT point_source_id, round(ne, 4) AS ne, round(sw, 4) AS sw, round(se, 4) AS se, round(nw, 4) AS nw, minx, maxy FROM e""")
def _(t):
    h = H.convex_hull(t.points.select("point_source_id", "x", "y"), "point_source_id")
    top = lambda f: F.array_max(F.transform("ring", f))
    low = lambda f: F.array_min(F.transform("ring", f))
    out = h.select("point_source_id", top(lambda p: p["x"] + p["y"]).alias("ne"), low(lambda p: p["x"] + p["y"]).alias("sw"), top(lambda p: p["x"] - p["y"]).alias("se"),
                   low(lambda p: p["x"] - p["y"]).alias("nw"), low(lambda p: p["x"]).alias("minx"), top(lambda p: p["y"]).alias("maxy"))
    return rounded(out, ne=4, sw=4, se=4, nw=4)


# --- descriptions ------------------------------------------------------------

def _described(t):
    segs = _segs(t).withColumn("vx", G.vertex_key(F.col("x1"), 0.01)).withColumn("vy", G.vertex_key(F.col("y1"), 0.01)).withColumn(
        "wx", G.vertex_key(F.col("x2"), 0.01)).withColumn("wy", G.vertex_key(F.col("y2"), 0.01))
    code = K.number_vertices(_lots(t), "lot_id").select("vx", "vy", F.format_string("P-%03d", F.col("vertex_no")).alias("from_code"))
    to = code.select(F.col("vx").alias("wx"), F.col("vy").alias("wy"), F.col("from_code").alias("to_code"))
    return K.shared_edges(segs.join(code, ["vx", "vy"]).join(to, ["wx", "wy"]), "lot_id")


_CODES = f"""{_KEYED}, f AS (SELECT x1, y1, min(lot_id*10 + seg_no) AS o FROM e GROUP BY 1, 2), v AS (SELECT x1, y1, printf('P-%03d', row_number() OVER (ORDER BY o)) AS code FROM f),
g AS (SELECT *, count(*) OVER w AS copies, min(lot_id) OVER w AS m1, max(lot_id) OVER w AS m2 FROM k WINDOW w AS (PARTITION BY ax, ay, bx, b_y)),
s AS (SELECT g.*, a.code AS c1, b.code AS c2, CASE seg_no % 2 WHEN 1 THEN '10,00' ELSE '25,00' END AS d, replace(printf('%.3f', g.y1), '.', ',') AS n1, replace(printf('%.3f', g.x1), '.', ',') AS e1, replace(printf('%.3f', g.y2), '.', ',') AS n2,
replace(printf('%.3f', g.x2), '.', ',') AS e2, CASE WHEN copies > 1 THEN 'confrontando com o Lote ' || CASE WHEN lot_id = m1 THEN m2 ELSE m1 END || ' da Quadra ' || block_id ELSE 'confrontante não identificado' END AS beside,
CASE WHEN copies > 1 THEN 'propriedade ' || CASE WHEN lot_id = m1 THEN m2 ELSE m1 END ELSE 'GLEBA' END AS own,
CASE seg_no WHEN 1 THEN 90 WHEN 2 THEN 0 WHEN 3 THEN 270 ELSE 180 END AS az FROM g JOIN v a ON a.x1 = g.x1 AND a.y1 = g.y1 JOIN v b ON b.x1 = g.x2 AND b.y1 = g.y2)"""


@query("describe", f"""WITH {_CODES}
SELECT lot_id, string_agg(CASE WHEN seg_no = 1 THEN 'Inicia-se a descrição deste perímetro no vértice ' || c1 || ', de coordenadas N ' || n1 || ' m e E ' || e1 || ' m; ' ELSE '' END ||
CASE WHEN seg_no < 4 THEN 'deste, segue ' ELSE 'por fim, segue ' END || beside || ' com os seguintes azimutes e distâncias: ' || printf('%03d°00''00,00" e ', az) || d || ' m até o vértice ' || c2 ||
CASE WHEN seg_no < 4 THEN ', de coordenadas N ' || n2 || ' m e E ' || e2 || ' m; ' ELSE ', ponto inicial da descrição deste perímetro. ' END, '' ORDER BY seg_no) AS text FROM s GROUP BY 1""")
def _(t):
    s = _described(t).withColumn("kind", F.when(F.col("neighbour").isNotNull(), "lot")).withColumn("road", F.lit(None).cast("string"))
    return K.describe(s.withColumn("beside", K.neighbour_text("kind", "neighbour", "block_id", "road")), "lot_id")


@query("describe_synthetic", f"""WITH {_CODES}
SELECT lot_id, string_agg('deste, segue confrontando com ' || own || CASE WHEN own = 'GLEBA' THEN ' por meio de Linha ideal' ELSE '' END || ' com azimute ' || printf('%02d°00''', az) || ' e distância ' || d || ' m até o vértice ' || c2 ||
', definido pelas coordenadas E: ' || e2 || '0 m e N: ' || n2 || '0 m' || CASE WHEN seg_no < 4 THEN ';' ELSE ', ponto inicial da descrição, encerrando o perímetro descrito.' END, ' ' ORDER BY seg_no) AS text FROM s GROUP BY 1""")
def _(t):
    s = _described(t)
    own = K.owner_text(F.lit(None).cast("string"), F.col("neighbour").cast("string"), F.lit(False))
    return K.describe_synthetic(s.withColumn("beside", own), "lot_id")


@query("describe_road", """SELECT road_id, 'Inicia-se a descrição desta via no vértice R' || road_id || '.1, de coordenadas N ' || replace(printf('%.3f', y1), '.', ',') || ' m e E 0,000 m; por fim, segue intersectando com a X pela distância de 1000,00 m até o vértice R' || road_id || '.2, ponto final desta via. ' AS text FROM {roads}""")
def _(t):
    r = t.roads.withColumn("line", F.array(G.xy(F.col("x1"), F.col("y1")), G.xy(F.col("x2"), F.col("y2")))).select("road_id", "line")
    s = K.line_segments(r).withColumn("azimuth", F.lit(90.0)).withColumn("dist", F.col("x2") - F.col("x1")).withColumn("is_last", F.lit(True)).withColumn(
        "beside", F.lit("intersectando com a X"))
    name = F.concat(F.lit("R"), F.col("road_id").cast("string"))
    return K.describe(s.withColumn("from_code", F.concat(name, F.lit(".1"))).withColumn("to_code", F.concat(name, F.lit(".2"))), "road_id", road=True)
