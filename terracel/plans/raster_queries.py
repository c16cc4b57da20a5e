"""Raster and colour queries."""

from pyspark.sql import functions as F

from ..functions import color as C
from ..functions import geometry as G
from ..operators import color as Q
from ..operators import raster as R
from ..operators import spatial as S
from .registry import query, rounded

_B = "CAST({} AS INT)"
# 3x3 surroundings with the border repeated, holes null
_AROUND = """x AS (SELECT tile_id, min(row_i) AS r0, max(row_i) AS r1, min(col_i) AS c0, max(col_i) AS c1 FROM {src} GROUP BY 1),
o AS (SELECT s.tile_id, s.row_i, s.col_i, s.v, di, dj, least(greatest(s.row_i + di, r0), r1) AS rr, least(greatest(s.col_i + dj, c0), c1) AS cc, r0, r1, c0, c1
 FROM {src} s JOIN x USING (tile_id), (SELECT unnest([-1,0,1]) AS di) a, (SELECT unnest([-1,0,1]) AS dj) b),
h AS (SELECT o.tile_id, o.row_i, o.col_i, o.v, r0, r1, c0, c1, max(s.v) FILTER (di=-1 AND dj=-1) AS nw, max(s.v) FILTER (di=-1 AND dj=0) AS n, max(s.v) FILTER (di=-1 AND dj=1) AS ne, max(s.v) FILTER (di=0 AND dj=-1) AS w,
 max(s.v) FILTER (di=0 AND dj=1) AS e, max(s.v) FILTER (di=1 AND dj=-1) AS sw, max(s.v) FILTER (di=1 AND dj=0) AS s, max(s.v) FILTER (di=1 AND dj=1) AS se
 FROM o LEFT JOIN {src} s ON s.tile_id = o.tile_id AND s.row_i = o.rr AND s.col_i = o.cc GROUP BY ALL)"""
_DEM = _AROUND.replace("{src}", "{dem}")


def _around(src, n):
    """``_AROUND`` over ``src`` as tables x, o and h with a number, to use it more than once in one statement."""
    text = _AROUND.replace("{src}", src)
    for name in "xoh":
        for before, after in (("", " AS (SELECT "), (" JOIN ", " USING"), (" FROM ", " LEFT")):
            text = text.replace(f"{before}{name}{after}", f"{before}{name}{n}{after}")
    return text.replace("SELECT o.", f"SELECT o{n}.").replace("o.", f"o{n}.").replace(f"o{n}{n}", f"o{n}")


_DX, _DY = ("((ne+2*e+se)-(nw+2*w+sw))/160", "((sw+2*s+se)-(nw+2*n+ne))/160")
_CURVATURE = f"""WITH {_around("{dem}", 1)}, d AS (SELECT tile_id, row_i, col_i, {_DX} AS a, {_DY} AS b FROM h1),
da AS (SELECT tile_id, row_i, col_i, a AS v FROM d), db AS (SELECT tile_id, row_i, col_i, b AS v FROM d), {_around("da", 2)}, {_around("db", 3)},
p AS (SELECT tile_id, row_i, col_i, {_DX} AS xx FROM h2), q AS (SELECT tile_id, row_i, col_i, {_DY} AS yy FROM h3)
SELECT row_i, col_i, round(xx + yy + 0.0000000003, 8) AS curv FROM p JOIN q USING (tile_id, row_i, col_i)"""
# sums that end in a half of the last digit shown are shifted off it, alike on both sides
# filled cells keep their mean; the others take the 12 nearest within 25 m by inverse square distance, else the nearest cell
_SURFACE = """WITH f AS (SELECT {tile} AS tile_id, CAST(floor(y/10) AS BIGINT) AS row_i, CAST(floor(x/10) AS BIGINT) AS col_i, avg(z) AS v FROM {points} WHERE {where} GROUP BY 1, 2, 3),
x AS (SELECT tile_id, min(row_i) AS r0, max(row_i) AS r1, min(col_i) AS c0, max(col_i) AS c1 FROM f GROUP BY 1),
r AS (SELECT tile_id, unnest(range(r0, r1 + 1)) AS row_i FROM x), c AS (SELECT tile_id, unnest(range(c0, c1 + 1)) AS col_i FROM x),
e AS (SELECT tile_id, row_i, col_i FROM r JOIN c USING (tile_id) WHERE (tile_id, row_i, col_i) NOT IN (SELECT (tile_id, row_i, col_i) FROM f)),
d AS (SELECT e.tile_id, e.row_i, e.col_i, f.v, (f.row_i-e.row_i)*(f.row_i-e.row_i) + (f.col_i-e.col_i)*(f.col_i-e.col_i) AS d2, f.row_i AS fr, f.col_i AS fc FROM e JOIN f ON f.tile_id = e.tile_id),
k AS (SELECT *, row_number() OVER (PARTITION BY tile_id, row_i, col_i ORDER BY d2, fr, fc) AS k FROM d WHERE d2 <= {reach}),
i AS (SELECT tile_id, row_i, col_i, sum(v/d2)/sum(1.0/d2) AS v FROM k WHERE k <= 12 GROUP BY 1, 2, 3),
n AS (SELECT tile_id, row_i, col_i, arg_min(v, d2*1000000 + fr*1000 + fc) AS v FROM d GROUP BY 1, 2, 3)
SELECT tile_id, row_i, col_i, round(v + 0.000000023, 6) AS v FROM f UNION ALL SELECT n.tile_id, n.row_i, n.col_i, round(coalesce(i.v, n.v) + 0.000000023, 6) FROM n LEFT JOIN i USING (tile_id, row_i, col_i)"""


@query("hillshade", f"""WITH {_DEM}, d AS (SELECT *, (e-w)/(CASE WHEN col_i IN (c0, c1) THEN 1.0 ELSE 2.0 END)/20 AS dx, (s-n)/(CASE WHEN row_i IN (r0, r1) THEN 1.0 ELSE 2.0 END)/20 AS dy FROM h)
SELECT row_i, col_i, round(greatest(least(sin(radians(45))*cos(atan(sqrt(dx*dx+dy*dy))) + cos(radians(45))*sin(atan(sqrt(dx*dx+dy*dy)))*cos(radians(315) - atan2(dy, -dx)), 1), 0), 8) AS shade FROM d""")
def _(t):
    return rounded(R.hillshade(t.dem, 20.0).select("row_i", "col_i", "shade"), shade=8)


@query("slope_horn", f"""WITH {_DEM} SELECT row_i, col_i, round(degrees(atan(sqrt((((ne+2*e+se)-(nw+2*w+sw))/160)**2 + (((sw+2*s+se)-(nw+2*n+ne))/160)**2))), 7) AS slope FROM h""")
def _(t):
    return rounded(R.slope_horn(t.dem, 20.0, 20.0).select("row_i", "col_i", "slope"), slope=7)


@query("curvature", _CURVATURE)
def _(t):
    return rounded(R.curvature(t.dem, 20.0, 20.0).select("row_i", "col_i", (F.col("curv") + 0.0000000003).alias("curv")), curv=8)


@query("gaussian", """WITH x AS (SELECT min(row_i) AS r0, max(row_i) AS r1, min(col_i) AS c0, max(col_i) AS c1 FROM {dem}),
k AS (SELECT i, exp(-0.5*i*i)/sum(exp(-0.5*i*i)) OVER () AS w FROM (SELECT unnest(range(-4, 5)) AS i) q),
p AS (SELECT d.row_i, d.col_i, k.w, CASE WHEN d.col_i + i < c0 THEN 2*c0 - 1 - d.col_i - i WHEN d.col_i + i > c1 THEN 2*c1 + 1 - d.col_i - i ELSE d.col_i + i END AS cc FROM {dem} d, x, k),
a AS (SELECT p.row_i, p.col_i, sum(w*v) AS v FROM p JOIN {dem} s ON s.row_i = p.row_i AND s.col_i = p.cc GROUP BY 1, 2 HAVING count(*) = 9),
q AS (SELECT a.row_i, a.col_i, k.w, CASE WHEN a.row_i + i < r0 THEN 2*r0 - 1 - a.row_i - i WHEN a.row_i + i > r1 THEN 2*r1 + 1 - a.row_i - i ELSE a.row_i + i END AS rr FROM a, x, k)
SELECT q.row_i, q.col_i, round(sum(w*v), 8) AS v FROM q JOIN a s ON s.col_i = q.col_i AND s.row_i = q.rr GROUP BY 1, 2 HAVING count(*) = 9""")
def _(t):
    return rounded(R.gaussian(t.dem, 1.0).select("row_i", "col_i", "v"), v=8)


@query("local_extrema", """WITH x AS (SELECT min(row_i) AS r0, max(row_i) AS r1, min(col_i) AS c0, max(col_i) AS c1 FROM {dem})
SELECT a.row_i, a.col_i, bool_and(b.v <= a.v) AND a.row_i BETWEEN any_value(r0)+3 AND any_value(r1)-3 AND a.col_i BETWEEN any_value(c0)+3 AND any_value(c1)-3 AS is_peak,
bool_and(b.v >= a.v) AND a.row_i BETWEEN any_value(r0)+3 AND any_value(r1)-3 AND a.col_i BETWEEN any_value(c0)+3 AND any_value(c1)-3 AS is_pit
FROM {dem} a JOIN {dem} b ON abs(a.row_i - b.row_i) <= 3 AND abs(a.col_i - b.col_i) <= 3, x GROUP BY 1, 2""")
def _(t):
    return R.local_extrema(t.dem, 7).select("row_i", "col_i", "is_peak", "is_pit")


@query("spot_points")
def _(t):
    out = R.spot_points(t.dem, 20.0, win=3, sigma=0.5, min_dist=100.0, top_n=50, mask=S.with_ring(t.clips))
    return rounded(out.select("kind", "x", "y", "score"), score=6)


@query("isolines", """WITH q AS (SELECT a.row_i, a.col_i, a.v AS a, b.v AS b, c.v AS c, d.v AS d FROM {dem} a JOIN {dem} b ON b.row_i = a.row_i AND b.col_i = a.col_i + 1
  JOIN {dem} c ON c.row_i = a.row_i + 1 AND c.col_i = a.col_i + 1 JOIN {dem} d ON d.row_i = a.row_i + 1 AND d.col_i = a.col_i),
l AS (SELECT *, unnest(range(CAST(floor(least(a, b, c, d)/10) AS BIGINT) + 1, CAST(floor(greatest(a, b, c, d)/10) AS BIGINT) + 1)) AS k FROM q),
z AS (SELECT *, CAST(k*10 AS DOUBLE) AS z, (col_i + 0.5)*20 AS x0, (row_i + 0.5)*20 AS y0 FROM l),
p AS (SELECT k, z, (a >= z) = ((a + b + c + d)/4 >= z) AS same, CASE WHEN (a >= z) <> (b >= z) THEN {'x': x0 + (z-a)/(b-a)*20, 'y': y0} END AS p0, CASE WHEN (b >= z) <> (c >= z) THEN {'x': x0 + 20, 'y': y0 + (z-b)/(c-b)*20} END AS p1,
  CASE WHEN (d >= z) <> (c >= z) THEN {'x': x0 + (z-d)/(c-d)*20, 'y': y0 + 20} END AS p2, CASE WHEN (a >= z) <> (d >= z) THEN {'x': x0, 'y': y0 + (z-a)/(d-a)*20} END AS p3 FROM z),
h AS (SELECT *, list_filter([p0, p1, p2, p3], lambda x: x IS NOT NULL) AS h FROM p),
g AS (SELECT k, z, h[1] AS f, h[2] AS t FROM h WHERE len(h) = 2 UNION ALL SELECT k, z, p0, CASE WHEN same THEN p1 ELSE p3 END FROM h WHERE len(h) = 4
  UNION ALL SELECT k, z, CASE WHEN same THEN p2 ELSE p1 END, CASE WHEN same THEN p3 ELSE p2 END FROM h WHERE len(h) = 4)
SELECT z AS level, k % 5 = 0 AS master, count(*) AS segments, round(sum(sqrt((t.x-f.x)**2 + (t.y-f.y)**2)), 4) AS length FROM g WHERE f.x <> t.x OR f.y <> t.y GROUP BY ALL""")
def _(t):
    segs = R.isolines(t.dem, 10.0, 20.0)
    return segs.groupBy("level", "master").agg(F.count(F.lit(1)).alias("segments"), F.round(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))), 4).alias("length"))


@query("long_isolines")
def _(t):
    segs = R.isolines(t.dem, 50.0, 20.0)
    out = R.long_isolines(segs, 100.0, S.with_ring(t.clips), 100.0)
    return out.groupBy("level").agg(F.count(F.lit(1)).alias("segments"), F.round(F.max("line_length"), 4).alias("longest"))


@query("sample_along", """SELECT road_id, CAST(p AS INT) AS pos, round((p - 0.5)*1000/12, 6) AS x, y1 AS y FROM {roads}, (SELECT unnest(range(1, 13)) AS p) q""")
def _(t):
    line = F.array(G.xy(F.col("x1"), F.col("y1")), G.xy((F.col("x1") + F.col("x2")) / 3, F.col("y1")), G.xy(F.col("x2"), F.col("y2")))
    return rounded(R.sample_along(t.roads.withColumn("line", line)).select("road_id", "pos", "x", "y"), x=6)


@query("clip_raster", """WITH i AS (SELECT c.tile_id, c.band, c.row_i, c.col_i, CASE WHEN EXISTS (SELECT 1 FROM {clips} s WHERE (col_i+0.5)*25 BETWEEN minx AND maxx AND (row_i+0.5)*25 BETWEEN miny AND maxy) THEN v ELSE -1 END AS v,
EXISTS (SELECT 1 FROM {clips} s WHERE (col_i+0.5)*25 BETWEEN minx AND maxx AND (row_i+0.5)*25 BETWEEN miny AND maxy) AS ins FROM {band_cells} c),
b AS (SELECT min(row_i) AS r0, max(row_i) AS r1, min(col_i) AS c0, max(col_i) AS c1 FROM i WHERE ins)
SELECT tile_id, band, row_i, col_i, v, bool_and(v <> -1) OVER (PARTITION BY tile_id, row_i, col_i) AS mask FROM i, b WHERE band <= 3 AND row_i BETWEEN r0 AND r1 AND col_i BETWEEN c0 AND c1""")
def _(t):
    return R.clip_raster(t.band_cells, S.with_ring(t.clips), 25.0, -1.0, max_bands=3).select("tile_id", "band", "row_i", "col_i", "v", "mask")


@query("already_clipped", """SELECT tile_id, tile_id % 2 = 0 AS clipped FROM {band_cells} GROUP BY 1""")
def _(t):
    poly = S.with_ring(t.clips)
    x, y = (F.col("col_i") + 0.5) * 25 % 200, (F.col("row_i") + 0.5) * 25 % 200
    outside = ~(x.between(30, 150) & y.between(20, 160))
    cells = t.band_cells.withColumn("v", F.when(outside & (F.col("tile_id") % 2 == 0), -1.0).otherwise(F.col("v")))
    return R.already_clipped(cells, poly, 25.0, -1.0)


@query("tile_relation", """WITH c AS (SELECT CAST(row_i//2 AS BIGINT) AS tile_id, row_i, col_i, v FROM {dem}), i AS (SELECT *, EXISTS (SELECT 1 FROM {belts} s WHERE (col_i+0.5)*20 BETWEEN minx AND maxx AND (row_i+0.5)*20 BETWEEN miny AND maxy) AS ins FROM c)
SELECT tile_id, CASE WHEN NOT bool_or(ins) THEN 'outside' WHEN bool_and(ins) THEN 'inside' ELSE 'partial' END AS relation FROM i GROUP BY 1""")
def _(t):
    cells = t.dem.withColumn("tile_id", F.floor(F.col("row_i") / 2))
    return R.tile_relation(cells, S.with_ring(t.belts), 20.0, -9999.0)


@query("mosaic", """SELECT row_i, col_i, arg_min(v, tile_id) AS v, min(tile_id) AS tile_id FROM {band_cells} WHERE band = 1 AND v <> 0 GROUP BY 1, 2""")
def _(t):
    return R.mosaic(t.band_cells.filter("band = 1"), nodata=0.0)


@query("select_bands", """SELECT tile_id, CAST(CASE band WHEN 4 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS INT) AS band, row_i, col_i, v FROM {band_cells} WHERE band IN (4, 1, 2)""")
def _(t):
    return R.select_bands(t.band_cells, "RGBI", "CIR").select("tile_id", "band", "row_i", "col_i", "v")


@query("single_if_identical", """SELECT tile_id, band, row_i, col_i, v FROM (SELECT tile_id, unnest([1,2,3]) AS band, row_i, col_i, CAST(r AS DOUBLE) AS v, r FROM {pixels}) q WHERE tile_id % 2 = 1 OR band = 1""".replace("AS v, r FROM", "AS v FROM").replace("CAST(r AS DOUBLE) AS v", "CAST(CASE WHEN tile_id % 2 = 1 THEN r + unnest([1,2,3]) ELSE r END AS DOUBLE) AS v"))
def _(t):
    v = F.when(F.col("tile_id") % 2 == 1, F.col("r") + F.col("band")).otherwise(F.col("r")).cast("double")
    cells = t.pixels.withColumn("band", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).withColumn("v", v)
    return R.single_if_identical(cells).select("tile_id", "band", "row_i", "col_i", "v")


@query("rc_to_xy", """SELECT row_i, col_i, 1000 + col_i*0.5 AS x, 5000 - row_i*0.5 AS y, CAST(row_i AS BIGINT) AS row, CAST(col_i AS BIGINT) AS col FROM {dem}""")
def _(t):
    gt = (0.5, 0.0, 1000.0, 0.0, -0.5, 5000.0)
    p = t.dem.select("row_i", "col_i", R.rc_to_xy(F.col("row_i"), F.col("col_i"), gt).alias("p"))
    rc = R.xy_to_rc(F.col("p.x") + 0.1, F.col("p.y") - 0.1, gt)
    return p.select("row_i", "col_i", F.col("p.x").alias("x"), F.col("p.y").alias("y"), rc["row"].alias("row"), rc["col"].alias("col"))


@query("world_file", """SELECT CAST(l_id AS VARCHAR) AS path, 0.5 AS a, CAST(0 AS DOUBLE) AS b, minx AS c, CAST(0 AS DOUBLE) AS d, -0.5 AS e, maxy AS f, 6 AS lines FROM (SELECT lot_id AS l_id, minx, maxy FROM {lots}) q""".replace("0.5 AS a", "CAST(0.5 AS DOUBLE) AS a").replace("-CAST", "-CAST").replace("-0.5 AS e", "CAST(-0.5 AS DOUBLE) AS e"))
def _(t):
    gt = t.lots.select(F.col("lot_id").cast("string").alias("path"), F.lit(0.5).alias("a"), F.lit(0.0).alias("b"), F.col("minx").alias("c"), F.lit(0.0).alias("d"), F.lit(-0.5).alias("e"), F.col("maxy").alias("f"))
    lines = R.world_text(gt)
    back = R.world_file(lines.select("path", "line_no", F.col("value").cast("string").alias("value")))
    return back.join(lines.groupBy("path").agg(F.count(F.lit(1)).alias("lines")), "path")


@query("raster_tiles", """SELECT row_i, col_i, v FROM {dtm_cells} WHERE v <> -9999 AND row_i % 2 = 0 AND col_i % 2 = 0 AND row_i BETWEEN 10 AND 60 AND col_i BETWEEN 5 AND 77""")
def _(t):
    tiles = R.to_tiles(t.dtm_cells, 16).select(F.lit(0).alias("tile_id"), F.lit(1).alias("band"), (F.col("tr") * 16).cast("int").alias("row0"), (F.col("tc") * 16).cast("int").alias("col0"), "h", "w", F.lit(-9999.0).alias("nodata"), "data")
    return R.raster_cells(tiles, 2, (10, 5, 60, 77)).filter("v IS NOT NULL").select("row_i", "col_i", "v")


@query("sample_tiles", """SELECT pid, d.v FROM {points} p LEFT JOIN (SELECT * FROM {dtm_cells} WHERE v <> -9999) d ON d.row_i = floor(p.y/10) AND d.col_i = floor(p.x/10)""")
def _(t):
    from ..operators.vertical import sample_tiles
    tiles = R.to_tiles(t.dtm_cells, 16).withColumn("size", F.lit(10.0))
    return sample_tiles(t.points.select("pid", "x", "y"), tiles, "v", -9999.0).select("pid", "v")


@query("warp_nearest")
def _(t):
    shifted = t.dem.select("tile_id", (F.col("row_i") + 375000).alias("row_i"), (F.col("col_i") + 25000).alias("col_i"), "v")
    return R.warp_nearest(shifted, 20.0, 31982, 31983).select("tile_id", "row_i", "col_i", "v")


@query("align_grids", """WITH a AS (SELECT DISTINCT CAST(floor(x/25) AS BIGINT) AS col_i, CAST(floor(y/25) AS BIGINT) AS row_i FROM {points}), f AS (SELECT *, (col_i+0.5)*25/20-0.5 AS fx, (row_i+0.5)*25/20-0.5 AS fy FROM a),
k AS (SELECT row_i, col_i, floor(fx)+i AS c, floor(fy)+j AS r, (CASE i WHEN 1 THEN fx-floor(fx) ELSE 1-fx+floor(fx) END)*(CASE j WHEN 1 THEN fy-floor(fy) ELSE 1-fy+floor(fy) END) AS w FROM f, (SELECT unnest([0,1]) AS i) p, (SELECT unnest([0,1]) AS j) q)
SELECT k.row_i, k.col_i, CASE WHEN bool_and(d.v IS NOT NULL) THEN sum(w*round(d.v*100000)) END AS vb FROM k LEFT JOIN {dem} d ON d.row_i = k.r AND d.col_i = k.c WHERE w > 0 GROUP BY 1, 2""")
def _(t):
    a = t.points.select(F.lit(0).alias("tile_id"), F.floor(F.col("y") / 25).alias("row_i"), F.floor(F.col("x") / 25).alias("col_i")).distinct().withColumn("v", F.lit(0.0))
    # whole numbers times binary fractions: exact in any order of summing
    dem = t.dem.withColumn("v", F.round(F.col("v") * 100000))
    return R.align_grids(a, dem, 25.0, 20.0).select("row_i", "col_i", "vb")


@query("grid_surface", _SURFACE.replace("{tile}", "tile_id % 2").replace("{where}", "classification = 2").replace("{reach}", "6"))
def _(t):
    out = R.grid_surface(t.points.withColumn("tile_id", F.col("tile_id") % 2), 10.0, radius=25.0, surface="dtm")
    return rounded(out.withColumn("v", F.col("v") + 0.000000023), v=6)


@query("grid_surface_nearest", _SURFACE.replace("{tile}", "0").replace("{where}", "classification <> 7").replace("{reach}", "0"))
def _(t):
    out = R.grid_surface(t.points.withColumn("tile_id", F.lit(0)), 10.0, "nearest", surface="dsm")
    return rounded(out.withColumn("v", F.col("v") + 0.000000023), v=6)


@query("stretch_uint8", """WITH q AS (SELECT tile_id, band, quantile_cont(v, 0.02) AS a, quantile_cont(v, 0.98) AS b FROM {band_cells} GROUP BY 1, 2)
SELECT tile_id, band, row_i, col_i, CAST(floor(greatest(least((v-a)/(b-a), 1), 0)*255) AS INT) AS u8 FROM {band_cells} JOIN q USING (tile_id, band)""")
def _(t):
    return R.stretch_uint8(t.band_cells, keys=("tile_id", "band")).select("tile_id", "band", "row_i", "col_i", "u8")


@query("height_colors", """SELECT tile_id, row_i, col_i, CAST(floor(greatest(least(2*(r/255.0-0.5), 1), 0)*255) AS INT) AS cr, CAST(floor(greatest(least(2*(0.5-abs(r/255.0-0.5)), 1), 0)*255) AS INT) AS cg,
CAST(floor(greatest(least(2*(0.5-r/255.0), 1), 0)*255) AS INT) AS cb, CAST(floor(r*(0.35+0.65*(g/255.0))) AS INT) AS shaded FROM {pixels}""")
def _(t):
    h = R.height_colors(F.col("r"))
    s = R.shade_rgb(F.struct("r", "g", "b"), F.col("g") / 255.0)
    return t.pixels.select("tile_id", "row_i", "col_i", h["r"].alias("cr"), h["g"].alias("cg"), h["b"].alias("cb"), s["r"].alias("shaded"))


@query("sample_pixels", """SELECT tile_id, least(count(*), 200) AS n FROM (SELECT tile_id, row_i, col_i FROM {band_cells} WHERE v <> 0 GROUP BY ALL HAVING count(DISTINCT band) = 4) q GROUP BY 1""")
def _(t):
    return R.sample_pixels(t.band_cells, 200, 7, 4, 0.0).groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"))


# --- colour ------------------------------------------------------------------

_CH = "CASE band WHEN 1 THEN 'R' WHEN 2 THEN 'G' WHEN 3 THEN 'B' ELSE 'I' END"


def _samples(t, cond):
    ch = F.element_at(F.array(*[F.lit(c) for c in "RGBI"]), F.col("band"))
    return t.band_cells.filter(cond).select(ch.alias("channel"), "v", "tile_id", "row_i", "col_i", "band")


_FIT = f"""s AS (SELECT {_CH} AS channel, quantile_cont(v, 0.02) AS s0, quantile_cont(v, 0.98) AS s1, count(*) AS sn FROM {{band_cells}} WHERE tile_id = 0 GROUP BY 1),
r AS (SELECT {_CH} AS channel, quantile_cont(v*0.8+5, 0.02) AS r0, quantile_cont(v*0.8+5, 0.98) AS r1, count(*) AS rn FROM {{band_cells}} WHERE (tile_id = 1 AND band IN (1, 2)) OR (tile_id = 2 AND band = 4) GROUP BY 1),
f AS (SELECT channel, r.channel IS NOT NULL AS enabled, s0, s1, r0, r1, sn, rn, (r1-r0)/(s1-s0+1e-9) AS g FROM s LEFT JOIN r USING (channel)),
p AS (SELECT channel, r0 IS NOT NULL AS enabled, CASE WHEN r0 IS NULL THEN 1.0 ELSE greatest(least(g, 0.79), 0.5)*CASE channel WHEN 'I' THEN 1.1 ELSE 1 END END AS gain,
CASE WHEN r0 IS NULL THEN 0.0 ELSE CASE WHEN greatest(least(g, 0.79), 0.5) = g THEN r0 - g*s0 ELSE g*(s0+s1)/2 + (r0 - g*s0) - greatest(least(g, 0.79), 0.5)*(s0+s1)/2 END + CASE channel WHEN 'I' THEN 2 ELSE 0 END END AS offset_, sn, rn FROM f)"""


def _fit(t):
    ref = lambda cond: _samples(t, cond).withColumn("v", F.col("v") * 0.8 + 5)
    return Q.affine_from_percentiles(_samples(t, "tile_id = 0"), ref("tile_id = 1 AND band IN (1, 2)"), ref("tile_id = 2 AND band IN (3, 4)"), gain_min=0.5, gain_max=0.79, ir_gain=1.1, ir_shift=2.0)


@query("affine_from_percentiles", f"""WITH {_FIT} SELECT channel, enabled, round(gain, 7) AS gain, round(offset_, 6) AS offset_, sn AS source_samples, rn AS reference_samples FROM p""")
def _(t):
    out = _fit(t).withColumnRenamed("offset", "offset_").select("channel", "enabled", "gain", "offset_", "source_samples", "reference_samples")
    return rounded(out, gain=7, offset_=6)


@query("refine_params", f"""WITH {_FIT} SELECT channel, round(CASE WHEN enabled AND channel <> 'G' THEN 1.0 + 0.5*greatest(least(gain - 1.0, 0.1), -0.1) ELSE gain END, 7) AS gain, round(CASE WHEN enabled AND channel <> 'G' THEN 1.0 + 0.5*greatest(least(offset_ - 1.0, 3), -3) ELSE offset_ END, 6) AS offset_, enabled AND channel <> 'G' AS refined FROM p""")
def _(t):
    fit = _fit(t)
    base = fit.select("channel", (F.col("channel") != "G").alias("enabled"), F.lit(1.0).alias("gain"), F.lit(1.0).alias("offset"))
    out = Q.refine_params(fit, base, 0.1, 3.0, 0.5).select("channel", "gain", F.col("offset").alias("offset_"), "refined")
    return rounded(out, gain=7, offset_=6)


@query("apply_gain_offset", f"""WITH {_FIT} SELECT tile_id, band, row_i, col_i, CASE WHEN enabled AND v <> 0 THEN greatest(least(round_even(v*gain + offset_, 0), 255), 0) ELSE v END AS v FROM (SELECT *, {_CH} AS channel FROM {{band_cells}}) c LEFT JOIN p USING (channel)""")
def _(t):
    return Q.apply_gain_offset(_samples(t, "true"), _fit(t), nodata=0.0).select("tile_id", "band", "row_i", "col_i", "v")


_STEP = lambda v, e, s: f"(greatest(least(({v}-{e})/{s}, 1), 0)**2*(3-2*greatest(least(({v}-{e})/{s}, 1), 0)))"
_W = "*".join([_STEP("(2.0*g-r-b)", 20, 15.0), _STEP("(g/(r+1e-9))", 1.05, 0.1), _STEP("(g/(b+1e-9))", 1.05, 0.1), _STEP("((ir-r)/(ir+r+1e-9))", 0.05, 0.05)])


@query("selective_tuning", f"""SELECT tile_id, row_i, col_i, round({_W}, 8) AS w, round(g*(1+{_W}*0.06), 7) AS g FROM {{pixels}}""")
def _(t):
    return rounded(Q.selective_tuning(t.pixels).select("tile_id", "row_i", "col_i", "w", "g"), w=8, g=7)


_LIN = lambda c: f"(CASE WHEN {c}/255.0 > 0.04045 THEN (({c}/255.0+0.055)/1.055)**2.4 ELSE {c}/255.0/12.92 END)"
_LAB = f"""l AS (SELECT *, {_LIN('r')} AS rl, {_LIN('g')} AS gl, {_LIN('b')} AS bl FROM {{pixels}}), z AS (SELECT *, (0.412453*rl+0.357580*gl+0.180423*bl)/0.950456 AS xx, 0.212671*rl+0.715160*gl+0.072169*bl AS yy, (0.019334*rl+0.119193*gl+0.950227*bl)/1.088754 AS zz FROM l),
f AS (SELECT *, CASE WHEN xx > 0.008856 THEN cbrt(xx) ELSE 7.787*xx+16/116.0 END AS fx, CASE WHEN yy > 0.008856 THEN cbrt(yy) ELSE 7.787*yy+16/116.0 END AS fy, CASE WHEN zz > 0.008856 THEN cbrt(zz) ELSE 7.787*zz+16/116.0 END AS fz FROM z),
q AS (SELECT *, CASE WHEN yy > 0.008856 THEN 116*cbrt(yy)-16 ELSE 903.3*yy END*2.55 AS ll, 500*(fx-fy)+128 AS aa, 200*(fy-fz)+128 AS bb FROM f)"""


@query("lab_stats", f"""WITH {_LAB} SELECT tile_id, round(avg(ll), 5) AS mean_l, round(stddev_pop(ll), 5) AS std_l, round(avg(aa), 5) AS mean_a, round(stddev_pop(aa), 5) AS std_a, round(avg(bb), 5) AS mean_b, round(stddev_pop(bb), 5) AS std_b FROM q GROUP BY 1""")
def _(t):
    return rounded(Q.lab_stats(t.pixels), mean_l=5, std_l=5, mean_a=5, std_a=5, mean_b=5, std_b=5)


@query("lab_round_trip", """SELECT tile_id, row_i, col_i, CAST(r AS DOUBLE) AS r, CAST(g AS DOUBLE) AS g, CAST(b AS DOUBLE) AS b FROM {pixels}""")
def _(t):
    p = t.pixels.withColumn("q", C.rgb_to_lab(F.col("r"), F.col("g"), F.col("b")))
    back = C.lab_to_rgb(F.col("q.l"), F.col("q.a"), F.col("q.b"))
    return p.withColumn("n", back).select("tile_id", "row_i", "col_i", *[(F.round(F.col(f"n.{c}"), 0)).alias(c) for c in "rgb"])


@query("lab_transfer")
def _(t):
    st = Q.lab_stats(t.pixels)
    out = Q.lab_transfer(t.pixels, st, st.filter("tile_id = 1"))
    return rounded(out.select("tile_id", "row_i", "col_i", "r", "g", "b"), r=4, g=4, b=4)


@query("color_spaces", """WITH p AS (SELECT *, greatest(r,g,b) AS mx, least(r,g,b) AS mn, CAST(0.299 AS DOUBLE)*r+CAST(0.587 AS DOUBLE)*g+CAST(0.114 AS DOUBLE)*b AS y FROM {pixels}), q AS (SELECT *, CASE WHEN mx = mn THEN 0 WHEN mx = r THEN 60.0*(g-b)/(mx-mn) WHEN mx = g THEN 120+60.0*(b-r)/(mx-mn) ELSE 240+60.0*(r-g)/(mx-mn) END AS h FROM p),
u AS (SELECT *, round(CASE WHEN h < 0 THEN h+360 ELSE h END/2) AS hh FROM q)
SELECT tile_id, row_i, col_i, CAST(CASE WHEN hh >= 180 THEN hh-180 ELSE hh END AS DOUBLE) AS h, CASE WHEN mx = 0 THEN 0.0 ELSE round(CAST(255*(mx-mn) AS DOUBLE)/mx) END AS s, CAST(mx AS DOUBLE) AS v, round(y, 6) AS y, round(CAST(0.492 AS DOUBLE)*(b-y)+128, 6) AS u FROM u""")
def _(t):
    r, g, b = (F.col(c) for c in "rgb")
    hsv, yuv = C.rgb_to_hsv(r, g, b), C.rgb_to_yuv(r, g, b)
    out = t.pixels.select("tile_id", "row_i", "col_i", *[hsv[c].alias(c) for c in "hsv"], yuv["y"].alias("y"), yuv["u"].alias("u"))
    return rounded(out, y=6, u=6)


@query("tone_gamma", """SELECT tile_id, row_i, col_i, CAST(floor(least(greatest(r*1.2, g, b), 255)) AS INT) AS r_max FROM {pixels}""")
def _(t):
    # the largest component survives the HSV round trip exactly
    out = Q.tone(t.pixels, gains=(1.2, 1.0, 1.0))
    return out.select("tile_id", "row_i", "col_i", F.greatest("r", "g", "b").alias("r_max"))


@query("tone")
def _(t):
    out = Q.tone(t.pixels, brightness=5, contrast=10, temperature=7000, tint=-10, hue=12, saturation=20, value=-5, gamma=0.9, haze=10)
    return out.select("tile_id", "row_i", "col_i", "r", "g", "b")
