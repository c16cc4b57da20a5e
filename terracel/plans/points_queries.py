"""Point-cloud and vertical-correction queries."""

from pyspark.sql import functions as F

from ..core.lineage import cut
from ..operators import points as P
from ..operators import vertical as V
from .registry import query, rounded

_THIN = """
cells AS (SELECT *, CAST(floor(x/10) AS BIGINT) AS cx, CAST(floor(y/10) AS BIGINT) AS cy FROM {points} WHERE classification = 2),
med AS (SELECT tile_id, cx, cy, quantile_cont(z, 0.5) AS m FROM cells GROUP BY ALL),
thin AS (SELECT c.* FROM cells c JOIN med USING (tile_id, cx, cy)
  QUALIFY row_number() OVER (PARTITION BY tile_id, cx, cy ORDER BY abs(z - m), pid) = 1)"""

_CHAIN = f"""WITH {_THIN},
s AS (SELECT t.*, d.v AS ref FROM thin t LEFT JOIN (SELECT * FROM {{dtm_cells}} WHERE v <> -9999) d
  ON d.row_i = floor(t.y/10) AND d.col_i = floor(t.x/10)),
dz AS (SELECT *, ref - z AS dz FROM s WHERE ref IS NOT NULL),
m AS (SELECT point_source_id, quantile_cont(dz, 0.5) AS md FROM dz GROUP BY 1),
kept AS (SELECT dz.* FROM dz JOIN m USING (point_source_id) WHERE abs(dz) <= 2.5*abs(md))"""


def _chain(t):
    thin = P.thin_median(t.points, 10.0)
    sampled = V.sample_raster(thin, t.dtm_cells, 10.0, "ref", nodata=-9999.0)
    dz = cut(V.height_difference(sampled, "ref").filter("valid"))  # read for the medians and again for the clip
    return V.median_clip(dz, ["point_source_id"], 2.5)


@query("vertical_correction", f"""{_CHAIN}
SELECT point_source_id, count(*) AS n, round(avg(dz), 6) AS mean_dz, CAST(sum(CAST(abs(dz) AS DECIMAL(18, 6))) AS DOUBLE) AS sum_abs,
       min(pid) AS first_pid FROM kept GROUP BY 1""")
def _(t):
    out = _chain(t).groupBy("point_source_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("dz").alias("mean_dz"), F.sum(F.abs("dz").cast("decimal(18,6)")).cast("double").alias("sum_abs"),
        F.min("pid").alias("first_pid"))
    return rounded(out, mean_dz=6)


@query("ground_or_all", """SELECT tile_id, pid, classification FROM {points} p
WHERE classification = 2 OR tile_id NOT IN (SELECT tile_id FROM {points} WHERE classification = 2)""")
def _(t):
    return P.ground_or_all(t.points).select("tile_id", "pid", "classification")


@query("class_range", "SELECT pid, classification FROM {points} WHERE NOT (classification BETWEEN 7 AND 7) AND classification BETWEEN 2 AND 6")
def _(t):
    return P.class_range(P.class_range(t.points, 7, 7, exclude=True), 2, 6).select("pid", "classification")


@query("return_filter", """SELECT 'first' AS mode, count(*) AS n, sum(pid % 1000003) AS s FROM {points} WHERE return_number = 1
UNION ALL SELECT 'last', count(*), sum(pid % 1000003) FROM {points} WHERE return_number = number_of_returns
UNION ALL SELECT 'last_only', count(*), sum(pid % 1000003) FROM {points} WHERE return_number = number_of_returns OR number_of_returns = 1
UNION ALL SELECT 'all', count(*), sum(pid % 1000003) FROM {points}""".replace("sum(pid % 1000003)", "CAST(sum(pid % 1000003) AS BIGINT)"))
def _(t):
    out = None
    for mode in ("first", "last", "last_only", "all"):
        part = P.return_filter(t.points, mode).agg(
            F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n"), F.sum(F.col("pid") % 1000003).alias("s"))
        out = part if out is None else out.unionByName(part)
    return out


@query("map_labels", """SELECT pid, CAST(CASE classification WHEN 2 THEN 0 WHEN 6 THEN 1 WHEN 3 THEN 2 WHEN 5 THEN 2 ELSE -1 END AS INT) AS label
FROM {points} WHERE classification NOT IN (7, 13)""")
def _(t):
    return P.map_labels(t.points, {2: 0, 6: 1, 3: 2, 4: 2, 5: 2}, [7, 13]).select("pid", "label")


@query("assign_class", "SELECT pid, 2 AS classification FROM {points}")
def _(t):
    return P.assign_class(t.points, 2).select("pid", "classification")


@query("number_lines", """WITH f AS (SELECT pid, concat('strip_', CAST(point_source_id AS VARCHAR), '.laz') AS file FROM {points}),
n AS (SELECT file, row_number() OVER (ORDER BY file) + 99 AS line_no FROM (SELECT DISTINCT file FROM f) u)
SELECT f.file, CAST(n.line_no AS INT) AS point_source_id, count(*) AS n FROM f JOIN n USING (file) GROUP BY ALL""")
def _(t):
    files = t.points.withColumn("file", F.concat(F.lit("strip_"), F.col("point_source_id").cast("string"), F.lit(".laz")))
    return P.number_lines(files, "file", 100).groupBy("file", "point_source_id").agg(F.count(F.lit(1)).alias("n"))


@query("valid_values", "SELECT row_i, col_i, v FROM {dtm_cells} WHERE v <> -9999 AND isfinite(v)")
def _(t):
    return t.dtm_cells.filter(P.valid_value(F.col("v"), -9999.0)).select("row_i", "col_i", "v")


@query("median_clip_text", """WITH dz AS (SELECT cid, strip_id, dz FROM {control_points}),
m AS (SELECT strip_id, quantile_cont(dz, 0.5) AS md FROM dz GROUP BY 1)
SELECT cid, strip_id, abs(dz) AS dz FROM dz JOIN m USING (strip_id) WHERE abs(dz) <= 40*abs(md) AND dz <= 0 AND abs(dz) BETWEEN 0.05 AND 0.6""")
def _(t):
    c = t.control_points.select("cid", "strip_id", "x", "y", "dz")
    return V.median_clip(c, ["strip_id"], 40.0, drop_positive=True, absolute=True, abs_min=0.05, abs_max=0.6).select("cid", "strip_id", "dz")


@query("crop_window", """WITH c AS (SELECT tile_id, quantile_cont(x, 0.5) AS mx, quantile_cont(y, 0.5) AS my FROM {points} GROUP BY 1),
i AS (SELECT p.tile_id, pid, p.x BETWEEN mx - 48 AND mx + 48 AND p.y BETWEEN my - 48 AND my + 48 AS inside FROM {points} p JOIN c USING (tile_id)),
k AS (SELECT * FROM i QUALIFY inside OR NOT max(inside) OVER (PARTITION BY tile_id)),
r AS (SELECT tile_id, pid, row_number() OVER (PARTITION BY tile_id ORDER BY pid) AS rn FROM k)
SELECT tile_id, pid FROM r WHERE rn <= 25""")
def _(t):
    return P.crop_window(t.points, 96.0, 25).select("tile_id", "pid")


@query("assign_blocks", """WITH o AS (SELECT tile_id, min(x) AS x0, min(y) AS y0 FROM {points} GROUP BY 1)
SELECT tile_id, CAST(floor((x - x0)/128) AS BIGINT) AS bx, CAST(floor((y - y0)/128) AS BIGINT) AS by, count(*) AS n, min(pid) AS first_pid
FROM {points} JOIN o USING (tile_id) GROUP BY ALL""")
def _(t):
    return P.assign_blocks(t.points, 128.0).groupBy("tile_id", "bx", "by").agg(
        F.count(F.lit(1)).alias("n"), F.min("pid").alias("first_pid"))


@query("cap_per_block", """WITH o AS (SELECT tile_id, min(x) AS x0, min(y) AS y0 FROM {points} GROUP BY 1),
b AS (SELECT tile_id, pid, floor((x - x0)/128) AS b1, floor((y - y0)/128) AS b2 FROM {points} JOIN o USING (tile_id))
SELECT tile_id, pid FROM b QUALIFY row_number() OVER (PARTITION BY tile_id, b1, b2 ORDER BY pid) <= 5""")
def _(t):
    return P.cap_per_group(P.assign_blocks(t.points, 128.0), ["tile_id", "bx", "by"], 5).select("tile_id", "pid")


@query("tile_band_mean", """SELECT tile_id, band, round(avg(v), 6) AS mean FROM {band_cells} WHERE v <> 0 AND row_i % 2 = 0 AND col_i % 2 = 0 GROUP BY 1, 2""")
def _(t):
    from ..operators.raster import every_kth, tile_band_mean
    return rounded(tile_band_mean(every_kth(t.band_cells, 2), nodata=0.0), mean=6)


@query("drop_outlier_tiles", """WITH s AS (SELECT tile_id, classification AS channel, avg(intensity) AS mean FROM {points} GROUP BY 1, 2),
c AS (SELECT channel, avg(mean) AS mu, stddev_pop(mean) AS sd FROM s GROUP BY 1),
z AS (SELECT tile_id, sum(CASE WHEN sd > 0 THEN abs(mean - mu)/sd ELSE 0 END) AS score FROM s JOIN c USING (channel) GROUP BY 1),
k AS (SELECT *, score <= 0.9*(SELECT count(DISTINCT channel) FROM s) AS keep FROM z)
SELECT tile_id, round(score, 6) AS score FROM k WHERE keep OR (SELECT count(*) FILTER (keep) FROM k) < 3""")
def _(t):
    stats = t.points.groupBy("tile_id", F.col("classification").alias("channel")).agg(F.avg("intensity").alias("mean"))
    return rounded(P.drop_outlier_tiles(stats, 0.9), score=6)


@query("cell_lowest", """WITH o AS (SELECT tile_id, min(x) AS x0, min(y) AS y0 FROM {points} GROUP BY 1)
SELECT tile_id, pid, x, y, z FROM {points} JOIN o USING (tile_id)
QUALIFY row_number() OVER (PARTITION BY tile_id, floor((x - x0)/25), floor((y - y0)/25) ORDER BY z, pid) = 1""")
def _(t):
    return P.cell_lowest(t.points, 25.0).select("tile_id", "pid", "x", "y", "z")


@query("thin_median", f"WITH {_THIN} SELECT tile_id, cx, cy, pid, z FROM thin")
def _(t):
    return P.thin_median(t.points, 10.0).select("tile_id", "cx", "cy", "pid", "z")


@query("rasterize", """SELECT tile_id, CAST(floor(y/20) AS BIGINT) AS row_i, CAST(floor(x/20) AS BIGINT) AS col_i,
max(z) AS zmax, round(avg(intensity), 6) AS imean FROM {points} WHERE classification <> 7 GROUP BY 1, 2, 3""")
def _(t):
    z = P.rasterize(t.points, 20.0, "z", "max").withColumnRenamed("v", "zmax")
    i = P.rasterize(t.points, 20.0, "intensity", "mean").withColumnRenamed("v", "imean")
    return rounded(z.join(i, ["tile_id", "row_i", "col_i"]), imean=6)


@query("density_stats", """WITH e AS (SELECT tile_id, count(*) AS n, (max(x)-min(x))*(max(y)-min(y)) AS area FROM {points} GROUP BY 1)
SELECT tile_id, n, round(area, 4) AS area, round(n/area, 9) AS density, round(1/sqrt(n/area), 6) AS spacing,
round(greatest(least(sqrt(8/(n/area)), 2.0), 0.1), 6) AS resolution FROM e""")
def _(t):
    out = P.density_stats(t.points).select("tile_id", "n", "area", "density", "spacing", "resolution")
    return rounded(out, area=4, density=9, spacing=6, resolution=6)


@query("quadrant_density", """WITH e AS (SELECT tile_id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM {points} GROUP BY 1),
q AS (SELECT tile_id, 'Q1' AS quadrant, x0+(x1-x0)*0.25 AS cx, y1-(y1-y0)*0.25 AS cy FROM e
UNION ALL SELECT tile_id, 'Q2', x0+(x1-x0)*0.75, y1-(y1-y0)*0.25 FROM e
UNION ALL SELECT tile_id, 'Q3', x0+(x1-x0)*0.25, y0+(y1-y0)*0.25 FROM e
UNION ALL SELECT tile_id, 'Q4', x0+(x1-x0)*0.75, y0+(y1-y0)*0.25 FROM e)
SELECT q.tile_id, quadrant, round(count(p.pid)/2500.0*12.0, 2) AS density FROM q LEFT JOIN {points} p
ON p.tile_id = q.tile_id AND p.x BETWEEN cx-25 AND cx+25 AND p.y BETWEEN cy-25 AND cy+25 GROUP BY 1, 2""")
def _(t):
    return P.quadrant_density(t.points, geographic=False)


@query("voxelize", """WITH v AS (SELECT tile_id, floor(x/50) - min(floor(x/50)) OVER w AS vx, floor(y/50) - min(floor(y/50)) OVER w AS vy,
floor(z/50) - min(floor(z/50)) OVER w AS vz, CAST(round(z*100000) AS BIGINT) AS z5, intensity, classification FROM {points} WINDOW w AS (PARTITION BY tile_id)),
l AS (SELECT tile_id, vx, vy, vz, classification, count(*) AS n FROM v GROUP BY ALL),
m AS (SELECT tile_id, vx, vy, vz, classification FROM l QUALIFY row_number() OVER (PARTITION BY tile_id, vx, vy, vz ORDER BY n DESC, classification) = 1),
a AS (SELECT tile_id, vx, vy, vz, count(*) AS n, avg(z5) AS z5, avg(intensity) AS intensity FROM v GROUP BY ALL)
SELECT tile_id, CAST(vx AS INT) AS vx, CAST(vy AS INT) AS vy, CAST(vz AS INT) AS vz, n, z5, intensity, classification
FROM a JOIN m USING (tile_id, vx, vy, vz)""")
def _(t):
    pts = t.points.withColumn("z5", F.round(F.col("z") * 100000).cast("long"))
    return P.voxelize(pts, 50.0, ["z5", "intensity"], "classification")


@query("majority_smoothing", """WITH v AS (SELECT tile_id, pid, floor((x - min(x) OVER w)/50) AS vx, floor((y - min(y) OVER w)/50) AS vy,
floor((z - min(z) OVER w)/50) AS vz, classification FROM {points} WINDOW w AS (PARTITION BY tile_id)),
l AS (SELECT tile_id, vx, vy, vz, classification, count(*) AS n FROM v GROUP BY ALL),
m AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY tile_id, vx, vy, vz ORDER BY n DESC, classification) = 1)
SELECT pid, m.classification FROM v JOIN m USING (tile_id, vx, vy, vz)""")
def _(t):
    return P.smooth_labels(t.points, 50.0, "classification").select("pid", "classification")


@query("cell_geometry", """WITH s AS (SELECT tile_id, CAST(floor(x/40) AS BIGINT) AS cx, CAST(floor(y/40) AS BIGINT) AS cy, count(*) AS n,
var_samp(x) AS xx, var_samp(y) AS yy, var_samp(z) AS zz, covar_samp(x,y) AS xy, covar_samp(x,z) AS xz, covar_samp(y,z) AS yz
FROM {points} GROUP BY 1, 2, 3),
q AS (SELECT *, (xx+yy+zz)/3 AS q, sqrt(((xx-(xx+yy+zz)/3)**2 + (yy-(xx+yy+zz)/3)**2 + (zz-(xx+yy+zz)/3)**2 + 2*(xy*xy+xz*xz+yz*yz))/6) AS p FROM s WHERE n >= 6),
f AS (SELECT *, acos(greatest(-1, least(1, ((xx-q)*((yy-q)*(zz-q)-yz*yz) - xy*(xy*(zz-q)-yz*xz) + xz*(xy*yz-(yy-q)*xz))/(2*p*p*p))))/3 AS phi FROM q),
e AS (SELECT *, q + 2*p*cos(phi) AS e1, q + 2*p*cos(phi + 2*pi()/3) AS e3 FROM f),
g AS (SELECT *, 3*q - e1 - e3 AS e2 FROM e),
h AS (SELECT *, sqrt(greatest(0, least(1, (e3*e3 - e3*(xx+yy) + xx*yy - xy*xy)/((e3-e1)*(e3-e2))))) AS nz FROM g)
SELECT tile_id, cx, cy, n, round(nz, 5) AS normal_z, round(sqrt(greatest(e3,0)*(n-1)/n), 5) AS roughness, round(1-nz, 5) AS slope,
round((e2-e3)/e1, 5) AS planarity, round((e1-e2)/e1, 5) AS linearity FROM h
UNION ALL SELECT tile_id, cx, cy, n, 1.0, 0.0, 0.0, 0.0, 0.0 FROM s WHERE n < 6""")
def _(t):
    out = P.cell_geometry(t.points, 40.0, 6)
    return rounded(out, normal_z=5, roughness=5, slope=5, planarity=5, linearity=5)


@query("height_above_ground", """WITH o AS (SELECT *, floor((x - min(x) OVER w)/20) AS cx, floor((y - min(y) OVER w)/20) AS cy,
min(z) FILTER (classification = 2) OVER w AS tg, min(z) OVER w AS tz FROM {points} WINDOW w AS (PARTITION BY tile_id)),
g AS (SELECT tile_id, cx, cy, min(z) AS g FROM o WHERE classification = 2 GROUP BY ALL)
SELECT pid, round(greatest(z - coalesce(g, tg, tz), 0), 6) AS hag FROM o LEFT JOIN g USING (tile_id, cx, cy)""")
def _(t):
    return rounded(P.height_above_ground(t.points, 20.0).select("pid", "hag"), hag=6)


@query("normalise_features", """SELECT pid, round(z - min(z) OVER w, 6) AS z_rel, round(x - avg(x) OVER w, 6) AS x_c, round(y - avg(y) OVER w, 6) AS y_c,
round(least(intensity/40000.0, 1), 6) AS intensity_norm, round(return_number/3.0, 6) AS return_ratio, 0.375 AS n_returns_norm,
round((scan_angle + 90)/180, 6) AS angle_norm FROM {points} WINDOW w AS (PARTITION BY tile_id)""".replace("0.375", "CAST(0.375 AS DOUBLE)"))
def _(t):
    out = P.normalise_features(t.points, 40000.0).select(
        "pid", "z_rel", "x_c", "y_c", "intensity_norm", "return_ratio", "n_returns_norm", "angle_norm")
    return rounded(out, z_rel=6, x_c=6, y_c=6, intensity_norm=6, return_ratio=6, n_returns_norm=6, angle_norm=6)


@query("fill_unresolved", """WITH p AS (SELECT pid, tile_id, x, y, CASE WHEN pid % 10 < 8 THEN -1 ELSE classification END AS label FROM {points}),
c AS (SELECT *, floor((x - min(x) OVER w)/8) AS cx, floor((y - min(y) OVER w)/8) AS cy FROM p WINDOW w AS (PARTITION BY tile_id)),
s AS (SELECT tile_id, cx, cy, arg_max(label, pid) AS lab FROM c WHERE label >= 0 GROUP BY ALL),
o AS (SELECT DISTINCT tile_id, cx, cy FROM c WHERE label < 0),
f AS (SELECT o.tile_id, o.cx, o.cy, s.lab FROM o JOIN s ON o.tile_id = s.tile_id AND abs(s.cx - o.cx) <= 7 AND abs(s.cy - o.cy) <= 7
QUALIFY row_number() OVER (PARTITION BY o.tile_id, o.cx, o.cy ORDER BY greatest(abs(s.cx-o.cx), abs(s.cy-o.cy)), s.cx-o.cx, s.cy-o.cy) = 1)
SELECT pid, CAST(CASE WHEN label < 0 THEN coalesce(lab, label) ELSE label END AS INT) AS label FROM c LEFT JOIN f USING (tile_id, cx, cy)""")
def _(t):
    p = t.points.withColumn("label", F.when(F.col("pid") % 10 < 8, -1).otherwise(F.col("classification")))
    return P.fill_unresolved(p, "label", 8.0).select("pid", "label")


@query("height_rules", """WITH o AS (SELECT p.pid, p.pred AS label, q.z - min(q.z) OVER (PARTITION BY q.tile_id) AS hag FROM {predictions} p JOIN {points} q USING (pid))
SELECT pid, CAST(CASE WHEN l2 = 2 AND hag < 5 THEN 0 ELSE l2 END AS INT) AS label FROM (
SELECT *, CASE WHEN l1 = 0 AND hag > 60 THEN 2 ELSE l1 END AS l2 FROM (
SELECT *, CASE WHEN label = 1 AND hag < 20 THEN 2 ELSE label END AS l1 FROM o) a) b""")
def _(t):
    h = t.predictions.join(t.points.select("pid", "tile_id", "z"), "pid")
    low = h.groupBy("tile_id").agg(F.min("z").alias("z0"))
    h = h.join(low, "tile_id").withColumn("hag", F.col("z") - F.col("z0")).withColumnRenamed("pred", "label")
    return P.height_rules(h, "label", 20.0, 60.0, 5.0).select("pid", "label")


@query("file_metadata", """WITH e AS (SELECT tile_id, count(*) AS n, min(x) AS minx, max(x) AS maxx, min(y) AS miny, max(y) AS maxy, min(z) AS minz, max(z) AS maxz,
min(intensity) AS min_int, max(intensity) AS max_int, count(*)*34/1048576.0 AS mb FROM {points} GROUP BY 1)
SELECT tile_id, n, minx, maxx, miny, maxy, minz, maxz, min_int, max_int, round((maxx-minx)*(maxy-miny), 4) AS area,
round(n/((maxx-minx)*(maxy-miny)), 9) AS density, round(1/sqrt(n/((maxx-minx)*(maxy-miny))), 6) AS spacing, round(mb, 6) AS est_mb FROM e""")
def _(t):
    return rounded(P.file_metadata(t.points), area=4, density=9, spacing=6, est_mb=6)


@query("score_blocks", """WITH o AS (SELECT tile_id, pid, z, floor((x - min(x) OVER w)/250) AS b1, floor((y - min(y) OVER w)/250) AS b2 FROM {points} WINDOW w AS (PARTITION BY tile_id))
SELECT pid, CAST(CASE WHEN z > avg(z) OVER (PARTITION BY tile_id, b1, b2) THEN 1 ELSE 0 END AS INT) AS label FROM o""")
def _(t):
    def above_mean(pdf):
        pdf["label"] = (pdf["z"] > pdf["z"].mean()).astype("int32")
        return pdf[["pid", "label"]]
    blocks = P.assign_blocks(t.points, 250.0).select("tile_id", "bx", "by", "pid", "z")
    return P.score_blocks(blocks, above_mean, "pid long, label int")


@query("sample_raster", """SELECT pid, d.v FROM {points} p LEFT JOIN (SELECT * FROM {dtm_cells} WHERE v <> -9999) d
ON d.row_i = floor(p.y/10) AND d.col_i = floor(p.x/10)""")
def _(t):
    return V.sample_raster(t.points, t.dtm_cells, 10.0, "v", nodata=-9999.0).select("pid", "v")


@query("nearest_join", """WITH c AS (SELECT p.pid, q.cid, sqrt((p.x-q.x)*(p.x-q.x) + (p.y-q.y)*(p.y-q.y)) AS d FROM
(SELECT *, floor(x/3) AS cx, floor(y/3) AS cy FROM {points}) p
JOIN (SELECT q.*, floor(x/3) + i AS cx, floor(y/3) + j AS cy FROM {control_points} q, (VALUES (-1),(0),(1)) a(i), (VALUES (-1),(0),(1)) b(j)) q
ON p.cx = q.cx AND p.cy = q.cy)
SELECT pid, cid, round(d, 6) AS dist FROM c WHERE d <= 3 QUALIFY row_number() OVER (PARTITION BY pid ORDER BY round(d, 9), cid) = 1""")
def _(t):
    # distances that are equal up to rounding tie on the id in both engines
    return rounded(V.nearest_join(t.points, t.control_points, 3.0), dist=6)


@query("idw_join", """WITH t AS (SELECT DISTINCT CAST(floor(x/10) AS BIGINT) AS col_i, CAST(floor(y/10) AS BIGINT) AS row_i FROM {points}),
c AS (SELECT t.*, q.cid, q.dz, round(sqrt((q.x - 10*col_i - 5)**2 + (q.y - 10*row_i - 5)**2), 9) AS d FROM t JOIN
(SELECT q.*, floor(x/10) + i AS ci, floor(y/10) + j AS cj FROM {control_points} q, (VALUES (-1),(0),(1)) a(i), (VALUES (-1),(0),(1)) b(j)) q ON q.ci = col_i AND q.cj = row_i),
k AS (SELECT * FROM c WHERE d <= 8 QUALIFY row_number() OVER (PARTITION BY col_i, row_i ORDER BY d, cid) <= 4)
SELECT row_i, col_i, count(*) AS n, round(CASE WHEN min(d) = 0 THEN arg_min(dz, CASE WHEN d = 0 THEN cid END) ELSE sum(dz/(d*d))/sum(1/(d*d)) END, 6) AS v
FROM k GROUP BY ALL HAVING count(*) >= 2""".replace("sum(dz/(d*d))/sum(1/(d*d))", "sum(dz/nullif(d*d,0))/sum(1/nullif(d*d,0))"))
def _(t):
    cells = t.points.select(F.floor(F.col("x") / 10).alias("c"), F.floor(F.col("y") / 10).alias("r")).distinct()
    targets = cells.withColumn("t", F.struct("r", "c")).withColumn("tx", F.col("c") * 10.0 + 5).withColumn("ty", F.col("r") * 10.0 + 5)
    out = V.idw_join(targets, t.control_points, "t", radius=8.0, max_points=4, min_points=2)
    return rounded(out.select(F.col("t.r").alias("row_i"), F.col("t.c").alias("col_i"), "n", "v"), v=6)


@query("control_surface", """WITH t AS (SELECT DISTINCT CAST(floor(x/10) AS BIGINT) AS col_i, CAST(floor(y/10) AS BIGINT) AS row_i FROM {points}),
c AS (SELECT t.*, q.cid, q.dz, round(sqrt((q.x - 10*col_i - 5)**2 + (q.y - 10*row_i - 5)**2), 9) AS d FROM t JOIN
(SELECT q.*, floor(x/10) + i AS ci, floor(y/10) + j AS cj FROM {control_points} q, (VALUES (-1),(0),(1)) a(i), (VALUES (-1),(0),(1)) b(j)) q ON q.ci = col_i AND q.cj = row_i),
k AS (SELECT * FROM c WHERE d <= 8 QUALIFY row_number() OVER (PARTITION BY col_i, row_i ORDER BY d, cid) <= 4),
s AS (SELECT row_i, col_i, CASE WHEN min(d) = 0 THEN arg_min(dz, CASE WHEN d = 0 THEN cid END) ELSE sum(dz/nullif(d*d, 0))/sum(1/nullif(d*d, 0)) END AS v FROM k GROUP BY ALL)
SELECT point_source_id, count(v) AS n_corrected, round(avg(z + coalesce(v, 0)), 6) AS mean_z FROM {points} p LEFT JOIN s ON s.row_i = floor(p.y/10) AND s.col_i = floor(p.x/10) GROUP BY 1""")
def _(t):
    out = V.control_surface(t.points, t.control_points, 10.0, radius=8.0, max_points=4)
    return V.apply_dz(out).groupBy("point_source_id").agg(
        F.count("dz").alias("n_corrected"), F.round(F.avg("z_corr"), 6).alias("mean_z"))


@query("robust_plane")
def _(t):
    out = V.robust_plane(t.control_points)
    return rounded(out, x0=4, y0=4, a=6, b=9, c=9, rmse=6)


@query("apply_plane")
def _(t):
    planes = V.robust_plane(t.control_points).withColumnRenamed("strip_id", "point_source_id")
    return V.apply_plane(t.points, planes, ["point_source_id"], 0.5).groupBy("point_source_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("z_corr"), 6).alias("mean_z"))


@query("nn_metrics", """WITH r AS (SELECT *, floor(x/40) AS cx, floor(y/40) AS cy FROM {control_points} WHERE strip_id < 10),
g AS (SELECT q.*, floor(x/40) + i AS cx, floor(y/40) + j AS cy FROM {control_points} q, (VALUES (-1),(0),(1)) a(i), (VALUES (-1),(0),(1)) b(j) WHERE strip_id >= 10),
n AS (SELECT r.cid, g.dz - r.dz AS e, sqrt((r.x-g.x)**2 + (r.y-g.y)**2) AS d FROM r JOIN g USING (cx, cy)
QUALIFY row_number() OVER (PARTITION BY r.cid ORDER BY round(sqrt((r.x-g.x)**2 + (r.y-g.y)**2), 9), g.cid) = 1),
m AS (SELECT * FROM n WHERE d <= 5)
SELECT (SELECT count(*) FROM {control_points} WHERE strip_id < 10) AS n_ref, (SELECT count(*) FROM {control_points} WHERE strip_id >= 10) AS n_gen,
count(*) AS matched, round(avg(e), 6) AS mean, round(quantile_cont(e, 0.5), 6) AS median, round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e*e)), 6) AS rmse,
round(quantile_cont(abs(e), 0.95), 6) AS p95_abs, (SELECT round(quantile_cont(d, 0.5), 6) FROM n) AS dist_median, (SELECT round(quantile_cont(d, 0.95), 6) FROM n) AS dist_p95 FROM m""")
def _(t):
    c = t.control_points
    out = V.nn_metrics(c.filter("strip_id < 10"), c.filter("strip_id >= 10").withColumnRenamed("cid", "gid"), 5.0, "cid", "gid")
    return rounded(out, mean=6, median=6, mae=6, rmse=6, p95_abs=6, dist_median=6, dist_p95=6)


@query("parameter_sweep", """WITH g AS (SELECT * FROM (VALUES (10.0, 2.5, 1), (10.0, 4.0, 2), (25.0, 2.5, 3), (25.0, 4.0, 4)) v(cell, factor, run_id)),
p AS (SELECT run_id, cell, factor, pid, z, point_source_id, floor(x/cell) AS cx, floor(y/cell) AS cy, tile_id FROM {points}, g WHERE classification = 2),
m AS (SELECT run_id, tile_id, cx, cy, quantile_cont(z, 0.5) AS m FROM p GROUP BY ALL),
t AS (SELECT p.* FROM p JOIN m USING (run_id, tile_id, cx, cy) QUALIFY row_number() OVER (PARTITION BY run_id, tile_id, cx, cy ORDER BY abs(z - m), pid) = 1),
k AS (SELECT run_id, point_source_id, quantile_cont(z, 0.5) AS md FROM t GROUP BY 1, 2)
SELECT run_id, CAST(cell AS DOUBLE) AS cell, CAST(factor AS DOUBLE) AS factor, count(*) AS n, round(avg(z), 6) AS mae
FROM t JOIN k USING (run_id, point_source_id) WHERE abs(z) <= factor*abs(md)/2 GROUP BY ALL ORDER BY mae, run_id LIMIT 3""")
def _(t):
    def run(cell, factor):
        thin = cut(P.thin_median(t.points, cell).withColumn("dz", F.col("z")))
        kept = V.median_clip(thin, ["point_source_id"], factor / 2)
        return kept.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("dz"), 6).alias("mae"))
    report = V.sweep(t.spark, run, {"cell": [10.0, 25.0], "factor": [2.5, 4.0]}, 4)
    return V.top_runs(report, 3).select("run_id", "cell", "factor", "n", "mae")


@query("match_strip_control", """SELECT o_orderkey, '/c/strip_' || o_orderkey || '_endz.txt' AS control_path FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 3 <> 0""")
def _(t):
    k = F.col("o_orderkey").cast("string")
    strips = t.orders.select("o_orderkey", F.concat(F.lit("/s/strip_"), k, F.lit(".laz")).alias("path"))
    control = t.orders.filter("o_orderkey % 3 = 0").select(F.concat(F.lit("/c/strip_"), k, F.lit("_endz.txt")).alias("path"))
    hit, missing = V.match_strip_control(strips, control, "_endz")
    return hit.select("o_orderkey", "control_path").unionByName(missing.select("o_orderkey", F.lit(None).cast("string").alias("control_path")))
