"""File-catalog and flight queries."""

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import files as O
from ..operators import flight as L
from .registry import query, rounded

_PB = """p AS (SELECT file_id, stem, length, path, 'LOTE_' || regexp_extract(path, '/LOTE_([^/]*)/', 1) AS lote, 'BLOCO_' || regexp_extract(path, '/BLOCO_([A-Z])/', 1) AS bloco FROM {file_paths})"""


def _placed(t):
    lb = X.lote_bloco_of_path(F.col("path"))
    return t.file_paths.withColumn("lote", lb["lote"]).withColumn("bloco", lb["bloco"])


@query("filter_files", """SELECT file_id, path FROM {file_paths} WHERE (path LIKE '%.las' OR path LIKE '%.laz') AND path NOT LIKE '%/BLOCO_C/%'""")
def _(t):
    return O.filter_files(t.file_paths, ["las", "laz"], ["bloco_c"], ["thumbs.db"]).select("file_id", "path")


@query("date_folders", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderdate IN (DATE '1997-05-28', DATE '1998-10-03', DATE '1999-01-01')""")
def _(t):
    d = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "notes").otherwise(
        F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_VOO"))).alias("folder"))
    return O.date_folders(d, "folder", ["1997-05-28", "1998-10-03", "1999-01-01"]).select("o_orderkey", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("flight_dates", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def _(t):
    d = t.orders.select(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_VOO")).alias("folder"))
    return O.date_folders(d).select(F.date_format("day", "yyyy-MM-dd").alias("day")).distinct()


@query("match_ids", r"""WITH r AS (SELECT file_id, unnest(list_distinct(regexp_extract_all(stem, '\d+'))) AS id FROM {product_files})
SELECT file_id, id AS matched_id FROM r WHERE id IN (SELECT CAST(2800 + p_size AS VARCHAR) FROM part)""")
def _(t):
    ids = t.part.select((F.lit(2800) + F.col("p_size")).alias("id"))
    return O.match_ids(t.product_files.select("file_id", "stem"), ids, "stem", "id").select("file_id", "matched_id")


@query("match_ids_loose", r"""WITH i AS (SELECT DISTINCT CAST(80 + p_size AS VARCHAR) AS id FROM part)
SELECT DISTINCT file_id, id AS matched_id FROM {product_files} JOIN i ON contains(stem, id)""")
def _(t):
    ids = t.part.select((F.lit(80) + F.col("p_size")).alias("id"))
    return O.match_ids(t.product_files.select("file_id", "stem"), ids, "stem", "id", strict=False).select("file_id", "matched_id")


@query("check_paths", """SELECT file_id FROM {file_paths} WHERE NOT (file_id % 3 = 0 AND path LIKE '%.tif') """)
def _(t):
    p = F.regexp_replace(F.regexp_replace("path", "^/data/MDS", "/data/6_MDS"), "(/BLOCO_.)/", "$1/1_GEOTIFF/")
    return O.check_paths(t.file_paths.withColumn("path", p), "/data").select("file_id")


@query("folder_sizes", r"""WITH f AS (SELECT *, string_split(regexp_replace(path, '/[^/]*$', ''), '/') AS w FROM {file_paths}),
e AS (SELECT *, array_to_string(w[1:n], '/') AS folder FROM (SELECT *, unnest(range(2, len(w)+1)) AS n FROM f) q)
SELECT folder, CAST(sum(length) AS BIGINT) AS bytes, count(*) AS n_files, count(*) FILTER (path LIKE '%.la_') AS n_points, count(*) FILTER (path LIKE '%.tif') AS n_rasters FROM e GROUP BY 1""")
def _(t):
    return O.folder_sizes(t.file_paths)


@query("folder_alerts", r"""WITH f AS (SELECT length*100 AS length, regexp_replace(path, 'BLOCO_B', 'temp') AS path FROM {file_paths}),
g AS (SELECT *, string_split(regexp_replace(path, '/[^/]*$', ''), '/') AS w FROM f),
e AS (SELECT *, array_to_string(w[1:n], '/') AS folder FROM (SELECT *, unnest(range(2, len(w)+1)) AS n FROM g) q),
s AS (SELECT folder, CAST(sum(length) AS BIGINT) AS bytes, max(CASE WHEN regexp_replace(path, '/[^/]*$', '') = folder AND path LIKE '%.la_' THEN 1 ELSE 0 END) AS pts FROM e WHERE len(string_split(folder, '/')) >= 4 GROUP BY 1)
SELECT folder, string_split(folder, '/')[3] AS project, array_to_string(list_filter([CASE WHEN pts = 1 THEN 'contém LAS/LAZ' END, CASE WHEN folder LIKE '%/temp' THEN 'palavra-chave: temp' END], lambda v: v IS NOT NULL), ', ') AS alert, bytes FROM s
WHERE NOT pts = 1 AND folder NOT LIKE '%/temp' OR bytes >= 1048576""")
def _(t):
    f = t.file_paths.select((F.col("length") * 100).alias("length"), F.regexp_replace("path", "BLOCO_B", "temp").alias("path"))
    return O.folder_alerts(f, "/data").select("folder", "project", "alert", "bytes")


@query("folder_name_overlap", r"""WITH s AS (SELECT DISTINCT 'MDS' AS project, '/data/MDS/F' || CAST(file_id % 7 AS VARCHAR) AS folder, lower(stem) AS stem FROM {file_paths} WHERE path LIKE '%.la_'
UNION SELECT DISTINCT 'MDS', '/data/MDS/G' || CAST(file_id % 3 AS VARCHAR), lower(stem) FROM {file_paths} WHERE path LIKE '%.la_')
SELECT a.project, a.folder AS folder_a, b.folder AS folder_b, count(*) AS shared FROM s a JOIN s b ON a.project = b.project AND a.stem = b.stem AND a.folder < b.folder GROUP BY ALL""")
def _(t):
    las = t.file_paths.filter(F.col("path").endswith(".las") | F.col("path").endswith(".laz"))
    name = F.concat(F.lit("/"), "stem", F.lit(".las"))
    a = las.select(F.concat(F.lit("/data/MDS/F"), (F.col("file_id") % 7).cast("string"), name).alias("path"))
    b = las.select(F.concat(F.lit("/data/MDS/G"), (F.col("file_id") % 3).cast("string"), name).alias("path"))
    return O.folder_name_overlap(a.unionByName(b), "/data")


@query("count_check", f"""WITH {_PB}, e(lote, bloco, expected) AS (VALUES {", ".join(f"('{a}', '{b}', {n})" for (a, b), n in O.EXPECTED_SHEETS.items())}),
c AS (SELECT lote, bloco, count(*) AS n FROM p GROUP BY 1, 2)
SELECT lote, bloco, expected, coalesce(n, 0) AS actual, coalesce(n, 0) - expected AS delta FROM e LEFT JOIN c USING (lote, bloco)""")
def _(t):
    return O.count_check(_placed(t), O.expected_sheets(t.spark), ["lote", "bloco"])


@query("dataset_check", f"""WITH {_PB}, g AS (SELECT DISTINCT lote, bloco FROM p), d AS (SELECT lote, bloco, count(*) AS n, min(stem || '.lasd') AS name FROM p WHERE file_id % 37 = 0 GROUP BY 1, 2)
SELECT lote, bloco, coalesce(n, 0) AS n, CASE WHEN coalesce(n, 0) <> 1 THEN 'count' WHEN name <> 'ES_L' || substr(lote, 6) || '_' || substr(bloco, 7) || '_NPc_C_R0.lasd' THEN 'name' ELSE 'ok' END AS status FROM g LEFT JOIN d USING (lote, bloco)""")
def _(t):
    p = _placed(t)
    sets = p.filter(F.col("file_id") % 37 == 0).withColumn("path", F.concat(F.lit("/x/"), "stem", F.lit(".lasd")))
    return O.dataset_check(sets, p.select("lote", "bloco").distinct()).select("lote", "bloco", "n", "status")


@query("status_summary", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return O.status_summary(t.orders.withColumnRenamed("o_orderstatus", "status"))


_K = r"lower(replace(regexp_replace(regexp_extract(stem, '(\d\d\d\d.*)', 1), '[-_]R\d+$', '', 'i'), '_', '-'))"


@query("missing_names", f"""WITH a AS (SELECT {_K} AS key, min(stem) AS name FROM {{product_files}} WHERE file_id % 3 = 0 GROUP BY 1), b AS (SELECT {_K} AS key, min(stem) AS name FROM {{product_files}} WHERE file_id % 3 <> 0 GROUP BY 1)
SELECT 'a' AS side, key, name FROM a WHERE key NOT IN (SELECT key FROM b) UNION ALL SELECT 'b', key, name FROM b WHERE key NOT IN (SELECT key FROM a)""")
def _(t):
    f = t.product_files
    return O.missing_names(f.filter("file_id % 3 = 0"), f.filter("file_id % 3 <> 0"), "stem", "both")


@query("missing_captures", """SELECT CAST(o_custkey AS VARCHAR) AS id FROM orders EXCEPT SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 3 = 0""")
def _(t):
    caps = t.orders.select(X.capture_number(F.concat(F.lit("cap-"), F.col("o_custkey").cast("string"))).alias("id")).distinct()
    have = t.customer.filter("c_custkey % 3 = 0").select(X.strip_number(F.concat(F.lit("FT"), F.col("c_custkey").cast("string"))).alias("id"))
    return caps.join(have, "id", "left_anti")


@query("match_by_sheet", r"""WITH s AS (SELECT file_id, stem, path, regexp_replace(regexp_extract(stem, '(\d\d\d\d[_-]\d[_-](?:SE|SO|NE|NO)[_-][A-Z][_-](?:I|II|III|IV|V))(?:[_-]R\d+)?$', 1), '[^A-Z0-9]+', '', 'g') AS sheet,
regexp_extract(path, '/(LOTE_[^/]*)/', 1) AS lote, regexp_extract(path, '/(BLOCO_[A-Z])/', 1) AS bloco, regexp_replace(upper(path), '[^A-Z0-9]+', '', 'g') AS txt FROM {file_paths}),
a AS (SELECT * FROM s WHERE path LIKE '%.tif'), l AS (SELECT * FROM s WHERE path LIKE '%.la_')
SELECT a.file_id, l.path AS las_path FROM a LEFT JOIN l ON a.sheet = l.sheet AND a.sheet <> ''
QUALIFY row_number() OVER (PARTITION BY a.file_id ORDER BY CASE WHEN contains(l.txt, replace(a.lote, '_', '')) THEN 20 ELSE 0 END + CASE WHEN contains(l.txt, replace(a.bloco, '_', '')) THEN 20 ELSE 0 END DESC, l.path DESC) = 1""")
def _(t):
    p = _placed(t)
    return O.match_by_sheet(p.filter(F.col("path").endswith(".tif")), O.filter_files(p, ["las", "laz"])).select("file_id", "las_path")


@query("find_sidecar", """SELECT file_id, path, CASE file_id % 3 WHEN 0 THEN regexp_replace(path, '[.]tif$', '.tfw') WHEN 1 THEN regexp_replace(path, '[.]tif$', '0.tfw') END AS side_path FROM {file_paths} WHERE path LIKE '%.tif'""")
def _(t):
    img = t.file_paths.filter(F.col("path").endswith(".tif")).select("file_id", "path")
    base = F.regexp_replace("path", "[.]tif$", "")
    side = img.select(F.when(F.col("file_id") % 3 == 0, F.concat(base, F.lit(".tfw"))).when(F.col("file_id") % 3 == 1, F.concat(base, F.lit("0.tfw"))).alias("path"))
    more = img.filter("file_id % 3 = 0").select(F.concat(base, F.lit(".wld")).alias("path"))
    return O.find_sidecar(img, side.filter("path IS NOT NULL").unionByName(more)).select("file_id", "path", "side_path")


@query("route_by_membership", """SELECT f.file_id, CASE WHEN n.n_nationkey IS NULL THEN 'other' WHEN n.n_regionkey < 2 THEN 'small' ELSE 'main' END AS route FROM {product_files} f LEFT JOIN nation n ON n.n_nationkey = f.file_id % 40""")
def _(t):
    listed = t.nation.select("n_nationkey", F.col("n_regionkey").cast("double").alias("area"))
    f = t.product_files.withColumn("path", F.col("stem"))
    return O.route_by_membership(f, listed, (F.col("file_id") % 40).cast("int"), "n_nationkey", 2.0).select("file_id", "route")


@query("first_of", "SELECT l_partkey % 100 AS k, arg_min(l_extendedprice, l_orderkey*100000000000 + l_partkey*1000000 + l_suppkey*10 + l_linenumber) AS price FROM lineitem GROUP BY 1")
def _(t):
    rows = t.lineitem.select((F.col("l_partkey") % 100).alias("k"), F.col("l_extendedprice").alias("price"),
                             (F.col("l_orderkey") * 100000000000 + F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return O.first_of(rows, ["k"], "seq").select("k", "price")


@query("reference_pool", """SELECT stem AS path, CAST(min(CASE WHEN file_id % 2 = 0 THEN 0 ELSE 1 END) AS INT) AS source, arg_min(file_id, CASE WHEN file_id % 2 = 0 THEN 0 ELSE 1000000 END + file_id) AS seq FROM {product_files} GROUP BY 1""")
def _(t):
    f = t.product_files.select(F.col("stem").alias("path"), F.col("file_id").alias("seq"))
    return O.reference_pool(f.filter("seq % 2 = 0"), f.filter("seq % 2 = 1"))


@query("name_set_operations", """SELECT 'both' AS kind, n FROM (SELECT l_partkey % 500 AS n FROM lineitem INTERSECT SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) a
UNION ALL SELECT 'only_left', n FROM (SELECT l_partkey % 500 AS n FROM lineitem EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) b""")
def _(t):
    a, b = t.lineitem.select((F.col("l_partkey") % 500).alias("n")), t.customer.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("n"))
    return a.intersect(b).select(F.lit("both").alias("kind"), "n").unionByName(a.subtract(b).select(F.lit("only_left").alias("kind"), "n"))


@query("attach_registry", """SELECT s.strip_no, c.c_name, c.c_mktsegment FROM {strips} s LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) c ON c.c_custkey = s.strip_no % 3000""")
def _(t):
    from ..operators.cadastre import attach_registry
    reg = t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("key"), "c_name", "c_mktsegment")
    s = t.strips.withColumn("key", F.col("strip_no") % 3000)
    return attach_registry(s, reg, "key", "strip_no").select("strip_no", "c_name", "c_mktsegment")


# --- flight ------------------------------------------------------------------

@query("plan_columns", """SELECT road_id AS line, CAST(y1 AS DOUBLE) AS start_lat, CAST(x1 AS DOUBLE) AS start_lon, CAST(y2 AS DOUBLE) AS end_lat, CAST(x2 AS DOUBLE) AS end_lon, (x2 - x1)/1000 AS length_km FROM {roads}""")
def _(t):
    pair = lambda a, b: F.concat_ws("  ", F.col(a).cast("string"), F.col(b).cast("string"))
    return L.plan_columns(t.roads.select(F.col("road_id").alias("line"), pair("y1", "x1").alias("first_event"), pair("y2", "x2").alias("last_event"), (F.col("x2") - F.col("x1")).alias("length_m")))


@query("strip_report", """SELECT strip_no, strftime(TIMESTAMP '1980-01-06' + to_seconds(CAST(gps_week*604800 + gps_stop AS BIGINT)), '%Y-%m-%dT%H:%M:%S') AS stop_text, round(altitude_m*3.28084, 1) AS altitude_ft, round(speed_ms*1.94384, 1) AS speed_kn FROM {strips}""")
def _(t):
    return L.strip_report(t.strips).select("strip_no", "stop_text", "altitude_ft", "speed_kn")


@query("nearest_line", """WITH c AS (SELECT pid, road_id, abs(y - y1) AS d FROM {points} JOIN {roads} ON y1 BETWEEN y - 6 AND y + 6 WHERE abs(y - y1) <= 5)
SELECT pid, road_id, round(d, 6) AS dist FROM c QUALIFY row_number() OVER (PARTITION BY pid ORDER BY round(d, 9), road_id) = 1""")
def _(t):
    # the distance is rounded before ties are broken so that both engines agree on equal ones
    return rounded(L.nearest_line(t.points.select("pid", "x", F.round("y", 2).alias("y")), t.roads, 5.0, "pid", "road_id"), dist=6)


@query("crew_for_day", """WITH s AS (SELECT strip_no, strip_no % 900 AS day FROM {strips}), l AS (SELECT c_custkey % 700 AS day, arg_min(c_name, c_custkey) AS pilot, arg_min(c_mktsegment, c_custkey) AS operator FROM customer GROUP BY 1)
SELECT strip_no, coalesce(pilot, '') AS pilot, coalesce(operator, '') AS operator FROM s LEFT JOIN l USING (day)""")
def _(t):
    log = t.customer.select((F.col("c_custkey") % 700).alias("day"), F.col("c_name").alias("pilot"), F.col("c_mktsegment").alias("operator"), F.lit("").alias("note"), F.col("c_custkey").alias("seq"))
    return L.crew_for_day(t.strips.withColumn("day", F.col("strip_no") % 900), log).select("strip_no", "pilot", "operator")


@query("agl_profile", """WITH s AS (SELECT road_id, i, x1 + i/99.0*(x2-x1) AS x, y1 AS y FROM {roads}, (SELECT unnest(range(100)) AS i) r),
e AS (SELECT s.*, d.v FROM s LEFT JOIN (SELECT * FROM {dtm_cells} WHERE v <> -9999) d ON d.row_i = floor(y/10) AND d.col_i = floor(x/10))
SELECT road_id, round(arg_min(v, i) FILTER (v IS NOT NULL) + 1400, 6) AS alt_msl, round(arg_min(v, i) FILTER (v IS NOT NULL) + 1400 - max(v), 6) AS min_agl,
round(arg_min(v, i) FILTER (v IS NOT NULL) + 1400 - min(v), 6) AS max_agl, 1000.0 AS length_m, round(1000/(120*0.514444)/60, 9) AS minutes FROM e GROUP BY 1""".replace("1000.0 AS length_m", "CAST(1000 AS DOUBLE) AS length_m"))
def _(t):
    return rounded(L.agl_profile(t.roads, t.dtm_cells, 10.0, "road_id", nodata=-9999.0), alt_msl=6, min_agl=6, max_agl=6, minutes=9)


@query("day_summary", """SELECT strip_no % 365 AS day, count(*) AS strips, round(avg(speed_ms)*1.94384, 6) AS speed_kn, round(avg(altitude_m), 6) AS terrain, min('BLOCO_' || CAST(block_no AS VARCHAR)) AS first_block FROM {strips} GROUP BY 1""")
def _(t):
    s = t.strips.select((F.col("strip_no") % 365).alias("day"), "speed_ms", F.col("altitude_m").alias("terrain"), F.concat(F.lit("BLOCO_"), F.col("block_no").cast("string")).alias("block"))
    return rounded(L.day_summary(s), speed_kn=6, terrain=6)


@query("number_flight_lines", """SELECT strip_no, row_number() OVER (ORDER BY block_no, cy DESC, strip_no) AS line_no, printf('L%03d', row_number() OVER (ORDER BY block_no, cy DESC, strip_no)) AS code FROM {strips}""")
def _(t):
    return L.number_flight_lines(t.strips, "block_no", "cy", "strip_no").select("strip_no", "line_no", "code")


@query("sheet_grid_ids", """WITH r AS (SELECT lot_id, CAST(round((minx + maxx)/2/40) AS BIGINT) AS gx, CAST(round((miny + maxy)/2/40) AS BIGINT) AS gy FROM {lots})
SELECT lot_id, 100000 + 1000*dense_rank() OVER (ORDER BY gy DESC) + dense_rank() OVER (ORDER BY gx) AS sheet_no FROM r""")
def _(t):
    c = t.lots.select("lot_id", ((F.col("minx") + F.col("maxx")) / 2).alias("cx"), ((F.col("miny") + F.col("maxy")) / 2).alias("cy"))
    return L.sheet_grid_ids(c, "cx", "cy", 40.0).select("lot_id", F.col("sheet_no").cast("long").alias("sheet_no"))


@query("union_tracks", """SELECT event_id, x + 500000 AS x, y + 7500000 AS y, CAST(31982 AS INT) AS epsg FROM {track_points}""")
def _(t):
    p = t.track_points.select("event_id", (F.col("x") + 500000).alias("x"), (F.col("y") + 7500000).alias("y"))
    a = p.filter("event_id % 2 = 0").withColumn("epsg", F.lit(None).cast("int"))
    return L.union_tracks(a, p.filter("event_id % 2 = 1").withColumn("epsg", F.lit(31982)), 31982)


@query("points_to_line", """SELECT track_id, count(*) AS n, round(arg_min(x, {'t': ts, 'x': x}), 2) AS x0, round(arg_max(x, {'t': ts, 'x': x}), 2) AS x1 FROM {track_points} GROUP BY 1""")
def _(t):
    from ..operators.tracks import line_vertices
    ends = line_vertices(t.track_points, "track_id", "ts").groupBy("track_id").agg(
        F.count(F.lit(1)).alias("n"), F.min_by("x", "seq").alias("x0"), F.max_by("x", "seq").alias("x1")
    )
    return ends.select("track_id", "n", F.round("x0", 2).alias("x0"), F.round("x1", 2).alias("x1"))


@query("simplified_tracks")
def _(t):
    from ..operators.tracks import simplified_vertices
    kept = simplified_vertices(t.track_points, "track_id", "ts", 50.0)
    return kept.groupBy("track_id").agg(F.count(F.lit(1)).alias("n"))
