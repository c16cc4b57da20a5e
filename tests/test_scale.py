"""Work a row and rows a task do not grow with the tables."""

import re

from pyspark.sql import functions as F

from terracel.functions import geometry as G
from terracel.plans.views import SPREAD_ROWS, Tables


def mentions(column):
    """How often an expression names the column ``ring``, in the plan it is analysed to."""
    return len(re.findall(r"\bring\b", str(column)))


def test_measures_of_a_ring_work_it_out_once(spark):  # F35
    ring = F.col("ring")
    assert mentions(G.signed_area(G.orient(ring, True))) == 1
    assert mentions(G.ring_centroid(ring)["x"]) == 2  # once for each axis


def test_close_vertices_work_the_ring_out_once(spark):  # F41
    assert mentions(G.drop_close_vertices(F.col("ring"), 0.1)) == 1


def test_length_in_ring_works_the_ring_out_once(spark):  # F32
    ends = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    text = str(G.length_in_ring(*ends, F.col("ring")))
    assert len(re.findall(r"\bring\b", text)) == 1 and len(re.findall("array_distinct", text)) == 1


def test_rows_of_small_files_are_spread_over_tasks(spark, tmp_path):  # F37
    n = 5 * SPREAD_ROWS
    spark.range(n).selectExpr("id AS c_custkey", "int(id % 25) AS c_nationkey", "'n' AS c_name").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    lots = Tables(spark, str(tmp_path)).lots
    assert lots.rdd.getNumPartitions() == 5
    assert lots.agg(F.count_distinct("lot_id")).first()[0] == n


def test_places_among_marks_take_few_steps(spark):  # F27
    from terracel.core.quantiles import BUCKETS, _place

    marks = [float(3 * i) for i in range(BUCKETS - 1)]
    rows = spark.range(-3, 3 * BUCKETS + 3).selectExpr("double(id) AS v").withColumn("m", F.array(*[F.lit(m) for m in marks]))
    got = {r["v"]: r["at"] for r in rows.select("v", _place(F.col("v"), F.col("m")).alias("at")).collect()}
    assert got == {v: sum(2 if v > m else v == m for m in marks) for v in got}
    few = spark.range(4).selectExpr("double(id) AS v", "array(1.0D) AS m").select(_place(F.col("v"), F.col("m"))).collect()
    assert [r[0] for r in few] == [0, 1, 2, 2]


def test_quantiles_without_a_large_group_skip_its_steps(spark):  # F43
    from terracel.core.quantiles import exact_quantiles

    rows = spark.range(100).selectExpr("id % 5 AS k", "double(id) AS v")
    plan = exact_quantiles(rows, ["k"], "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Join" not in plan


def _segments(spark, copies):
    return spark.range(copies).selectExpr("id AS line", "id * 0.0D AS x1", "id * 0.0D AS y1", "id * 0.0D + 100 AS x2", "id * 0.0D AS y2")


def _lowest(df):
    """Places of the lowest grouping and of the lowest laying over cells in the plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.rfind("Aggregate ["), plan.rfind("Generate explode(sequence")


def test_lines_along_one_segment_are_laid_once(spark):  # F19
    from terracel.operators.flight import nearest_line

    points = spark.range(50).selectExpr("id AS pid", "double(id) AS x", "double(id % 7) AS y")
    near = nearest_line(points, _segments(spark, 30), 5.0, "pid", "line")
    merged, laid = _lowest(near)
    assert merged > laid > 0  # merged below, before they are laid over cells
    assert {(r["pid"], r["line"], round(r["dist"], 6)) for r in near.collect()} == {(i, 0, float(i % 7)) for i in range(50) if i % 7 <= 5}


def test_directions_lay_a_segment_once(spark):  # F24
    from terracel.operators.spatial import local_direction

    points = spark.range(50).selectExpr("id AS pid", "double(id) AS x", "double(id % 7) AS y")
    out = local_direction(points, _segments(spark, 30), "pid", 3.0, 0.001, None)
    merged, laid = _lowest(out)
    assert merged > laid > 0
    assert {(r["pid"], r["angle"]) for r in out.collect()} == {(i, 0.0 if i % 7 <= 3 else None) for i in range(50)}


def test_nearest_starts_at_the_usual_gap(spark, monkeypatch):  # F25
    from terracel.operators import vertical as V

    radii, plain = [], V.nearest
    monkeypatch.setattr(V, "nearest", lambda left, right, radius, *a, **k: radii.append(radius) or plain(left, right, radius, *a, **k))
    points = spark.range(400).selectExpr("id AS cid", "id % 20 * 0.1D AS x", "floor(id / 20) * 0.1D AS y")
    asked = spark.createDataFrame([(1, 0.52, 0.5), (2, 30.0, 0.0)], "pid long, x double, y double")
    got = {r["pid"]: (r["cid"], round(r["dist"], 6)) for r in V.nearest_any(asked, points, 5.0, "pid", "cid").collect()}
    assert got == {1: (105, 0.02), 2: (19, 28.1)} and radii[0] < 0.2


def test_survey_text_is_not_dealt_by_file(spark):  # F18
    from terracel.sources.tables import parse_survey_points

    lines = spark.range(200).selectExpr("concat('f', id % 2) AS path", "id AS seq", "concat_ws(';', 'PVE', id, id + 1, 5) AS value")
    out = parse_survey_points(lines)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "strategy=broadcast" in plan
    assert {(r["seq"], r["type"], r["e"], r["n"], r["z"]) for r in out.collect()} == {(i, "PVE", float(i), float(i + 1), 5.0) for i in range(200)}


def _boxes(spark, n, step):
    return spark.range(n).selectExpr("id AS fid", f"double(id * {step} % 40) AS minx", f"double(id * {step} % 40 + 5) AS maxx", "double(id % 7) AS miny", "double(id % 7 + 4) AS maxy")


def _meets(spark, df, pad):
    df.createOrReplaceTempView("fp")
    gap = "hypot(greatest(a.minx - b.maxx, b.minx - a.maxx, 0D), greatest(a.miny - b.maxy, b.miny - a.maxy, 0D))"
    return {tuple(r) for r in spark.sql(f"SELECT a.fid, b.fid FROM fp a JOIN fp b ON a.fid < b.fid AND {gap} <= {pad}").collect()}


def test_hulls_that_are_boxes_compare_no_edges(spark):  # F22
    from terracel.operators import spatial as S

    fp = _boxes(spark, 60, 17)
    for pad in (0.0, 1.5):
        out = S.footprint_overlaps(S.with_ring(fp).select("fid", "ring"), "fid", 10.0, pad, "hull")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "ring" not in plan[: plan.index("Join Inner")]  # no ring reaches the pairs
        assert {tuple(r) for r in out.collect()} == _meets(spark, fp, pad)


def test_other_hulls_still_compare_edges(spark):  # F22
    from terracel.operators import spatial as S

    xy = lambda *v: [{"x": float(x), "y": float(y)} for x, y in v]
    rings = [(1, xy((0, 0), (4, 0), (4, 4), (0, 4))), (2, xy((5, 5), (3.5, 5), (5, 3.5))), (3, xy((3, 3), (6, 3), (6, 6), (3, 6))),
             (4, xy((0, 0), (1, 0), (0, 1))), (5, xy((0, 4), (4, 4), (0, 0), (4, 0))), (6, None), (7, xy((4, 0), (6, 0), (6, 3)))]
    fp = spark.createDataFrame(rings, "fid long, ring array<struct<x: double, y: double>>")
    assert [r["fid"] for r in fp.filter(G.is_box(F.col("ring"))).orderBy("fid").collect()] == [1, 3]
    got = {tuple(r) for r in S.footprint_overlaps(fp, "fid", 10.0, 0.0, "hull").collect()}
    assert {(1, 3), (2, 3), (1, 4), (1, 7), (3, 7)} <= got and (1, 2) not in got and (2, 4) not in got and not any(6 in p for p in got)


def test_sheets_of_a_code_meet_in_cells(spark):  # F26
    from terracel.operators import spatial as S

    box = ["double(id * 13 % 300) AS minx", "double(id * 13 % 300 + w) AS maxx", "0D AS miny", "1D AS maxy"]
    rasters = spark.range(80).selectExpr("id", "IF(id % 9 = 0, 400, 20) AS w").selectExpr("id AS file_id", "'/a/ES_L09_A_MDS_2801_1_SE_A_I.tif' AS path", *box)
    sheets = spark.range(90).selectExpr("id", "5 AS w").selectExpr("id AS sheet_id", "IF(id % 4 = 0, NULL, '2801-1-SE-A-I') AS code", *box)
    out = S.clip_geometry_for(rasters, sheets)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_cx" in plan[plan.index("Join Inner"): plan.index("Join Inner") + 400]
    rasters.createOrReplaceTempView("r"), sheets.createOrReplaceTempView("s")
    want = spark.sql("SELECT file_id, sheet_id FROM r JOIN s ON s.code IS NOT NULL AND r.minx <= s.maxx AND s.minx <= r.maxx").collect()
    assert sorted(map(tuple, out.select("file_id", "sheet_id").collect())) == sorted(map(tuple, want)) and want
