"""Cases that earlier versions got wrong: caps, size switches, several tiles and files."""

import math
import random

import pytest
from pyspark.sql import functions as F

from terracel.core.numbering import number_rows
from terracel.core.quantiles import exact_quantiles
from terracel.functions import text as X
from terracel.operators import color, ground, raster, vertical


def test_numbering_does_not_depend_on_group_size(spark):
    rng = random.Random(4)
    rows = [(i % 3, None if rng.random() < 0.2 else rng.randrange(6) * 1.5, i) for i in range(60)]
    rows += [(7, 4.0, 100 + i) for i in range(20)] + [(8, None, 200 + i) for i in range(20)]
    df = spark.createDataFrame(rows, "g int, v double, i long")
    small = {r["i"]: r["rn"] for r in number_rows(df, ["g"], "v", ["i"], hot_rows=10**6).collect()}
    large = {r["i"]: r["rn"] for r in number_rows(df, ["g"], "v", ["i"], hot_rows=2).collect()}
    order = {}
    for g in {r[0] for r in rows}:
        part = sorted([r for r in rows if r[0] == g], key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        order |= {r[2]: n for n, r in enumerate(part, 1)}
    assert small == large == order


@pytest.mark.parametrize("spread", [3, 5000])
def test_hot_quantiles_are_exact(spark, spread):
    rng = random.Random(spread)
    values = [round(rng.lognormvariate(0, 2) * spread) / 4 for _ in range(4000)]
    df = spark.createDataFrame([(1, v) for v in values] + [(2, 1.0), (2, 2.0)], "g int, v double")
    probs = [0.0, 0.02, 0.333, 0.5, 0.98, 1.0]
    a = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(df, ["g"], "v", probs, hot_rows=100).collect()}
    b = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(df, ["g"], "v", probs, hot_rows=None).collect()}
    assert a.keys() == b.keys()
    for g in a:
        assert a[g][0] == b[g][0] and a[g][1] == pytest.approx(b[g][1], rel=1e-12)


def test_five_channels_are_corrected(spark):
    cells = spark.createDataFrame([(c, 10.0) for c in "ABCDE"], "channel string, v double")
    params = spark.createDataFrame([(c, True, 2.0, 0.0) for c in "ABCDE"], "channel string, enabled boolean, gain double, offset double")
    assert {r["v"] for r in color.apply_gain_offset(cells, params).collect()} == {20.0}


def test_several_reference_rows_raise(spark):
    px = spark.createDataFrame([(0, 0, 0, 10.0, 20.0, 30.0)], "tile_id int, row_i int, col_i int, r double, g double, b double")
    stats = color.lab_stats(px)
    one = stats.drop("tile_id")
    assert color.lab_transfer(px, stats, one).count() == 1
    with pytest.raises(Exception, match="one reference row"):
        color.lab_transfer(px, stats, one.unionByName(one)).collect()


def test_narrow_edge_tiles(spark):
    tiles = [(0, 0, 2, 3, 1.0, [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]), (0, 1, 2, 1, 1.0, [6.0, 7.0]), (1, 0, 1, 3, 1.0, [8.0, 9.0, 10.0])]
    t = spark.createDataFrame(tiles, "tr long, tc long, h int, w int, size double, data array<double>").repartition(3)
    pts = spark.createDataFrame([(i, x + 0.5, y + 0.5) for i, (x, y) in enumerate([(0, 0), (2, 1), (3, 0), (3, 1), (4, 1), (1, 2), (1, 3)])], "pid long, x double, y double")
    got = [r["v"] for r in vertical.sample_tiles(pts, t).orderBy("pid").collect()]
    assert got == [0.0, 5.0, 6.0, 7.0, None, 9.0, None]


def test_surface_keeps_tiles_apart(spark):
    pts = [(0, 0.5, 0.5, 1.0), (0, 1.5, 400.5, 1.0), (1, 0.5, 0.5, 99.0), (1, 0.5, 400.5, 99.0)]
    df = spark.createDataFrame([(t, x, y, z, 2) for t, x, y, z in pts], "tile_id int, x double, y double, z double, classification int")
    for method in ("idw", "nearest"):
        out = raster.grid_surface(df, 1.0, method, radius=1.5, surface="dtm").groupBy("tile_id").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count("*").alias("n"))
        assert {r["tile_id"]: (r["a"], r["b"], r["n"]) for r in out.collect()} == {0: (1.0, 1.0, 802), 1: (99.0, 99.0, 401)}


def test_noise_of_one_file_flags_no_other(spark):
    rows = [("a", 1, 0.5, 0.5, -50.0), ("a", 2, 0.6, 0.5, 1.0), ("b", 1, 0.5, 0.5, 1.0), ("b", 2, 0.6, 0.5, 1.1)]
    df = spark.createDataFrame(rows, "tile_id string, pid long, x double, y double, z double")
    flagged = ground.low_noise(df).filter("noise").collect()
    assert [(r["tile_id"], r["pid"]) for r in flagged] == [("a", 1)]


def test_outliers_keep_points_without_a_place(spark):
    rows = [(i, float(i % 5), float(i // 5), 0.0) for i in range(25)] + [(90, math.nan, 1.0, 0.0), (91, 500.0, 500.0, 0.0), (92, None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "pid long, x double, y double, z double")
    out = {r["pid"]: r["noise"] for r in ground.statistical_outliers(df, k=3).collect()}
    assert set(out) == {r[0] for r in rows} and out[91] and not out[92]


def test_nested_json_at_any_depth(spark):
    doc = '{"b": [1, {"x": [true, null]}], "a": {"d": {"e": {"f": {"g": 1.5}}}}, "c": "s"}'
    df = spark.createDataFrame([(doc,), (None,), ("no json",)], "t string")
    got = [r[0] for r in df.select(X.flatten_json(F.col("t"), "M")).collect()]
    assert got == [["M_a_d_e_f_g=1.5", "M_b_1=1", "M_b_2_x_1=True", "M_b_2_x_2=None", "M_c=s"], None, None]


def test_survey_types(spark):
    want = {
        "1 PVSNM": "1 PVSN", "1pvsnm": "1 PVSN", "2PV33m": "2 PV 33", "1 PV 12AM": "1 PV 12A", "1PVSN12M": "1 PV SN12", "1 PV33B": "1 PV 33", "3PV33abX": "3 PV 33A",
        "1PV33": "1PV33", "1 PV 33": "1 PV 33", "E 12--33--1--tv": "TV", "E1--SN--2--PV": "2 PVSN", "E 7 -- 12a -- O -- PV": "1 PV 12A", "E7--12--1": "E7--12--1",
        "arv12": "ARVORE", "ARV": "ARVORE", "arv 1": "arv 1", " PVE ": "PVE", "": "", None: "",
    }
    df = spark.createDataFrame([(k,) for k in want], "t string")
    got = {r["t"]: r["s"] for r in df.select("t", X.survey_type(F.col("t")).alias("s")).collect()}
    assert got == want
    doors = {"2 PV 15A": (2, "15A"), "1 PVSN": (1, None), "YPVSN": (1, None), "1 PVSN x": (1, None), "PVE": None, "1 PV": None, None: None, "tv": None}
    df = spark.createDataFrame([(k,) for k in doors], "t string")
    got = {r["t"]: r["d"] and (r["d"]["floors"], r["d"]["number"]) for r in df.select("t", X.door_number(F.col("t")).alias("d")).collect()}
    assert got == doors


def test_nearest_line_without_a_limit(spark):
    from terracel.operators import flight

    pts = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 5000.0), (3, math.nan, 0.0), (4, -90000.0, 0.0)], "pid long, x double, y double")
    lines = spark.createDataFrame([(10, 0.0, 0.0, 10.0, 0.0), (11, 0.0, 6000.0, 10.0, 6000.0)], "lid long, x1 double, y1 double, x2 double, y2 double")
    out = {r["pid"]: (r["lid"], r["dist"]) for r in flight.nearest_line(pts, lines, None, "pid", "lid").collect()}
    assert out == {1: (10, 1.0), 2: (11, 1000.0), 4: (10, 90000.0)}
    assert flight.nearest_line(pts, lines.limit(0), None, "pid", "lid").count() == 0


def test_frontage_without_a_limit(spark):
    from terracel.operators import cadastre

    ring = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    lots = spark.createDataFrame([(1, ring)], "lot_id long, ring array<struct<x:double,y:double>>")
    doors = spark.createDataFrame([(1, 700.0, 4.0)], "d long, x double, y double")
    first = lambda **k: tuple(cadastre.frontage_vertex(lots, doors, "lot_id", "d", **k).first()["ring"][0])
    assert first() == (10.0, 10.0) and first(reach=3.0) == (0.0, 0.0)


def test_open_boundaries_raise(spark):
    from terracel.operators import graph

    e = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 0.0), (1, 1.0, 0.0, 1.0, 1.0)], "k int, x1 double, y1 double, x2 double, y2 double")
    with pytest.raises(Exception, match="does not close"):
        graph.chain_rings(e, "k").collect()


def test_side_files_with_commas_and_blanks(spark):
    lines = [("f", i, v) for i, v in enumerate(["0,5", "", "0.0", "0", " ", "-0,5", "100,25", "200.75"], 1)]
    df = spark.createDataFrame(lines, "path string, line_no int, value string")
    r = raster.world_file(df).first()
    assert (r["a"], r["d"], r["b"], r["e"], r["c"], r["f"]) == (0.5, 0.0, 0.0, -0.5, 100.0, 201.0)


def test_weighted_sample_takes_exactly_n(spark):
    from terracel.operators import evaluation

    rows = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).cast("double").alias("w"))
    out = evaluation.weighted_sample(rows, "w", 120, "k", alpha=0.0)
    assert out.count() == 120 and out.filter("w = 0").count() == 0 and out.columns == rows.columns
    assert evaluation.weighted_sample(rows, "w", 450, "k", alpha=0.0).count() == 450


def test_line_vertices_are_rows_in_time_order(spark):
    from terracel.operators.tracks import line_vertices

    rows = [(k % 2, float(k * 7 % 50), float(k), 0.0) for k in range(50)] + [(0, None, 1.0, 1.0)]
    out = line_vertices(spark.createDataFrame(rows, "g int, t double, x double, y double"), "g", "t")
    want = []
    for g in (0, 1):
        line = sorted(r[1:] for r in rows if r[0] == g and r[1] is not None)
        want += [(g, i + 1, x, y) for i, (_, x, y) in enumerate(line)]
    assert sorted(tuple(r) for r in out.collect()) == want


def test_names_that_begin_alike_are_numbered_in_ranges(spark):
    from terracel.core.numbering import number_sorted, range_slices
    from terracel.sources.sinks import side_by_side

    names = [f"ES_L{k * 37 % 1000:04d}" for k in range(1000)] + [None, "ES_L0000"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert range_slices(df, ["name"]).groupBy("_slice").count().agg({"count": "max"}).first()[0] < 600
    got = sorted((r["rn"], r["name"]) for r in number_sorted(df, ["name"]).collect())
    assert got == list(enumerate(sorted(names, key=lambda n: (n is not None, n)), 1))
    both = side_by_side(df.filter("name < 'ES_L0005'"), df.filter("name > 'ES_L0997'"), "name", ["a", "b"]).collect()
    assert sorted(tuple(r) for r in both)[:3] == [(1, "ES_L0000", "ES_L0998"), (2, "ES_L0000", "ES_L0999"), (3, "ES_L0001", None)]


def test_folder_pairs_come_from_a_join(spark):
    from terracel.operators.files import folder_name_overlap

    paths = [f"/d/P/{f}/{s}.las" for f, stems in (("a", "xyz"), ("b", "xy"), ("c", "Xw"), ("e", "v")) for s in stems]
    out = folder_name_overlap(spark.createDataFrame([(p,) for p in paths], "path string"), "/d")
    assert sorted(tuple(r) for r in out.collect()) == [("P", "/d/P/a", "/d/P/b", 2), ("P", "/d/P/a", "/d/P/c", 1), ("P", "/d/P/b", "/d/P/c", 1)]
    assert "collect_set" not in out._jdf.queryExecution().toString()


def test_weighted_sample_with_small_weights(spark):
    from terracel.operators.evaluation import weighted_sample

    # lower keys have the lower weights: none, then a thousandth, then ten times that
    rows = spark.createDataFrame([(k, 0.0 if k < 300 else 0.001 if k < 600 else 0.01) for k in range(900)], "k int, w double")
    drawn = [r["k"] for r in weighted_sample(rows, "w", 300, "k", alpha=0.0).collect()]
    assert len(drawn) == 300 and min(drawn) >= 300 and sum(k >= 600 for k in drawn) > 200
