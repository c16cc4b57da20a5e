"""Operators without an SQL twin, against brute force on small inputs."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terracel.functions import geometry as G
from terracel.operators import cadastre as K
from terracel.operators import evaluation as E
from terracel.operators import graph as H
from terracel.operators import ground as D
from terracel.operators import points as P
from terracel.operators import raster as R
from terracel.operators import overlay as O
from terracel.operators import spatial as S
from terracel.operators import vertical as V

from test_core import frame


def rings(spark, items, name="pid"):
    rows = [(i, [{"x": float(x), "y": float(y)} for x, y in ring]) for i, ring in items]
    return spark.createDataFrame(rows, f"{name} long, ring array<struct<x:double,y:double>>")


def test_robust_plane_matches_rounds(spark):
    rng = np.random.default_rng(5)
    n = 200
    x, y = rng.random(n) * 100, rng.random(n) * 100
    dz = 0.5 + 0.01 * x - 0.02 * y + rng.normal(0, 0.05, n)
    dz[:12] += 5
    got = V.robust_plane(frame(spark, cid=np.arange(n), strip_id=np.zeros(n, int), x=x, y=y, dz=dz)).first()
    x0, y0 = np.median(x), np.median(y)
    a = np.column_stack([np.ones(n), x - x0, y - y0])
    keep = np.ones(n, bool)
    for _ in range(6):
        if keep.sum() < max(30, int(0.25 * n)):
            break
        c = np.linalg.lstsq(a[keep], dz[keep], rcond=None)[0]
        res = dz - a @ c
        med = np.median(res[keep])
        sigma = 1.4826 * np.median(np.abs(res[keep] - med))
        if sigma < 1e-6:
            break
        new = np.abs(res - med) <= 2.5 * sigma
        same = new.sum() == keep.sum()
        keep = new
        if same:
            break
    c = np.linalg.lstsq(a[keep], dz[keep], rcond=None)[0]
    assert got["kept"] == keep.sum()
    np.testing.assert_allclose([got["a"], got["b"], got["c"]], c, atol=1e-9)
    assert got["rmse"] == pytest.approx(np.sqrt(np.mean((dz - a @ c)[keep] ** 2)))


def test_thinning_equals_taking_in_order(spark):
    rng = np.random.default_rng(6)
    n = 400
    xy, score = rng.random((n, 2)) * 60, rng.integers(0, 50, n).astype(float)
    xy[:130] = 30 + rng.random((130, 2))  # a third of the points in one spot
    got = {r["pid"] for r in H.thin_by_distance(frame(spark, pid=np.arange(n), x=xy[:, 0], y=xy[:, 1], s=score), 5.0, "s", "pid").collect()}
    taken = []
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        if all(np.hypot(*(xy[i] - xy[j])) >= 5.0 for j in taken):
            taken.append(i)
    assert got == set(taken)


def test_claims_equal_serving_in_order(spark):
    rng = np.random.default_rng(7)
    rows = [(s, l, float(round(rng.random() * 5, 3))) for s in range(60) for l in rng.choice(25, 6, replace=False).tolist()]
    got = {r["seq"]: r["lot"] for r in H.claim_lots(spark.createDataFrame(rows, "seq long, lot long, dist double"), "seq", "lot").collect()}
    free, want = set(range(25)), {}
    for s in range(60):
        options = sorted((d, l) for q, l, d in rows if q == s and l in free)
        if options:
            want[s] = options[0][1]
            free.discard(options[0][1])
    assert got == want


def test_colouring_has_no_conflict(spark):
    rng = np.random.default_rng(8)
    edges = sorted({(min(a, b), max(a, b)) for a, b in rng.integers(0, 40, (120, 2)).tolist() if a != b} | {(0, i) for i in range(1, 15)})
    g = {r["node"]: r["grp"] for r in H.conflict_groups(frame(spark, node=np.arange(40)), spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len(g) == 40 and min(g.values()) == 1
    assert all(g[a] != g[b] for a, b in edges)
    degree = max(sum(v in e for e in edges) for v in range(40))
    assert max(g.values()) <= degree + 1


def test_overlay_areas_against_a_fine_grid(spark):
    concave = [(0, 0), (8, 0), (8, 8), (4, 3), (0, 8)]
    other = [(2, -2), (6, -2), (7, 5), (3, 7), (5, 2)]
    touching = [(8, 0), (12, 0), (12, 8), (8, 8)]
    rows = [(0, concave, other), (1, concave, touching), (2, concave, concave), (3, concave, [(1, 0), (3, 0), (3, 2), (1, 2)])]
    to = lambda r: [{"x": float(x), "y": float(y)} for x, y in r]
    left = spark.createDataFrame([(i, to(a)) for i, a, b in rows], "i long, ring array<struct<x:double,y:double>>")
    right = spark.createDataFrame([(i, to(b)) for i, a, b in rows], "j long, ring array<struct<x:double,y:double>>")
    got = {(r["i"], r["j"]): r["area"] for r in O.overlay_sums(left, right, "i", "j", 1.0).collect()}
    g = (np.arange(0, 1600) + 0.5) / 100 - 3

    def inside(ring):
        x, y = np.meshgrid(g, g)
        c = np.zeros(x.shape, bool)
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if y1 != y2:
                c ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
        return c

    for i, a, b in rows:
        assert got.get((i, i), 0) == pytest.approx((inside(a) & inside(b)).sum() / 10000, abs=0.05)
    assert got.get((1, 1), 0) == pytest.approx(0, abs=1e-9)
    both = O.covered_sums(left.filter("i = 0"), right.filter("j <> 2"), "i", "j", 1.0).first()["area"]
    want = (inside(concave) & (inside(other) | inside([(1, 0), (3, 0), (3, 2), (1, 2)]))).sum() / 10000
    assert both == pytest.approx(want, abs=0.05)


def test_dissolve_joins_touching_cells(spark):
    sq = lambda x, y: [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]
    polys = rings(spark, [(0, sq(0, 0)), (1, sq(1, 0)), (2, sq(1, 1)), (3, sq(2, 2))]).withColumn("k", F.lit("a"))
    v = K.dissolve(polys, "pid", "k").toPandas().sort_values(["ring_id", "seq"])
    areas = []
    for _, g in v.groupby(v["ring_id"].astype(str)):
        x, y = g["x"].to_numpy(), g["y"].to_numpy()
        areas.append(round(float(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y) / 2), 6))
    assert sorted(areas) == [1.0, 3.0]


def test_cell_geometry_matches_eigh(spark):
    rng = np.random.default_rng(9)
    pts = rng.normal(size=(300, 3)) * [2, 1, 0.2]
    df = frame(spark, tile_id=np.zeros(300, int), pid=np.arange(300), x=pts[:, 0], y=pts[:, 1], z=pts[:, 2])
    for r in P.cell_geometry(df, 2.0, 5).collect():
        p = pts[(np.floor(pts[:, 0] / 2) == r["cx"]) & (np.floor(pts[:, 1] / 2) == r["cy"])]
        if len(p) < 5:
            assert (r["normal_z"], r["roughness"]) == (1.0, 0.0)
            continue
        w, vec = np.linalg.eigh(np.cov(p.T))
        assert r["normal_z"] == pytest.approx(abs(vec[2, 0]), abs=1e-6)
        assert r["roughness"] == pytest.approx(np.std((p - p.mean(0)) @ vec[:, 0]), abs=1e-6)
        assert r["linearity"] == pytest.approx((w[2] - w[1]) / w[2], abs=1e-6)


def test_outliers_match_brute_force(spark):
    rng = np.random.default_rng(10)
    p = np.round(rng.random((200, 3)) * 20, 2)
    p[:60] = p[0]  # a third are copies
    p[199] = [90, 90, 90]
    df = frame(spark, pid=np.arange(200), x=p[:, 0], y=p[:, 1], z=p[:, 2])
    got = {r["pid"] for r in D.statistical_outliers(df, 6, 2.5).filter("noise").collect()}
    d = np.sort(np.linalg.norm(p[:, None] - p[None], axis=2), axis=1)[:, 1:7].mean(1)
    assert got == set(np.flatnonzero(d > d.mean() + 2.5 * d.std(ddof=1)))


def test_ground_filters_drop_a_building(spark):
    g = np.arange(0, 40) + 0.5
    x, y = (a.ravel() for a in np.meshgrid(g, g))
    z = 100 + 0.05 * x
    house = (abs(x - 20) < 4) & (abs(y - 20) < 4)
    z = np.where(house, z + 8, z)
    df = frame(spark, tile_id=np.zeros(1600, int), pid=np.arange(1600), x=x, y=y, z=z)
    for out in (D.ground_pmf(df, **D.pmf_parameters(1.0, 20.0, 8.0, 1.0)), D.ground_smrf(df, 1.0, 0.2, 1.2, 0.45, 12.0)):
        flag = {r["pid"]: r["ground"] for r in out.collect()}
        assert not any(flag[i] for i in np.flatnonzero(house))
        assert all(flag[i] for i in np.flatnonzero(~house))


def test_curvature_and_isolines_of_known_surfaces(spark):
    r, c = (a.ravel() for a in np.meshgrid(np.arange(12), np.arange(12), indexing="ij"))
    cells = frame(spark, tile_id=np.zeros(144, int), row_i=r, col_i=c, v=(c * 1.0) ** 2)
    mid = {(q["row_i"], q["col_i"]): q["curv"] for q in R.curvature(cells, 1.0, 1.0).collect()}
    assert mid[(6, 6)] == pytest.approx(2.0)
    cone = np.hypot(r - 5.5, c - 5.5)
    segs = R.isolines(frame(spark, tile_id=np.zeros(144, int), row_i=r, col_i=c, v=cone), 2.0, 1.0)
    two = segs.filter("level = 2").toPandas()
    length = np.hypot(two.x2 - two.x1, two.y2 - two.y1).sum()
    assert length == pytest.approx(2 * math.pi * 2, rel=0.05)
    ends = np.round(np.concatenate([two[["x1", "y1"]].to_numpy(), two[["x2", "y2"]].to_numpy()]), 6)
    assert all(n == 2 for n in np.unique(ends, axis=0, return_counts=True)[1])  # a closed line


def test_frontage_starts_at_the_northern_end(spark):
    lots = rings(spark, [(1, [(0, 0), (10, 0), (10, 10), (0, 10)]), (2, [(50, 0), (60, 0), (60, 10), (50, 10)])], "lot_id")
    doors = spark.createDataFrame([(1, 10.5, 4.0)], "d long, x double, y double")
    out = {r["lot_id"]: r["ring"][0] for r in K.frontage_vertex(lots, doors, "lot_id", "d", 3.0).collect()}
    assert (out[1]["x"], out[1]["y"]) == (10, 10) and (out[2]["x"], out[2]["y"]) == (50, 0)


def test_merge_and_cover_rules(spark):
    e = "x1 double, y1 double, x2 double, y2 double"
    segs = spark.createDataFrame([(0.0, 0.0, 5.0, 0.0), (5.0, 0.0, 5.008, 0.0), (5.008, 0.0, 9.0, 0.0), (5.0, 0.0, 5.0, 7.0)], e)
    out = sorted((round(r["x1"], 3), round(r["x2"], 3), r["y2"]) for r in K.merge_short_segments(segs, tol=0.001).collect())
    assert len(out) == 2 and {abs(b - a) for a, b, _ in out} == {9.0, 0.0}
    long_ = spark.createDataFrame([(0.0, 0.0, 9.0, 0.0), (0.0, 0.0, 4.0, 0.0), (4.0, 0.0, 9.0, 0.0), (20.0, 0.0, 29.0, 0.0), (20.0, 0.0, 24.0, 0.0)], e)
    assert K.drop_covered_segments(long_).count() == 4


def test_noding_splits_at_a_t_junction(spark):
    lots = rings(spark, [(1, [(0, 0), (10, 0), (10, 10), (0, 10)]), (2, [(10, 0), (20, 0), (20, 5), (10, 5)])], "lot_id")
    s = {tuple(sorted([(r["x1"], r["y1"]), (r["x2"], r["y2"])])) for r in K.node_segments(lots, "lot_id").select(*[F.round(c, 3).alias(c) for c in ("x1", "y1", "x2", "y2")]).collect()}
    assert ((10.0, 0.0), (10.0, 5.0)) in s and ((10.0, 5.0), (10.0, 10.0)) in s and ((10.0, 0.0), (10.0, 10.0)) not in s
    assert len(s) == 8


def test_surface_fill_keeps_filled_cells(spark):
    df = frame(spark, tile_id=[0, 0, 0], pid=[1, 2, 3], x=[0.5, 5.5, 0.5], y=[0.5, 0.5, 5.5], z=[10.0, 20.0, 30.0], classification=[2, 2, 2])
    g = {(r["row_i"], r["col_i"]): r["v"] for r in R.grid_surface(df, 1.0, radius=1.5, surface="dtm").collect()}
    assert len(g) == 36 and g[(0, 0)] == 10 and g[(0, 1)] == 10 and g[(5, 5)] in (20, 30)


def test_weighted_sample_is_repeatable_and_prefers_weight(spark):
    df = frame(spark, id=np.arange(500), w=np.where(np.arange(500) < 50, 1e6, 0.0))
    a = [r["id"] for r in E.weighted_sample(df, "w", 40, "id").collect()]
    assert a == [r["id"] for r in E.weighted_sample(df.repartition(7), "w", 40, "id").collect()]
    assert len(set(a)) == 40 and np.mean(np.array(a) < 50) > 0.9
    with pytest.raises(ValueError):
        E.split_sizes(10, 0.5, 0.2, 0.2)


def test_line_numbers_are_guarded(spark):
    df = spark.range(3).withColumn("f", F.col("id").cast("string"))
    assert [r[0] for r in P.number_lines(df, "f", 5).select("point_source_id").orderBy("f").collect()] == [5, 6, 7]
    with pytest.raises(Exception, match="do not fit"):
        P.number_lines(df, "f", 65535).collect()


def test_simplified_track(spark):
    from terracel.operators.tracks import points_to_line

    n = 200
    t = np.arange(n)
    df = frame(spark, track=np.zeros(n, int), t=t, x=t * 1.0, y=np.where(t < 100, 0.0, (t - 100) * 1.0))
    line = points_to_line(df, "track", "t", 0.01).first()["line"]
    assert [(p["x"], p["y"]) for p in line] == [(0, 0), (100, 0), (199, 99)]


def test_scalar_geometry_cases(spark):
    from terracel.functions.numbers import clamp

    r = spark.range(1).select(
        clamp(F.lit(5), 0, 10), clamp(F.lit(-1), 0, 10), clamp(F.lit(15), 0, 10),
        G.offset_point(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(0.0), 1.0)).first()
    assert tuple(r[:3]) == (5, 0, 10) and (r[3]["x"], r[3]["y"]) == (0.0, 1.0)
