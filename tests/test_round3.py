"""Unions of uneven borders, merged chains, whole-track simplification."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from terracel.operators import cadastre as K
from terracel.operators import graph as H
from terracel.operators import tracks as T

RINGS = "pid long, k string, ring array<struct<x:double,y:double>>"


def rings(spark, rows):
    return spark.createDataFrame([(i, k, [{"x": float(x), "y": float(y)} for x, y in r]) for i, k, r in rows], RINGS)


def measures(vertices):
    """Signed area and perimeter of each ring of ``dissolve``."""
    by = defaultdict(list)
    for r in vertices.collect():
        by[r["k"], str(r["ring_id"])].append((r["seq"], r["x"], r["y"]))
    out = defaultdict(list)
    for (k, _), ps in by.items():
        ps = [p[1:] for p in sorted(ps)]
        area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ps, ps[1:] + ps[:1])) / 2
        out[k].append((round(area, 6), round(sum(math.dist(a, b) for a, b in zip(ps, ps[1:] + ps[:1])), 6)))
    return {k: sorted(v) for k, v in out.items()}


def test_union_with_t_junctions_and_a_hole(spark):
    """Borders that end in the middle of others, slanted ones, either direction of rings, a gap that becomes a hole."""
    box = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d)]
    rows = [
        (1, "t", box(0, 0, 4, 10)), (2, "t", box(4, 0, 9, 3)), (3, "t", box(4, 3, 9, 10)[::-1]),
        (4, "hole", box(0, 0, 9, 3)), (5, "hole", box(0, 3, 3, 9)), (6, "hole", box(3, 6, 9, 9)[::-1]), (7, "hole", box(6, 3, 9, 6)),
        (8, "slant", [(0, 0), (10, 5), (0, 5)]), (9, "slant", [(0, 0), (4, 0), (4, 2)]), (10, "slant", [(4, 2), (4, 0), (10, 0), (10, 5)]),
        (11, "apart", box(0, 0, 1, 1)), (12, "apart", box(5, 5, 6, 6)), (13, "same", box(0, 0, 4, 10)),
    ]
    got = measures(K.dissolve(rings(spark, rows), "pid", "k"))
    assert got["t"] == [(90, 38)] and got["same"] == [(40, 28)] and got["apart"] == [(1, 4), (1, 4)]
    assert got["hole"] == [(-9, 12), (81, 36)]
    assert got["slant"] == [(50, 30)]


def test_union_of_features_with_holes(spark):
    parts = "pid long, k string, parts array<struct<ring:array<struct<x:double,y:double>>,holes:array<array<struct<x:double,y:double>>>>>"
    pt = lambda r: [{"x": float(x), "y": float(y)} for x, y in r]
    frame = [(pt([(0, 0), (9, 0), (9, 9), (0, 9)]), [pt([(3, 3), (6, 3), (6, 6), (3, 6)])])]
    plug = [(pt([(3, 3), (6, 3), (6, 4), (3, 4)]), [])]
    df = spark.createDataFrame([(1, "a", frame), (2, "a", plug)], parts)
    assert measures(K.dissolve(df, "pid", "k"))["a"] == [(-6, 10), (81, 36)]


def plain_chains(segs):
    """Walk from every end of degree other than two, then around what is left."""
    near = defaultdict(set)
    for a, b in segs:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    left = {frozenset((a, b)) for a in near for b in near[a]}
    lines = []

    def walk(a, b):
        path = [a, b]
        left.discard(frozenset((a, b)))
        while len(near[path[-1]]) == 2 and path[-1] != path[0]:
            nxt = next(c for c in near[path[-1]] if c != path[-2])
            left.discard(frozenset((path[-1], nxt)))
            path.append(nxt)
        return path

    for a in sorted(near):
        if len(near[a]) != 2:
            for b in sorted(near[a]):
                if frozenset((a, b)) in left:
                    lines.append(walk(a, b))
    while left:
        a = min(v for e in left for v in e)
        lines.append(walk(a, min(b for b in near[a] if frozenset((a, b)) in left)))
    return lines


def undirected(path):
    if path[0] == path[-1]:
        ring = path[:-1]
        i = ring.index(min(ring))
        ring = ring[i:] + ring[:i]
        other = [ring[0], *ring[1:][::-1]]
        return ("loop", *min(ring, other))
    return ("line", *min(path, path[::-1]))


@pytest.mark.parametrize("seed", range(3))
def test_merge_chains(spark, seed):
    rng = random.Random(seed)
    segs = [((0, 0), (1, 0)), ((1, 0), (2, 1)), ((1, 0), (2, -1))]  # a Y
    segs += [((10 + i, i % 3), (11 + i, (i + 1) % 3)) for i in range(rng.randrange(2, 70))]  # a long line
    ring = [(round(300 + 20 * math.cos(i), 0), round(20 * math.sin(i), 0)) for i in range(6)]
    segs += list(zip(ring, ring[1:] + ring[:1]))  # a closed line
    segs += [((200, 0), (201, 0)), ((201, 0), (201, 1)), ((201, 1), (200, 0)), ((200, 0), (199, 0))]  # a loop on a stem
    segs += [((rng.randrange(400, 406), rng.randrange(6)), (rng.randrange(400, 406), rng.randrange(6))) for _ in range(14)]
    segs += [segs[0], (segs[4][1], segs[4][0])]
    rng.shuffle(segs)
    df = spark.createDataFrame([("n", *map(float, (*a, *b))) for a, b in segs if rng.random() < 2], "k string, x1 double, y1 double, x2 double, y2 double")
    chains = H.merge_chains(df, "k")
    got = defaultdict(list)
    for r in H.chain_vertices(chains, "k").collect():
        got[str(r["line_id"])].append((r["seq"], (r["x"], r["y"])))
    paths = []
    for ps in got.values():
        ps = sorted(ps)
        assert [s for s, _ in ps] == list(range(len(ps)))
        paths.append([p for _, p in ps])
    assert sorted(map(undirected, paths)) == sorted(map(undirected, plain_chains([(tuple(map(float, a)), tuple(map(float, b))) for a, b in segs])))
    closed = {str(r["line_id"]) for r in chains.filter("closed").collect()}
    assert len(closed) >= 1 and all(min(got[c])[1] == max(got[c])[1] for c in closed)
    tagged = H.merge_lines(df, "k").groupBy("line_id").agg(F.max("line_length").alias("n")).collect()
    assert sum(r["n"] for r in tagged) == pytest.approx(sum(math.dist(*sorted(e)) for e in {frozenset(s) for s in segs if s[0] != s[1]}))


def test_a_y_stays_three_lines_and_empty_input(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0, 1.0, 0.0), ("a", 1.0, 0.0, 2.0, 1.0), ("a", 2.0, -1.0, 1.0, 0.0), ("b", 0.0, 0.0, 1.0, 0.0)], "k string, x1 double, y1 double, x2 double, y2 double")
    assert H.merge_chains(df, "k").select("k", "line_id").distinct().count() == 4
    assert H.merge_chains(df.limit(0), "k").count() == 0


@pytest.mark.parametrize("at_once", [3, 50, 20_000])
def test_tracks_are_simplified_as_a_whole(spark, at_once):
    """Rounds over long intervals and groups for short ones give the rule over the whole track."""
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for track, n in (("a", 1), ("b", 2), ("c", 400), ("d", 37)):
        x, y = np.cumsum(rng.normal(0, 3, n)), np.cumsum(rng.normal(0, 3, n))
        rows += [(track, float(i * 700), float(x[i]), float(y[i])) for i in range(n)]
        want[track] = (T._simplify(x, y, 6.0) + 1).tolist()
    rng.shuffle(rows)
    df = spark.createDataFrame([(r[0], float(r[1]), float(r[2]), float(r[3])) for r in rows] + [("c", None, 0.0, 0.0)], "track string, t double, x double, y double")
    got = defaultdict(list)
    for r in T.simplified_vertices(df, "track", "t", 6.0, at_once).collect():
        got[r["track"]].append(r["seq"])
    assert {k: sorted(v) for k, v in got.items()} == want
    assert T.simplified_vertices(df.limit(0), "track", "t", 6.0, at_once).count() == 0


def sequential(rows, d):
    out = []
    for _, pid, x, y in sorted((-s, p, x, y) for p, x, y, s in rows):
        if all(math.hypot(x - u, y - v) >= d for _, u, v in out):
            out.append((pid, x, y))
    return {p for p, _, _ in out}


@pytest.mark.parametrize("at_once", [60, 50_000])
def test_thinning_by_blocks(spark, at_once):
    """Chains, crowds, equal scores and repeated places; blocks of any size give the sequential rule."""
    rng = random.Random(at_once)
    rows = [(i, i * 0.9, 0.0, -float(i)) for i in range(120)]  # each point hangs on the one before
    rows += [(1000 + i, rng.uniform(0, 30), rng.uniform(5, 30), float(rng.randrange(4))) for i in range(250)]
    rows += [(2000 + i, 50 + rng.random() / 100, 50 + rng.random() / 100, rng.random()) for i in range(80)]
    rows += [(3000 + i, 7.0, 7.0, 1.0) for i in range(5)]
    df = spark.createDataFrame([(int(p), float(x), float(y), float(s), k) for k in "uv" for p, x, y, s in rows], "pid long, x double, y double, s double, k string")
    got = H.thin_by_distance(df, 1.0, "s", "pid", ["k"], rows_at_once=at_once).collect()
    want = sequential(rows, 1.0)
    assert {(r["k"], r["pid"]) for r in got} == {(k, p) for k in "uv" for p in want}
    nested = H.thin_by_distance(df.filter("k = 'u'").withColumn("id", F.struct("pid", F.lit("z").alias("t"))), 1.0, "s", "id", rows_at_once=at_once)
    assert {r["pid"] for r in nested.collect()} == want


def test_thinning_rounds_do_not_grow_with_a_chain(spark):
    counts = []
    for n in (1_000, 10_000):
        df = spark.range(n).selectExpr("id as pid", "id * 0.9d as x", "0d as y", "-double(id) as s")
        rounds = []
        out = H.thin_by_distance(df, 1.0, "s", "pid", rounds=rounds)
        assert out.filter("pid % 2 = 1").isEmpty() and out.count() == n // 2
        counts.append(len(rounds))
    assert counts[1] <= counts[0] <= 4


@pytest.mark.parametrize("at_once", [6, 50_000])
def test_claims(spark, at_once):
    """A chain of claims, competing rows, ties of distance and lots with one asker."""
    rng = random.Random(2)
    rows = [(i, lot, 1.0 if lot == i else 2.0) for i in range(1, 200) for lot in (i - 1, i)] + [(0, 0, 1.0)]
    rows += [(1000 + i, 1000 + rng.randrange(12), float(rng.randrange(3))) for i in range(40) for _ in range(3)]
    rows = list({(s, lot): (s, lot, d) for s, lot, d in rows}.values())
    taken, want = set(), {}
    for seq in sorted({r[0] for r in rows}):
        for d, lot in sorted((r[2], r[1]) for r in rows if r[0] == seq):
            if lot not in taken:
                taken.add(lot)
                want[seq] = (lot, d)
                break
    df = spark.createDataFrame(rows, "s long, lot long, dist double")
    got = {r["s"]: (r["lot"], r["dist"]) for r in H.claim_lots(df, "s", "lot", rows_at_once=at_once).collect()}
    assert got == want
    assert H.claim_lots(df.limit(0), "s", "lot").count() == 0


@pytest.mark.parametrize("bound", [20, 3000, 100_000])
def test_hot_quantiles_by_refinement(spark, bound, monkeypatch):
    """Distinct values, one heavy value, few values and infinities; no opened range has more rows than the bound."""
    from terracel.core import quantiles

    rng = np.random.default_rng(7)
    groups = {"wide": rng.normal(0, 1, 20_000), "heavy": np.r_[np.zeros(9_000), rng.uniform(-1, 1, 6_000)], "few": rng.integers(0, 3, 5_000).astype(float), "edge": np.r_[rng.normal(size=4_000), [np.inf, -np.inf]]}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("wide", None), ("few", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.01, 0.5, 0.98, 1.0]
    hot = quantiles.hot_keys(df.filter("v is not null and not isnan(v)"), ["k"], 1000)
    base = df.select("k", F.col("v").alias("_v")).filter("_v is not null and not isnan(_v)")
    got = {r["k"]: r for r in quantiles._hot_quantiles(base, hot, ["k"], probs, "q", bound).collect()}
    for k, vs in groups.items():
        vs = np.sort(vs)
        assert got[k]["n"] == len(vs)
        for p, q in zip(probs, got[k]["q"], strict=True):
            at = p * (len(vs) - 1)
            a, b = vs[math.floor(at)], vs[math.ceil(at)]
            want = a if a == b else a + (b - a) * (at - math.floor(at))
            assert q == pytest.approx(want, abs=1e-12) or (math.isnan(q) and math.isinf(a))
    plain = {r["k"]: r["q"] for r in quantiles.exact_quantiles(df, ["k"], "v", [0.5], "q", 1000).collect()}
    assert {k: q[0] for k, q in plain.items()} == pytest.approx({k: float(np.quantile(v, 0.5)) for k, v in groups.items()})


def test_holes_are_filled_where_windows_look(spark):
    """A stray cell far away costs nine blocks; extrema and ground filters are those of the filled box."""
    from terracel.operators import ground as D
    from terracel.operators import raster as R

    rng = np.random.default_rng(9)
    cells = [(0, int(r), int(c), float(v)) for r, c, v in zip(rng.integers(0, 90, 900), rng.integers(0, 90, 900), rng.integers(0, 40, 900), strict=True)]
    cells = list({x[:3]: x for x in cells}.values())
    near = spark.createDataFrame([*cells, (0, 200, 130, 5.0)], "tile_id int, row_i int, col_i int, v double")
    far = near.unionByName(spark.createDataFrame([(0, 10**6, 10**6, 1.0)], near.schema))
    assert R.complete(far, reach=5).count() < 90 * 90 + 30 * 16 * 16
    whole = R.complete(near).groupBy("tile_id").count().first()["count"]
    assert whole == (200 - min(c[1] for c in cells) + 1) * (130 - min(c[2] for c in cells) + 1) or whole > 20_000
    keep = lambda df: sorted((r["row_i"], r["col_i"], r["is_peak"], r["is_pit"]) for r in df.collect() if r["row_i"] < 80 and r["col_i"] < 80)
    full = R.focal(R.focal(R.complete(near), 3, "max", out="hi"), 3, "min", out="lo").filter("v is not null")
    want = {(r["row_i"], r["col_i"]): (r["v"] == r["hi"], r["v"] == r["lo"]) for r in full.collect()}
    for r, c, peak, pit in keep(R.local_extrema(far, 7)):
        if r >= 5 and c >= 5:
            assert (peak, pit) == want[r, c]
    pts = near.selectExpr("row_number() over (order by row_i, col_i) as pid", "tile_id", "col_i + 0.5 as x", "row_i + 0.5 as y", "v as z")
    ground = lambda: {r["pid"]: r["ground"] for r in D.ground_pmf(pts, 1.0, 0.3, 0.5, 3.0, 9).collect()}
    got = ground()
    plain = R.complete
    try:
        D.complete = lambda cells, keys, value="v", reach=None: plain(cells, keys, value)
        assert got == ground()
    finally:
        D.complete = plain


def test_edges_are_taken_once(spark):
    """Doors of one lot in order: unshared edges first, each once, then the closest of all; many doors on one lot."""
    square = [(0, 0, 10, 0, 1), (10, 0, 10, 10, 2), (10, 10, 0, 10, 1), (0, 10, 0, 0, 1)]
    segs = spark.createDataFrame([(lot, i + 1, copies, *map(float, (a, b, c, d))) for lot in (1, 2) for i, (a, b, c, d, copies) in enumerate(square)],
                                 "lot long, seg_no int, copies long, x1 double, y1 double, x2 double, y2 double")
    doors = [(1, 1, 5.0, 1.0), (2, 1, 5.0, 0.5), (3, 1, 9.0, 5.0), (4, 1, 9.5, 5.0), (5, 1, 5.0, 0.2), (9, 2, 9.9, 5.0)]
    doors += [(100 + i, 2, 5.0, 9.0) for i in range(50)]
    got = {r["seq"]: (r["seg_no"], round(r["dist"], 6), r["px"], r["py"]) for r in K.pick_edge(spark.createDataFrame(doors, "seq long, lot long, x double, y double"), segs, "lot").collect()}
    # 1 takes edge 1; 2 the next closest free one, 4; 3 edge 3; then all free ones are gone and the shared edge may be the closest
    assert [got[i][0] for i in (1, 2, 3, 4, 5)] == [1, 4, 3, 2, 1]
    assert got[3] == (3, 5.0, 9.0, 10.0) and got[4] == (2, 0.5, 10.0, 5.0)
    assert got[9][0] == 1 and [got[100 + i][0] for i in range(4)] == [3, 4, 3, 3] and len(got) == len(doors)


def test_sections_along_bent_axes(spark):
    pt = lambda r: [{"x": float(x), "y": float(y)} for x, y in r]
    axes = spark.createDataFrame([(1, pt([(0, 0), (60, 0), (60, 40)])), (2, pt([(0, 0), (0.5, 0), (30, 0)])), (3, pt([(5, 5), (6, 5)]))], "a long, line array<struct<x:double,y:double>>")
    at = lambda **o: sorted((r["a"], r["part"], round(r["fraction"], 6), round(r["mx"], 6), round(r["my"], 6), round(r["nx"], 6), round(r["ny"], 6)) for r in K.section_places(axes, "a", **o).collect())
    bent = [x for x in at() if x[0] == 1]
    assert bent == [(1, 0, 0.2, 20, 0, 0, 1), (1, 0, 0.5, 50, 0, 0, 1), (1, 0, 0.8, 60, 20, -1, 0)]
    assert [x[2] for x in at(spacing=30.0) if x[0] == 1] == [0.2, 0.5, 0.8] and [x[2] for x in at(spacing=30.0) if x[0] == 3] == [0.2]
    assert [x[2] for x in at(spacing=1.0, most=4) if x[0] == 1] == [0.2, 0.4, 0.6, 0.8]
    assert {x[0] for x in at(min_len=10.0)} == {1, 2} and {x[:2] for x in at(by_segment=True)} == {(1, 1), (1, 2), (2, 2), (3, 1)}
    assert [x[2] for x in at(min_gap=20.0) if x[0] == 2] == [0.2] and [x[2] for x in at(fractions=(0.0, 1.0)) if x[0] == 1] == [0.0, 1.0]
    kerbs = spark.createDataFrame([(-10.0, 4.0, 56.0, 4.0), (-10.0, -4.0, 64.0, -4.0), (56.0, 4.0, 56.0, 50.0), (64.0, -4.0, 64.0, 50.0)], "x1 double, y1 double, x2 double, y2 double")
    out = K.cross_sections(axes.filter("a = 1"), kerbs, kerbs, "a", size=10.0).collect()
    assert [(r["fraction"], round(r["kerb_kerb"], 6)) for r in sorted(out, key=lambda r: r["fraction"])] == [(0.2, 8.0), (0.5, 8.0), (0.8, 8.0)]


def test_lots_without_doors_start_at_their_access_road(spark):
    sq = lambda x: [{"x": float(a), "y": float(b)} for a, b in ((x, 0), (x + 10, 0), (x + 10, 10), (x, 10))]
    lots = spark.createDataFrame([(1, "A", sq(0)), (2, "A", sq(20)), (3, "B", sq(40)), (4, None, sq(60)), (5, "C", sq(80))], "lot long, road string, ring array<struct<x:double,y:double>>")
    doors = spark.createDataFrame([(1, 5.0, 10.5)], "d long, x double, y double")
    roads = spark.createDataFrame([("A", 0.0, -1.0, 35.0, -1.0), ("A", 30.0, -5.0, 30.0, 4.0), ("B", 0.0, 5.0, 45.0, 5.0), ("C", 0.0, 99.0, 9.0, 99.0)], "road string, x1 double, y1 double, x2 double, y2 double")
    got = {r["lot"]: (r["ring"][0]["x"], r["ring"][0]["y"]) for r in K.frontage_vertex(lots, doors, "lot", "d", 2.0, roads=roads, road="road").collect()}
    assert got == {1: (10, 10), 2: (30, 10), 3: (40, 10), 4: (60, 0), 5: (80, 0)}
