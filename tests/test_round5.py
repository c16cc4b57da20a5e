"""Crowds: covered areas by tiles, groups settled by blocks."""

import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F
from terracel.operators import overlay as V


@pytest.fixture
def in_time(spark):
    """Jobs of the test are cancelled after 100 seconds."""
    timer = threading.Timer(100, spark.sparkContext.cancelAllJobs)
    timer.start()
    yield
    timer.cancel()


def boxes(spark, rows, fid):
    ring = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"))])
    return spark.createDataFrame(rows, f"{fid} long, x1 double, y1 double, x2 double, y2 double").select(fid, ring.alias("ring"))


def test_covered_by_a_crowd(spark, in_time):
    """20,000 boxes over five lots: edges in covered tiles are not compared, level edges do not look for crossings."""
    rng = random.Random(3)
    right, seen = [], np.zeros((400, 400), bool)
    for i in range(20_000):
        x, y, w, h = rng.randrange(300), rng.randrange(200), rng.randrange(40, 100), rng.randrange(40, 100)
        right.append((i, x / 10, y / 10, (x + w) / 10, (y + h) / 10))
        seen[x:x + w, y:y + h] = True
    lots = [(0, 0, 0, 100, 250), (1, 100, 0, 200, 250), (2, 200, 0, 300, 400), (3, 0, 250, 200, 400), (4, 300, 0, 400, 400)]
    left = [(i, *[float(v) / 10 for v in lot]) for i, *lot in lots]
    got = {r["i"]: r["area"] for r in V.covered_sums(boxes(spark, left, "i"), boxes(spark, right, "j"), "i", "j", 20.0).collect()}
    assert got == {i: pytest.approx(seen[a:c, b:d].sum() / 100, abs=1e-6) for i, a, b, c, d in lots}


def test_tiles_of_a_shape(spark):
    """Tiles that lie wholly in a shape: an L of many small edges, a slanted roof, a frame."""
    ring = lambda *p: [{"x": float(x), "y": float(y)} for x, y in p]
    fine = [(0, 0), (8, 0), (8, 3), (4, 3), *[(4, 3 + i / 4) for i in range(1, 20)], *[(4 - i / 3, 8) for i in range(12)], (0, 8)]
    rows = [(0, ring(*fine), []), (1, ring((0, 0), (8, 0), (8, 8)), []), (2, ring((0, 0), (8, 0), (8, 8), (0, 8)), [ring((2, 2), (6.5, 2), (6.5, 6), (2, 6))])]
    shape = "array<struct<x:double,y:double>>"
    laid = V.tile_rows(spark.createDataFrame(rows, f"i int, ring {shape}, holes array<{shape}>"), ["i"], 8.0)
    masks = {r["i"]: r["m"] & (1 << 64) - 1 for r in laid.filter("_cx = 0 AND _cy = 0").select("i", V._full_tiles(8.0).alias("m")).collect()}
    tiles = lambda m: {(n // 8, n % 8) for n in range(64) if m >> n & 1}
    every = {(i, j) for i in range(8) for j in range(8)}
    assert tiles(masks[0]) == {(i, j) for i, j in every if i < 4 or j < 3}
    assert tiles(masks[1]) == {(i, j) for i, j in every if j < i}
    assert tiles(masks[2]) == {(i, j) for i, j in every if not (2 <= i < 7 and 2 <= j < 6)}


def test_groups_by_blocks(spark):
    """Blocks settle their nodes as the sequential rule does, in few rounds; copies and both directions of an edge count once."""
    from terracel.operators.graph import conflict_groups

    rng = np.random.default_rng(4)
    at = rng.random((1500, 2)) * 60
    near = [(int(i), int(j)) for i in range(1500) for j in np.flatnonzero(np.abs(at[i] - at).max(axis=1) < 2) if i < j]
    edges = spark.createDataFrame([*near, *[(j, i) for i, j in near[:50]], *near[50:90], (7, 7)], "a long, b long")
    nodes = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(at)] + [(2000, None, None)], "node long, x double, y double")
    rank = {r[0]: r[1] for r in nodes.select("node", F.xxhash64("node")).collect()}
    beside = {i: set() for i in rank}
    for i, j in near:
        beside[i].add(j)
        beside[j].add(i)
    want = {}
    for i in sorted(beside, key=lambda i: (-len(beside[i]) - (i == 7), rank[i], i)):
        used = {want.get(j) for j in beside[i]}
        want[i] = next(g for g in range(1, 2000) if g not in used)
    rounds = []
    got = conflict_groups(nodes, edges, "node", ("x", "y"), 700, rounds)
    assert {r["node"]: r["grp"] for r in got.collect()} == want and 2 <= len(rounds) <= 12 and got.schema["grp"].dataType.simpleString() == "int"
    plain = conflict_groups(nodes, edges, "node")
    assert {r["node"]: r["grp"] for r in plain.collect()} == want
    crowd = conflict_groups(nodes.select("node", F.lit(1.0).alias("x"), F.lit(1.0).alias("y")), edges, "node", ("x", "y"), 700)
    assert {r["node"]: r["grp"] for r in crowd.collect()} == want
    none = conflict_groups(nodes, edges.limit(0), "node", ("x", "y"))
    assert {r["grp"] for r in none.collect()} == {1} and none.count() == 1501


@pytest.mark.parametrize("block", [40, 300])
def test_neighbours_by_blocks(spark, block):
    """Blocks with borders: even points, a dense corner, a lonely point, copies; no tree of cells is built."""
    from terracel.core import knn

    rng = np.random.default_rng(block)
    xyz = np.concatenate([rng.uniform(0, 10, (900, 3)), rng.uniform(0, 2, (60, 3)), [[60.0, 3, 3], [59.0, 3, 8]]])
    copies = rng.integers(1, 4, len(xyz)) if block == 40 else np.ones(len(xyz), int)
    d = np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(axis=2))
    want = {}
    for i, p in enumerate(xyz.tolist()):
        others = np.sort(np.repeat(d[i], copies - (np.arange(len(xyz)) == i)))
        want[tuple(p)] = others[:6].mean()
    df = spark.createDataFrame([(*map(float, p), int(c)) for p, c in zip(xyz, copies, strict=True)], "x double, y double, z double, copies long")
    found = knn.mean_nearest(df, 6, block=block)
    assert "_up0" not in found._jdf.queryExecution().toString()
    assert {(r["x"], r["y"], r["z"]): r["mean_d"] for r in found.collect()} == {p: pytest.approx(w, rel=1e-9) for p, w in want.items()}


def test_crowd_around_few_lots(spark, monkeypatch):
    """30,000 rows want 40 lots: those that come too late are gone before components are looked for."""
    from terracel.operators import graph

    rng = np.random.default_rng(8)
    rows = [(int(i), int(lot), float(d)) for i in range(30_000) for lot, d in zip(rng.choice(40, 3, replace=False), rng.integers(0, 6, 3), strict=True)]
    taken, want = set(), {}
    for i in range(30_000):
        free = sorted((d, lot) for _, lot, d in rows[3 * i:3 * i + 3] if lot not in taken)
        if free:
            want[i] = free[0][1]
            taken.add(free[0][1])
    seen, plain = [], graph.components
    monkeypatch.setattr(graph, "components", lambda e, *a: (seen.append(e.count()), plain(e, *a))[1])
    got = graph.claim_lots(spark.createDataFrame(rows, "seq long, lot long, dist double"), "seq", "lot")
    assert {r["seq"]: r["lot"] for r in got.collect()} == want and seen[0] < 5_000


def test_points_and_plain_boxes(spark):
    """Boxes give the pairs and distances that their edges give."""
    from terracel.operators import spatial

    rng = np.random.default_rng(9)
    pts = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(rng.integers(0, 48, (400, 2)) / 4)], "pid long, x double, y double")
    lots = boxes(spark, [(i, 3.0 * (i % 4), 4.0 * (i // 4), 3.0 * (i % 4) + 3, 4.0 * (i // 4) + 4) for i in range(12)], "lot")
    # one corner more makes a ring that is not told apart as a box
    more = lots.withColumn("ring", F.concat("ring", F.array(F.struct(F.col("ring")[0]["x"].alias("x"), (F.col("ring")[0]["y"] + 1).alias("y")))))
    a, b = ({(r["pid"], r["lot"], r["_in"]): r["_d"] for r in spatial.points_near_polygons(pts, ls, 1.5, 2.0, "pid").collect()} for ls in (lots, more))
    assert set(a) == set(b) and all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)
    assert len(a) > 400
