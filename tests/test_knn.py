"""Neighbour search through the cell tree against all pairs."""

import numpy as np
import pytest
from terracel.core import knn
from terracel.operators import ground


def plain(xyz, k):
    d = np.sqrt(((xyz[:, None, :] - xyz[None, :, :]) ** 2).sum(axis=2))
    d.sort(axis=1)
    return d[:, 1 : k + 1].mean(axis=1)


def frame(spark, xyz):
    return spark.createDataFrame([tuple(map(float, p)) for p in xyz], "x double, y double, z double")


def compare(spark, xyz, k):
    got = {(r["x"], r["y"], r["z"]): r["mean_d"] for r in ground.mean_neighbour_distance(frame(spark, xyz), k).collect()}
    want = plain(xyz, min(k, len(xyz) - 1))
    assert len(got) == len({tuple(p) for p in xyz.tolist()})
    for p, w in zip(xyz.tolist(), want, strict=True):
        assert got[tuple(p)] == pytest.approx(w, rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("k", [6])
def test_mixed_cloud(spark, k):
    """A crowd, a sparse plain, a line, copies, and points far away from everything."""
    rng = np.random.default_rng(k)
    parts = [rng.normal(0, 0.001, (300, 3)), rng.uniform(-50, 50, (200, 3)), np.c_[np.arange(60), np.zeros((60, 2))], np.repeat(rng.uniform(0, 9, (7, 3)), 5, axis=0)]
    far = np.array([[1e5, 0, 0], [-3e4, 2e4, 7], [1e5, 0, 1]])
    compare(spark, np.concatenate([*parts, far]), k)


def test_degenerate_clouds(spark):
    compare(spark, np.zeros((40, 3)) + [[i % 2, 0, 0] for i in range(40)], 3)
    compare(spark, np.array([[0.0, 0, 0], [1, 1, 1]]), 5)
    one = ground.mean_neighbour_distance(frame(spark, np.zeros((1, 3))), 5).collect()
    assert [r["mean_d"] for r in one] == [0.0] and ground.mean_neighbour_distance(frame(spark, np.zeros((1, 3))).limit(0), 5).count() == 0


def test_a_lonely_point_opens_few_cells_of_a_crowd(spark):
    """10^5 points in one cell and one far point: leaves that meet are linear in the points."""
    rng = np.random.default_rng(3)
    xyz = np.concatenate([rng.uniform(0, 1, (100_000, 3)), [[1e6, 1e6, 0.0]]])
    spots = frame(spark, xyz).selectExpr("x", "y", "z", "1L as copies")
    tree = knn.cell_tree(spots)
    pairs = knn.candidate_leaves(tree, 6)
    n_leaves = tree.leaves.count()
    lonely = tree.leaves.filter("members[0].x > 1000").select(*knn.CELL)
    assert lonely.count() == 1 and pairs.join(lonely, list(knn.CELL)).count() < 2_000
    assert pairs.count() < 150 * n_leaves
    got = knn.mean_nearest(spots, 6).filter("x > 1000").first()["mean_d"]
    d = np.sort(np.sqrt(((xyz[:-1] - xyz[-1]) ** 2).sum(axis=1)))[:6].mean()
    assert got == pytest.approx(d, rel=1e-12)


def test_a_cell_opens_few_cells(spark):  # F6
    """Even points: no leaf meets all cells of a wide round, and the members of a leaf bound what it meets."""
    rng = np.random.default_rng(5)
    spots = frame(spark, rng.uniform(0, 1, (4_000, 3))).selectExpr("x", "y", "z", "1L as copies")
    tree = knn.cell_tree(spots)
    assert tree.rounds[1].count() <= 8
    assert knn.candidate_leaves(tree, 6).count() < 70 * tree.leaves.count()
