"""Kernels against plain NumPy, with hot groups forced by low limits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracel.core.grid import box_pairs, nearest
from terracel.core.numbering import number_rows
from terracel.core.quantiles import exact_quantiles
from terracel.core.skew import salted_join


def frame(spark, **cols):
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame(cols)).repartition(4)


def test_quantiles_exact_for_hot_and_small_groups(spark):
    rng = np.random.default_rng(1)
    key = np.where(np.arange(60000) % 3 == 0, 0, np.arange(60000) % 50)
    val = np.round(rng.lognormal(size=60000), 3)
    probs = [0.0, 0.02, 0.5, 0.95, 1.0]
    got = exact_quantiles(frame(spark, k=key, v=val), ["k"], "v", probs, "q", hot_rows=5000).collect()
    assert len(got) == len(set(key))
    for r in got:
        assert r["n"] == (key == r["k"]).sum()
        np.testing.assert_allclose(r["q"], np.quantile(val[key == r["k"]], probs), rtol=0, atol=1e-12)


def test_number_rows_hot_group_and_whole_table(spark):
    rng = np.random.default_rng(2)
    n = 5000
    key, o = np.where(rng.random(n) < 0.4, 7, rng.integers(0, 30, n)), rng.integers(0, 900, n)
    df = frame(spark, k=key, o=o, id=np.arange(n))
    for keys, limit in ((["k"], 100), ([], 10)):
        rows = number_rows(df, keys, "o", ["id"], "rn", slices=16, hot_rows=limit).collect()
        groups = {}
        for r in sorted(rows, key=lambda r: (r["o"], r["id"])):
            g = r["k"] if keys else 0
            groups[g] = groups.get(g, 0) + 1
            assert r["rn"] == groups[g]
        assert len(rows) == n


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    n = 4000
    left = frame(spark, k=np.where(np.arange(n) % 3 == 0, 1, np.arange(n) % 40), id=np.arange(n))
    right = frame(spark, k=np.arange(0, 40, 2), w=np.arange(20))
    a = salted_join(left, right, ["k"], ["id"], how, rows_per_salt=50)
    b = left.join(right, "k", how)
    cols = sorted(b.columns)
    assert sorted(map(tuple, a.select(*cols).collect()), key=str) == sorted(map(tuple, b.select(*cols).collect()), key=str)


@pytest.mark.parametrize("dense", [2000, 40])
def test_nearest_plain_and_narrowed(spark, dense):
    rng = np.random.default_rng(3)
    l, r = rng.random((300, 2)) * 40, rng.random((400, 2)) * 40
    r[:150] = r[0] + rng.random((150, 2)) * 0.3  # a crowded spot
    r[150:200] = r[150]  # copies
    left = frame(spark, lid=np.arange(300), x=l[:, 0], y=l[:, 1])
    right = frame(spark, rid=np.arange(400), rx=r[:, 0], ry=r[:, 1])
    got = {x["lid"]: (x["rid"], x["dist"]) for x in nearest(left, right, 3.0, "lid", "rid", dense=dense).collect()}
    d = np.hypot(l[:, None, 0] - r[None, :, 0], l[:, None, 1] - r[None, :, 1])
    for i in range(300):
        j = d[i].argmin()
        if d[i, j] <= 3.0:
            assert got[i][1] == pytest.approx(d[i, j]) and d[i, got[i][0]] == pytest.approx(d[i, j])
        else:
            assert i not in got


def test_box_pairs_once_each(spark):
    rng = np.random.default_rng(4)
    b = rng.random((120, 2)) * 50
    s = rng.random((120, 2)) * 9
    df = frame(spark, i=np.arange(120), a=b[:, 0], b=b[:, 1], c=b[:, 0] + s[:, 0], d=b[:, 1] + s[:, 1])
    other = df.select(*[F.col(c).alias("o" + c) for c in df.columns])
    got = sorted((r["i"], r["oi"]) for r in box_pairs(df, other, "abcd", ["oa", "ob", "oc", "od"], 4.0, ["i"]).collect())
    e = b + s
    want = sorted((i, j) for i in range(120) for j in range(120) if (b[i] <= e[j]).all() and (b[j] <= e[i]).all())
    assert got == want
