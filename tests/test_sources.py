"""Readers, writers and incremental runs on small files."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracel.sources import las, sinks, tables
from terracel.streaming import incremental


def write_las(path, xyz, cls, fmt=1):
    size = {0: 20, 1: 28}[fmt]
    head = bytearray(227)
    head[0:4], head[24], head[25], head[104] = b"LASF", 1, 2, fmt
    struct.pack_into("<I", head, 96, 227)
    struct.pack_into("<H", head, 105, size)
    struct.pack_into("<I", head, 107, len(xyz))
    lo, hi = xyz.min(0), xyz.max(0)
    struct.pack_into("<12d", head, 131, 0.01, 0.01, 0.01, 0, 0, 0, hi[0], lo[0], hi[1], lo[1], hi[2], lo[2])
    body = b""
    for i, (p, c) in enumerate(zip(np.round(xyz * 100).astype(int), cls)):
        rec = struct.pack("<iiiHBBbBH", *p.tolist(), 100 + i, 1 | (2 << 3), c, -5, 0, 17)
        body += rec + (struct.pack("<d", float(i)) if fmt == 1 else b"")
    path.write_bytes(bytes(head) + body)


def test_bounds_reach_the_point_scan(spark, tmp_path):
    """Files out of the bounds are not read beyond their header: one here has no records left to read."""
    rng = np.random.default_rng(1)
    sets = {}
    for k in range(4):
        xyz = np.round(rng.random((40, 3)) * 10 + [100 * k, 0, 0], 2)
        write_las(tmp_path / f"t{k}.las", xyz, rng.integers(1, 8, 40), 1)
        sets[f"t{k}.las"] = xyz
    whole = (tmp_path / "t3.las").read_bytes()
    pts = las.read_points(spark, str(tmp_path), records_per_partition=15)
    got = pts.filter("x >= 100.5 AND x < 208 AND y <= 7.25 AND classification <> 3").select("tile_id", "x", "y", "z").collect()
    plain = pts.select("tile_id", "x", "y", "z", "classification").collect()
    want = [r for r in plain if 100.5 <= r["x"] < 208 and r["y"] <= 7.25 and r["classification"] != 3]
    assert sorted((r["tile_id"], r["x"], r["y"], r["z"]) for r in got) == sorted((r["tile_id"], r["x"], r["y"], r["z"]) for r in want) and want
    edge = float(sets["t1.las"][:, 0].max())
    assert pts.filter(F.col("x") == edge).count() == int((sets["t1.las"][:, 0] == edge).sum())
    (tmp_path / "t3.las").write_bytes(whole[:227] + b"\0" * 7)
    again = las.read_points(spark, str(tmp_path), records_per_partition=15)
    assert again.filter("x < 290").count() == 120


def test_las_points_and_headers(spark, tmp_path):
    rng = np.random.default_rng(0)
    sets = {}
    for name, fmt in (("a.las", 0), ("b.las", 1)):
        xyz, cls = np.round(rng.random((25, 3)) * 100, 2), rng.integers(1, 8, 25)
        write_las(tmp_path / name, xyz, cls, fmt)
        sets[name] = (xyz, cls)
    got = las.read_points(spark, str(tmp_path), records_per_partition=10).toPandas().sort_values(["tile_id", "pid"])
    for name, (xyz, cls) in sets.items():
        g = got[got.tile_id == name]
        np.testing.assert_allclose(g[["x", "y", "z"]].to_numpy(), xyz, atol=1e-9)
        assert g.classification.tolist() == cls.tolist() and set(g.number_of_returns) == {2} and set(g.point_source_id) == {17}
    assert got[got.tile_id == "b.las"].gps_time.tolist() == list(range(25))
    h = {r["path"].split("/")[-1]: r for r in las.read_point_headers(spark, str(tmp_path)).collect()}
    assert h["a.las"]["n"] == 25 and h["a.las"]["maxx"] == sets["a.las"][0][:, 0].max()


def test_survey_file(spark, tmp_path):
    (tmp_path / "s.txt").write_text("TYPE;E;N;Z\n1 PV 123;345678.12;7654321.98;850.5\nTV;345680.00;7654320.00;850.0\nARVORE;345690.00;7654330.00;851.2\n")
    rows = tables.read_survey_points(spark, str(tmp_path)).orderBy("seq").collect()
    assert len(rows) == 3 and rows[0]["type"] == "1 PV 123" and rows[2]["z"] == 851.2


def test_strict_control_raises(spark, tmp_path):
    (tmp_path / "c.txt").write_text("1 2 0.5\n\n3 x 1\n4 5\n")
    assert tables.read_xydz(spark, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="bad control line"):
        tables.read_xydz(spark, str(tmp_path), strict=True).collect()


def test_json_readers(spark, tmp_path):
    (tmp_path / "m.json").write_text("﻿" + json.dumps({"2": 0, "6": 1}), encoding="utf-8")
    assert {tuple(r) for r in tables.read_class_map(spark, str(tmp_path / "m.json")).collect()} == {(2, 0), (6, 1)}
    (tmp_path / "l.json").write_text("[7, 13]")
    assert {r[0] for r in tables.read_class_list(spark, str(tmp_path / "l.json")).collect()} == {7, 13}
    sq = lambda o, s: [[[o, 0], [o + s, 0], [o + s, s], [o, s], [o, 0]]]
    feats = [
        {"type": "Feature", "properties": {"n": "a"}, "geometry": {"type": "Polygon", "coordinates": sq(0, 2)}},
        {"type": "Feature", "properties": {"n": "Estrada X"}, "geometry": {"type": "MultiPolygon", "coordinates": [sq(0, 1), sq(5, 3)]}},
        {"type": "Feature", "properties": {"n": "p"}, "geometry": {"type": "Point", "coordinates": [1, 1]}},
        {"type": "Feature", "properties": {"n": "z"}, "geometry": None},
    ]
    (tmp_path / "f.geojson").write_text("\n".join(json.dumps(f) for f in feats))
    f = tables.read_features(spark, str(tmp_path / "f.geojson"))
    rest, roads = tables.split_roads(f, F.col("properties")["n"])
    assert rest.count() == 1 and len(rest.first()["ring"]) == 4
    assert [p["x"] for p in roads.first()["ring"]] == [5, 8, 8, 5]


def test_log_and_files(spark, tmp_path):
    (tmp_path / "log.csv").write_text("a\nb\nc\n DATA , PILOT\n2024-01-05,x\nsoon,y\n")
    rows = tables.read_log_table(spark, str(tmp_path / "log.csv"), "DATA").orderBy("seq").collect()
    assert [str(r["DATA"]) for r in rows] == ["2024-01-05", "None"] and rows[1]["PILOT"] == "y"
    sub = tmp_path / "x" / "y"
    sub.mkdir(parents=True)
    (sub / "t.las").write_bytes(b"abc")
    files = tables.list_files(spark, str(tmp_path), "*.las").collect()
    assert len(files) == 1 and files[0]["length"] == 3
    (tmp_path / "notes").mkdir()
    (tmp_path / "notes" / "a.txt").write_text("9,9")
    (tmp_path / "notes" / "Altura Antena.txt").write_text("altura antena 1,532 m")
    assert tables.read_antenna_height(spark, str(tmp_path / "notes")).first()["height"] == 1.532


def test_writers(spark, tmp_path):
    p = spark.createDataFrame([("t", 1, "A", 1.0, 2.0, 3.0)], "product string, lote int, bloco string, x double, y double, z double")
    sinks.write_products(p, str(tmp_path / "p"))
    assert (tmp_path / "p" / "product=t" / "lote=01" / "bloco=A").exists()
    sinks.write_xyz(p, str(tmp_path / "xyz"), "bloco")
    assert spark.read.text(str(tmp_path / "xyz")).first()["value"] == "1.000 2.000 3.000"
    sinks.write_report(p, str(tmp_path / "r"), ["y", "nope", "x"])
    assert spark.read.csv(str(tmp_path / "r"), header=True).columns == ["y", "nope", "x"]
    for _ in range(2):
        sinks.append_experiment(p, str(tmp_path / "e"), ["id", "x"])
    assert spark.read.csv(str(tmp_path / "e"), header=True, sep=";").count() == 2
    sinks.write_metrics_json(p, str(tmp_path / "m"))
    assert json.loads(spark.read.text(str(tmp_path / "m")).first()[0])["lote"] == 1


def test_incremental_runs(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    day = lambda lo, hi: spark.range(lo, hi).select((F.col("id") % 5).alias("day"), F.col("id").alias("seq"))
    day(0, 10).write.parquet(src)
    run = lambda: incremental.process_new_files(spark, src, "day long, seq long", lambda d: d.filter("seq >= 5"), out, ck)
    assert run() == 1 and run() == 0
    day(10, 20).write.mode("append").parquet(src)
    assert run() == 1 and spark.read.parquet(out).count() == 15
    reg, ck2 = str(tmp_path / "reg"), str(tmp_path / "ck2")
    incremental.register_days(spark, src, "day long, seq long", reg, ck2)
    day(20, 22).write.mode("append").parquet(src)
    incremental.register_days(spark, src, "day long, seq long", reg, ck2)
    assert {r["day"]: r["seq"] for r in incremental.latest_registry(spark, reg).collect()} == {0: 20, 1: 21, 2: 17, 3: 18, 4: 19}


def test_features_with_holes_and_collections(spark, tmp_path):
    ring = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    a = {"type": "Feature", "properties": {"n": "a"}, "geometry": {"type": "Polygon", "coordinates": [ring(0, 0, 10), ring(2, 2, 6)]}}
    b = {"type": "Feature", "properties": {"n": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring(0, 0, 1)], [ring(20, 0, 4), ring(21, 1, 1), ring(22, 2, 1)]]}}
    doc = {"type": "FeatureCollection", "features": [a, b]}
    (tmp_path / "one.geojson").write_text(json.dumps(doc))
    (tmp_path / "many.geojson").write_text(json.dumps(doc, indent=1))
    for name, multiline in (("one", False), ("many", True)):
        f = tables.read_features(spark, str(tmp_path / f"{name}.geojson"), multiline=multiline).withColumn("id", F.col("properties")["n"])
        assert {r["id"]: r["area"] for r in f.collect()} == {"a": 64.0, "b": 15.0}
        parts = tables.feature_parts(f, "id").collect()
        assert sorted((r["id"], r["part"], len(r["holes"]), r["area"]) for r in parts) == [("a", 0, 1, 64.0), ("b", 0, 0, 1.0), ("b", 1, 2, 14.0)]
    with pytest.raises(Exception, match="neither a Feature"):
        tables.read_features(spark, str(tmp_path / "many.geojson")).collect()


def test_logs_with_headers_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1\n2\n3\nDATA,PILOT\n05/01/2024,"x, y"\n')
    (tmp_path / "b.csv").write_text("1\n2\n3\nPLANE, DATA\np1,2024-01-06\n")
    rows = tables.read_log_table(spark, str(tmp_path), "DATA").collect()
    got = {(str(r["DATA"]), r["PILOT"], r["PLANE"]) for r in rows}
    assert got == {("2024-01-05", "x, y", None), ("2024-01-06", None, "p1")}
