"""Plans and results of queries over larger tables."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from terracel.core.lineage import cut

FOLDER = "/root/testdata/sf0.1"  # planned only: smaller tables may be broadcast whatever is done with them


def broadcast_explodes(df):
    """Lines of the plan in which rows are multiplied below a broadcast."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    found, under = [], None
    for line in text.getvalue().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if under is not None and depth <= under:
            under = None
        if under is not None and "Generate explode" in line.replace("posexplode", "explode"):
            found.append(line.strip())
        if under is None and "BroadcastExchange" in line:
            under = depth
    return found


# finding -> query whose driver held a broadcast of exploded rows
@pytest.mark.parametrize("name", ["best_neighbour", "nearest_line", "road_name_at", "along_line_distance", "land_use_overlaps", "land_use_check", "covered_area_parts", "land_use_check_parts"])
def test_exploded_rows_are_not_broadcast(spark, name):
    assert broadcast_explodes(entry.queries()[name](spark, FOLDER)) == []


def test_checkpoints_of_exploded_rows_are_not_broadcast(spark):
    rows = spark.range(100).selectExpr("id", "explode(sequence(0, 20)) AS i")
    keys = cut(rows).groupBy("id").count()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        spark.range(100_000).join(keys, "id").explain()
    assert "Broadcast" not in text.getvalue()


def test_states_of_chains_are_not_broadcast(spark):
    darts = spark.range(1000).selectExpr("0 AS net", "explode(array(id, id + 1)) AS dart").distinct()
    state = cut(darts).groupBy("net", "dart").count()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        cut(darts).join(state, ["net", "dart"]).explain()
    assert "Broadcast" not in text.getvalue()


def under_broadcasts(df, text):
    """Lines of the plan with ``text`` below a broadcast."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    found, under = [], None
    for line in out.getvalue().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        under = under if under is not None and depth > under else depth if "BroadcastExchange" in line else None
        if under is not None and text in line:
            found.append(line.strip())
    return found


def test_places_of_sections_are_not_broadcast(spark):
    assert under_broadcasts(entry.queries()["cross_sections"](spark, FOLDER), "Generate posexplode") == []


def test_lots_without_a_door_are_not_broadcast(spark):
    assert under_broadcasts(entry.queries()["frontage_vertex"](spark, FOLDER), "LeftAnti") == []


@pytest.mark.parametrize("name", ["land_use_detail", "land_use_check", "land_use_check_parts"])
def test_attributes_of_uses_are_not_broadcast(spark, name):
    # their file is small, their rows are not
    assert under_broadcasts(entry.queries()[name](spark, FOLDER), "p_partkey") == []


def test_polygon_tests_are_worked_out_once_a_pair(spark):
    from terracel.operators.spatial import points_near_polygons

    points = spark.sql("SELECT id AS pid, id / 10.0D AS x, 1.0D AS y FROM range(200)")
    square = "array(struct(0.0D AS x, 0.0D AS y), struct(9.0D AS x, 0.0D AS y), struct(9.0D AS x, 9.0D AS y), struct(0.0D AS x, 9.0D AS y))"
    near = points_near_polygons(points, spark.sql(f"SELECT 1 AS lot, {square} AS ring FROM range(1)"), 2.0, 5.0, "pid")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        near.filter("_in OR _d <= 1.0").select("pid", "lot", "_in", "_d").explain()
    assert out.getvalue().count("aggregate(") == 1
    rows = {r.pid: (r["_in"], r["_d"]) for r in near.collect()}
    assert sorted(rows) == list(range(111)) and rows[45] == (True, 0.0) and rows[110] == (False, 2.0)


def test_groups_are_those_of_the_ranks_in_order(spark):
    from terracel.operators.graph import conflict_groups

    # a hub with more neighbours than one row lists, and a ring around it
    edges = [(0, i) for i in range(1, 5001)] + [(i, i % 5000 + 1) for i in range(1, 5001)]
    nodes = spark.range(5002).withColumnRenamed("id", "node")
    hashed = {r.node: r.h for r in nodes.selectExpr("node", "xxhash64(node) AS h").collect()}
    near = {i: set() for i in range(5002)}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for i in sorted(near, key=lambda i: (-len(near[i]), hashed[i], i)):
        taken = {want[j] for j in near[i] if j in want}
        want[i] = next(g for g in range(1, 10) if g not in taken)
    got = conflict_groups(nodes, spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.grp for r in got.collect()} == want
