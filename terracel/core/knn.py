"""Nearest neighbours in space that survive crowds and lonely points: blocks of bounded size, or a tree of cells, searched cell by cell."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import cut
from .skew import checked_join

#: Positions of a block that one task searches, about, and the grid it is made of: at most so many cells along an axis.
BLOCK, GRID = 32_000, 48
#: A cell with more positions is cut; the finest cells are 2**-MOST_LEVELS of the whole.
LEAF, MOST_LEVELS = 32, 50
AXES = ("x", "y", "z")
CELL = ("level", "_i", "_j", "_k")
UP = tuple(f"_up{i}" for i in range(4))


class CellTree(NamedTuple):
    """Cells by round, from the root, and per leaf its positions.

    ``rounds[r]`` has the cell (``level, _i, _j, _k``), the cell it was cut from (``_up0`` ...), ``n`` (members, copies
    counted), ``leaf`` and the box of the members; ``leaves`` has the cell and ``members`` (array of x, y, z, copies).
    """

    rounds: list[DataFrame]
    leaves: DataFrame


def _box() -> list[Column]:
    return [f(a).alias(f"{n}{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max))]


def cell_tree(spots: DataFrame, leaf: int = LEAF) -> CellTree:
    """Tree over distinct positions ``x, y, z, copies``: a crowded cell is halved along each axis, once below the box of its members.

    Only positions of crowded cells go on to the next round, so a crowd makes the tree deep where it is and
    costs nothing elsewhere.  A cell has at most 8 cells below it, so opening one adds few pairs.
    """
    ext = spots.agg(*_box()).first()
    if ext["lox"] is None:
        return CellTree([], spots.sparkSession.createDataFrame([], "level int, _i long, _j long, _k long, members array<struct<x:double,y:double,z:double,copies:bigint>>"))
    side = max(ext[f"hi{a}"] - ext[f"lo{a}"] for a in AXES) * (1 + 1e-9) or 1.0
    whole = [F.lit(0).alias("level"), *[F.lit(0).cast("long").alias(c) for c in CELL[1:]]]
    open_ = spots.select(*AXES, "copies", *whole, *[c.alias(u) for c, u in zip(whole, UP, strict=True)])
    rounds, members = [], None
    while True:
        crowd = (F.count(F.lit(1)) > leaf) & (F.col("level") < MOST_LEVELS)
        # halvings down to the size of the members' box, and one more
        extent = F.greatest(*[F.max(a) - F.min(a) for a in AXES])
        spare = F.coalesce(F.floor(F.log2(F.lit(side) / F.pow(F.lit(2.0), F.col("level")) / F.nullif(extent, F.lit(0.0)))), F.lit(0))
        steps = F.greatest(spare, F.lit(0)) + 1
        steps = F.least(steps.cast("int"), F.lit(MOST_LEVELS) - F.col("level"))
        cells = cut(open_.groupBy(*CELL, *UP).agg(F.sum("copies").alias("n"), (~crowd).alias("leaf"), steps.alias("_steps"), *_box()))
        rounds.append(cells)
        crowded = cells.filter("NOT leaf").select(*CELL, "_steps")
        n = crowded.count()
        settled = checked_join(open_, crowded, n, CELL, AXES, "left_anti").select(*CELL, F.struct(*AXES, "copies").alias("_m"))
        members = settled if members is None else members.unionByName(settled)
        if not n:
            return CellTree(rounds, cut(members.groupBy(*CELL).agg(F.collect_list("_m").alias("members"))))
        inner = checked_join(open_, crowded, n, CELL, AXES)
        width = F.lit(side) / F.pow(F.lit(2.0), F.col("level") + F.col("_steps"))
        part = [F.floor((F.col(a) - F.lit(ext[f"lo{a}"])) / width).cast("long").alias(c) for a, c in zip(AXES, CELL[1:], strict=True)]
        open_ = cut(inner.select(*AXES, "copies", (F.col("level") + F.col("_steps")).alias("level"), *part, *[F.col(c).alias(u) for c, u in zip(CELL, UP, strict=True)]))


def _gap(far: bool) -> Column:
    """Least or greatest distance between the boxes ``lo*, hi*`` and ``_lo*, _hi*``."""
    parts = []
    for a in AXES:
        lo, hi, _lo, _hi = (F.col(f"{p}{a}") for p in ("lo", "hi", "_lo", "_hi"))
        parts.append(F.greatest(hi - _lo, _hi - lo) if far else F.greatest(_lo - hi, lo - _hi, F.lit(0.0)))
    return F.sqrt(parts[0] * parts[0] + parts[1] * parts[1] + parts[2] * parts[2])


def _own_reach(need: int) -> Column:
    """Distance within which every member of a leaf has ``need`` others of the leaf; null if they are too few."""
    def kth(m):
        gap = lambda o: F.sqrt((m["x"] - o["x"]) * (m["x"] - o["x"]) + (m["y"] - o["y"]) * (m["y"] - o["y"]) + (m["z"] - o["z"]) * (m["z"] - o["z"]))
        return F.get(F.sort_array(F.transform("members", gap)), F.lit(need))

    return F.when(F.size("members") > need, F.array_max(F.transform("members", kth)) * (1 + 1e-9))


def candidate_leaves(tree: CellTree, need: int) -> DataFrame:
    """Pairs of leaves, the cell of one and ``to`` (the other's), such that the ``need`` nearest others of every
    position of the first lie in the paired ones.

    Pairs of cells go from the root down, both sides opened at once, so a round has pairs by its cells and not by
    all leaves.  Cells whose farthest corners are near enough to hold ``need`` + 1 members bound the distance, and
    cells beyond that bound go; at the end the members of a leaf itself bound it.  Boxes are those of the
    members, so a lonely point is exact from the start.
    """
    boxes = [f"{n}{a}" for a in AXES for n in ("lo", "hi")]
    facts = [*CELL, "n", "leaf", *boxes]
    other = [f"_{c}" for c in facts]
    theirs = [F.col(c).alias(o) for c, o in zip(facts, other, strict=True)]
    diagonal = _gap(True)  # of a cell with itself, as pairs of the root are
    root = tree.rounds[0]
    now = root.select(*facts).crossJoin(F.broadcast(root.select(*theirs))).withColumn("_reach", diagonal)  # one row
    for deeper in tree.rounds[1:]:
        m = deeper.count()
        up = [F.col(u).alias(f"_p{i}") for i, u in enumerate(UP)]
        on = [f"_p{i}" for i in range(4)]

        def opened(pairs, side, below, m=m, on=on):
            """Pairs whose cell of one side is a leaf, and those with the cells below it."""
            whole = pairs.withColumns({o: F.col(c) for c, o in zip(side, on, strict=False)}).filter(f"NOT {side[5]}").drop(*side)
            return pairs.filter(side[5]).unionByName(checked_join(whole, below, m, on, [next(c for c in whole.columns if c.endswith("_i"))]).drop(*on))

        now = opened(now, facts, deeper.select(*facts, *up))
        own = F.sqrt(sum(((F.col(f"hi{a}") - F.col(f"lo{a}")) * (F.col(f"hi{a}") - F.col(f"lo{a}")) for a in AXES), F.lit(0.0)))
        now = now.withColumn("_reach", F.when(F.col("n") > need, F.least("_reach", own * (1 + 1e-9))).otherwise(F.col("_reach")))
        now = opened(now, other, deeper.select(*theirs, *up)).withColumn("_g", _gap(False)).filter("_g <= _reach")
        per = now.groupBy(*CELL).agg(
            *[F.first(c).alias(c) for c in (*facts[4:], "_reach")], F.collect_list(F.struct(*other, "_g", _gap(True).alias("d"))).alias("_met"))
        # the least distance within which there are need + 1 members, the position itself included
        far = F.array_sort(F.transform("_met", lambda o: F.struct(o["d"].alias("d"), o["_n"].alias("n"))))
        reach = F.aggregate(far, F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("d")), lambda acc, x: F.struct(
            (acc["n"] + x["n"]).alias("n"), F.when(acc["n"] >= need + 1, acc["d"]).otherwise(x["d"]).alias("d")), lambda acc: acc["d"])
        per = per.withColumn("_reach", F.least("_reach", reach * (1 + 1e-9)))
        per = per.withColumn("_m", F.explode(F.filter("_met", lambda o: o["_g"] <= F.col("_reach"))))
        now = cut(per.select(*facts, "_reach", *[F.col(f"_m.{o}").alias(o) for o in other]))
    near = now.join(tree.leaves.select(*CELL, _own_reach(need).alias("_own")), list(CELL)).filter(F.col("_own").isNull() | (_gap(False) <= F.col("_own")))
    return near.select(*CELL, F.struct(*[F.col(f"_{c}").alias(c) for c in CELL]).alias("to"))


def _blocks(counts: np.ndarray, width: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Boxes of grid cells (first, end, positions), halved along the longest side until they hold at most ``most`` or are one cell."""
    todo, out = [(np.zeros(3, int), np.array(counts.shape))], []
    while todo:
        lo, hi = todo.pop()
        part = counts[tuple(slice(a, b) for a, b in zip(lo, hi, strict=True))]
        n, side = int(part.sum()), (hi - lo) * width
        if n <= most or (hi - lo).max() == 1:
            if n:
                out.append((lo, hi, n))
            continue
        axis = int(np.argmax(np.where(hi - lo > 1, side, -1.0)))
        run = part.sum(axis=tuple(i for i in range(3) if i != axis)).cumsum()
        at = int(np.clip(np.argmin(np.abs(run * 2 - n)) + 1, 1, hi[axis] - lo[axis] - 1))
        left, right = hi.copy(), lo.copy()
        left[axis] = right[axis] = lo[axis] + at
        todo += [(lo, left), (right, hi)]
    return out


def _sum_of_first(d: np.ndarray, copies: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the ``need`` least distances (rows of ``d`` ascending, copies counted) and the last of them, infinite if there are fewer."""
    have = np.minimum(np.cumsum(copies, axis=1), need)
    taken = np.diff(have, axis=1, prepend=0)
    total = np.where(taken > 0, taken * np.where(taken > 0, d, 0.0), 0.0).sum(axis=1)
    last = np.take_along_axis(d, np.argmax(have == need, axis=1)[:, None], axis=1)[:, 0]
    return total, np.where(have[:, -1] == need, last, np.inf)


def _search(at: np.ndarray, copies: np.ndarray, core: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """For the ``core`` positions of a block, the sum of distances to the ``need`` nearest others of the block and the greatest of them.

    Positions are halved along the longest side into leaves; members of a leaf bound how far others may lie, and
    only leaves that near are compared.
    """
    n, nothing = len(at), 1e150
    levels = max(0, int(np.ceil(np.log2(n / max(16, 2 * (need + 1))))))
    size = -(-n // 2**levels)
    at = np.concatenate([at, np.full((size * 2**levels - n + 1, 3), nothing)])
    copies = np.concatenate([copies, np.zeros(len(at) - n, copies.dtype)])
    core = np.concatenate([core, np.zeros(len(at) - n, bool)])
    empty = len(at) - 1
    order = np.arange(empty)[None, :]

    def box(order):
        real = (order < n)[:, :, None]
        return np.where(real, at[order], np.inf).min(axis=1), np.where(real, at[order], -np.inf).max(axis=1)

    for _ in range(levels):
        lo, hi = box(order)
        axis = np.argmax(hi - lo, axis=1)
        half = order.shape[1] // 2
        by = np.argpartition(at[order, axis[:, None]], half, axis=1)
        order = np.take_along_axis(order, by, axis=1).reshape(-1, half)
    lo, hi = box(order)
    asked = np.flatnonzero(core[order].any(axis=1))
    # squares of distances, one axis at a time
    between = lambda p, q: sum((at[p, i][:, :, None] - at[q, i][:, None, :]) ** 2 for i in range(3))
    reach = np.full(len(order), np.inf)
    if size > need:
        for part in np.array_split(asked, max(1, len(asked) * size * size // 2_000_000)):
            kth = np.partition(between(order[part], order[part]), need, axis=2)[:, :, need]
            reach[part] = np.where(core[order[part]], kth, 0.0).max(axis=1) * (1 + 1e-9)
    total, last = np.zeros(len(at)), np.full(len(at), np.inf)
    order = np.concatenate([order, np.full((1, size), empty)])
    single, width = copies.max() == 1, need + 1
    for part in np.array_split(asked, max(1, len(asked) * len(lo) // 500_000)):
        gap = sum(np.maximum(0.0, np.maximum(lo[None, :, i] - hi[part, None, i], lo[part, None, i] - hi[None, :, i])) ** 2 for i in range(3))
        near = gap <= reach[part, None]
        many = near.sum(axis=1)
        by = np.argsort(many, kind="stable")
        start = 0
        while start < len(by):
            # leaves with about as many leaves near them go together
            end = start + 1
            while end < len(by) and many[by[end]] * (end + 1 - start) * size * size <= 2_000_000 and many[by[end]] <= 1.3 * many[by[start]] + 2:
                end += 1
            rows = by[start:end]
            most = int(many[rows].max())
            which = np.full((len(rows), most), len(order) - 1)
            i, j = np.nonzero(near[rows])
            which[i, np.concatenate([np.arange(m) for m in many[rows]])] = j
            mine, theirs = order[part[rows]], order[which].reshape(len(rows), -1)
            d = between(mine, theirs)
            if single:
                d = np.partition(d, min(need, d.shape[2] - 1), axis=2)[:, :, :width]
                d.sort(axis=2)
                d = np.sqrt(d[:, :, 1:].reshape(mine.size, -1))
                c = (d < 1e100).astype(np.int64)
            else:
                first = np.argpartition(d, min(need, d.shape[2] - 1), axis=2)[:, :, :width]
                c = copies[theirs[np.arange(len(rows))[:, None, None], first]]
                d = np.take_along_axis(d, first, axis=2)
                up = np.argsort(d, axis=2, kind="stable")
                d, c = np.sqrt(np.take_along_axis(d, up, axis=2)), np.take_along_axis(c, up, axis=2)
                c[:, :, 0] -= 1  # the position itself; distinct ones lie apart
                d, c = d.reshape(mine.size, -1), c.reshape(mine.size, -1)
            if not d.shape[1]:
                d, c = np.full((mine.size, 1), np.inf), np.zeros((mine.size, 1), np.int64)
            total[mine.ravel()], last[mine.ravel()] = _sum_of_first(d, c, need)
            start = end
    last[empty] = np.inf
    return total[:n][core[:n]], last[:n][core[:n]]


def mean_nearest(spots: DataFrame, need: int, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """``x, y, z, copies, mean_d``: mean distance of each position to its ``need`` nearest other points.

    Copies of a position are neighbours at distance 0.  There must be more than ``need`` points.  Positions are dealt into
    blocks of about ``block``, each with a border of its surroundings, and a block is searched by one task.  Where the
    neighbours found lie beyond the border, all blocks within their distance are asked.  Clouds of which one cell
    of a coarse grid is crowded go through the tree of cells.
    """
    ext = spots.agg(*_box(), F.count(F.lit(1)).alias("n")).first()
    if not ext["n"]:
        return _mean_nearest_by_tree(spots, need, leaf)
    low = np.array([ext[f"lo{a}"] for a in AXES])
    extent = np.array([ext[f"hi{a}"] for a in AXES]) - low
    along = int(min(GRID, max(1, np.ceil((64 * ext["n"] / block) ** (1 / 3)))))
    shape = np.where(extent > 0, along, 1)
    width = np.where(extent > 0, extent / shape, 1.0)
    cells = [F.least(F.floor((F.col(a) - float(lo)) / float(w)).cast("int"), F.lit(int(n) - 1)).alias(c) for a, lo, w, n, c in zip(AXES, low, width, shape, CELL[1:], strict=True)]
    laid = spots.select(*AXES, "copies", *cells)
    held = laid.groupBy(*CELL[1:]).count().toPandas()  # at most GRID ** 3 rows
    if held["count"].max() > 2 * block:
        return _mean_nearest_by_tree(spots, need, leaf)
    counts = np.zeros(shape, np.int64)
    counts[tuple(held[c] for c in CELL[1:])] = held["count"]
    bounds, places = {}, []
    for b, (first, end, n) in enumerate(_blocks(counts, width, block)):
        lo, hi = low + first * width, low + end * width
        flat = np.maximum(hi - lo, (hi - lo).max() * 1e-6 or 1.0)
        border = 2.2 * (3 * (need + 1) / (4 * np.pi) * flat.prod() / n) ** (1 / 3)
        # nothing lies beyond the cloud
        bounds[b] = (np.where(first == 0, -np.inf, lo - border), np.where(end == shape, np.inf, hi + border), lo, hi)
        wide = np.maximum(first - np.ceil(border / width).astype(int) - 1, 0), np.minimum(end + np.ceil(border / width).astype(int) + 1, shape)
        at = np.argwhere(counts[tuple(slice(i, j) for i, j in zip(*wide, strict=True))]) + wide[0]
        own = ((at >= first) & (at < end)).all(axis=1)
        places.append(pd.DataFrame({"_i": at[:, 0], "_j": at[:, 1], "_k": at[:, 2], "block": b, "core": own, **{f"{s}{a}": float(v[i]) for s, v in zip(("l", "h"), bounds[b][:2], strict=True) for i, a in enumerate(AXES)}}))
    spark = spots.sparkSession
    # rows by cells of the grid, a few for each: bounded as they are
    table = F.broadcast(spark.createDataFrame(pd.concat(places, ignore_index=True), "_i int, _j int, _k int, block int, core boolean, " + ", ".join(f"{s}{a} double" for s in "lh" for a in AXES)))
    within = F.lit(True)
    for a in AXES:
        within = within & F.col(a).between(F.col(f"l{a}"), F.col(f"h{a}"))
    dealt = laid.join(table, list(CELL[1:])).filter(F.col("core") | within).select("block", "core", *AXES, "copies")

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        at, core = pdf[list(AXES)].to_numpy(), pdf["core"].to_numpy()
        total, last = _search(at, pdf["copies"].to_numpy(), core, need)
        lo, hi = bounds[int(pdf["block"].iloc[0])][:2]
        room = np.minimum(at[core] - lo, hi - at[core]).min(axis=1) * (1 - 1e-9)
        out = pdf.loc[core, [*AXES, "copies"]]
        return out.assign(mean_d=total / need, reach=np.where(last <= room, -1.0, last))

    found = cut(dealt.groupBy("block").applyInPandas(settle, "x double, y double, z double, copies long, mean_d double, reach double"))
    settled, open_ = found.filter("reach < 0").select(*AXES, "copies", "mean_d"), found.filter("reach >= 0")
    if open_.isEmpty():
        return settled
    boxes = spark.createDataFrame([(b, *map(float, v[2]), *map(float, v[3])) for b, v in bounds.items()], "block int, " + ", ".join(f"{s}{a} double" for s in "lh" for a in AXES))
    away = [F.greatest(F.col(f"l{a}") - F.col(a), F.col(a) - F.col(f"h{a}"), F.lit(0.0)) for a in AXES]
    met = F.sqrt(away[0] * away[0] + away[1] * away[1] + away[2] * away[2]) <= F.col("reach") * (1 + 1e-9)
    asks = cut(open_.drop("mean_d").crossJoin(F.broadcast(boxes)).filter(met).select("block", *AXES, "copies"))  # one row a block
    hit = F.broadcast(spark.createDataFrame([(r[0],) for r in asks.select("block").distinct().collect()], "block int"))
    members = dealt.filter("core").join(hit, "block").select("block", *AXES, "copies")

    def answer(points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        at, copies, out = points[list(AXES)].to_numpy(), points["copies"].to_numpy(), []
        for part in np.array_split(np.arange(len(asked)), max(1, len(asked) * max(len(at), 1) // 2_000_000)):
            q = asked.iloc[part]
            p = q[list(AXES)].to_numpy()
            d = sum((p[:, None, i] - at[None, :, i]) ** 2 for i in range(3))
            first = np.argpartition(d, min(need, len(at) - 1), axis=1)[:, : need + 1] if len(at) else np.zeros((len(q), 0), int)
            d, c = np.sqrt(np.take_along_axis(d, first, axis=1)), copies[first]
            c = c - (d == 0)  # the position itself
            out.append(q.drop(columns="block").assign(d=list(d), n=list(c)))
        return pd.concat(out)

    told = members.groupBy("block").cogroup(asks.groupBy("block")).applyInPandas(
        lambda p, q: answer(p, q) if len(q) else pd.DataFrame(columns=["x", "y", "z", "copies", "d", "n"]), "x double, y double, z double, copies long, d array<double>, n array<bigint>")
    found = F.filter(F.flatten(F.collect_list(F.arrays_zip("d", "n"))), lambda o: o["n"] > 0)
    return settled.unionByName(told.groupBy(*AXES, "copies").agg(found.alias("_f")).select(*AXES, "copies", _mean_of_first(F.col("_f"), need).alias("mean_d")))


def _mean_of_first(found: Column, need: int) -> Column:
    """Mean of the ``need`` least distances of structs ``d, n``."""
    first = F.slice(F.sort_array(found), 1, need)
    start = F.struct(F.lit(need).cast("long").alias("left"), F.lit(0.0).alias("sum"))
    total = F.aggregate(first, start, lambda acc, o: F.struct(
        (acc["left"] - F.least(acc["left"], o["n"])).alias("left"), (acc["sum"] + F.least(acc["left"], o["n"]) * o["d"]).alias("sum")), lambda acc: acc["sum"])
    return total / need


def _mean_nearest_by_tree(spots: DataFrame, need: int, leaf: int) -> DataFrame:
    """``mean_nearest`` through the tree of cells."""
    tree = cell_tree(spots, leaf)
    own = list(CELL)
    there = tree.leaves.select(F.struct(*CELL).alias("to"), F.col("members").alias("_others"))
    near = candidate_leaves(tree, need).join(there, "to").groupBy(*own).agg(F.flatten(F.collect_list("_others")).alias("_others"))
    rows = tree.leaves.join(near, own).select(F.explode("members").alias("_m"), "_others").select("_m.*", "_others")
    gap = lambda o: F.hypot(F.hypot(F.col("x") - o["x"], F.col("y") - o["y"]), F.col("z") - o["z"])
    self_ = lambda o: (o["x"] == F.col("x")) & (o["y"] == F.col("y")) & (o["z"] == F.col("z"))
    found = F.filter(F.transform("_others", lambda o: F.struct(gap(o).alias("d"), (o["copies"] - F.when(self_(o), 1).otherwise(0)).alias("n"))), lambda o: o["n"] > 0)
    return rows.select(*AXES, "copies", _mean_of_first(found, need).alias("mean_d"))
