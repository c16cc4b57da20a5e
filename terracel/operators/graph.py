"""Rule-in-order operators as rounds: thinning, claims, colouring, components, chains, hulls.

Each loop keeps a small state, cuts its lineage through the shared checkpoint folder and
stops when a round changes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..core.grid import cell
from ..core.lineage import cut
from ..core.numbering import number_rows
from ..core.skew import checked_join, exploded, salted_join
from ..functions import geometry as G


#: Undecided rows that one task settles in order.
ROWS_AT_ONCE = 50_000
#: Undecided points of a neighbouring cell that are looked at one by one.
LOOK_AT = 64
#: Edges of a block of nodes that one task settles in order, and the finest blocks: so many along either axis.
EDGES_AT_ONCE, FINEST = 4_000_000, 4096
#: Nodes that one row of a node's neighbours lists, about.
LISTED = 4096


def _settle(pts: pd.DataFrame, d: float) -> np.ndarray:
    """Which points of a block can be accepted now: rows by rank (``x, y, core``), the others wait or are too close to one.

    A point is accepted if every better point within ``d`` is known to be out, and waits if one of them waits; points
    outside the core wait always.  Of a cell of diagonal below ``d`` at most one is accepted, and behind one that
    waits all others wait.
    """
    side = d / 1.4143
    ci, cj = np.floor(pts["x"].to_numpy() / side).astype(np.int64).tolist(), np.floor(pts["y"].to_numpy() / side).astype(np.int64).tolist()
    accepted: dict[tuple[int, int], tuple[float, float]] = {}
    waiting: dict[tuple[int, int], list[tuple[float, float]]] = {}
    out = np.zeros(len(pts), bool)
    near = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if (i, j) != (0, 0)]
    for n, (x, y, core, i, j) in enumerate(zip(pts["x"].tolist(), pts["y"].tolist(), pts["core"].tolist(), ci, cj, strict=True)):
        if (i, j) in accepted:
            continue
        close = [(i + a, j + b) for a, b in near]
        if any(c in accepted and math.hypot(x - accepted[c][0], y - accepted[c][1]) < d for c in close):
            continue
        wait = not core or (i, j) in waiting
        for c in close if not wait else ():
            others = waiting.get(c, ())
            if len(others) > LOOK_AT or any(math.hypot(x - u, y - v) < d for u, v in others):
                wait = True
                break
        if wait:
            waiting.setdefault((i, j), []).append((x, y))
        else:
            accepted[i, j] = (x, y)
            out[n] = True
    return out


def thin_by_distance(
    points: DataFrame, d: float, score: str, point_id: str, keys: Sequence[str] = (), top_n: int | None = None,
    rows_at_once: int = ROWS_AT_ONCE, rounds: list | None = None,
) -> DataFrame:
    """Points taken by score descending (then id), none closer than ``d`` to an accepted one.

    In the first rounds the best undecided point of each cell competes with the best of the cells around: cells
    have a diagonal below ``d``, so a cell holds at most one accepted point and crowds are gone at once.  Then
    blocks of cells that hold at most ``rows_at_once`` undecided points, with a border of ``d`` around them, are settled in
    order, each by one task; what hangs on points beyond a border waits.  As fewer points remain, blocks grow
    until one holds them all, so a chain of points that depend on each other takes rounds by the logarithm of
    its length.  The outcome equals taking the points one after another.  ``rounds`` collects the undecided of each round.
    """
    keys = list(keys)
    side = d / 1.4143
    place = [*keys, "_i", "_j"]
    cols = points.columns
    open_ = cut(points.withColumn("_i", cell(F.col("x"), side)).withColumn("_j", cell(F.col("y"), side)))
    rank = F.struct((-F.col(score)).alias("s"), F.col(point_id).alias("id"))
    span = F.sequence(F.lit(-2), F.lit(2))

    def around(df):
        return df.withColumn("_di", F.explode(span)).withColumn("_dj", F.explode(span)).withColumn(
            "_i", F.col("_i") + F.col("_di")).withColumn("_j", F.col("_j") + F.col("_dj")).drop("_di", "_dj")

    id_type = points.schema[point_id].dataType
    nested = isinstance(id_type, StructType)
    id_kind = "string" if nested else id_type.simpleString()  # travels as text where it is a struct
    key_kinds = "".join(f"`{k}` {points.schema[k].dataType.simpleString()}, " for k in keys)

    def by_cells(open_):
        best = cut(open_.groupBy(*place).agg(F.min_by(F.struct("x", "y", point_id), rank).alias("_p"), F.min(rank).alias("_r")))
        # strongest rival among the best points of the surrounding cells
        rivals = around(best.select(*place, "_r")).groupBy(*place).agg(F.min("_r").alias("_top"))
        return best.join(rivals, place).filter(F.col("_r") <= F.col("_top")).select(
            *place, F.col("_p.x").alias("_ax"), F.col("_p.y").alias("_ay"), F.col(f"_p.{point_id}").alias("_aid"))

    def by_blocks(open_, wide):
        # a border of three cells is at least d wide
        rows = open_.select(*keys, "_i", "_j", "x", "y", (-F.col(score)).alias("_s"), F.col(point_id).alias("_aid"))
        block = lambda c, at: F.floor((F.col(c) + at) / F.lit(wide)).cast("long")
        spread = rows.withColumn("_bi", F.explode(F.sequence(block("_i", -3), block("_i", 3)))).withColumn("_bj", F.explode(F.sequence(block("_j", -3), block("_j", 3))))
        spread = spread.withColumn("core", (F.col("_bi") == block("_i", 0)) & (F.col("_bj") == block("_j", 0)))
        ranked = spread.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_bi", "_bj").orderBy("_s", "_aid"))).drop("_s")
        if nested:
            ranked = ranked.withColumn("_aid", F.to_json("_aid"))

        def settle(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("_rank").reset_index(drop=True)
            return pdf[_settle(pdf, d)][[*keys, "_i", "_j", "x", "y", "_aid"]]

        won = ranked.groupBy(*keys, "_bi", "_bj").applyInPandas(settle, f"{key_kinds}_i long, _j long, x double, y double, _aid {id_kind}")
        won = won.withColumnsRenamed({"x": "_ax", "y": "_ay"})
        return won.withColumn("_aid", F.from_json("_aid", id_type)) if nested else won

    taken, wide, round_no = None, 8, 0
    while True:
        n = open_.count()
        if rounds is not None:
            rounds.append(n)
        if not n:
            break
        wide_enough = None
        if round_no >= 2:
            while True:  # the widest blocks that a task can settle
                block = lambda c, w: F.floor(F.col(c) / F.lit(w)).cast("long")
                busiest = open_.groupBy(*keys, block("_i", wide), block("_j", wide)).count().agg(F.max("count")).first()[0]
                if busiest > rows_at_once:
                    wide //= 2
                    break
                wide_enough = wide
                if busiest == n or wide >= 1 << 40:
                    break
                wide *= 4 if busiest * 16 <= rows_at_once else 2
        won = cut(by_cells(open_) if wide_enough is None else by_blocks(open_, wide_enough))
        wide = max(wide, 8)
        round_no += 1
        taken = won if taken is None else taken.unionByName(won)
        near = around(won).groupBy(*place).agg(F.collect_list(F.struct("_ax", "_ay")).alias("_acc"))  # at most 25
        close = F.exists("_acc", lambda a: F.hypot(F.col("x") - a["_ax"], F.col("y") - a["_ay"]) < d)
        open_ = cut(
            salted_join(open_, near, place, [point_id], "left")
            .filter(F.col("_acc").isNull() | ~close).drop("_acc")
            # a point that shares its place with an accepted one is closer than d, the accepted one itself too
        )
    if taken is None:
        return points.limit(0)
    out = salted_join(points, taken.select(*keys, F.col("_aid").alias(point_id)), [*keys, point_id], [point_id], "left_semi").select(*cols)
    if top_n is not None:
        ranked = number_rows(out.withColumn("_o", -F.col(score)), keys, "_o", [point_id], "_n")
        out = ranked.filter(F.col("_n") <= top_n).drop("_o", "_n")
    return out


def _serve(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of ``seq`` one after another, each with its nearest free lot."""
    taken, out = set(), []
    for seq, group in pdf.sort_values(["seq", "dist", "lot"], kind="stable").groupby("seq", sort=False):
        for lot, dist in zip(group["lot"], group["dist"], strict=True):
            if lot not in taken:
                taken.add(lot)
                out.append((seq, lot, dist))
                break
    return pd.DataFrame(out, columns=["seq", "lot", "dist"])


def claim_lots(candidates: DataFrame, seq: str, lot: str, dist: str = "dist", rows_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """Rows in ``seq`` order, each takes its nearest lot that is still free: ``seq, lot, dist``.

    Rows that compete for a lot, directly or through others, form a component; components of at most ``rows_at_once``
    candidates are served row by row, each by one task.  In larger ones rows propose in rounds.

    First every row asks its nearest lot.  A lot ends with its earliest asker or an earlier row, so later rows lose it as a candidate;
    where rows crowd around few lots hardly any candidate is left.
    """
    c = cut(candidates.select(F.col(seq).alias("seq"), F.col(lot).alias("lot"), F.col(dist).cast("double").alias("dist")))
    n = c.count()
    while n:
        asked = c.groupBy("seq").agg(F.min(F.struct("dist", "lot")).alias("_b")).groupBy(F.col("_b.lot").alias("lot")).agg(F.min("seq").alias("_first"))
        c = cut(c.join(exploded(asked), "lot", "left").filter(F.col("_first").isNull() | (F.col("seq") <= F.col("_first"))).drop("_first"))
        before, n = n, c.count()
        if 2 * n > before:
            break
    node = lambda kind, of: F.concat(F.lit(kind), F.col(of).cast("string"))
    group = components(c.select(node("s", "seq").alias("a"), node("l", "lot").alias("b")).distinct())
    placed = cut(c.withColumn("node", node("l", "lot")).join(group, "node").drop("node"))
    sizes = placed.groupBy("comp").agg(F.count(F.lit(1)).alias("_n"))
    sized = placed.join(sizes, "comp")
    kinds = {x: c.schema[x].dataType.simpleString() for x in ("seq", "lot")}
    served = sized.filter(F.col("_n") <= rows_at_once).groupBy("comp").applyInPandas(
        lambda pdf: _serve(pdf[["seq", "lot", "dist"]]), f"seq {kinds['seq']}, lot {kinds['lot']}, dist double")
    large = cut(sized.filter(F.col("_n") > rows_at_once).select("seq", "lot", "dist"))
    if not large.isEmpty():
        served = served.unionByName(_claim_by_rounds(large, "seq", "lot", "dist").select("seq", "lot", "dist"))
    return served.select(F.col("seq").alias(seq), F.col("lot").alias(lot), F.col("dist").alias(dist))


def _claim_by_rounds(candidates: DataFrame, seq: str, lot: str, dist: str) -> DataFrame:
    """Rounds of proposals: a row asks its nearest lot that has not turned it down, a lot holds the earliest asker.

    All lots prefer the earlier row, so the stable outcome is the one of serving the rows one by one.
    """
    left = cut(candidates.select(seq, lot, dist))
    while True:
        asks = left.groupBy(seq).agg(F.min(F.struct(dist, lot)).alias("_b")).select(
            seq, F.col(f"_b.{lot}").alias(lot), F.col(f"_b.{dist}").alias(dist))
        held = cut(asks.groupBy(lot).agg(F.min(F.struct(seq, dist)).alias("_h")).select(
            lot, F.col(f"_h.{seq}").alias("_holder"), F.col(f"_h.{dist}").alias("_hd")))
        # a lot also turns down, now and for good, everyone later than its holder
        nxt = cut(
            salted_join(left, held.select(lot, "_holder"), [lot], [seq], "left")
            .filter(F.col("_holder").isNull() | (F.col(seq) <= F.col("_holder"))).drop("_holder")
        )
        if nxt.count() == left.count():
            return held.select(F.col("_holder").alias(seq), lot, F.col("_hd").alias(dist))
        left = nxt


def _colour(rows: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
    """One block in order: ``rows`` as ``_groups_by_blocks`` has them, its open nodes ``u, deg, h``; gives new groups (``done``) and the rows of nodes that wait.

    A node waits if a better neighbour is open: one of another block, or of this block and waiting itself.
    """
    nodes = nodes.sort_values("u", ignore_index=True)
    ids, n = nodes["u"].to_numpy(), len(nodes)
    order = np.lexsort((np.arange(n), nodes["h"].to_numpy(), -nodes["deg"].to_numpy()))
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    at, told = rank[np.searchsorted(ids, rows["u"].to_numpy())], rows["g"].to_numpy()
    v = rows["v"].to_numpy()
    place = np.minimum(np.searchsorted(ids, v), n - 1)
    here = (ids[place] == v) & (told == 0)
    far = np.zeros(n, bool)
    far[at[~here & (told == 0)]] = True
    # group 0 is open; behind the nodes come the groups that rows tell
    group = np.concatenate([np.zeros(n, np.int64), told])
    source = np.where(here, rank[place], n + np.arange(len(rows)))
    by = np.argsort(at, kind="stable")
    source, start = source[by], np.searchsorted(at[by], np.arange(n + 1))
    for r in np.flatnonzero(~far).tolist():
        used = set(group[source[start[r]:start[r + 1]]].tolist())
        if 0 not in used:
            free = 1
            while free in used:
                free += 1
            group[r] = free
    new = np.flatnonzero(group[:n])
    done = pd.DataFrame({"u": ids[order[new]], "v": ids[order[new]], "cu": 0, "cv": 0, "g": group[new], "done": True})
    left = group[:n][at] == 0
    rest = rows.loc[left, ["u", "v", "cu", "cv"]].assign(g=np.where(here, group[np.where(here, rank[place], 0)], told)[left], done=False)
    known = rest["g"] > 0
    return pd.concat([done, rest[~known], rest[known].drop_duplicates(["u", "g"])], ignore_index=True)


def _groups_by_blocks(nodes: DataFrame, edges: DataFrame, most: int, rounds: list | None) -> DataFrame | None:
    """``conflict_groups`` of nodes ``u, x, y`` in blocks: a round settles each block in order, as far as the groups of others are known.

    Blocks are squares of a grid, as wide as at most ``most`` rows in each allow; the grid is shifted from round to
    round, so that what hangs on a border once lies inside next.  No result if even the finest squares hold more.
    Rows ``u, v, cu, cv, g`` are a node, a better neighbour, the finest squares of both, and its group, 0 if it has none yet.
    """
    box = nodes.agg(*[f(c) for c in ("x", "y") for f in (F.min, F.max)]).first()
    if None in box:
        return None
    wide = max(box[1] - box[0], box[3] - box[2]) or 1.0
    at = lambda c, low: F.coalesce(F.least(F.floor((F.col(c) - low) * (FINEST / wide)), F.lit(FINEST - 1)), F.lit(0)).cast("int")
    kind = nodes.schema["u"].dataType.simpleString()
    pairs = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    degree = pairs.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("u")).groupBy("u").agg(F.count(F.lit(1)).alias("deg"))
    fine = nodes.select("u", F.xxhash64("u").alias("h"), (at("x", box[0]) * FINEST + at("y", box[2])).alias("cu")).dropDuplicates(["u"])
    todo = cut(fine.join(exploded(degree), "u", "left").withColumn("deg", F.coalesce("deg", F.lit(0).cast("long"))))
    n = todo.count()
    end = lambda c: todo.select(F.col("u").alias(c), F.struct(-F.col("deg"), "h", F.col("u")).alias(f"_r{c}"), F.col("cu").alias(f"_c{c}"))
    both = checked_join(checked_join(pairs.filter("a <> b"), end("a"), n, ["a"], ["b"]), end("b"), n, ["b"], ["a"])
    first = F.col("_ra") < F.col("_rb")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    rows = cut(both.select(pick("b", "a").alias("u"), pick("a", "b").alias("v"), pick("_cb", "_ca").alias("cu"), pick("_ca", "_cb").alias("cv"), F.lit(0).cast("long").alias("g")))
    found, step, shift = [], FINEST, 0
    while n:
        if rounds is not None:
            rounds.append(n)
        held = cut(rows.groupBy("cu").count())
        step = FINEST
        while True:
            at_x, at_y = (step // 2 * int(s in odd) for s, odd in ((shift, (1, 2)), (shift, (1, 3))))
            block = F.floor((F.floor(F.col("cu") / FINEST) + at_x) / step) * FINEST + F.floor((F.col("cu") % FINEST + at_y) / step)
            if (held.groupBy(block).agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] or 0) <= most:
                break
            if step == 1:
                return None
            step //= 2
        placed = lambda df, b=block: df.withColumn("block", b.cast("int")).groupBy("block")
        out = cut(placed(rows).cogroup(placed(todo)).applyInPandas(lambda r, k: _colour(r, k), f"u {kind}, v {kind}, cu int, cv int, g long, done boolean"))
        new = out.filter("done").select("u", "g")
        found, m = [*found, new], new.count()
        n, shift = n - m, (shift + 1) % 4
        if n:
            todo = cut(todo.join(new.select("u"), "u", "left_anti"))
            told = checked_join(out.filter("NOT done").drop("done"), new.select(F.col("u").alias("v"), F.col("g").alias("_g")), m, ["v"], ["u"], "left")
            rows = cut(told.select("u", "v", "cu", "cv", F.when(F.col("g") > 0, F.col("g")).otherwise(F.coalesce("_g", F.lit(0))).alias("g")))
    return reduce(DataFrame.unionByName, found).select("u", F.col("g").cast("int").alias("grp")) if found else None


def conflict_groups(nodes: DataFrame, edges: DataFrame, node: str = "node", xy: Sequence[str] = (), edges_at_once: int = EDGES_AT_ONCE, rounds: list | None = None) -> DataFrame:
    """Groups numbered from 1 with no conflict edge inside: ``node, grp``.

    Nodes take the smallest free group in the order of their ranks.  Where ``xy`` names their places, nodes that lie together are settled
    in order by one task for every ``edges_at_once`` edges; only those that hang on other blocks need another round.  Otherwise:

    In each round the uncoloured nodes that outrank all uncoloured neighbours (more conflicts,
    then a hash of the id) take the smallest free group.  Hashed ranks have no long chains, so the
    number of rounds grows with the logarithm of the nodes, whatever order their ids come in.

    Ranks never change, so a node waits for its better neighbours only: each of them, once coloured, tells its group to
    those behind it, and an edge is used once in all rounds.
    """
    if xy:
        at = nodes.select(F.col(node).alias("u"), *[F.col(c).cast("double").alias(o) for c, o in zip(xy, ("x", "y"), strict=True)])
        settled = _groups_by_blocks(at, edges.select("a", "b"), edges_at_once, rounds)
        if settled is not None:
            return settled.withColumnRenamed("u", node)
    both = cut(
        edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct()
    )
    degree = both.groupBy("u").agg(F.count(F.lit(1)).alias("_deg"))
    ranked = cut(
        nodes.select(F.col(node).alias("u")).distinct().join(degree, "u", "left")
        .select("u", F.struct((-F.coalesce("_deg", F.lit(0))).alias("d"), F.xxhash64("u").alias("h"), F.col("u").alias("i")).alias("r"))
    )
    better = ranked.select(F.col("u").alias("v"), F.col("r").alias("_rv"))
    waits = cut(salted_join(both.join(ranked, "u"), better, ["v"], ["u"]).filter(F.col("_rv") < F.col("r")).select(
        "u", "v", F.pmod(F.xxhash64("u"), F.ceil(-F.col("_rv.d") / LISTED)).alias("_part")))
    behind = cut(waits.groupBy("v", "_part").agg(F.collect_list("u").alias("_us")).select("v", "_us"))
    ahead = waits.groupBy("u").agg(F.count(F.lit(1)).alias("_n"))
    none = F.array().cast("array<int>")
    todo = cut(ranked.select("u").join(ahead, "u", "left").select("u", F.coalesce("_n", F.lit(0)).alias("left"), none.alias("used")))
    done, n = [], todo.count()
    listed = n
    while n:
        # the smallest free number
        free = F.array_min(F.array_except(F.sequence(F.lit(1), F.size("used") + 1), F.col("used")))
        new = cut(todo.filter("left = 0").select("u", free.alias("grp")))
        told = checked_join(behind, new.withColumnRenamed("u", "v"), new.count(), ["v"], ["v"]).select(F.explode("_us").alias("u"), "grp")
        told = exploded(told.groupBy("u").agg(F.count(F.lit(1)).alias("_n"), F.collect_set("grp").alias("_g")))
        todo = cut(todo.filter("left > 0").join(told, "u", "left").select(
            "u", (F.col("left") - F.coalesce("_n", F.lit(0))).alias("left"), F.array_union("used", F.coalesce("_g", none)).alias("used")))
        done, n = [*done, new], todo.count()
        if len(done) == 16:
            done = [cut(reduce(DataFrame.unionByName, done))]
        if 2 * n <= listed:  # those coloured have nothing more to tell
            behind, listed = cut(behind.join(todo.select(F.col("u").alias("v")), "v", "left_semi")), n
    if not done:
        return nodes.select(F.col(node), F.lit(1).alias("grp"))
    return reduce(DataFrame.unionByName, done).withColumnRenamed("u", node)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: ``node, comp`` with the smallest node as the name.

    Alternating large-star and small-star steps; each works from the minimum of a
    neighbourhood, which combines map-side, and never lists the neighbourhood.
    """
    e = cut(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    )
    nodes = edges.select(F.explode(F.array(a, b)).alias("node")).distinct()
    mark = None
    while True:
        ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        both = e.select(F.explode(ways).alias("_w")).select("_w.*")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = salted_join(both.filter("v > u"), low, ["u"], ["v"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        oriented = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low2 = oriented.groupBy("u").agg(F.min("v").alias("m"))
        small = salted_join(oriented, low2, ["u"], ["v"])
        nxt = cut(
            small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .unionByName(low2.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        )
        e, before = nxt, mark
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
    return nodes.join(e.select(F.col("u").alias("node"), F.col("v").alias("comp")), "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))


# --- chains ------------------------------------------------------------------

def chain_rings(edges: DataFrame, key: str, tol: float = 0.01) -> DataFrame:
    """Directed boundary edges ``key, x1, y1, x2, y2`` chained into rings: ``key, ring_id, seq, x, y``.

    Pointers are doubled until every edge knows the smallest edge of its ring and its distance
    to it.  Where rings touch in a vertex the sharpest turn to the left continues a ring.
    """
    k = lambda c: G.vertex_key(F.col(c), tol)
    e = cut(
        edges.select(key, "x1", "y1", "x2", "y2", k("x1").alias("_sx"), k("y1").alias("_sy"), k("x2").alias("_tx"), k("y2").alias("_ty"))
        .withColumn("eid", F.struct(F.col("_sy").alias("y"), F.col("_sx").alias("x"), F.col("_ty").alias("ty"), F.col("_tx").alias("tx")))
    )
    nxt = e.select(key, F.col("_sx").alias("_tx"), F.col("_sy").alias("_ty"), F.col("eid").alias("_n"),
                   (F.col("x2") - F.col("x1")).alias("_dx"), (F.col("y2") - F.col("y1")).alias("_dy"))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    bend = F.atan2(G.cross(dx, dy, F.col("_dx"), F.col("_dy")), dx * F.col("_dx") + dy * F.col("_dy"))
    links = (
        e.join(nxt, [key, "_tx", "_ty"], "left").groupBy(key, "eid")
        .agg(F.max_by("_n", F.struct(bend, "_n")).alias("nxt"))
    )
    gap = F.raise_error(F.lit("a boundary does not close: no edge starts where one ends"))
    links = links.withColumn("nxt", F.coalesce("nxt", gap))
    # smallest edge of the ring
    state = cut(links.select(key, "eid", F.col("nxt").alias("jump"), F.least("eid", "nxt").alias("low")))
    while True:
        ahead = state.select(key, F.col("eid").alias("jump"), F.col("jump").alias("_j2"), F.col("low").alias("_l2"))
        new = cut(state.join(ahead, [key, "jump"]).select(
            key, "eid", F.col("_j2").alias("jump"), F.least("low", "_l2").alias("low"), (F.col("_l2") < F.col("low")).alias("_ch")))
        moved = not new.filter("_ch").isEmpty()
        state = new.drop("_ch")
        if not moved:
            break
    ring = cut(state.select(key, "eid", "low"))
    # steps from the ring's smallest edge, counted backwards along predecessors
    pred = links.join(ring, [key, "eid"]).select(key, F.col("nxt").alias("eid"), F.col("eid").alias("prev"), "low")
    walk = cut(pred.select(key, "eid", "low",
                           F.when(F.col("eid") != F.col("low"), F.col("prev")).alias("jump"),
                           F.when(F.col("eid") != F.col("low"), 1).otherwise(0).cast("long").alias("steps")))
    while not walk.filter("jump IS NOT NULL").isEmpty():
        ahead = walk.select(key, F.col("eid").alias("jump"), F.col("jump").alias("_j2"), F.col("steps").alias("_s2"))
        walk = cut(walk.join(ahead, [key, "jump"], "left").select(
            key, "eid", "low", F.col("_j2").alias("jump"), (F.col("steps") + F.coalesce("_s2", F.lit(0))).alias("steps")))
    return walk.join(e, [key, "eid"]).select(
        key, F.col("low").alias("ring_id"), F.col("steps").alias("seq"), F.col("x1").alias("x"), F.col("y1").alias("y"))


def _darts(segments: DataFrame, key: str, tol: float) -> DataFrame:
    """Both directions of every distinct segment: ``key, dart, back, p, q``; a dart is the pair of its vertices on a grid of ``tol``."""
    v = lambda x, y: F.struct(G.vertex_key(F.col(x), tol).alias("x"), G.vertex_key(F.col(y), tol).alias("y"))
    e = segments.select(key, v("x1", "y1").alias("_a"), v("x2", "y2").alias("_b"), G.xy(F.col("x1"), F.col("y1")).alias("_p"), G.xy(F.col("x2"), F.col("y2")).alias("_q"))
    e = e.filter(F.col("_a") != F.col("_b"))
    way = lambda a, b, p, q: F.struct(F.struct(F.col(a).alias("a"), F.col(b).alias("b")).alias("dart"), F.col(p).alias("p"), F.col(q).alias("q"))
    both = e.select(key, F.explode(F.array(way("_a", "_b", "_p", "_q"), way("_b", "_a", "_q", "_p"))).alias("_w")).select(key, "_w.*")
    # copies of a segment are one
    return both.groupBy(key, "dart").agg(F.min("p").alias("p"), F.min("q").alias("q"))


def _reverse(dart: str) -> Column:
    return F.struct(F.col(f"{dart}.b").alias("a"), F.col(f"{dart}.a").alias("b"))


def _double(state: DataFrame, key: str) -> DataFrame:
    """Pointers ``jump`` of darts doubled until they end: ``last`` (dart at the end), ``steps`` to it and ``low``, the least vertex passed.

    Darts whose ``jump`` is still set are on closed chains, for which ``low`` is the least vertex of the whole.  The
    number of rounds is the logarithm of the longest chain.
    """
    state = cut(state.withColumns({"last": F.col("dart"), "steps": F.when(F.col("jump").isNull(), 0).otherwise(1).cast("long"), "low": F.least("dart.a", "dart.b")}))
    while True:
        ahead = state.select(key, F.col("dart").alias("jump"), F.col("jump").alias("_j"), F.col("last").alias("_t"), F.col("steps").alias("_s"), F.col("low").alias("_l"))
        moving = state.filter("jump IS NOT NULL").join(ahead, [key, "jump"]).select(
            key, "dart", F.col("_j").alias("jump"), F.col("_t").alias("last"), (F.col("steps") + F.col("_s")).alias("steps"),
            F.least("low", "_l").alias("low"), (F.col("_j").isNull() | (F.col("_l") < F.col("low"))).alias("_changed"))
        state = cut(moving.unionByName(state.filter("jump IS NULL").withColumn("_changed", F.lit(False))))
        if state.filter("_changed").isEmpty():
            return state.drop("_changed")
        state = state.drop("_changed")


def merge_chains(segments: DataFrame, key: str, tol: float = 0.01) -> DataFrame:
    """Segments of one key merged where exactly two of them meet: ``key, line_id, seq, x1, y1, x2, y2, closed``.

    One row per segment, in the direction of its line and numbered from 0; vertices where three or more segments
    meet end lines, as free ends do, so a Y stays three lines.  A line without an end starts at its least
    vertex.  ``line_id`` is its first segment.  Copies of a segment count once; segments shorter than ``tol`` drop out.

    Every segment stands for both of its directions, each knows the one after it, and pointers are doubled.
    Of the two ways to go along a line the one with the lesser last segment is kept.
    """
    darts = cut(_darts(segments, key, tol))
    leaving = darts.groupBy(key, F.col("dart.a").alias("_v")).agg(F.count(F.lit(1)).alias("_n"), F.min("dart").alias("_d0"), F.max("dart").alias("_d1")).filter("_n = 2")
    pair = lambda a, b: F.struct(_reverse(a).alias("dart"), F.col(b).alias("jump"))
    nxt = leaving.select(key, F.explode(F.array(pair("_d0", "_d1"), pair("_d1", "_d0"))).alias("_w")).select(key, "_w.dart", "_w.jump")
    linked = cut(darts.select(key, "dart").join(nxt, [key, "dart"], "left"))
    ranked = _double(linked, key)
    open_ = ranked.filter("jump IS NULL").select(key, "dart", "last", "steps", F.lit(False).alias("closed"))
    loops = cut(ranked.filter("jump IS NOT NULL").select(key, "dart", "low"))
    if not loops.isEmpty():
        opened = linked.join(loops, [key, "dart"]).select(key, "dart", F.when(F.col("dart.b") != F.col("low"), F.col("jump")).alias("jump"))
        open_ = cut(open_.unionByName(_double(opened, key).select(key, "dart", "last", "steps", F.lit(True).alias("closed"))))
    firsts = open_.groupBy(key, "last").agg(F.max_by("dart", "steps").alias("line_id"), F.max("steps").alias("_most"))
    kept = firsts.filter(F.col("last") < _reverse("line_id"))
    out = open_.join(kept, [key, "last"]).join(darts, [key, "dart"])
    return out.select(
        key, "line_id", (F.col("_most") - F.col("steps")).alias("seq"), F.col("p.x").alias("x1"), F.col("p.y").alias("y1"),
        F.col("q.x").alias("x2"), F.col("q.y").alias("y2"), "closed",
    )


def chain_vertices(chains: DataFrame, key: str) -> DataFrame:
    """Vertices of merged lines in order: ``key, line_id, seq, x, y``; the last vertex of a closed line repeats its first."""
    ends = chains.groupBy(key, "line_id").agg(F.max_by(F.struct(F.col("seq"), F.col("x2").alias("x"), F.col("y2").alias("y")), "seq").alias("_e"))
    starts = chains.select(key, "line_id", "seq", F.col("x1").alias("x"), F.col("y1").alias("y"))
    return starts.unionByName(ends.select(key, "line_id", (F.col("_e.seq") + 1).alias("seq"), F.col("_e.x").alias("x"), F.col("_e.y").alias("y")))


def merge_lines(segments: DataFrame, key: str, tol: float = 0.01) -> DataFrame:
    """Rows of ``merge_chains`` with the length of their line: ``line_length``."""
    tagged = cut(merge_chains(segments, key, tol))
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    totals = tagged.groupBy(key, "line_id").agg(F.sum(length).alias("line_length"))
    return salted_join(tagged, totals, [key, "line_id"], ["x1", "y1"])


# --- hulls -------------------------------------------------------------------

def _hull(xy: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise from the lowest left point; collinear points dropped."""
    pts = np.unique(xy, axis=0)
    if len(pts) < 3:
        return pts

    def half(rows):
        out: list = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(pts) + half(pts[::-1]))


def convex_hull(points: DataFrame, key: str, cells: int = 64) -> DataFrame:
    """Hull ``ring`` per file, counter-clockwise.

    Only points that are extreme in their thin x strip of the file can be corners, so a strip
    keeps its lowest and highest point (map-side aggregates) and the final hull of a file is
    built from at most ``2 * cells + 4`` corner candidates per pass of the fan below.
    """
    ext = points.groupBy(key).agg(F.min("x").alias("_x0"), F.max("x").alias("_x1"), F.min("y").alias("_y0"), F.max("y").alias("_y1"))
    # directions of a fan: the farthest point in each direction is always a corner
    box = salted_join(points, ext, [key], ["x", "y"])
    strip = F.floor((F.col("x") - F.col("_x0")) / F.nullif(F.col("_x1") - F.col("_x0"), F.lit(0.0)) * cells)
    cand = box.withColumn("_s", F.coalesce(strip, F.lit(0)))

    def partial(batches):
        for pdf in batches:
            parts = [(k, s, *p) for (k, s), g in pdf.groupby([key, "_s"], sort=False) for p in _hull(g[["x", "y"]].to_numpy(float))]
            yield pd.DataFrame(parts, columns=[key, "_s", "x", "y"])

    kind = points.schema[key].dataType.simpleString()
    shape = f"{key} {kind}, _s long, x double, y double"
    small = cand.select(key, F.col("_s").cast("long").alias("_s"), "x", "y").mapInPandas(partial, shape)
    # corners of each strip, then of the file: hull sizes, not point counts
    strips = small.groupBy(key, "_s").applyInPandas(
        lambda g: pd.DataFrame([(g[key].iloc[0], *p) for p in _hull(g[["x", "y"]].to_numpy(float))], columns=[key, "x", "y"]),
        f"{key} {kind}, x double, y double")

    def final(g):
        h = _hull(g[["x", "y"]].to_numpy(float))
        return pd.DataFrame({key: [g[key].iloc[0]], "ring": [[{"x": float(x), "y": float(y)} for x, y in h]]})

    return strips.groupBy(key).applyInPandas(final, f"{key} {kind}, ring array<struct<x:double,y:double>>")
