"""Trajectories: points in time order to simplified lines."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..core.lineage import cut
from ..core.numbering import number_rows
from ..core.skew import checked_join

#: Points of an interval that one task simplifies.
ROWS_AT_ONCE = 20_000


def _simplify(x: np.ndarray, y: np.ndarray, tol: float) -> np.ndarray:
    """Positions kept by the farthest-point rule with an explicit stack."""
    keep = np.zeros(len(x), bool)
    keep[[0, -1]] = True
    stack = [(0, len(x) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        dx, dy = x[b] - x[a], y[b] - y[a]
        px, py = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        n = dx * dx + dy * dy
        f = np.clip((px * dx + py * dy) / n, 0, 1) if n else 0.0
        d = np.hypot(px - f * dx, py - f * dy)
        i = int(d.argmax())
        if d[i] > tol:
            keep[a + 1 + i] = True
            stack += [(a, a + 1 + i), (a + 1 + i, b)]
    return np.flatnonzero(keep)


def _timed(points: DataFrame, track: str, time: str) -> DataFrame:
    """``track, _t, x, y`` with time in seconds; rows without a numeric time drop out."""
    when = dict(points.dtypes)[time]
    if when.startswith("timestamp"):
        t = F.unix_micros(F.col(time).cast("timestamp")) / 1e6
    else:
        t = F.col(time).try_cast("double")
    return points.select(track, t.alias("_t"), "x", "y").filter("_t IS NOT NULL")


def line_vertices(points: DataFrame, track: str, time: str) -> DataFrame:
    """Track points in time order as rows ``track, seq, x, y``, seq from 1; no task holds a whole track."""
    return number_rows(_timed(points, track, time), [track], "_t", ["x", "y"], "seq").select(track, "seq", "x", "y")


def simplified_vertices(points: DataFrame, track: str, time: str, tol: float, rows_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """Corners of each track after the farthest-point rule over the whole of it, as rows ``track, seq, x, y`` (seq in the full track).

    The rule splits the interval between two kept points at its farthest point while that is more than ``tol`` off.
    Intervals of at most ``rows_at_once`` points are finished as groups; only longer ones are split in rounds, in each
    of which every one finds its farthest point by a partial aggregate.  The result does not depend on
    ``rows_at_once``, and no task or row holds more than so many points.  Of equally far points the first counts.
    """
    v = line_vertices(points, track, time)
    ends = v.groupBy(track).agg(*[f(F.struct("seq", "x", "y")).alias(c) for f, c in ((F.min, "_lo"), (F.max, "_hi"))])
    ends = cut(ends)
    kept = ends.select(track, F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_v")).select(track, "_v.*")
    kind = points.schema[track].dataType.simpleString()

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq")
        first, last = pdf.iloc[0], pdf.iloc[-1]
        x = np.concatenate([[first["_lx"]], pdf["x"], [last["_hx"]]])
        y = np.concatenate([[first["_ly"]], pdf["y"], [last["_hy"]]])
        return pdf.iloc[_simplify(x, y, tol)[1:-1] - 1][[track, "seq", "x", "y"]]

    spans = ends.select(track, F.col("_lo.seq").alias("_ls"), *[F.col(f"_{n}.{c}").alias(f"_{n[0]}{c}") for n in ("lo", "hi") for c in "xy"], (F.col("_hi.seq") - F.col("_lo.seq") - 1).alias("_n"))
    open_ = v.join(spans.filter("_n > 0"), track).filter("seq > _ls AND seq <= _ls + _n")
    columns = [track, "seq", "x", "y", "_ls", "_lx", "_ly", "_hx", "_hy", "_n"]
    open_ = cut(open_.select(*columns))
    dx, dy = F.col("_hx") - F.col("_lx"), F.col("_hy") - F.col("_ly")
    px, py = F.col("x") - F.col("_lx"), F.col("y") - F.col("_ly")
    share = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (px * dx + py * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)))), F.lit(0.0))
    off = F.hypot(px - share * dx, py - share * dy)
    while True:
        small = open_.filter(F.col("_n") <= rows_at_once)
        kept = kept.unionByName(small.groupBy(track, "_ls").applyInPandas(finish, f"{track} {kind}, seq long, x double, y double"))
        large = open_.filter(F.col("_n") > rows_at_once)
        far = large.groupBy(track, "_ls").agg(F.max(F.struct(off.alias("d"), (-F.col("seq")).alias("s"), F.col("x").alias("x"), F.col("y").alias("y"))).alias("_f"))
        far = cut(far.filter(F.col("_f.d") > tol).select(track, "_ls", (-F.col("_f.s")).alias("_s"), F.col("_f.x").alias("_x"), F.col("_f.y").alias("_y")))
        n = far.count()
        if not n:
            return kept
        kept = kept.unionByName(far.select(track, F.col("_s").alias("seq"), F.col("_x").alias("x"), F.col("_y").alias("y")))
        split = checked_join(large, far, n, [track, "_ls"], ["seq"]).filter("seq <> _s")
        before = F.col("seq") < F.col("_s")
        side = lambda a, b: F.when(before, a).otherwise(b)
        open_ = cut(split.select(
            track, "seq", "x", "y", side(F.col("_ls"), F.col("_s")).alias("_ls"),
            side(F.col("_lx"), F.col("_x")).alias("_lx"), side(F.col("_ly"), F.col("_y")).alias("_ly"),
            side(F.col("_x"), F.col("_hx")).alias("_hx"), side(F.col("_y"), F.col("_hy")).alias("_hy"),
            side(F.col("_s") - F.col("_ls") - 1, F.col("_n") - (F.col("_s") - F.col("_ls"))).alias("_n"),
        ))


def points_to_line(points: DataFrame, track: str, time: str, tol: float = 0.0) -> DataFrame:
    """Track points in time order as a line, simplified with a tolerance: ``track, line``.

    Rows without a numeric time drop out.  The line is one array of all its corners, of all points with no
    tolerance; ``line_vertices`` and ``simplified_vertices`` give the same as rows.
    """
    corners = line_vertices(points, track, time) if tol <= 0 else simplified_vertices(points, track, time, tol)
    ordered = F.array_sort(F.collect_list(F.struct("seq", "x", "y")))
    return corners.groupBy(track).agg(F.transform(ordered, lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y"))).alias("line"))
