"""Raster operators on cell tables ``tile_id[, band], row_i, col_i, v``."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.grid import cell
from ..core.lineage import cut
from ..core.quantiles import exact_quantiles
from ..core.skew import salted_join
from ..functions import geometry as G
from ..functions.color import clip
from .points import valid_value
from .spatial import points_in_mask

# --- storage -----------------------------------------------------------------


def raster_cells(tiles: DataFrame, decimate: int = 1, box: tuple | None = None) -> DataFrame:
    """Cells of storage tiles ``tile_id, band, row0, col0, h, w, nodata, data``; nodata becomes null.

    ``decimate`` keeps every k-th row and column, ``box`` is (row0, col0, row1, col1) inclusive.
    """
    t = tiles
    if box is not None:
        t = t.filter((F.col("row0") <= box[2]) & (F.col("row0") + F.col("h") > box[0]) & (F.col("col0") <= box[3]) & (F.col("col0") + F.col("w") > box[1]))
    c = t.select("tile_id", "band", "row0", "col0", "w", "nodata", F.posexplode("data").alias("_p", "_v"))
    v = F.col("_v").cast("double")
    out = c.select(
        "tile_id", "band", (F.col("row0") + F.floor(F.col("_p") / F.col("w"))).cast("int").alias("row_i"),
        (F.col("col0") + F.col("_p") % F.col("w")).cast("int").alias("col_i"), F.when(valid_value(v) & ~v.eqNullSafe(F.col("nodata")), v).alias("v"))
    if box is not None:
        out = out.filter(F.col("row_i").between(box[0], box[2]) & F.col("col_i").between(box[1], box[3]))
    return out if decimate <= 1 else every_kth(out, decimate)


def every_kth(cells: DataFrame, k: int) -> DataFrame:
    """Every k-th row and column."""
    return cells.filter((F.col("row_i") % k == 0) & (F.col("col_i") % k == 0))


def to_tiles(cells: DataFrame, size: int, nodata: float = -9999.0) -> DataFrame:
    """Cells packed into square storage tiles; a tile holds ``size * size`` values at most."""
    keyed = cells.withColumn("tr", F.floor(F.col("row_i") / size)).withColumn("tc", F.floor(F.col("col_i") / size))
    pos = (F.col("row_i") - F.col("tr") * size) * size + F.col("col_i") - F.col("tc") * size
    packed = keyed.groupBy("tr", "tc").agg(F.map_from_entries(F.collect_list(F.struct(pos.cast("int"), "v"))).alias("_m"))
    data = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda i: F.coalesce(F.try_element_at("_m", i), F.lit(nodata)))
    return packed.select("tr", "tc", F.lit(size).alias("h"), F.lit(size).alias("w"), data.alias("data"))


def tile_band_mean(cells: DataFrame, nodata: float | None = None) -> DataFrame:
    """Mean of the valid cells per tile and band."""
    return cells.filter(valid_value(F.col("v"), nodata)).groupBy("tile_id", "band").agg(F.avg("v").alias("mean"))


def mosaic(tiles: DataFrame, keys: Sequence[str] = ("row_i", "col_i"), priority: str = "tile_id", nodata: float | None = None) -> DataFrame:
    """Many rasters as one: the valid value of the first raster in priority order."""
    ok = tiles.filter(valid_value(F.col("v"), nodata))
    best = ok.groupBy(*keys).agg(F.min_by("v", F.col(priority)).alias("v"), F.min(priority).alias(priority))
    return best


def select_bands(cells: DataFrame, order: str, wanted: str | None = None, cap: int | None = None) -> DataFrame:
    """Bands picked and renumbered by letters.

    ``order`` names the stored bands (``RGBI``; ``CIR`` and ``IRRG`` mean infrared, red, green);
    ``wanted`` lists the letters to keep, ``cap`` limits the count.
    """
    stored = band_letters(order)
    pick = band_letters(wanted) if wanted else stored
    pick = pick[: cap or len(pick)]
    renumber = F.create_map(*[F.lit(v) for i, ch in enumerate(pick) for v in (stored.index(ch) + 1, i + 1)])
    return cells.withColumn("band", F.try_element_at(renumber, F.col("band"))).filter(F.col("band").isNotNull())


def band_letters(order: str) -> str:
    """Letters of a band order; aliases resolved, repeats and unknown letters refused."""
    text = {"CIR": "IRG", "IRRG": "IRG"}.get(order.upper(), order.upper())
    if len(set(text)) != len(text) or set(text) - set("RGBI"):
        raise ValueError(f"bad band order {order!r}")
    return text


def single_if_identical(cells: DataFrame) -> DataFrame:
    """Tiles whose bands all hold the same values keep band 1 only."""
    per = cells.groupBy("tile_id", "row_i", "col_i").agg(F.min("v").alias("_a"), F.max("v").alias("_b"), F.count(F.lit(1)).alias("_n"))
    bands = cells.groupBy("tile_id").agg(F.count_distinct("band").alias("_k"))
    same = per.groupBy("tile_id").agg(F.bool_and(F.col("_a") == F.col("_b")).alias("_same"), F.min("_n").alias("_least")).join(bands, "tile_id")
    flag = same.select("tile_id", (F.col("_same") & (F.col("_least") == F.col("_k")) & (F.col("_k") > 1)).alias("_one"))
    return salted_join(cells, flag, ["tile_id"], ["row_i", "col_i"]).filter(~F.col("_one") | (F.col("band") == 1)).drop("_one")


# --- grid positions ----------------------------------------------------------

def rc_to_xy(row: Column, col: Column, gt: Sequence[float]) -> Column:
    """``struct(x, y)`` of a cell corner by the transform (a, b, c, d, e, f)."""
    a, b, c, d, e, f = gt
    return G.xy(c + col * a + row * b, f + col * d + row * e)


def xy_to_rc(x: Column, y: Column, gt: Sequence[float]) -> Column:
    """``struct(row, col)`` of the cell holding a position."""
    a, b, c, d, e, f = gt
    det = a * e - b * d
    col, row = ((x - c) * e - (y - f) * b) / det, ((y - f) * a - (x - c) * d) / det
    return F.struct(F.floor(row).alias("row"), F.floor(col).alias("col"))


def world_file(lines: DataFrame) -> DataFrame:
    """Transforms from side files ``path, line_no, value`` (A, D, B, E, C, F; centre of the first cell).

    Blank lines are passed over and a decimal comma counts as a point.
    """
    value = F.translate(F.trim("value"), ",", ".")
    nth = F.row_number().over(Window.partitionBy("path").orderBy("line_no"))  # six lines a file
    w = lines.filter(F.trim("value") != "").withColumn("_n", nth).groupBy("path").pivot("_n", [1, 2, 3, 4, 5, 6]).agg(F.first(value.try_cast("double")))
    a, d, b, e, c, f = (F.col(str(i)) for i in range(1, 7))
    return w.select("path", a.alias("a"), b.alias("b"), (c - a / 2 - b / 2).alias("c"), d.alias("d"), e.alias("e"), (f - d / 2 - e / 2).alias("f"))


def world_text(gt: DataFrame) -> DataFrame:
    """Side-file lines of transforms, first cell centre: the inverse of ``world_file``."""
    values = ["a", "d", "b", "e", "cx", "cy"]
    c = gt.withColumn("cx", F.col("c") + F.col("a") / 2 + F.col("b") / 2).withColumn("cy", F.col("f") + F.col("d") / 2 + F.col("e") / 2)
    return c.select("path", F.posexplode(F.array(*values)).alias("_i", "value")).select("path", (F.col("_i") + 1).alias("line_no"), "value")


# --- focal operators ---------------------------------------------------------

def _edges(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(F.min("row_i").alias("_r0"), F.max("row_i").alias("_r1"), F.min("col_i").alias("_c0"), F.max("col_i").alias("_c1"))


def with_edges(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the row and column range of the raster each cell belongs to.

    One row per raster: small enough for AQE to broadcast at run time, and if it is not, AQE
    splits the partitions of large rasters.
    """
    return cells.join(_edges(cells, keys), list(keys))


def neighbours(cells: DataFrame, keys: Sequence[str] = ("tile_id",), value: str = "v") -> DataFrame:
    """Adds the 3x3 surroundings ``nw n ne w e sw s se`` (row_i - 1 is ``n``).

    Outside the raster the border repeats; holes stay null.  Two window passes, one along
    rows and one along columns; the raster is shuffled twice and never multiplied.
    """
    keys = list(keys)
    e = with_edges(cells, keys)
    along = Window.partitionBy(*keys, "row_i").orderBy("col_i")
    down = Window.partitionBy(*keys, "col_i").orderBy("row_i")

    def side(df, w, axis, step, col, out):
        pos = F.lag(axis, step).over(w) if step > 0 else F.lead(axis, -step).over(w)
        val = F.lag(col, step).over(w) if step > 0 else F.lead(col, -step).over(w)
        return df.withColumn(out, F.when(pos == F.col(axis) - step, val))

    e = side(side(e, along, "col_i", 1, value, "_w"), along, "col_i", -1, value, "_e")
    v = F.col(value)
    e = e.withColumn("_t", F.struct(
        F.when(F.col("col_i") == F.col("_c0"), v).otherwise(F.col("_w")).alias("w"), v.alias("c"),
        F.when(F.col("col_i") == F.col("_c1"), v).otherwise(F.col("_e")).alias("e")))
    e = side(side(e, down, "row_i", 1, "_t", "_n"), down, "row_i", -1, "_t", "_s")
    n = F.when(F.col("row_i") == F.col("_r0"), F.col("_t")).otherwise(F.col("_n"))
    s = F.when(F.col("row_i") == F.col("_r1"), F.col("_t")).otherwise(F.col("_s"))
    e = e.withColumn("_n", n).withColumn("_s", s)
    named = {"nw": "_n.w", "n": "_n.c", "ne": "_n.e", "w": "_t.w", "e": "_t.e", "sw": "_s.w", "s": "_s.c", "se": "_s.e"}
    return e.withColumns({k: F.col(p) for k, p in named.items()}).drop("_w", "_e", "_t", "_n", "_s")


_AROUND = ["nw", "n", "ne", "w", "e", "sw", "s", "se", "_r0", "_r1", "_c0", "_c1"]


def hillshade(cells: DataFrame, size: float, azimuth: float = 315.0, altitude: float = 45.0, keys: Sequence[str] = ("tile_id",)) -> DataFrame:
    """Shade 0..1 from central differences, one-sided on the borders."""
    h = neighbours(cells, keys)
    # with repeated borders the span is one cell there
    span_x = F.when((F.col("col_i") == F.col("_c0")) | (F.col("col_i") == F.col("_c1")), 1.0).otherwise(2.0)
    span_y = F.when((F.col("row_i") == F.col("_r0")) | (F.col("row_i") == F.col("_r1")), 1.0).otherwise(2.0)
    dx, dy = (F.col("e") - F.col("w")) / span_x / size, (F.col("s") - F.col("n")) / span_y / size
    slope, aspect = F.atan(F.hypot(dx, dy)), F.atan2(dy, -dx)
    az, alt = math.radians(azimuth), math.radians(altitude)
    shade = math.sin(alt) * F.cos(slope) + math.cos(alt) * F.sin(slope) * F.cos(F.lit(az) - aspect)
    return h.withColumn("shade", clip(shade, 0.0, 1.0)).drop(*_AROUND)


def sobel(cells: DataFrame, xres: float, yres: float, keys: Sequence[str] = ("tile_id",), value: str = "v", out: Sequence[str] = ("dzdx", "dzdy")) -> DataFrame:
    """Horn derivatives of a cell table."""
    h = neighbours(cells, keys, value)
    c = F.col
    dx = (c("ne") + 2 * c("e") + c("se")) - (c("nw") + 2 * c("w") + c("sw"))
    dy = (c("sw") + 2 * c("s") + c("se")) - (c("nw") + 2 * c("n") + c("ne"))
    return h.withColumn(out[0], dx / (8.0 * xres)).withColumn(out[1], dy / (8.0 * yres)).drop(*_AROUND)


def slope_horn(cells: DataFrame, xres: float, yres: float, keys: Sequence[str] = ("tile_id",)) -> DataFrame:
    """Adds ``slope`` in degrees."""
    return sobel(cells, xres, yres, keys).withColumn("slope", F.degrees(F.atan(F.hypot("dzdx", "dzdy"))))


def curvature(cells: DataFrame, xres: float, yres: float, keys: Sequence[str] = ("tile_id",)) -> DataFrame:
    """Adds ``curv``: derivative of the derivative in both directions."""
    first = cut(sobel(cells, xres, yres, keys))
    second = sobel(first, xres, yres, keys, "dzdx", ("_xx", "_xy"))
    third = sobel(second, xres, yres, keys, "dzdy", ("_yx", "_yy"))
    return third.withColumn("curv", F.col("_xx") + F.col("_yy")).drop("_xx", "_xy", "_yx", "_yy", "dzdx", "dzdy")


def gaussian(
    cells: DataFrame, sigma: float, keys: Sequence[str] = ("tile_id",), radius: int | None = None, spread_holes: bool = True
) -> DataFrame:
    """Gaussian smoothing in two passes, borders mirrored.

    Radius ``int(4 sigma + 0.5)``; an image blur of kernel ``2 round(3 sigma) + 1`` has radius
    ``round(3 sigma)``.  Holes spread, or the weights are renormalised over what is there.
    """
    if sigma <= 0:
        return cells
    r = int(4 * sigma + 0.5) if radius is None else radius
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
    weights = [w / sum(raw) for w in raw]
    keys = list(keys)
    out = with_edges(cells.filter(valid_value(F.col("v"))), keys)
    for axis, lo, hi in (("col_i", "_c0", "_c1"), ("row_i", "_r0", "_r1")):
        p = F.col(axis)
        kernel = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(w).alias("w")) for k, w in zip(range(-r, r + 1), weights)]))
        # a cell serves the position k before it, and the mirrored ones near a border
        serves = F.explode(F.array(p - F.col("_k.k"), 2 * F.col(lo) - 1 - p - F.col("_k.k"), 2 * F.col(hi) + 1 - p - F.col("_k.k")))
        other = "row_i" if axis == "col_i" else "col_i"
        pushed = out.withColumn("_k", kernel).withColumn("_to", serves).filter(F.col("_to").between(F.col(lo), F.col(hi)))
        sums = pushed.groupBy(*keys, other, F.col("_to").alias(axis), "_r0", "_r1", "_c0", "_c1").agg(
            F.sum(F.col("_k.w") * F.col("v")).alias("_s"), F.sum("_k.w").alias("_w"), F.count(F.lit(1)).alias("_n"))
        if spread_holes:
            out = sums.filter(F.col("_n") == 2 * r + 1).withColumn("v", F.col("_s"))
        else:
            out = sums.withColumn("v", F.col("_s") / F.col("_w"))
        out = out.drop("_s", "_w", "_n")
    smooth = out.select(*keys, "row_i", "col_i", "v")
    if spread_holes:
        return smooth
    return smooth.join(cells.select(*keys, "row_i", "col_i"), [*keys, "row_i", "col_i"], "left_semi")


def focal(cells: DataFrame, half: int, stat: str, keys: Sequence[str] = ("tile_id",), value: str = "v", out: str = "f") -> DataFrame:
    """Minimum or maximum over a square of ``2 half + 1`` cells, by two range windows.

    The cost does not depend on the window.  Rasters with holes go through ``complete`` first.
    """
    fn = {"min": F.min, "max": F.max}[stat]
    along = Window.partitionBy(*keys, "row_i").orderBy("col_i").rangeBetween(-half, half)
    down = Window.partitionBy(*keys, "col_i").orderBy("row_i").rangeBetween(-half, half)
    return cells.withColumn(out, fn(value).over(along)).withColumn(out, fn(out).over(down))


#: Least side of the blocks in which holes are filled.
BLOCK = 16


def complete(cells: DataFrame, keys: Sequence[str] = ("tile_id",), value: str = "v", reach: int | None = None) -> DataFrame:
    """Positions of each raster's extent, holes as null: all of them, or those that windows may need.

    With ``reach``, the cells by which a result may look away from a given cell over all its windows, only blocks of
    that side (BLOCK at least) that hold a cell, and the blocks around them, are filled: whatever lies
    farther off is a hole that no result at a given cell sees.  A stray cell costs nine blocks and not the box
    between it and the rest.
    """
    keys = list(keys)
    edges = _edges(cells, keys)
    if reach is None:
        grid = edges.withColumn("row_i", F.explode(F.sequence("_r0", "_r1"))).withColumn("col_i", F.explode(F.sequence("_c0", "_c1")))
    else:
        side = max(BLOCK, reach)
        around = F.explode(F.array(*[F.lit(i) for i in (-1, 0, 1)]))
        held = cells.select(*keys, F.floor(F.col("row_i") / side).alias("_i"), F.floor(F.col("col_i") / side).alias("_j")).distinct()
        blocks = held.withColumn("_di", around).withColumn("_dj", around).select(*keys, (F.col("_i") + F.col("_di")).alias("_i"), (F.col("_j") + F.col("_dj")).alias("_j")).distinct()
        # blocks out of the extent have an empty range
        lo = lambda at, edge: F.greatest(F.col(at) * side, F.col(edge).cast("long"))
        hi = lambda at, edge: F.least((F.col(at) + 1) * side - 1, F.col(edge).cast("long"))
        kept = blocks.join(edges, keys).filter((lo("_i", "_r0") <= hi("_i", "_r1")) & (lo("_j", "_c0") <= hi("_j", "_c1")))
        grid = kept.withColumn("row_i", F.explode(F.sequence(lo("_i", "_r0"), hi("_i", "_r1")))).withColumn("col_i", F.explode(F.sequence(lo("_j", "_c0"), hi("_j", "_c1"))))
        kind = lambda c: F.col(c).cast(cells.schema[c].dataType).alias(c)
        grid = grid.select(*keys, "_r0", "_r1", "_c0", "_c1", kind("row_i"), kind("col_i"))
    return grid.join(cells.select(*keys, "row_i", "col_i", value), [*keys, "row_i", "col_i"], "left")


def local_extrema(cells: DataFrame, win: int, keys: Sequence[str] = ("tile_id",)) -> DataFrame:
    """Adds ``is_peak`` and ``is_pit``: equal to the window extreme, border of ``win // 2`` left out."""
    r = win // 2
    full = complete(cells.filter(valid_value(F.col("v"))), keys, reach=r)
    f = focal(focal(full, r, "max", keys, "v", "_hi"), r, "min", keys, "v", "_lo").filter("v IS NOT NULL")
    inner = F.col("row_i").between(F.col("_r0") + r, F.col("_r1") - r) & F.col("col_i").between(F.col("_c0") + r, F.col("_c1") - r)
    return f.withColumn("is_peak", inner & (F.col("v") == F.col("_hi"))).withColumn("is_pit", inner & (F.col("v") == F.col("_lo"))).drop(
        "_hi", "_lo", "_r0", "_r1", "_c0", "_c1")


def spot_points(
    cells: DataFrame, size: float, win: int = 7, sigma: float = 1.0, min_slope: float = 2.0, min_dist: float = 100.0,
    top_n: int = 300, mask: DataFrame | None = None, mask_mode: str = "covers", mask_buffer: float = 0.0,
) -> DataFrame:
    """Peaks, pits and sharp curvature spots of a surface: ``kind, x, y, z, score, pid``.

    Smoothed surface, slope at least ``min_slope``; per kind the strongest spots no closer than
    ``min_dist``; optional polygon mask.
    """
    from .graph import thin_by_distance

    smooth = cut(gaussian(cells, sigma))
    keys = ["tile_id", "row_i", "col_i"]
    slope = slope_horn(smooth, size, size).select(*keys, "v", "slope").filter(F.col("slope") >= min_slope)
    curv = curvature(smooth, size, size).select(*keys, F.abs("curv").alias("curv"))
    ext = local_extrema(smooth, win).select(*keys, "is_peak", "is_pit")
    s = slope.join(curv, keys, "left").join(ext, keys).withColumn("curv", F.coalesce("curv", F.lit(0.0)))
    s = cut(s)
    limit = exact_quantiles(s, [], "curv", [0.98], "_q").select(F.col("_q")[0].alias("_lim"))  # one row
    s = s.crossJoin(F.broadcast(limit))
    kinds = F.array_compact(F.array(
        F.when(F.col("is_peak"), F.struct(F.lit("peak").alias("kind"), F.col("v").alias("score"))),
        F.when(F.col("is_pit"), F.struct(F.lit("pit").alias("kind"), (-F.col("v")).alias("score"))),
        F.when(F.col("curv") >= F.col("_lim"), F.struct(F.lit("curv").alias("kind"), F.col("curv").alias("score")))))
    pts = s.select(
        F.explode(kinds).alias("_k"), ((F.col("col_i") + 0.5) * size).alias("x"), ((F.col("row_i") + 0.5) * size).alias("y"), F.col("v").alias("z"),
        F.struct("row_i", "col_i", "tile_id").alias("pid")).select("_k.kind", "x", "y", "z", "_k.score", "pid")
    taken = thin_by_distance(cut(pts), min_dist, "score", "pid", ["kind"], top_n)
    if mask is None:
        return taken
    return points_in_mask(taken.withColumn("_id", F.struct("kind", "pid")), mask, min_dist, "_id", mask_mode, mask_buffer).drop("_id")


def isolines(cells: DataFrame, interval: float, size: float, keys: Sequence[str] = ("tile_id",), master_every: int = 5) -> DataFrame:
    """Contour segments ``keys, level, master, x1, y1, x2, y2`` through squares of four cell centres.

    Each square names the levels between its lowest and highest corner; a saddle is resolved by
    the mean of its corners.
    """
    keys = list(keys)
    ok = cells.filter(valid_value(F.col("v")))
    along = Window.partitionBy(*keys, "row_i").orderBy("col_i")
    q = ok.withColumn("_b", F.when(F.lead("col_i").over(along) == F.col("col_i") + 1, F.lead("v").over(along))).filter("_b IS NOT NULL")
    down = Window.partitionBy(*keys, "col_i").orderBy("row_i")
    nxt = F.lead("row_i").over(down) == F.col("row_i") + 1
    q = q.withColumn("_d", F.when(nxt, F.lead("v").over(down))).withColumn("_c", F.when(nxt, F.lead("_b").over(down))).filter("_c IS NOT NULL")
    a, b, c, d = F.col("v"), F.col("_b"), F.col("_c"), F.col("_d")
    lo, hi = F.least(a, b, c, d), F.greatest(a, b, c, d)
    first, last = F.floor(lo / interval) + 1, F.floor(hi / interval)
    q = q.filter(first <= last).withColumn("_l", F.explode(F.sequence(first, last))).withColumn("level", F.col("_l") * F.lit(float(interval)))
    z = F.col("level")
    x0, y0 = (F.col("col_i") + 0.5) * size, (F.col("row_i") + 0.5) * size
    above = lambda v: v >= z
    t = lambda p, r: (z - p) / F.nullif(r - p, F.lit(0.0))
    on = lambda p, r, x, y: F.when(above(p) != above(r), G.xy(x, y))
    sides = [on(a, b, x0 + t(a, b) * size, y0), on(b, c, x0 + size, y0 + t(b, c) * size), on(d, c, x0 + t(d, c) * size, y0 + size), on(a, d, x0, y0 + t(a, d) * size)]
    q = q.withColumns({f"_p{i}": s for i, s in enumerate(sides)})
    p = [F.col(f"_p{i}") for i in range(4)]
    mid_above = (a + b + c + d) / 4 >= z
    seg = lambda u, w: F.struct(u.alias("p"), w.alias("q"))
    hits = F.array_compact(F.array(*p))
    # corners a and c stand out together: they join when the middle is on their side
    split_a = F.array(seg(p[0], p[3]), seg(p[1], p[2]))
    split_b = F.array(seg(p[0], p[1]), seg(p[2], p[3]))
    segs = F.when(F.size(hits) == 4, F.when(above(a) == mid_above, split_b).otherwise(split_a)).otherwise(F.array(seg(hits[0], F.get(hits, F.lit(1)))))
    out = q.select(*keys, "level", (F.col("_l") % master_every == 0).alias("master"), F.explode(segs).alias("_s"))
    return out.select(*keys, "level", "master", F.col("_s.p.x").alias("x1"), F.col("_s.p.y").alias("y1"), F.col("_s.q.x").alias("x2"), F.col("_s.q.y").alias("y2")).filter(
        "x1 <> x2 OR y1 <> y2")


def long_isolines(segs: DataFrame, min_len: float, clip_to: DataFrame | None = None, size: float = 50.0) -> DataFrame:
    """Contours with their chained length, short ones dropped; segments outside the polygon (by middle) go first."""
    from .graph import merge_lines

    if clip_to is not None:
        mid = segs.withColumn("_id", F.struct("level", "x1", "y1", "x2", "y2")).withColumn("x", (F.col("x1") + F.col("x2")) / 2).withColumn("y", (F.col("y1") + F.col("y2")) / 2)
        segs = points_in_mask(mid, clip_to, size, "_id").drop("_id", "x", "y")
    return merge_lines(segs, "level", 1e-4).filter(F.col("line_length") >= min_len)


def sample_along(lines: DataFrame, step: float = 80.0) -> DataFrame:
    """``max(1, length // step)`` evenly centred positions on each line: adds ``n_pos, pos, x, y``."""
    length = G.line_length(F.col("line"))
    n = F.greatest(F.lit(1), F.floor(length / step)).cast("int")
    out = lines.withColumn("_len", length).withColumn("n_pos", n).withColumn("pos", F.explode(F.sequence(F.lit(1), F.col("n_pos"))))
    at = G.along(F.col("line"), (F.col("pos") - 0.5) * F.col("_len") / F.col("n_pos"))
    return out.withColumn("_p", at).withColumn("x", F.col("_p.x")).withColumn("y", F.col("_p.y")).drop("_p", "_len")


# --- clipping and relations --------------------------------------------------

def _inside_cells(cells: DataFrame, poly: DataFrame, size: float) -> DataFrame:
    """Distinct cell positions whose centre lies in the polygon."""
    pos = cells.select("row_i", "col_i").distinct().withColumn("_id", F.struct("row_i", "col_i")).withColumn(
        "x", (F.col("col_i") + 0.5) * size).withColumn("y", (F.col("row_i") + 0.5) * size)
    return points_in_mask(pos, poly, size * 16, "_id").select("row_i", "col_i", F.lit(True).alias("_in"))


def clip_raster(cells: DataFrame, poly: DataFrame, size: float, nodata: float, max_bands: int | None = None) -> DataFrame:
    """Cells outside the polygon become nodata, the raster is cut to the polygon's extent.

    At most ``max_bands`` bands stay, all of them without it; ``mask`` tells whether all bands of the cell are valid.
    """
    inside = _inside_cells(cells, poly, size)
    box = inside.agg(F.min("row_i").alias("_r0"), F.max("row_i").alias("_r1"), F.min("col_i").alias("_c0"), F.max("col_i").alias("_c1"))  # one row
    c = salted_join(cells if max_bands is None else cells.filter(F.col("band") <= max_bands), inside, ["row_i", "col_i"], ["tile_id", "band"], "left").crossJoin(F.broadcast(box)).filter(
        F.col("row_i").between(F.col("_r0"), F.col("_r1")) & F.col("col_i").between(F.col("_c0"), F.col("_c1")))
    c = c.withColumn("v", F.when(F.col("_in"), F.col("v")).otherwise(nodata))
    ok = c.groupBy("tile_id", "row_i", "col_i").agg(F.bool_and(valid_value(F.col("v"), nodata)).alias("mask"))
    return salted_join(c.drop("_in", "_r0", "_r1", "_c0", "_c1"), ok, ["tile_id", "row_i", "col_i"], ["band"])


def already_clipped(cells: DataFrame, poly: DataFrame, size: float, nodata: float, alpha_band: int | None = None) -> DataFrame:
    """``tile_id, clipped``: whether everything outside the polygon is empty.

    Empty: alpha all 0, all nodata, one constant, or deviation up to 0.001 per band; false when
    nothing lies outside.
    """
    out = salted_join(cells, _inside_cells(cells, poly, size), ["row_i", "col_i"], ["tile_id", "band"], "left").filter(F.col("_in").isNull())
    per = out.groupBy("tile_id", "band").agg(
        F.bool_and(F.col("v") == nodata).alias("_nd"), (F.min("v") == F.max("v")).alias("_const"), F.stddev_pop("v").alias("_sd"), F.bool_and(F.col("v") == 0).alias("_zero"))
    band_ok = F.col("_nd") | F.col("_const") | (F.col("_sd") <= 1e-3)
    alpha = F.max((F.col("band") == alpha_band) & F.col("_zero")) if alpha_band else F.lit(False)
    flags = per.groupBy("tile_id").agg((F.bool_and(band_ok) | alpha).alias("clipped"))
    return cells.select("tile_id").distinct().join(flags, "tile_id", "left").withColumn("clipped", F.coalesce("clipped", F.lit(False)))


def tile_relation(cells: DataFrame, area: DataFrame, size: float, nodata: float) -> DataFrame:
    """``tile_id, relation``: outside, inside (all valid cells in the area) or partial."""
    marked = salted_join(cells, _inside_cells(cells, area, size), ["row_i", "col_i"], ["tile_id"], "left").withColumn("_in", F.coalesce("_in", F.lit(False)))
    valid = valid_value(F.col("v"), nodata)
    per = marked.groupBy("tile_id").agg(F.max("_in").alias("_any"), F.bool_and(F.when(valid, F.col("_in"))).alias("_all"))
    return per.select("tile_id", F.when(~F.col("_any"), "outside").when(F.coalesce("_all", F.lit(True)), "inside").otherwise("partial").alias("relation"))


# --- resampling --------------------------------------------------------------

def warp_nearest(cells: DataFrame, size: float, source_epsg: int | None, target_epsg: int, target_size: float | None = None) -> DataFrame:
    """Cell table moved to another zone: each target cell takes the source cell holding its centre.

    An unknown source code is assigned the target's; equal codes leave the table untouched.
    """
    if source_epsg is None or source_epsg == target_epsg:
        return cells
    from ..functions.crs import rezone

    step = target_size or size
    corner = lambda dx, dy: rezone((F.col("col_i") + dx) * size, (F.col("row_i") + dy) * size, F.lit(source_epsg), target_epsg)
    spots = cells.select("row_i", "col_i").distinct().withColumn("_k", F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)]))
    lim = lambda f, a: f(F.transform("_k", lambda p: p[a]))
    targets = (
        spots.withColumn("tc", F.explode(F.sequence(cell(lim(F.array_min, "x"), step), cell(lim(F.array_max, "x"), step))))
        .withColumn("tr", F.explode(F.sequence(cell(lim(F.array_min, "y"), step), cell(lim(F.array_max, "y"), step))))
        .select("tr", "tc").distinct()
    )
    back = rezone((F.col("tc") + 0.5) * step, (F.col("tr") + 0.5) * step, F.lit(target_epsg), source_epsg)
    asked = targets.withColumn("_b", back).select("tr", "tc", cell(F.col("_b.x"), size).alias("col_i"), cell(F.col("_b.y"), size).alias("row_i"))
    joined = salted_join(asked, cells, ["row_i", "col_i"], ["tr", "tc"]).drop("row_i", "col_i")
    return joined.withColumnsRenamed({"tr": "row_i", "tc": "col_i"})


def align_grids(a: DataFrame, b: DataFrame, size_a: float, size_b: float, nodata: float | None = None, keys: Sequence[str] = ("tile_id",)) -> DataFrame:
    """Values of ``b`` on the grid of ``a`` (bilinear between cell centres): ``keys, row_i, col_i, v, vb``.

    Null where one of the four cells around is missing or nodata.
    """
    keys = list(keys)
    fx, fy = (F.col("col_i") + 0.5) * size_a / size_b - 0.5, (F.col("row_i") + 0.5) * size_a / size_b - 0.5
    base = a.withColumn("_fx", fx - F.floor(fx)).withColumn("_fy", fy - F.floor(fy)).withColumn("_c", F.floor(fx)).withColumn("_r", F.floor(fy))
    corners = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    wx = F.when(F.col("_k.i") == 1, F.col("_fx")).otherwise(1 - F.col("_fx"))
    wy = F.when(F.col("_k.j") == 1, F.col("_fy")).otherwise(1 - F.col("_fy"))
    asked = base.withColumn("_k", corners).withColumn("_w", wx * wy).withColumn("_qc", F.col("_c") + F.col("_k.i")).withColumn("_qr", F.col("_r") + F.col("_k.j"))
    have = b.filter(valid_value(F.col("v"), nodata)).select(*keys, F.col("row_i").cast("long").alias("_qr"), F.col("col_i").cast("long").alias("_qc"), F.col("v").alias("_bv"))
    got = salted_join(asked.filter(F.col("_w") > 0), have, [*keys, "_qr", "_qc"], ["row_i", "col_i"], "left")
    return got.groupBy(*keys, "row_i", "col_i").agg(F.first("v").alias("v"), F.when(F.bool_and(F.col("_bv").isNotNull()), F.sum(F.col("_w") * F.col("_bv"))).alias("vb"))


def grid_surface(
    points: DataFrame, size: float, method: str = "idw", radius: float = 3.0, max_points: int = 12,
    surface: str = "dsm", tile: str = "tile_id",
) -> DataFrame:
    """Regular grid over each tile's extent filled from its points: ``tile, row_i, col_i, v``.

    ``dsm`` leaves class 7 out, ``dtm`` uses class 2.  Cells with points take their mean, the
    others the inverse-distance mean within ``radius`` and, failing that, the nearest filled cell.
    """
    from .vertical import nearest_any

    src = points.filter(F.col("classification") == 2) if surface == "dtm" else points.filter(F.col("classification") != 7)
    filled = src.groupBy(tile, cell(F.col("y"), size).alias("row_i"), cell(F.col("x"), size).alias("col_i")).agg(F.avg("z").alias("v"))
    filled = cut(filled)
    ext = _edges(filled, [tile])
    grid = ext.withColumn("row_i", F.explode(F.sequence("_r0", "_r1"))).withColumn("col_i", F.explode(F.sequence("_c0", "_c1"))).select(tile, "row_i", "col_i")
    empty = grid.join(filled, [tile, "row_i", "col_i"], "left_anti")
    out = filled
    if method == "idw":
        half = int(math.ceil(radius / size))
        span = F.sequence(F.lit(-half), F.lit(half))
        asked = empty.withColumn("_dr", F.explode(span)).withColumn("_dc", F.explode(span)).withColumn("_d", F.hypot(F.col("_dr") * size, F.col("_dc") * size)).filter(F.col("_d") <= radius)
        asked = asked.select(tile, F.col("row_i").alias("_tr"), F.col("col_i").alias("_tc"), (F.col("row_i") + F.col("_dr")).alias("row_i"), (F.col("col_i") + F.col("_dc")).alias("col_i"), "_d")
        near = asked.join(filled, [tile, "row_i", "col_i"])
        w = Window.partitionBy(tile, "_tr", "_tc").orderBy("_d", "row_i", "col_i")
        best = near.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= max_points)
        idw = best.groupBy(tile, F.col("_tr").alias("row_i"), F.col("_tc").alias("col_i")).agg((F.sum(F.col("v") / (F.col("_d") * F.col("_d"))) / F.sum(1 / (F.col("_d") * F.col("_d")))).alias("v"))
        out = filled.unionByName(idw)
        empty = empty.join(idw, [tile, "row_i", "col_i"], "left_anti")
    # tiles are searched apart: the tile is a key of the nearest search
    place = lambda df: df.withColumn("x", (F.col("col_i") + 0.5) * size).withColumn("y", (F.col("row_i") + 0.5) * size)
    lonely = cut(place(empty).withColumn("lid", F.struct("row_i", "col_i")))
    have = cut(place(filled).withColumn("rid", F.struct("row_i", "col_i")))
    found = nearest_any(lonely, have, size * 4, "lid", "rid", keys=[tile])
    fallback = found.join(have.select(tile, "rid", "v"), [tile, "rid"]).select(tile, F.col("lid.row_i").alias("row_i"), F.col("lid.col_i").alias("col_i"), "v")
    return out.unionByName(fallback)


# --- stretching, sampling ----------------------------------------------------

def stretch_uint8(cells: DataFrame, lo: float = 2.0, hi: float = 98.0, keys: Sequence[str] = ("tile_id",)) -> DataFrame:
    """Adds ``u8``: percentile stretch to 0..255 (truncated), range stretch as a fallback, constants 0."""
    keys = list(keys)
    q = exact_quantiles(cells, keys, "v", [lo / 100, hi / 100, 0.0, 1.0], "_q").drop("n")
    c = salted_join(cells, q, keys, ["row_i", "col_i"])
    flat = F.col("_q")[1] <= F.col("_q")[0]
    a = F.when(flat, F.col("_q")[2]).otherwise(F.col("_q")[0])
    b = F.when(flat, F.col("_q")[3]).otherwise(F.col("_q")[1])
    y = clip((F.col("v") - a) / F.nullif(b - a, F.lit(0.0)), 0.0, 1.0)
    return c.withColumn("u8", F.floor(F.coalesce(y, F.lit(0.0)) * 255).cast("int")).drop("_q")


def height_colors(u8: Column) -> Column:
    """``struct(r, g, b)`` from blue over green to red, truncated to 8 bits."""
    z = u8 / 255.0
    unit = lambda c: F.floor(clip(c, 0.0, 1.0) * 255).cast("int")
    return F.struct(unit(2 * (z - 0.5)).alias("r"), unit(2 * (0.5 - F.abs(z - 0.5))).alias("g"), unit(2 * (0.5 - z)).alias("b"))


def shade_rgb(rgb: Column, shade: Column, ambient: float = 0.35) -> Column:
    """Colours darkened by the shade, truncated to 8 bits."""
    k = clip(ambient + (1 - ambient) * shade, 0.0, 1.0)
    return F.struct(*[F.floor(clip(rgb[c] * k)).cast("int").alias(c) for c in "rgb"])


def sample_pixels(cells: DataFrame, n: int, seed: int, channels: int, nodata: float | None = None) -> DataFrame:
    """Up to ``n`` cells per tile, valid in all channels, drawn without replacement by a seeded hash."""
    from ..core.numbering import number_rows

    ok = cells.filter(valid_value(F.col("v"), nodata)).groupBy("tile_id", "row_i", "col_i").agg(
        F.count_distinct("band").alias("_k"), F.map_from_entries(F.collect_list(F.struct("band", "v"))).alias("values")).filter(F.col("_k") == channels)
    drawn = ok.withColumn("_h", F.xxhash64("tile_id", "row_i", "col_i", F.lit(seed)))
    return number_rows(drawn, ["tile_id"], "_h", ["row_i", "col_i"], "_n").filter(F.col("_n") <= n).drop("_n", "_h", "_k")
