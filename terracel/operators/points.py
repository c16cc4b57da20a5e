"""Point-cloud operators: filters, thinning, gridding, heights, voxels, densities.

Points carry ``tile_id, pid, x, y, z, intensity, classification, return_number,
number_of_returns, point_source_id, scan_angle``; ``pid`` stands for input order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.grid import cell
from ..core.numbering import number_rows
from ..core.quantiles import exact_quantiles, group_median
from ..core.skew import HOT_ROWS, group_shape, hot_keys, salted_join

GROUND = 2
NOISE = 7
MAX_LINE_NUMBER = 65535


# --- filters -----------------------------------------------------------------

def ground_or_all(points: DataFrame, tile: str = "tile_id") -> DataFrame:
    """Ground points; every point of a tile that has no ground."""
    flags = points.groupBy(tile).agg(
        F.max(F.col("classification") == GROUND).alias("_has_ground")
    )
    joined = salted_join(points, flags, [tile], ["pid"])
    return joined.filter(~F.col("_has_ground") | (F.col("classification") == GROUND)).drop("_has_ground")


def class_range(points: DataFrame, lo: int, hi: int, exclude: bool = False) -> DataFrame:
    """Points whose class lies in ``[lo, hi]``, or outside it."""
    inside = F.col("classification").between(lo, hi)
    return points.filter(~inside if exclude else inside)


def return_filter(points: DataFrame, mode: str) -> DataFrame:
    """``first``, ``last`` (the last of its pulse), ``only`` (single returns), ``last_only`` or ``all``."""
    first = F.col("return_number") == 1
    last = F.col("return_number") == F.col("number_of_returns")
    only = F.col("number_of_returns") == 1
    rules = {"first": first, "last": last, "only": only, "last_only": last | only}
    return points.filter(rules[mode]) if mode in rules else points


def map_labels(
    points: DataFrame, mapping: Mapping[int, int], ignore: Sequence[int] = (), out: str = "label"
) -> DataFrame:
    """Drop ignored classes and map the rest; unmapped classes become -1."""
    pairs = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    kept = points.filter(~F.col("classification").isin(*ignore)) if ignore else points
    return kept.withColumn(out, F.coalesce(F.try_element_at(pairs, F.col("classification").cast("int")), F.lit(-1)))


def assign_class(points: DataFrame, value: int) -> DataFrame:
    """Give every point one class."""
    return points.withColumn("classification", F.lit(value))


def number_lines(points: DataFrame, file: str, start: int = 1) -> DataFrame:
    """``point_source_id`` = position of the file in name order; more than 65535 is an error."""
    # the cut keeps one name too many, so the check below still fires
    names = points.select(file).distinct().orderBy(file).limit(MAX_LINE_NUMBER + 1)
    number = F.row_number().over(Window.orderBy(file)) + F.lit(start - 1)
    checked = F.when(
        number > MAX_LINE_NUMBER,
        F.raise_error(F.lit(f"line numbers above {MAX_LINE_NUMBER} do not fit")).cast("int"),
    ).otherwise(number)
    numbered = names.withColumn("point_source_id", checked)
    return points.drop("point_source_id").join(F.broadcast(numbered), file)


def valid_value(v: Column, nodata: float | None = None) -> Column:
    """Finite and different from ``nodata``."""
    ok = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    return ok if nodata is None else ok & (v != F.lit(nodata))


def crop_window(
    points: DataFrame,
    size: float,
    cap: int | None = None,
    train_seed: int | None = None,
    tile: str = "tile_id",
) -> DataFrame:
    """Square window per tile around the XY median (or, with a seed, around a random point).

    Bounds are inclusive and a tile with nothing inside is kept whole.  ``cap`` keeps the
    first points in input order, or a random choice with a seed.
    """
    if not size or size <= 0:
        kept = points
    else:
        hot = hot_keys(points, [tile])
        if train_seed is None:
            axes = points.select(tile, "x", "y").unpivot([tile], ["x", "y"], "_axis", "_v")
            med = group_median(axes, [tile, "_axis"], "_v", "_m")
            centres = med.groupBy(tile).agg(
                F.max(F.when(F.col("_axis") == "x", F.col("_m"))).alias("_mx"),
                F.max(F.when(F.col("_axis") == "y", F.col("_m"))).alias("_my"),
            )
        else:
            draw = F.struct(F.xxhash64("pid", F.lit(train_seed)).alias("h"), "pid", "x", "y")
            centres = points.groupBy(tile).agg(F.min(draw).alias("_c")).select(
                tile, F.col("_c.x").alias("_mx"), F.col("_c.y").alias("_my")
            )
        half = size / 2.0
        inside = F.col("x").between(F.col("_mx") - half, F.col("_mx") + half) & F.col("y").between(
            F.col("_my") - half, F.col("_my") + half
        )
        marked = salted_join(points, centres, [tile], ["pid"], hot=hot).withColumn("_in", inside)
        hits = marked.groupBy(tile).agg(F.max("_in").alias("_any"))
        kept = (
            salted_join(marked, hits, [tile], ["pid"], hot=hot)
            .filter(F.col("_in") | ~F.col("_any"))
            .drop("_in", "_any", "_mx", "_my")
        )
    if cap is None:
        return kept
    order = F.col("pid") if train_seed is None else F.xxhash64("pid", F.lit(train_seed + 1))
    ranked = number_rows(kept.withColumn("_o", order), [tile], "_o", ["pid"], "_rn")
    return ranked.filter(F.col("_rn") <= cap).drop("_o", "_rn")


def assign_blocks(points: DataFrame, size: float, tile: str = "tile_id") -> DataFrame:
    """Half-open XY blocks counted from the tile minimum: adds ``bx, by``."""
    origin = points.groupBy(tile).agg(F.min("x").alias("_x0"), F.min("y").alias("_y0"))
    return (
        salted_join(points, origin, [tile], ["pid"])
        .withColumn("bx", cell(F.col("x") - F.col("_x0"), size))
        .withColumn("by", cell(F.col("y") - F.col("_y0"), size))
        .drop("_x0", "_y0")
    )


def cap_per_group(points: DataFrame, keys: Sequence[str], n: int, order: str = "pid") -> DataFrame:
    """First ``n`` rows of each group in input order."""
    return number_rows(points, keys, order, [], "_rn").filter(F.col("_rn") <= n).drop("_rn")


def drop_outlier_tiles(
    stats: DataFrame, z: float = 3.5, min_keep: int = 3, tile: str = "tile_id"
) -> DataFrame:
    """Tiles kept for calibration, from ``tile, channel, mean`` rows.

    The summed absolute z-scores (population sigma per channel) of a tile may not exceed
    ``z`` times the channel count; a tile without any mean counts 0.  All tiles stay when
    fewer than ``min_keep`` would.
    """
    ch = stats.filter(F.col("mean").isNotNull() & ~F.isnan("mean")).groupBy("channel").agg(
        F.avg("mean").alias("_mu"), F.stddev_pop("mean").alias("_sd")
    )
    score = F.when(F.col("_sd") > 0, F.abs(F.col("mean") - F.col("_mu")) / F.col("_sd")).otherwise(0.0)
    n_channels = stats.agg(F.count_distinct("channel").alias("_k"))
    scored = (
        salted_join(stats, ch, ["channel"], [tile], "left")
        .withColumn("_z", F.when(F.isnan("mean"), F.lit(None)).otherwise(score))
        .groupBy(tile)
        .agg(F.coalesce(F.sum("_z"), F.lit(0.0)).alias("score"))
        .crossJoin(F.broadcast(n_channels))  # one row
        .withColumn("_keep", F.col("score") <= F.lit(z) * F.col("_k"))
    )
    kept = scored.agg(F.count_if("_keep").alias("_n"))
    return (
        scored.crossJoin(F.broadcast(kept))  # one row
        .filter(F.col("_keep") | (F.col("_n") < min_keep))
        .select(tile, "score")
    )


# --- thinning and gridding ---------------------------------------------------

def with_cells(points: DataFrame, size: float, origin: str = "absolute", tile: str = "tile_id") -> DataFrame:
    """Adds ``cx, cy``: cells from 0,0 (``absolute``) or from the tile minimum (``tile``)."""
    if origin == "absolute":
        return points.withColumn("cx", cell(F.col("x"), size)).withColumn("cy", cell(F.col("y"), size))
    return assign_blocks(points, size, tile).withColumnsRenamed({"bx": "cx", "by": "cy"})


def cell_lowest(points: DataFrame, size: float, tile: str = "tile_id", origin: str = "tile") -> DataFrame:
    """Lowest point of each XY cell of each tile (lowest pid on ties)."""
    celled = with_cells(points, size, origin, tile)
    row = F.struct(*[c for c in points.columns if c != tile])
    low = celled.groupBy(tile, "cx", "cy").agg(
        F.min_by(row, F.struct("z", "pid")).alias("_p")
    )
    return low.select(tile, "cx", "cy", "_p.*")


def _with_cell_median(celled: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds the exact median of ``value`` in the cell; cells without a value or with a null key are left out.

    Cells that one task can sort are ordered where they lie: a percentile per cell would build a map for each of many
    small cells, and its result would have to be joined back.
    """
    if group_shape(celled, keys)[1] > HOT_ROWS:
        return salted_join(celled, group_median(celled, keys, value, out), keys, ["pid"])
    v = F.col(value).cast("double")
    good = v.isNotNull() & ~F.isnan(v)
    cell_rows = Window.partitionBy(*keys)
    ranked = celled.dropna(subset=list(keys)).withColumns({
        "_good": good, "_at": F.row_number().over(cell_rows.orderBy(F.desc(good), v)) - 1, "_n": F.count_if(good).over(cell_rows)})
    value_at = lambda i: F.max(F.when(F.col("_good") & (F.col("_at") == i), v)).over(cell_rows)
    low, high = value_at(F.floor((F.col("_n") - 1) / 2)), value_at(F.ceil((F.col("_n") - 1) / 2))
    ranked = ranked.filter("_n > 0").withColumns({"_low": low, "_high": high})
    return ranked.withColumn(out, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(0.5 * F.col("_low") + 0.5 * F.col("_high"))).drop(
        "_good", "_at", "_n", "_low", "_high")


def thin_median(
    points: DataFrame, size: float | None, keep_class: int | None = GROUND, tile: str = "tile_id"
) -> DataFrame:
    """One point per XY cell: the one whose z is closest to the cell median, first on ties."""
    if keep_class is not None:
        points = points.filter(F.col("classification") == keep_class)
    if not size or size <= 0:
        return points
    keys = [tile, "cx", "cy"]
    celled = with_cells(points, size)
    row = F.struct(*[c for c in points.columns if c != tile])
    best = (
        _with_cell_median(celled, keys, "z", "_med")
        .groupBy(*keys)
        .agg(F.min_by(row, F.struct(F.abs(F.col("z") - F.col("_med")), "pid")).alias("_p"))
    )
    return best.select(*keys, "_p.*")


def rasterize(
    points: DataFrame, size: float, dim: str, stat: str, drop_class: int | None = NOISE,
    tile: str = "tile_id",
) -> DataFrame:
    """Cell table ``tile, row, col, v`` of a point attribute (``max``, ``min``, ``mean`` or ``count``)."""
    if drop_class is not None:
        points = points.filter(F.col("classification") != drop_class)
    agg = {"max": F.max, "min": F.min, "mean": F.avg, "count": F.count}[stat]
    return points.groupBy(
        tile, cell(F.col("y"), size).alias("row_i"), cell(F.col("x"), size).alias("col_i")
    ).agg(agg(dim).alias("v"))


def density_stats(points: DataFrame, tile: str = "tile_id", target: float = 8.0) -> DataFrame:
    """Count, extent, density, spacing and the raster resolution that holds ``target`` points.

    Resolution is clipped to 0.1..2 and is 1 where the density is undefined.
    """
    ext = points.groupBy(tile).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("minx"), F.max("x").alias("maxx"),
        F.min("y").alias("miny"), F.max("y").alias("maxy"),
    )
    return density_from_extent(ext, target)


def density_from_extent(ext: DataFrame, target: float = 8.0) -> DataFrame:
    """Density columns from rows that already hold ``n`` and the box (file headers)."""
    area = (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))
    density = F.when(F.col("area") > 0, F.col("n") / F.col("area"))
    return (
        ext.withColumn("area", F.greatest(area, F.lit(0.0)))
        .withColumn("density", F.coalesce(density, F.lit(0.0)))
        .withColumn("spacing", F.when(F.col("density") > 0, 1 / F.sqrt("density")).otherwise(0.0))
        .withColumn(
            "resolution",
            F.when(
                F.col("density") > 0,
                F.greatest(F.least(F.sqrt(F.lit(target) / F.col("density")), F.lit(2.0)), F.lit(0.1)),
            ).otherwise(1.0),
        )
    )


def quadrant_density(
    points: DataFrame, window: float = 50.0, factor: float = 12.0, keys: Sequence[str] = ("tile_id",),
    geographic: bool = True,
) -> DataFrame:
    """Density in four windows at 25 % and 75 % of the extent, two decimals: ``keys, quadrant, density``."""
    from ..functions.numbers import metres_to_degrees

    keys = list(keys)
    ext = points.groupBy(*keys).agg(
        F.min("x").alias("_x0"), F.max("x").alias("_x1"), F.min("y").alias("_y0"), F.max("y").alias("_y1")
    )
    if geographic:
        dx, dy = metres_to_degrees((F.col("_y0") + F.col("_y1")) / 2, F.lit(window))
    else:
        dx = dy = F.lit(window)
    ext = ext.withColumn("_hx", dx / 2).withColumn("_hy", dy / 2)
    w, h = F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")
    left, right = F.col("_x0") + w * 0.25, F.col("_x0") + w * 0.75
    top, bottom = F.col("_y1") - h * 0.25, F.col("_y0") + h * 0.25
    centres = [("Q1", left, top), ("Q2", right, top), ("Q3", left, bottom), ("Q4", right, bottom)]
    near = lambda v, c, half: v.between(c - half, c + half)
    counts = [
        F.count_if(near(F.col("x"), cx, F.col("_hx")) & near(F.col("y"), cy, F.col("_hy"))).alias(q)
        for q, cx, cy in centres
    ]
    wide = salted_join(points, ext, keys, ["pid"]).groupBy(*keys).agg(*counts)
    long = wide.unpivot(keys, [q for q, _, _ in centres], "quadrant", "_n")
    return long.select(
        *keys, "quadrant", F.round(F.col("_n") / F.lit(window * window) * F.lit(factor), 2).alias("density")
    )


# --- heights, voxels and local geometry --------------------------------------

def height_above_ground(points: DataFrame, size: float, tile: str = "tile_id") -> DataFrame:
    """Adds ``hag``: z over the lowest ground point of the cell, else of the tile, else over min z."""
    celled = with_cells(points, size, "tile", tile)
    ground = F.when(F.col("classification") == GROUND, F.col("z"))
    cells = celled.groupBy(tile, "cx", "cy").agg(F.min(ground).alias("_g"), F.min("z").alias("_z0"))
    tiles = cells.groupBy(tile).agg(F.min("_g").alias("_tg"), F.min("_z0").alias("_tz"))
    floor = salted_join(cells, tiles, [tile], ["cx", "cy"]).select(
        tile, "cx", "cy", F.coalesce("_g", "_tg", "_tz").alias("_floor")
    )
    return (
        salted_join(celled, floor, [tile, "cx", "cy"], ["pid"])
        .withColumn("hag", F.greatest(F.col("z") - F.col("_floor"), F.lit(0.0)))
        .drop("_floor", "cx", "cy")
    )


def with_voxels(points: DataFrame, size: float, tile: str = "tile_id", from_min: bool = True) -> DataFrame:
    """Adds voxel indices ``vx, vy, vz`` counted from the smallest index of the tile.

    ``from_min`` floors offsets from the tile minimum; otherwise absolute coordinates are
    floored first and the indices shifted to start at zero.
    """
    low = points.groupBy(tile).agg(*[F.min(a).alias(f"_{a}0") for a in "xyz"])
    out = salted_join(points, low, [tile], ["pid"])
    for a in "xyz":
        v, v0 = F.col(a), F.col(f"_{a}0")
        idx = cell(v - v0, size) if from_min else cell(v, size) - cell(v0, size)
        out = out.withColumn(f"v{a}", idx.cast("int"))
    return out.drop("_x0", "_y0", "_z0")


def voxelize(
    points: DataFrame, size: float, features: Sequence[str], label: str | None = None,
    tile: str = "tile_id",
) -> DataFrame:
    """One row per voxel: point count, mean of each feature and, if asked, the majority label."""
    keys = [tile, "vx", "vy", "vz"]
    vox = with_voxels(points, size, tile, from_min=False)
    if label is None:
        return vox.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), *[F.avg(f).alias(f) for f in features]
        )
    # one pass: sums per (voxel, label) first, then per voxel
    part = vox.groupBy(*keys, label).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f).alias(f"_s_{f}") for f in features]
    )
    return part.groupBy(*keys).agg(
        F.sum("_n").alias("n"),
        *[(F.sum(f"_s_{f}") / F.sum("_n")).alias(f) for f in features],
        F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias(label),
    )


def majority(points: DataFrame, keys: Sequence[str], label: str, out: str = "majority") -> DataFrame:
    """Modal label of each group, the lowest label on ties."""
    counts = points.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias(out)
    )


def smooth_labels(points: DataFrame, size: float, label: str, tile: str = "tile_id") -> DataFrame:
    """Replace each label by the majority of its voxel (off for size <= 0)."""
    if size <= 0:
        return points
    keys = [tile, "vx", "vy", "vz"]
    vox = with_voxels(points, size, tile)
    modes = majority(vox, keys, label, "_mode")
    return (
        salted_join(vox, modes, keys, ["pid"])
        .withColumn(label, F.col("_mode"))
        .drop("_mode", "vx", "vy", "vz")
    )


def cell_geometry(
    points: DataFrame, size: float, min_points: int = 3, tile: str = "tile_id"
) -> DataFrame:
    """Per XY cell: ``normal_z, roughness, slope, planarity, linearity`` of its points.

    The covariance comes from built-in aggregates; eigenvalues use the trigonometric
    form for symmetric 3x3 matrices and the normal's z part the eigenvector-from-
    eigenvalues identity, so everything stays in generated code.
    """
    keys = [tile, "cx", "cy"]
    stats = with_cells(points, size, "absolute", tile).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.var_samp("x").alias("_xx"), F.var_samp("y").alias("_yy"), F.var_samp("z").alias("_zz"),
        F.covar_samp("x", "y").alias("_xy"), F.covar_samp("x", "z").alias("_xz"),
        F.covar_samp("y", "z").alias("_yz"),
    )
    xx, yy, zz, xy, xz, yz = (F.col(c) for c in ("_xx", "_yy", "_zz", "_xy", "_xz", "_yz"))
    q = (xx + yy + zz) / 3
    off = xy * xy + xz * xz + yz * yz
    p = F.sqrt(((xx - q) * (xx - q) + (yy - q) * (yy - q) + (zz - q) * (zz - q) + 2 * off) / 6)
    det = (
        (xx - q) * ((yy - q) * (zz - q) - yz * yz)
        - xy * (xy * (zz - q) - yz * xz)
        + xz * (xy * yz - (yy - q) * xz)
    )
    stats = stats.withColumn("_q", q).withColumn("_p", p).withColumn(
        "_phi",
        F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), det / 2 / F.nullif(p * p * p, F.lit(0.0))))) / 3,
    )
    e1 = F.col("_q") + 2 * F.col("_p") * F.cos("_phi")
    e3 = F.col("_q") + 2 * F.col("_p") * F.cos(F.col("_phi") + F.lit(2.0943951023931953))
    stats = stats.withColumn("_e1", e1).withColumn("_e3", e3).withColumn(
        "_e2", 3 * F.col("_q") - F.col("_e1") - F.col("_e3")
    )
    tr2, det2 = xx + yy, xx * yy - xy * xy
    part = lambda e: e * e - e * tr2 + det2
    e1, e2, e3 = F.col("_e1"), F.col("_e2"), F.col("_e3")
    flat_gap = (e2 - e3) > e1 * 1e-12
    nz2 = F.when(flat_gap, part(e3) / ((e3 - e1) * (e3 - e2))).otherwise(
        1 - part(e1) / F.nullif((e1 - e2) * (e1 - e3), F.lit(0.0))
    )
    nz = F.sqrt(F.least(F.greatest(F.coalesce(nz2, F.lit(1.0)), F.lit(0.0)), F.lit(1.0)))
    l1, l2, l3 = F.greatest(e1, F.lit(1e-12)), F.greatest(e2, F.lit(0.0)), F.greatest(e3, F.lit(0.0))
    unit = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    big = (F.col("n") >= max(min_points, 3)) & F.col("_phi").isNotNull()
    pick = lambda c, small: F.when(big, c).otherwise(F.lit(small))
    return stats.select(
        *keys, "n",
        pick(nz, 1.0).alias("normal_z"),
        pick(F.sqrt(l3 * (F.col("n") - 1) / F.col("n")), 0.0).alias("roughness"),
        pick(unit(1 - nz), 0.0).alias("slope"),
        pick(unit((l2 - l3) / l1), 0.0).alias("planarity"),
        pick(unit((l1 - l2) / l1), 0.0).alias("linearity"),
    )


def normalise_features(
    points: DataFrame, max_intensity: float = 65535.0, tile: str = "tile_id"
) -> DataFrame:
    """Model inputs: relative z, centred XY, scaled intensity, returns and scan angle."""
    base = points.groupBy(tile).agg(
        F.min("z").alias("_z0"), F.avg("x").alias("_mx"), F.avg("y").alias("_my")
    )
    unit = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    return (
        salted_join(points, base, [tile], ["pid"])
        .withColumn("z_rel", F.col("z") - F.col("_z0"))
        .withColumn("x_c", F.col("x") - F.col("_mx"))
        .withColumn("y_c", F.col("y") - F.col("_my"))
        .withColumn("intensity_norm", unit(F.col("intensity") / F.lit(max(max_intensity, 1.0))))
        .withColumn(
            "return_ratio",
            unit(F.col("return_number") / F.greatest(F.col("number_of_returns"), F.lit(1))),
        )
        .withColumn("n_returns_norm", unit(F.col("number_of_returns") / 8.0))
        .withColumn("angle_norm", unit((F.col("scan_angle") + 90.0) / 180.0))
        .drop("_z0", "_mx", "_my")
    )


def fill_unresolved(
    points: DataFrame, label: str, size: float = 1.0, reach: int = 7, tile: str = "tile_id"
) -> DataFrame:
    """Unlabelled points (label < 0) take the label of the first occupied cell around them.

    Cells are searched in square rings 0..``reach``, inside a ring by column then row
    offset; the last labelled point (highest pid) speaks for a cell.
    """
    size = max(size, 0.25)
    celled = with_cells(points, size, "tile", tile)
    open_ = F.col(label) < 0
    speakers = celled.filter(~open_).groupBy(tile, "cx", "cy").agg(
        F.max_by(label, "pid").alias("_lab")
    )
    # questions are asked once per cell, not per point
    asking = celled.filter(open_).select(tile, "cx", "cy").distinct()
    span = F.sequence(F.lit(-reach), F.lit(reach))
    offsets = asking.withColumn("_dx", F.explode(span)).withColumn("_dy", F.explode(span))
    rank = F.struct(F.greatest(F.abs("_dx"), F.abs("_dy")).alias("ring"), "_dx", "_dy")
    found = (
        offsets.withColumn("_qx", F.col("cx")).withColumn("_qy", F.col("cy"))
        .withColumn("cx", F.col("cx") + F.col("_dx")).withColumn("cy", F.col("cy") + F.col("_dy"))
        .join(speakers, [tile, "cx", "cy"])
        .groupBy(tile, F.col("_qx").alias("cx"), F.col("_qy").alias("cy"))
        .agg(F.min_by("_lab", rank).alias("_found"))
    )
    return (
        salted_join(celled, found, [tile, "cx", "cy"], ["pid"], "left")
        .withColumn(label, F.when(open_, F.coalesce("_found", label)).otherwise(F.col(label)))
        .drop("_found", "cx", "cy")
    )


def height_rules(
    points: DataFrame, label: str, min_building: float = -1.0, max_ground: float = -1.0,
    min_vegetation: float = -1.0, building: int = 1, ground: int = 0, vegetation: int = 2,
    building_fallback: int = 2, ground_fallback: int = 2,
) -> DataFrame:
    """Correct labels by height: low buildings, then high ground, then low vegetation.

    Nothing happens unless one of the first two limits is switched on (>= 0).
    """
    if min_building < 0 and max_ground < 0:
        return points
    lab, h = F.col(label), F.col("hag")
    out = points
    if min_building >= 0:
        out = out.withColumn(label, F.when((lab == building) & (h < min_building), building_fallback).otherwise(lab))
    if max_ground >= 0:
        out = out.withColumn(label, F.when((lab == ground) & (h > max_ground), ground_fallback).otherwise(lab))
    if min_vegetation >= 0:
        out = out.withColumn(label, F.when((lab == vegetation) & (h < min_vegetation), ground).otherwise(lab))
    return out


def file_metadata(points: DataFrame, tile: str = "tile_id", record_bytes: int = 34) -> DataFrame:
    """Count, size estimate, density, spacing, box and value ranges per file."""
    ext = points.groupBy(tile).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("minx"), F.max("x").alias("maxx"),
        F.min("y").alias("miny"), F.max("y").alias("maxy"), F.min("z").alias("minz"), F.max("z").alias("maxz"),
        F.min("intensity").alias("min_int"), F.max("intensity").alias("max_int"),
    )
    return density_from_extent(ext).drop("resolution").withColumn(
        "est_mb", F.col("n") * record_bytes / F.lit(1048576.0)
    )


def score_blocks(points: DataFrame, predict, schema: str, keys: Sequence[str] = ("tile_id", "bx", "by")):
    """Run a user model on each block: ``predict(pandas frame) -> pandas frame``.

    Blocks bound what one task holds; cut them finer (``assign_blocks``) for dense clouds.
    """
    return points.groupBy(*keys).applyInPandas(predict, schema)
