"""Vertical correction: raster sampling, height differences, control interpolation, plane fits."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..core.grid import cell, nearest, pairs_within
from ..core.lineage import cut
from ..core.quantiles import exact_quantiles, group_median
from ..core.skew import HOT_ROWS, checked_join, group_shape, salted_join
from .points import valid_value


def sample_raster(
    points: DataFrame, cells: DataFrame, size: float, out: str = "v", nodata: float | None = None,
    origin: tuple[float, float] = (0.0, 0.0), north_up: bool = False, digits: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Value of the cell holding each point; null outside the raster or on nodata.

    ``cells`` has ``row_i, col_i, v`` (and ``keys``); ``north_up`` counts rows down from the
    origin.
    """
    x0, y0 = origin
    row = cell(F.lit(y0) - F.col("y") if north_up else F.col("y") - F.lit(y0), size)
    values = cells.filter(valid_value(F.col("v"), nodata)).select(
        *keys, F.col("row_i").cast("long").alias("_r"), F.col("col_i").cast("long").alias("_c"),
        (F.round("v", digits) if digits is not None else F.col("v")).alias(out),
    )
    keyed = points.withColumn("_r", row).withColumn("_c", cell(F.col("x") - F.lit(x0), size))
    spread = ["pid"] if "pid" in points.columns else ["x", "y"]
    return salted_join(keyed, values, [*keys, "_r", "_c"], spread, "left").drop("_r", "_c")


def sample_tiles(
    points: DataFrame, tiles: DataFrame, out: str = "v", nodata: float | None = None
) -> DataFrame:
    """Raster sampling straight from storage tiles ``tr, tc, h, w, size, data``.

    Tile row ``tr`` and column ``tc`` count blocks of the largest ``h`` and ``w``; a tile at the edge may
    have fewer rows or columns and is read with its own width.  All tiles share one cell size.
    """
    shape = tiles.agg(F.max("h").alias("h"), F.max("w").alias("w"), F.min("size").alias("size"), F.max("size").alias("top")).first()
    if shape["size"] != shape["top"]:
        raise ValueError("sample_tiles takes tiles of one cell size")
    size, h, w = shape["size"] or 1.0, shape["h"] or 1, shape["w"] or 1
    keyed = points.withColumn("_r", cell(F.col("y"), size)).withColumn("_c", cell(F.col("x"), size))
    keyed = keyed.withColumn("tr", F.floor(F.col("_r") / h)).withColumn("tc", F.floor(F.col("_c") / w))
    spread = ["pid"] if "pid" in points.columns else ["x", "y"]
    stored = tiles.select("tr", "tc", F.col("h").alias("_h"), F.col("w").alias("_w"), "data")
    joined = salted_join(keyed, stored, ["tr", "tc"], spread, "left")
    i, j = F.col("_r") - F.col("tr") * h, F.col("_c") - F.col("tc") * w
    v = F.when((i < F.col("_h")) & (j < F.col("_w")), F.get("data", (i * F.col("_w") + j).cast("int")).cast("double"))
    return joined.withColumn(out, F.when(valid_value(v, nodata), v)).drop("_r", "_c", "tr", "tc", "_h", "_w", "data")


def height_difference(df: DataFrame, ref: str, z: str = "z") -> DataFrame:
    """Adds ``valid`` and ``dz = ref - z``, zero where the reference is missing."""
    d = F.col(ref) - F.col(z)
    return df.withColumn("valid", F.col(ref).isNotNull()).withColumn("dz", F.coalesce(d, F.lit(0.0)))


def apply_dz(df: DataFrame, dz: str = "dz", clip: float | None = None) -> DataFrame:
    """Adds ``z_corr = z + dz``, the correction optionally clipped."""
    d = F.coalesce(F.col(dz), F.lit(0.0))
    if clip:
        d = F.least(F.greatest(d, F.lit(-clip)), F.lit(clip))
    return df.withColumn("z_corr", F.col("z") + d)


def median_clip(
    df: DataFrame, keys: Sequence[str], factor: float | None = None, dz: str = "dz",
    drop_positive: bool = False, absolute: bool = False,
    abs_min: float | None = None, abs_max: float | None = None,
) -> DataFrame:
    """Drop rows with ``|dz| > factor * |median|``; the median is taken before other filters.

    The text cleaner drops positive values and reports ``|dz|``; the generator keeps signs.
    """
    out = df
    if factor is not None:
        med = group_median(df, keys, dz, "_med")
        spread = [c for c in ("pid", "x", "y") if c in df.columns]
        out = salted_join(df, med, keys, spread or [dz])
        out = out.filter(F.abs(dz) <= F.lit(factor) * F.abs("_med")).drop("_med")
    if drop_positive:
        out = out.filter(F.col(dz) <= 0)
    if abs_min is not None:
        out = out.filter(F.abs(dz) >= abs_min)
    if abs_max is not None:
        out = out.filter(F.abs(dz) <= abs_max)
    return out.withColumn(dz, F.abs(dz)) if absolute else out


def nearest_join(
    left: DataFrame, right: DataFrame, tol: float, left_id: str = "pid", right_id: str = "cid",
    right_xy: Sequence[str] = ("x", "y"), dense: int = 2_000,
) -> DataFrame:
    """``left_id, right_id, dist`` of the closest right point in XY, where within ``tol``."""
    return nearest(left, right, tol, left_id, right_id, ("x", "y"), right_xy, dense)


def nearest_any(
    left: DataFrame, right: DataFrame, start: float, left_id: str, right_id: str,
    right_xy: Sequence[str] = ("x", "y"), grow: float = 4.0, keys: Sequence[str] = (),
) -> DataFrame:
    """Closest right point at any distance among those with equal ``keys``; the radius grows until every left row has one.

    Left rows whose keys have no right point, or whose position is no number, are left out.  After the first
    round only the right points around rows still open are searched.
    """
    keys, (rx, ry) = list(keys), right_xy
    fits = lambda x, y: F.col(x).isNotNull() & ~F.isnan(x) & F.col(y).isNotNull() & ~F.isnan(y)
    right = right.filter(fits(rx, ry))
    open_ = left.filter(fits("x", "y"))
    open_ = open_.join(right.select(*keys).distinct(), keys, "left_semi") if keys else open_
    if right.isEmpty():
        return nearest(left.limit(0), right, start, left_id, right_id, ("x", "y"), right_xy, keys=keys)
    # a wider first radius would compare every row with more points the denser they lie
    gap = 0.0 if keys else usual_gap(right, rx, ry)
    radius, done, around = min(start, max(gap, start / 1024)) if gap > 0 else start, None, right
    while True:
        found = cut(nearest(open_, around, radius, left_id, right_id, ("x", "y"), right_xy, keys=keys))
        done = found if done is None else done.unionByName(found)
        open_ = cut(open_.join(found.select(*keys, left_id), [*keys, left_id], "left_anti"))
        if open_.isEmpty():
            return done
        radius *= grow
        box = open_.select(*keys, cell(F.col("x"), radius).alias("_i"), cell(F.col("y"), radius).alias("_j")).distinct()
        step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        near = box.withColumn("_n", step).select(*keys, (F.col("_i") + F.col("_n.i")).alias("_i"), (F.col("_j") + F.col("_n.j")).alias("_j")).distinct()
        placed = right.withColumn("_i", cell(F.col(rx), radius)).withColumn("_j", cell(F.col(ry), radius))
        around = placed.join(near, [*keys, "_i", "_j"], "left_semi").drop("_i", "_j")


def usual_gap(points: DataFrame, x: str, y: str) -> float:
    """Side of a square that holds one of the points on average; 0 where they lie on one line."""
    e = points.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{i}{f.__name__}") for i, c in enumerate((x, y)) for f in (F.min, F.max)]).first()
    return ((e["0max"] - e["0min"]) * (e["1max"] - e["1min"]) / e["n"]) ** 0.5


def idw_join(
    targets: DataFrame, control: DataFrame, target_id: str, value: str = "dz", power: float = 2.0,
    radius: float = 3.0, max_points: int = 12, min_points: int = 1, control_id: str = "cid",
    target_xy: Sequence[str] = ("tx", "ty"), control_xy: Sequence[str] = ("x", "y"),
) -> DataFrame:
    """Inverse-distance mean of the closest ``max_points`` control values around each target.

    ``target_id, n, v``; targets with fewer than ``min_points`` are left out and a control
    point on the target decides alone.  Targets are distinct cell centres, so each control
    point meets a bounded number of them.
    """
    pairs = pairs_within(
        control.select(control_id, *control_xy, value),
        targets.select(target_id, *target_xy), radius, control_xy, target_xy, [control_id],
    )
    by_distance = Window.partitionBy(target_id).orderBy("_d", control_id)
    near = pairs.withColumn("_k", F.row_number().over(by_distance)).filter(F.col("_k") <= max_points)
    w = F.when(F.col("_d") > 0, 1 / F.pow("_d", F.lit(power)))
    agg = near.groupBy(target_id).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(value, F.when(F.col("_d") == 0, F.col("_k"))).alias("_hit"),
        F.min("_d").alias("_d0"), (F.sum(F.col(value) * w) / F.sum(w)).alias("_idw"),
    )
    v = F.when(F.col("_d0") == 0, F.col("_hit")).otherwise(F.col("_idw"))
    return agg.filter(F.col("n") >= min_points).select(target_id, "n", v.alias("v"))


def control_surface(
    points: DataFrame, control: DataFrame, size: float, strip: str = "strip_id", **idw
) -> DataFrame:
    """Control values interpolated on the cells that hold points, then read back per point."""
    keyed = points.withColumn("_r", cell(F.col("y"), size)).withColumn("_c", cell(F.col("x"), size))
    targets = keyed.select("_r", "_c").distinct().withColumn(
        "_t", F.struct("_r", "_c")
    ).withColumn("tx", (F.col("_c") + 0.5) * size).withColumn("ty", (F.col("_r") + 0.5) * size)
    surf = idw_join(targets, control, "_t", **idw).select(
        F.col("_t._r").alias("_r"), F.col("_t._c").alias("_c"), F.col("v").alias("dz")
    )
    return salted_join(keyed, surf, ["_r", "_c"], ["pid"], "left").drop("_r", "_c")


def match_strip_control(strips: DataFrame, control: DataFrame, suffix: str, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """Strip files with the control file of the same stem plus ``suffix``, and the strips that have none."""
    stem = F.regexp_replace(F.element_at(F.split(F.col(path), "/"), -1), r"\.[^.]*$", "")
    keyed = strips.withColumn("_stem", F.concat(stem, F.lit(suffix)))
    have = control.select(stem.alias("_stem"), F.col(path).alias("control_path"))
    return keyed.join(have, "_stem").drop("_stem"), keyed.join(have, "_stem", "left_anti").drop("_stem")


# --- robust plane ------------------------------------------------------------

def _plane(kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Least-squares plane per group from central moments: ``keys, _n, a, b, c``."""
    m = kept.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.avg("dx").alias("_mx"), F.avg("dy").alias("_my"), F.avg("dz").alias("_mz"),
        F.var_pop("dx").alias("_sxx"), F.var_pop("dy").alias("_syy"), F.covar_pop("dx", "dy").alias("_sxy"),
        F.covar_pop("dx", "dz").alias("_sxz"), F.covar_pop("dy", "dz").alias("_syz"),
    )
    sxx, syy, sxy, sxz, syz = (F.col(c) for c in ("_sxx", "_syy", "_sxy", "_sxz", "_syz"))
    det = sxx * syy - sxy * sxy
    solid = det > 1e-12 * sxx * syy
    # a degenerate layout (all on one line) falls back to the mean
    b = F.when(solid, (sxz * syy - syz * sxy) / F.nullif(det, F.lit(0.0))).otherwise(0.0)
    c = F.when(solid, (syz * sxx - sxz * sxy) / F.nullif(det, F.lit(0.0))).otherwise(0.0)
    return (
        m.withColumn("b", b).withColumn("c", c)
        .withColumn("a", F.col("_mz") - F.col("b") * F.col("_mx") - F.col("c") * F.col("_my"))
        .select(*keys, "_n", "a", "b", "c")
    )


def _residual() -> Column:
    return F.col("dz") - F.col("a") - F.col("b") * F.col("dx") - F.col("c") * F.col("dy")


def robust_plane(
    control: DataFrame, keys: Sequence[str] = ("strip_id",), iters: int = 6, k: float = 2.5,
    min_keep: float = 0.25, row_id: str = "cid",
) -> DataFrame:
    """Plane ``dz = a + b (x - x0) + c (y - y0)`` per strip with residual clipping.

    Returns ``keys, x0, y0, a, b, c, n, kept, rmse``.  A strip stops when too few rows are
    kept, the residual spread vanishes or the kept count stays the same.
    """
    keys = list(keys)
    groups, most = group_shape(control, keys)
    hot_rows = None if most <= HOT_ROWS else HOT_ROWS
    attach = lambda left, right: checked_join(left, right, groups, keys, [row_id])
    centre = (
        control.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        .join(group_median(control, keys, "x", "x0", hot_rows), keys)
        .join(group_median(control, keys, "y", "y0", hot_rows), keys)
    )
    nothing = F.lit(None).cast("double")
    # one state row per strip: the plane, median and limit that define the kept rows
    state = cut(centre.withColumns(
        {"a": nothing, "b": nothing, "c": nothing, "_med": nothing, "_lim": nothing,
         "_kept": F.col("n"), "_live": F.lit(True)}
    ))
    rows = cut(
        attach(control.select(*keys, row_id, "x", "y", "dz"), centre)
        .select(*keys, row_id, (F.col("x") - F.col("x0")).alias("dx"),
                (F.col("y") - F.col("y0")).alias("dy"), "dz")
    )
    keep = F.col("_lim").isNull() | (F.abs(_residual() - F.col("_med")) <= F.col("_lim"))
    for _ in range(iters):
        enough = F.col("_kept") >= F.greatest(F.lit(30), F.floor(F.lit(min_keep) * F.col("n")))
        live = state.filter(F.col("_live") & enough)
        if live.isEmpty():
            break
        kept = attach(rows, live).filter(keep).select(*keys, row_id, "dx", "dy", "dz")
        plane = cut(_plane(kept, keys).drop("_n"))
        res = attach(kept, plane).withColumn("_res", _residual())
        med = cut(group_median(res, keys, "_res", "_med", hot_rows).join(plane, keys))
        dev = attach(res.drop("a", "b", "c"), med).withColumn("_dev", F.abs(F.col("_res") - F.col("_med")))
        mad = group_median(dev, keys, "_dev", "_mad", hot_rows)
        # fixed value: MAD to sigma
        fresh = cut(med.join(mad, keys).withColumn("_lim", F.lit(k * 1.4826) * F.col("_mad")).filter(
            1.4826 * F.col("_mad") >= 1e-6))
        counts = attach(rows, fresh).filter(keep).groupBy(*keys).agg(F.count(F.lit(1)).alias("_now"))
        moved = fresh.drop("_mad").join(counts, keys, "left").withColumn("_now", F.coalesce("_now", F.lit(0)))
        old = live.select(*keys, "n", "x0", "y0", F.col("_kept").alias("_was"))
        changed = old.join(moved, keys).select(
            *keys, "n", "x0", "y0", "a", "b", "c", "_med", "_lim", F.col("_now").alias("_kept"),
            (F.col("_now") != F.col("_was")).alias("_live"),
        )
        rest = state.join(changed.select(*keys), keys, "left_anti").withColumn("_live", F.lit(False))
        state = cut(changed.unionByName(rest))
    kept = attach(rows, state).filter(keep).select(*keys, row_id, "dx", "dy", "dz")
    final = cut(_plane(kept, keys))
    scored = attach(kept, final).withColumn("_res", _residual())
    rmse = scored.groupBy(*keys).agg(F.sqrt(F.avg(F.col("_res") * F.col("_res"))).alias("rmse"))
    return final.withColumnRenamed("_n", "kept").join(rmse, keys).join(
        state.select(*keys, "n", "x0", "y0"), keys)


def apply_plane(
    points: DataFrame, planes: DataFrame, keys: Sequence[str] = ("strip_id",), clip: float | None = None
) -> DataFrame:
    """Adds the plane's ``dz`` (clipped to ``±clip``) and ``z_corr`` to each point of the strip."""
    planes = planes.select(*keys, "x0", "y0", "a", "b", "c")
    joined = checked_join(points, planes, planes.count(), list(keys), ["pid"])
    dz = F.col("a") + F.col("b") * (F.col("x") - F.col("x0")) + F.col("c") * (F.col("y") - F.col("y0"))
    if clip:
        dz = F.least(F.greatest(dz, F.lit(-clip)), F.lit(clip))
    return joined.withColumn("dz", dz).drop("x0", "y0", "a", "b", "c").transform(apply_dz)


# --- scoring and sweeps ------------------------------------------------------

def nn_metrics(
    ref: DataFrame, gen: DataFrame, tol: float, ref_id: str, gen_id: str, value: str = "dz",
    start: float | None = None,
) -> DataFrame:
    """One row: errors of the closest generated value within ``tol`` of each reference point.

    Distance median and p95 cover all reference points, matched or not.
    """
    near = nearest_any(ref, gen, start or tol, ref_id, gen_id)
    errs = (
        salted_join(
            near.join(ref.select(ref_id, F.col(value).alias("_rv")), ref_id),
            gen.select(gen_id, F.col(value).alias("_gv")), [gen_id], [ref_id],
        )
        .withColumn("_m", F.col("dist") <= tol)
        .withColumn("_e", F.when(F.col("_m"), F.col("_gv") - F.col("_rv")))
        .withColumn("_ae", F.abs("_e"))
    )
    errs = cut(errs.select("dist", "_m", "_e", "_ae"))
    sums = errs.agg(
        F.count_if("_m").alias("matched"), F.avg("_e").alias("mean"), F.avg("_ae").alias("mae"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"),
    )
    e = exact_quantiles(errs, [], "_e", [0.5], "q").select(F.col("q")[0].alias("median"))
    ae = exact_quantiles(errs, [], "_ae", [0.95], "q").select(F.col("q")[0].alias("p95_abs"))
    d = exact_quantiles(errs, [], "dist", [0.5, 0.95], "q").select(
        F.col("q")[0].alias("dist_median"), F.col("q")[1].alias("dist_p95")
    )
    one = F.lit(1)  # all of these frames have at most one row
    sizes = ref.agg(F.count(one).alias("n_ref")).crossJoin(gen.agg(F.count(one).alias("n_gen")))
    out = sizes.crossJoin(sums)
    for part in (e, ae, d):
        out = out.withColumn("_j", one).join(F.broadcast(part.withColumn("_j", one)), "_j", "left").drop("_j")
    some = F.col("matched") > 0
    return out.withColumns({c: F.when(some, F.col(c)) for c in ("dist_median", "dist_p95")})


def parameter_grid(spark, lists: Mapping[str, Sequence], max_runs: int | None = None) -> DataFrame:
    """Every combination of the parameter values in order: ``run_id`` plus one column each.

    The lists are arguments typed by the caller, not data.
    """
    grid = spark.range(1).select(F.lit(0).alias("_o"))
    for name, values in lists.items():
        part = F.posexplode(F.array(*[F.lit(v) for v in values])).alias("_p", name)
        grid = grid.select("*", part).withColumn("_o", F.col("_o") * len(values) + F.col("_p")).drop("_p")
    runs = grid.withColumn("run_id", F.col("_o") + 1).drop("_o")
    return runs if max_runs is None else runs.filter(F.col("run_id") <= max_runs)


def sweep(
    spark, operator: Callable[..., DataFrame], lists: Mapping[str, Sequence], max_runs: int | None = None
) -> DataFrame:
    """Union of ``operator(**parameters)`` over a parameter grid, tagged with its ``run_id``."""
    runs = parameter_grid(spark, lists, max_runs).orderBy("run_id").collect()  # caller's arguments
    out = None
    for run in runs:
        args = {k: run[k] for k in lists}
        part = operator(**args).withColumn("run_id", F.lit(run["run_id"])).withColumns(
            {k: F.lit(v) for k, v in args.items()}
        )
        out = part if out is None else out.unionByName(part)
    return out


def top_runs(report: DataFrame, n: int = 10, score: str = "mae") -> DataFrame:
    """Best runs by score, undefined scores last."""
    undefined = F.col(score).isNull() | F.isnan(score)
    return report.orderBy(F.when(undefined, 1e9).otherwise(F.col(score)), "run_id").limit(n)
