"""Colour matching: percentile fits, parameter rules, tone and LAB transfer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..core.quantiles import exact_quantiles
from ..core.skew import salted_join
from ..functions import color as C
from .points import valid_value

INF = float("inf")
# fixed values: reasons of channels that cannot be fitted
NO_SOURCE = "Sem amostras na area para esse canal."
NO_REFERENCE = "Sem amostras de referencia para esse canal."


def affine_from_percentiles(
    source: DataFrame, rgb_ref: DataFrame, cir_ref: DataFrame, lo: float = 2.0, hi: float = 98.0,
    gain_min: float = -INF, gain_max: float = INF, ir_gain: float = 1.0, ir_shift: float = 0.0,
) -> DataFrame:
    """Gain and offset per channel from ``channel, v`` samples: one row per channel R, G, B, I.

    RGB references feed R, G and B, CIR references only I.  A channel without samples on a side
    is disabled with a reason.  A clamped gain keeps the middle of the fitted range.
    """
    probs = [lo / 100, hi / 100]
    src = exact_quantiles(source, ["channel"], "v", probs, "_s").withColumnRenamed("n", "source_samples")
    ref = rgb_ref.filter(F.col("channel").isin("R", "G", "B")).unionByName(cir_ref.filter(F.col("channel") == "I"))
    ref = exact_quantiles(ref, ["channel"], "v", probs, "_r").withColumnRenamed("n", "reference_samples")
    both = src.join(ref, "channel", "full").filter(F.col("channel").isin("R", "G", "B", "I"))
    s0, s1, r0, r1 = F.col("_s")[0], F.col("_s")[1], F.col("_r")[0], F.col("_r")[1]
    gain = (r1 - r0) / (s1 - s0 + 1e-9)
    fitted = both.withColumn("_g", gain).withColumn("_o", r0 - F.col("_g") * s0)
    g, o = clamp_gain(F.col("_g"), F.col("_o"), s0, s1, gain_min, gain_max)
    ir = F.col("channel") == "I"
    ok = F.col("_s").isNotNull() & F.col("_r").isNotNull()
    return fitted.select(
        "channel", ok.alias("enabled"),
        F.when(F.col("_s").isNull(), NO_SOURCE).when(F.col("_r").isNull(), NO_REFERENCE).otherwise("ok").alias("reason"),
        F.when(~ok, 1.0).when(ir, g * ir_gain).otherwise(g).alias("gain"), F.when(~ok, 0.0).when(ir, o + ir_shift).otherwise(o).alias("offset"),
        "source_samples", "reference_samples", s0.alias("source_low"), s1.alias("source_high"), r0.alias("reference_low"), r1.alias("reference_high"))


def clamp_gain(gain: Column, offset: Column, src_lo: Column, src_hi: Column, gain_min: float, gain_max: float) -> tuple[Column, Column]:
    """Gain within limits; a changed gain moves the offset so that the mid-point keeps its value."""
    g = F.least(F.greatest(gain, F.lit(gain_min)), F.lit(gain_max))
    mid = 0.5 * (src_lo + src_hi)
    return g, F.when(g == gain, offset).otherwise(gain * mid + offset - g * mid)


def refine_params(new: DataFrame, base: DataFrame, max_gain: float = INF, max_offset: float = INF, blend: float = 1.0) -> DataFrame:
    """New parameters held near the base ones: delta clipped, then blended; only where both are enabled."""
    b = base.select("channel", F.col("enabled").alias("_be"), F.col("gain").alias("base_gain"), F.col("offset").alias("base_offset"))
    j = new.join(b, "channel", "left")
    both = F.coalesce(F.col("enabled") & F.col("_be"), F.lit(False))
    k = min(1.0, max(0.0, blend))
    near = lambda c, m: F.col(f"base_{c}") + k * F.least(F.greatest(F.col(c) - F.col(f"base_{c}"), F.lit(-m)), F.lit(m))
    return j.withColumn("_g", F.when(both, near("gain", max_gain)).otherwise(F.col("gain"))).withColumn(
        "offset", F.when(both, near("offset", max_offset)).otherwise(F.col("offset"))).withColumn("gain", F.col("_g")).withColumn("refined", both).drop("_g", "_be")


def apply_gain_offset(cells: DataFrame, params: DataFrame, lo: float = 0.0, hi: float = 255.0, nodata: float | None = None) -> DataFrame:
    """Enabled channels, valid cells only; result rounded half to even and clipped to the data type.

    ``params`` has one row per channel, of which there may be any number.
    """
    j = cells.join(params.select("channel", "enabled", "gain", "offset"), "channel", "left")
    change = F.coalesce("enabled", F.lit(False)) & valid_value(F.col("v"), nodata)
    v = C.clip(F.bround(F.col("v") * F.col("gain") + F.col("offset")), lo, hi)
    return j.withColumn("v", F.when(change, v).otherwise(F.col("v"))).drop("enabled", "gain", "offset")


# fixed values: vegetation mask limits and channel adjustments used when none are given
VEGETATION = {
    "exg": (20.0, 15.0), "rg": (1.05, 0.10), "gb": (1.05, 0.10), "ndvi": (0.05, 0.05), "strength": 1.0,
    "gain": {"r": 1.0, "g": 1.06, "b": 1.0, "ir": 1.0}, "offset": {"r": 0.0, "g": 0.0, "b": 0.0, "ir": 0.0},
}


def vegetation_weight(cfg: Mapping = VEGETATION, use_ndvi: bool = True, nodata: float | None = None) -> Column:
    """Weight 0..1 of pixels ``r, g, b, ir``: excess green, green ratios and NDVI, all smooth."""
    r, g, b, ir = (F.col(c).cast("double") for c in ("r", "g", "b", "ir"))
    w = C.smoothstep(2 * g - r - b, *cfg["exg"]) * C.smoothstep(g / (r + 1e-9), *cfg["rg"]) * C.smoothstep(g / (b + 1e-9), *cfg["gb"])
    ok = valid_value(r, nodata) & valid_value(g, nodata) & valid_value(b, nodata)
    if use_ndvi:
        w = w * C.smoothstep((ir - r) / (ir + r + 1e-9), *cfg["ndvi"])
        ok = ok & valid_value(ir, nodata)
    return F.when(ok, C.clip(w * cfg["strength"], 0.0, 1.0)).otherwise(0.0)


def selective_tuning(pixels: DataFrame, cfg: Mapping = VEGETATION, use_ndvi: bool = True, nodata: float | None = None) -> DataFrame:
    """Gain and offset blended in by the vegetation weight: ``w`` and new ``r, g, b, ir``."""
    out = pixels.withColumn("w", vegetation_weight(cfg, use_ndvi, nodata))
    tuned = {c: F.col(c) * (1 + F.col("w") * (cfg["gain"][c] - 1)) + F.col("w") * cfg["offset"][c] for c in ("r", "g", "b", "ir")}
    return out.withColumns(tuned)


def lab_stats(pixels: DataFrame, keys=("tile_id",)) -> DataFrame:
    """Mean and population deviation of L, a and b."""
    lab = pixels.withColumn("_q", C.rgb_to_lab(F.col("r"), F.col("g"), F.col("b")))
    aggs = [f(F.col(f"_q.{c}")).alias(f"{n}_{c}") for c in "lab" for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    return lab.groupBy(*keys).agg(*aggs)


def lab_transfer(pixels: DataFrame, source: DataFrame, reference: DataFrame, keys=("tile_id",)) -> DataFrame:
    """Source LAB distribution moved to the reference's: ``(v - ms) * sr / (ss + 1e-8) + mr``, clipped, as RGB.

    ``reference`` has one row; more raise an error.
    """
    names = [f"{n}_{c}" for c in "lab" for n in ("mean", "std")]
    several = F.raise_error(F.lit("lab_transfer takes one reference row"))
    ref = reference.agg(*[F.when(F.count(F.lit(1)) > 1, several).otherwise(F.max(n)).alias(f"r_{n}") for n in names])
    j = salted_join(pixels, source.select(*keys, *names), list(keys), ["row_i", "col_i"]).crossJoin(F.broadcast(ref))
    j = j.withColumn("_q", C.rgb_to_lab(F.col("r"), F.col("g"), F.col("b")))
    moved = [C.clip((F.col(f"_q.{c}") - F.col(f"mean_{c}")) * F.col(f"r_std_{c}") / (F.col(f"std_{c}") + 1e-8) + F.col(f"r_mean_{c}")) for c in "lab"]
    rgb = C.lab_to_rgb(*moved)
    return j.withColumn("_n", rgb).withColumns({c: F.col(f"_n.{c}") for c in "rgb"}).drop("_n", "_q", *names, *[f"r_{n}" for n in names])


def tone(
    pixels: DataFrame, brightness: float = 0, contrast: float = 0, temperature: float = 6500, tint: float = 0,
    gains: tuple[float, float, float] = (1.0, 1.0, 1.0), hue: float = 0, saturation: float = 0, value: float = 0,
    gamma: float = 1.0, haze: float = 0, scale_max: float = 255.0, keys=("tile_id",),
) -> DataFrame:
    """Tone chain on ``r, g, b``: contrast about the image mean, brightness, temperature, tint, gains, HSV, gamma, haze.

    Inputs with another maximum are scaled to 255 and back.  Values are truncated to 8 bits where
    the colour space changes.
    """
    k = 255.0 / scale_max
    px = pixels.withColumns({c: F.col(c).cast("double") * k for c in "rgb"})
    mean = px.groupBy(*keys).agg(F.avg((F.col("r") + F.col("g") + F.col("b")) / 3).alias("_m"))
    px = salted_join(px, mean, list(keys), ["row_i", "col_i"])
    r, g, b = gains
    f = (temperature - 6500) / 4500.0
    r, b = (r * (1 + f), b) if f > 0 else (r, b * (1 - f))
    t = tint / 100.0
    r, g, b = (r * (1 + 0.5 * t), g, b * (1 + 0.5 * t)) if t > 0 else (r, g * (1 - 0.5 * t), b)
    bc = lambda c: C.clip(((1 + contrast / 100) * (F.col(c) - F.col("_m")) + F.col("_m")) * (1 + brightness / 100))
    px = px.withColumns({c: C.clip(bc(c) * gain) for c, gain in zip("rgb", (r, g, b))})
    trunc = lambda c: F.floor(F.col(c))
    px = px.withColumn("_h", C.rgb_to_hsv(trunc("r"), trunc("g"), trunc("b")))
    h = F.floor(F.pmod(F.col("_h.h") + hue, F.lit(180.0)))
    s, v = F.floor(C.clip(F.col("_h.s") * (1 + saturation / 100))), F.floor(C.clip(F.col("_h.v") * (1 + value / 100)))
    px = px.withColumn("_n", C.hsv_to_rgb(h, s, v))
    px = px.withColumns({c: F.col(f"_n.{c}") for c in "rgb"})
    if gamma != 1.0:
        px = px.withColumns({c: C.clip(F.pow(F.col(c) / 255, F.lit(gamma)) * 255) for c in "rgb"})
    if haze > 0:
        yuv = C.rgb_to_yuv(trunc("r"), trunc("g"), trunc("b"))
        px = px.withColumn("_y", yuv).withColumn("_n", C.yuv_to_rgb(C.clip(F.round(F.col("_y.y")) * (1 + haze / 100)), F.round("_y.u"), F.round("_y.v")))
        px = px.withColumns({c: F.col(f"_n.{c}") for c in "rgb"})
    out = {c: F.floor(C.clip(F.floor(F.col(c)) / k, 0.0, scale_max)).cast("int") for c in "rgb"}
    return px.withColumns(out).drop("_m", "_h", "_n", "_y")
