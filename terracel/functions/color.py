"""Colour-space expressions with 8-bit conventions (hue 0..179, L scaled to 255, a and b + 128)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: sRGB to XYZ (D65) rows, each divided by the white point, and luma weights
XYZ = ((0.412453 / 0.950456, 0.357580 / 0.950456, 0.180423 / 0.950456), (0.212671, 0.715160, 0.072169),
       (0.019334 / 1.088754, 0.119193 / 1.088754, 0.950227 / 1.088754))
RGB = ((3.240479, -1.53715, -0.498535), (-0.969256, 1.875991, 0.041556), (0.055648, -0.204043, 1.057311))
WHITE = (0.950456, 1.0, 1.088754)
LUMA = (0.299, 0.587, 0.114)


def clip(v: Column, lo: float = 0.0, hi: float = 255.0) -> Column:
    return F.least(F.greatest(v, F.lit(lo)), F.lit(hi))


def rgb_to_lab(r: Column, g: Column, b: Column) -> Column:
    """``struct(l, a, b)`` in 8-bit scaling, not rounded."""
    lin = lambda c: F.when(c / 255 > 0.04045, F.pow((c / 255 + 0.055) / 1.055, F.lit(2.4))).otherwise(c / 255 / 12.92)
    rl, gl, bl = lin(r), lin(g), lin(b)
    x, y, z = (m[0] * rl + m[1] * gl + m[2] * bl for m in XYZ)
    f = lambda t: F.when(t > 0.008856, F.cbrt(t)).otherwise(7.787 * t + 16 / 116)
    light = F.when(y > 0.008856, 116 * F.cbrt(y) - 16).otherwise(903.3 * y)
    return F.struct((light * 255 / 100).alias("l"), (500 * (f(x) - f(y)) + 128).alias("a"), (200 * (f(y) - f(z)) + 128).alias("b"))


def lab_to_rgb(light: Column, a: Column, b: Column) -> Column:
    """``struct(r, g, b)`` 0..255 of 8-bit scaled LAB, clipped, not rounded."""
    ll = light * 100 / 255
    fy = F.when(ll > 7.9996248, (ll + 16) / 116).otherwise(ll / 903.3 * 7.787 + 16 / 116)
    y = F.when(ll > 7.9996248, fy * fy * fy).otherwise(ll / 903.3)
    inv = lambda t: F.when(t > 0.206893, t * t * t).otherwise((t - 16 / 116) / 7.787)
    x, z = inv(fy + (a - 128) / 500) * WHITE[0], inv(fy - (b - 128) / 200) * WHITE[2]
    gam = lambda c: F.when(c > 0.0031308, 1.055 * F.pow(F.greatest(c, F.lit(0.0)), F.lit(1 / 2.4)) - 0.055).otherwise(12.92 * c)
    rgb = [clip(gam(m[0] * x + m[1] * y + m[2] * z) * 255) for m in RGB]
    return F.struct(*[c.alias(n) for c, n in zip(rgb, "rgb")])


def rgb_to_hsv(r: Column, g: Column, b: Column) -> Column:
    """``struct(h, s, v)`` with h 0..179, s and v 0..255, rounded."""
    v, low = F.greatest(r, g, b), F.least(r, g, b)
    d = F.nullif((v - low).cast("double"), F.lit(0.0))
    h = F.when(v == r, 60 * (g - b) / d).when(v == g, 120 + 60 * (b - r) / d).otherwise(240 + 60 * (r - g) / d)
    h = F.coalesce(h, F.lit(0.0))
    hue = F.round(F.when(h < 0, h + 360).otherwise(h) / 2)
    s = F.coalesce(255 * (v - low) / F.nullif(v.cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.struct(F.when(hue >= 180, hue - 180).otherwise(hue).alias("h"), F.round(s).alias("s"), v.cast("double").alias("v"))


def hsv_to_rgb(h: Column, s: Column, v: Column) -> Column:
    """``struct(r, g, b)`` rounded, of 8-bit HSV."""
    c = v * s / 255
    sector = h / 30
    x = c * (1 - F.abs(F.pmod(sector, F.lit(2.0)) - 1))
    zero, m = F.lit(0.0), v - c
    i = F.floor(sector)
    pick = lambda *six: F.element_at(F.array(*six), (F.pmod(i, F.lit(6)) + 1).cast("int"))
    r, g, b = pick(c, x, zero, zero, x, c), pick(x, c, c, x, zero, zero), pick(zero, zero, x, c, c, x)
    return F.struct(F.round(r + m).alias("r"), F.round(g + m).alias("g"), F.round(b + m).alias("b"))


def rgb_to_yuv(r: Column, g: Column, b: Column) -> Column:
    """``struct(y, u, v)`` with u and v around 128, not rounded."""
    y = LUMA[0] * r + LUMA[1] * g + LUMA[2] * b
    return F.struct(y.alias("y"), (0.492 * (b - y) + 128).alias("u"), (0.877 * (r - y) + 128).alias("v"))


def yuv_to_rgb(y: Column, u: Column, v: Column) -> Column:
    r = y + 1.140 * (v - 128)
    g = y - 0.395 * (u - 128) - 0.581 * (v - 128)
    b = y + 2.032 * (u - 128)
    return F.struct(clip(r).alias("r"), clip(g).alias("g"), clip(b).alias("b"))


def smoothstep(v: Column, edge: float, softness: float) -> Column:
    """0 below ``edge``, 1 above ``edge + softness``, smooth between."""
    if softness <= 0:
        return (v >= edge).cast("double")
    t = clip((v - edge) / softness, 0.0, 1.0)
    return t * t * (3 - 2 * t)


def piecewise(v: Column, src: Column, dst: Column) -> Column:
    """Curve map over two arrays, end slopes outside; a constant source only shifts."""
    n = F.size(src)
    first, last = F.element_at(src, 1), F.element_at(src, -1)
    d_first, d_last = F.element_at(dst, 1), F.element_at(dst, -1)
    span = F.nullif(last - first, F.lit(0.0))
    whole = (d_last - d_first) / F.greatest(span, F.lit(1e-6))
    slope = lambda i, j: F.coalesce(
        (F.element_at(dst, j) - F.element_at(dst, i)) / F.nullif(F.element_at(src, j) - F.element_at(src, i), F.lit(0.0)), whole)
    # the last knot not above v starts the segment
    i = F.least(F.greatest(F.size(F.filter(src, lambda s: s <= v)), F.lit(1)), n - 1)
    s0, d0, s1, d1 = F.element_at(src, i), F.element_at(dst, i), F.element_at(src, i + 1), F.element_at(dst, i + 1)
    inner = d0 + (v - s0) * F.coalesce((d1 - d0) / F.nullif(s1 - s0, F.lit(0.0)), F.lit(0.0))
    return (
        F.when((n != F.size(dst)) | (n < 2), v)
        .when(last == first, v - first + d_first)
        .when(v < first, d_first + (v - first) * slope(F.lit(1), F.lit(2)))
        .when(v > last, d_last + (v - last) * slope(F.lit(-2), F.lit(-1)))
        .when(v == last, d_last)
        .otherwise(inner)
    )
