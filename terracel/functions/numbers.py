"""Numeric expressions: units, number text, angles as text, sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: unit factors
FEET_PER_METRE = 3.28084
KNOTS_PER_MS = 1.94384
MS_PER_KNOT = 0.514444
SQUARE_METRES_PER_HECTARE = 10000.0


def metres_to_feet(m: Column) -> Column:
    return m * FEET_PER_METRE


def ms_to_knots(v: Column) -> Column:
    return v * KNOTS_PER_MS


def knots_to_ms(v: Column) -> Column:
    return v * MS_PER_KNOT


def hectares(area: Column) -> Column:
    return area / SQUARE_METRES_PER_HECTARE


def metres_to_degrees(lat: Column, metres: Column) -> tuple[Column, Column]:
    """Longitude and latitude span of a length at a latitude."""
    phi = F.radians(lat)
    # fixed values: metres per degree
    per_lon = F.lit(111320) * F.cos(phi)
    per_lat = F.lit(111132.92) - 559.82 * F.cos(2 * phi) + 1.175 * F.cos(4 * phi)
    return metres / per_lon, metres / per_lat


def clamp(v: Column, lo, hi) -> Column:
    return F.least(F.greatest(v, F.lit(lo)), F.lit(hi))


def number_text(v: Column, decimals: int = 2, grouped: bool = True, null: str = "-") -> Column:
    """Decimal comma and thousands dot ("1.234,50"); ``null`` text for missing values."""
    plain = F.format_string(f"%{',' if grouped else ''}.{decimals}f", v)
    return F.when(v.isNull(), F.lit(null)).otherwise(F.translate(plain, ",.", ".,"))


def trimmed_text(v: Column, decimals: int = 2) -> Column:
    """Fixed decimals without trailing zeros ("850.5", "850")."""
    text = F.format_string(f"%.{decimals}f", v)
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def parse_number(text: Column) -> Column:
    """Number from text such as "1.234,5", "12,5" or "12.5"; null when it is none.

    With one comma and points, the points are thousands marks.
    """
    t = F.replace(F.trim(text), F.lit(" "), F.lit(""))
    commas = F.length(t) - F.length(F.replace(t, F.lit(","), F.lit("")))
    t = F.when((commas == 1) & t.contains("."), F.replace(t, F.lit("."), F.lit(""))).otherwise(t)
    value = F.replace(t, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def dms_text(
    deg: Column,
    decimals: int = 2,
    deg_pad: int = 1,
    min_pad: int = 2,
    carry: bool = True,
    wrap: bool = False,
    comma: bool = False,
    degree: str = "°",
    gap: str = "",
    close: str = '"',
    hemisphere: str | None = None,
    minutes_only: bool = False,
    drop_whole: bool = False,
) -> Column:
    """Decimal degrees as degrees, minutes and seconds.

    ``wrap`` brings the angle to 0..360 first; ``carry`` turns 60 seconds (after rounding) into a
    minute and 60 minutes into a degree; ``minutes_only`` cuts the seconds off; ``drop_whole``
    leaves decimals out of whole seconds; ``hemisphere`` ("NS" or "EW") adds the letter.
    """
    a = F.pmod(deg, F.lit(360.0)) if wrap else F.abs(deg)
    d = F.floor(a)
    m_full = (a - d) * 60
    m = F.floor(m_full)
    deg_f, min_f = f"%0{deg_pad}d{degree}{gap}", f"%0{min_pad}d'"
    if minutes_only:
        body = F.format_string(deg_f + min_f, d, m)
    else:
        s = F.round((m_full - m) * 60, decimals)
        if carry:
            m2 = m + F.when(s >= 60, 1).otherwise(0)
            d2 = d + F.when(m2 >= 60, 1).otherwise(0)
            s = F.when(s >= 60, 0.0).otherwise(s)
            m = F.when(m2 >= 60, F.lit(0)).otherwise(m2).cast("long")
            d = (F.pmod(d2, F.lit(360)) if wrap else d2).cast("long")
        width = decimals + 3 if decimals else 2
        seconds = F.format_string(f"%0{width}.{decimals}f", s)
        if drop_whole:
            seconds = F.when(s == F.floor(s), F.format_string("%02d", F.floor(s))).otherwise(seconds)
        if comma:
            seconds = F.translate(seconds, ".", ",")
        body = F.concat(F.format_string(deg_f + min_f, d, m), F.lit(gap), seconds, F.lit(close))
    if hemisphere:
        letter = F.when(deg < 0, hemisphere[1]).otherwise(hemisphere[0])
        return F.concat(body, F.lit(gap), letter)
    return body if wrap else F.when(deg < 0, F.concat(F.lit("-"), body)).otherwise(body)


def size_text(n: Column) -> Column:
    """Bytes as B, KB, MB, GB or TB with two decimals."""
    units = ["B", "KB", "MB", "GB"]
    out = F.format_string("%.2f TB", n / F.lit(1024.0**4))
    for i in range(3, -1, -1):
        text = F.format_string(f"%.2f {units[i]}", n / F.lit(1024.0**i))
        out = F.when(n < F.lit(1024.0 ** (i + 1)), text).otherwise(out)
    return out
