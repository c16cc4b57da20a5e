"""Projections of the SIRGAS 2000 family (GRS 80) as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: GRS 80 ellipsoid and UTM constants
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
SCALE = 0.9996
FALSE_EAST = 500000.0
FALSE_NORTH_SOUTH = 10000000.0

# fixed values: EPSG codes of the family
EPSG_GEOGRAPHIC = 4674
EPSG_SOUTH_BASE = 31960

_N = FLATTENING / (2 - FLATTENING)
_A = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Krueger series to the third order in n (sub-millimetre inside a zone)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96,
    _N**2 / 48 + _N**3 / 15,
    17 * _N**3 / 480,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3,
    7 * _N**2 / 3 - 8 * _N**3 / 5,
    56 * _N**3 / 15,
)
_E2N = 2 * math.sqrt(_N) / (1 + _N)


def zone_to_epsg(zone: Column) -> Column:
    return F.lit(EPSG_SOUTH_BASE) + zone


def epsg_to_zone(epsg: Column) -> Column:
    return epsg - EPSG_SOUTH_BASE


def zone_of(lon: Column) -> Column:
    return F.floor((lon + 180) / 6).cast("int") + 1


def central_meridian(zone: Column) -> Column:
    return F.lit(-183.0) + zone * 6


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once (formulas below use each step many times)."""
    return F.transform(F.array(value), then)[0]


def _atanh(v: Column) -> Column:
    return 0.5 * F.log((1 + v) / (1 - v))


def to_utm(lon: Column, lat: Column, zone: Column) -> Column:
    """``struct(x, y)``: southern UTM metres of geographic degrees."""
    def conformal(p):
        t = F.sinh(_atanh(p["s"]) - _E2N * _atanh(_E2N * p["s"]))
        return _let(F.struct(t.alias("t"), p["lam"].alias("lam")), sphere)

    def sphere(p):
        xi = F.atan2(p["t"], F.cos(p["lam"]))
        eta = _atanh(F.sin(p["lam"]) / F.sqrt(1 + p["t"] * p["t"]))
        return _let(F.struct(xi.alias("xi"), eta.alias("eta")), series)

    def series(p):
        x, y = p["eta"], p["xi"]
        for j, a in enumerate(_ALPHA, 1):
            x = x + a * F.cos(2 * j * p["xi"]) * F.sinh(2 * j * p["eta"])
            y = y + a * F.sin(2 * j * p["xi"]) * F.cosh(2 * j * p["eta"])
        return F.struct((FALSE_EAST + SCALE * _A * x).alias("x"), (FALSE_NORTH_SOUTH + SCALE * _A * y).alias("y"))

    lam = F.radians(lon - central_meridian(zone))
    return _let(F.struct(F.sin(F.radians(lat)).alias("s"), lam.alias("lam")), conformal)


def to_geographic(x: Column, y: Column, zone: Column) -> Column:
    """``struct(lon, lat)``: degrees of southern UTM metres."""
    def series(p):
        xi, eta = p["xi"], p["eta"]
        for j, b in enumerate(_BETA, 1):
            xi = xi - b * F.sin(2 * j * p["xi"]) * F.cosh(2 * j * p["eta"])
            eta = eta - b * F.cos(2 * j * p["xi"]) * F.sinh(2 * j * p["eta"])
        return _let(F.struct(xi.alias("xi"), eta.alias("eta"), p["zone"].alias("zone")), sphere)

    def sphere(p):
        chi = F.asin(F.sin(p["xi"]) / F.cosh(p["eta"]))
        lam = F.atan2(F.sinh(p["eta"]), F.cos(p["xi"]))
        lon = central_meridian(p["zone"]) + F.degrees(lam)
        return _let(F.struct(chi.alias("chi"), lon.alias("lon")), latitude)

    def latitude(p):
        phi = p["chi"]
        for j, d in enumerate(_DELTA, 1):
            phi = phi + d * F.sin(2 * j * p["chi"])
        return F.struct(p["lon"].alias("lon"), F.degrees(phi).alias("lat"))

    xi0 = (y - FALSE_NORTH_SOUTH) / (SCALE * _A)
    eta0 = (x - FALSE_EAST) / (SCALE * _A)
    return _let(F.struct(xi0.alias("xi"), eta0.alias("eta"), zone.alias("zone")), series)


def rezone(x: Column, y: Column, epsg: Column, target: int) -> Column:
    """``struct(x, y)`` of UTM metres moved from one southern zone to another."""
    zone = F.lit(target - EPSG_SOUTH_BASE)
    return _let(to_geographic(x, y, epsg_to_zone(epsg)), lambda g: to_utm(g["lon"], g["lat"], zone))


def meridian_convergence(lon: Column, lat: Column, zone: Column) -> Column:
    """Grid convergence in degrees: atan(tan(lon difference) * sin(lat))."""
    return F.degrees(F.atan(F.tan(F.radians(lon - central_meridian(zone))) * F.sin(F.radians(lat))))
