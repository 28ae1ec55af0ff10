"""Coordinate systems as column expressions (G2): transverse Mercator zones and the European equal-area plane."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

A_AXIS, FLATTENING = 6378137.0, 1 / 298.257223563
_N = FLATTENING / (2 - FLATTENING)
_RECT = A_AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_E = math.sqrt(FLATTENING * (2 - FLATTENING))
# Krueger series coefficients to the fourth order in the third flattening.
_ALPHA = [_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
          61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280]
_BETA = [_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840,
         4397 * _N**4 / 161280]


def _zone(crs: str) -> tuple[float, float]:
    code = int(crs.split(":")[1])
    if not (32601 <= code <= 32660 or 32701 <= code <= 32760):
        raise ValueError(f"{crs} is no UTM zone")
    return math.radians((code % 100) * 6 - 183), 0.0 if code < 32700 else 10_000_000.0


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _atanh(c: Column) -> Column:
    return 0.5 * F.ln((1.0 + c) / (1.0 - c))


def to_utm(lon: Column, lat: Column, crs: str = "EPSG:32634") -> tuple[Column, Column]:
    """Degrees to metres in a UTM zone."""
    lon0, north0 = _zone(crs)
    lam = F.radians(lon) - lon0
    t = _let(F.sin(F.radians(lat)), lambda s: F.sinh(_atanh(s) - _E * _atanh(_E * s)))
    base = _let(t, lambda t: F.struct(F.atan2(t, F.cos(lam)).alias("xi"), _atanh(F.sin(lam) / F.sqrt(1.0 + t * t)).alias("eta")))

    def shifted(p: Column) -> Column:
        x, y = p["eta"], p["xi"]
        for j, a in enumerate(_ALPHA, 1):
            x = x + a * F.cos(2 * j * p["xi"]) * F.sinh(2 * j * p["eta"])
            y = y + a * F.sin(2 * j * p["xi"]) * F.cosh(2 * j * p["eta"])
        return F.struct((500_000.0 + 0.9996 * _RECT * x).alias("x"), (north0 + 0.9996 * _RECT * y).alias("y"))
    out = _let(base, shifted)
    return out["x"], out["y"]


def from_utm(x: Column, y: Column, crs: str = "EPSG:32634") -> tuple[Column, Column]:
    """Metres in a UTM zone to degrees."""
    lon0, north0 = _zone(crs)
    xi, eta = (y - north0) / (0.9996 * _RECT), (x - 500_000.0) / (0.9996 * _RECT)

    def unshifted(p: Column) -> Column:
        u, v = p["xi"], p["eta"]
        for j, b in enumerate(_BETA, 1):
            u = u - b * F.sin(2 * j * p["xi"]) * F.cosh(2 * j * p["eta"])
            v = v - b * F.cos(2 * j * p["xi"]) * F.sinh(2 * j * p["eta"])
        return F.struct(u.alias("u"), v.alias("v"))

    def newton(tau1: Column) -> Column:  # three steps from conformal to geographic latitude
        def step(tau: Column, _: Column) -> Column:
            sigma = F.sinh(_E * _atanh(_E * tau / F.sqrt(1.0 + tau * tau)))
            guess = _let(sigma, lambda g: tau * F.sqrt(1.0 + g * g) - g * F.sqrt(1.0 + tau * tau))
            return tau + _let(guess, lambda g: (tau1 - g) / F.sqrt(1.0 + g * g) * (1.0 + (1.0 - _E**2) * tau * tau) / ((1.0 - _E**2) * F.sqrt(1.0 + tau * tau)))
        return F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), tau1, step)
    out = _let(_let(F.struct(xi.alias("xi"), eta.alias("eta")), unshifted), lambda w: F.struct(
        F.degrees(lon0 + F.atan2(F.sinh(w["v"]), F.cos(w["u"]))).alias("lon"),
        F.degrees(F.atan(_let(F.sin(w["u"]) / F.sqrt(F.sinh(w["v"]) * F.sinh(w["v"]) + F.cos(w["u"]) * F.cos(w["u"])), newton))).alias("lat")))
    return out["lon"], out["lat"]


def _q(s: Column | float):
    if isinstance(s, float):
        return (1 - _E**2) * (s / (1 - (_E * s) ** 2) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    return (1 - _E**2) * (s / (1 - (_E * s) * (_E * s)) - F.ln((1 - _E * s) / (1 + _E * s)) / (2 * _E))


_LAT0, _LON0 = math.radians(52.0), math.radians(10.0)
_QP = _q(1.0)
_B0 = math.asin(_q(math.sin(_LAT0)) / _QP)
_RQ = A_AXIS * math.sqrt(_QP / 2)
_D = A_AXIS * (math.cos(_LAT0) / math.sqrt(1 - (_E * math.sin(_LAT0)) ** 2)) / (_RQ * math.cos(_B0))


def to_laea(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres in EPSG:3035."""
    lam, b = F.radians(lon) - _LON0, F.asin(_q(F.sin(F.radians(lat))) / _QP)
    k = _RQ * F.sqrt(2.0 / (1.0 + math.sin(_B0) * F.sin(b) + math.cos(_B0) * F.cos(b) * F.cos(lam)))
    x = k * _D * F.cos(b) * F.sin(lam)
    y = k / _D * (math.cos(_B0) * F.sin(b) - math.sin(_B0) * F.cos(b) * F.cos(lam))
    return 4_321_000.0 + x, 3_210_000.0 + y


def from_laea(x: Column, y: Column) -> tuple[Column, Column]:
    """Metres in EPSG:3035 to degrees."""
    dx, dy = (x - 4_321_000.0) / _D, (y - 3_210_000.0) * _D
    rho = F.sqrt(dx * dx + dy * dy)
    c = 2.0 * F.asin(rho / (2.0 * _RQ))
    b = F.when(rho == 0, F.lit(_B0)).otherwise(F.asin(F.cos(c) * math.sin(_B0) + dy * F.sin(c) * math.cos(_B0) / F.nullif(rho, F.lit(0.0))))
    lon = _LON0 + F.atan2(dx * F.sin(c), math.cos(_B0) * rho * F.cos(c) - math.sin(_B0) * dy * F.sin(c))
    e2 = _E**2
    lat = (b + (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040) * F.sin(2 * b) + (23 * e2**2 / 360 + 251 * e2**3 / 3780) * F.sin(4 * b)
           + 761 * e2**3 / 45360 * F.sin(6 * b))
    return F.degrees(lon), F.degrees(lat)
