"""UTM zones, degree sizes and the transverse Mercator series (WGS 84)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres in a degree of longitude at the equator and of latitude.
LON_M, LAT_M = 111320.0, 110540.0
_A, _F, _K0 = 6378137.0, 1 / 298.257223563, 0.9996


def utm_epsg(lon: Column, lat: Column) -> Column:
    zone = F.floor((lon + 180) / 6) + 1
    return (F.when(lat >= 0, 32600).otherwise(32700) + zone).cast("long")


def utm_epsg_of(lon: float, lat: float) -> int:
    return (32600 if lat >= 0 else 32700) + math.floor((lon + 180) / 6) + 1


def pixel_size_m(px: Column, py: Column, lat: Column, geographic: Column) -> Column:
    metres = (F.abs(px) * LON_M * F.cos(F.radians(lat)) + F.abs(py) * LAT_M) / 2
    return F.when(geographic, metres).otherwise((F.abs(px) + F.abs(py)) / 2)


def _series() -> tuple[float, list[float], list[float]]:
    n = _F / (2 - _F)
    a = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    fwd = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    inv = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    return a, fwd, inv


def to_utm(lon: float, lat: float, epsg: int) -> tuple[float, float]:
    """Easting and northing by the third-order flattening series (millimetres within a zone)."""
    a, alpha, _ = _series()
    n = _F / (2 - _F)
    dl = math.radians(lon - ((epsg % 100) * 6 - 183))
    s = math.sin(math.radians(lat))
    c = 2 * math.sqrt(n) / (1 + n)
    t = math.sinh(math.atanh(s) - c * math.atanh(c * s))
    xi, eta = math.atan2(t, math.cos(dl)), math.atanh(math.sin(dl) / math.sqrt(1 + t * t))
    e = eta + sum(v * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, v in enumerate(alpha, 1))
    q = xi + sum(v * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, v in enumerate(alpha, 1))
    return 500000 + _K0 * a * e, (1e7 if epsg // 100 == 327 else 0.0) + _K0 * a * q


def from_utm(x: float, y: float, epsg: int) -> tuple[float, float]:
    a, _, beta = _series()
    n = _F / (2 - _F)
    xi, eta = (y - (1e7 if epsg // 100 == 327 else 0.0)) / (_K0 * a), (x - 500000) / (_K0 * a)
    p = xi - sum(v * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, v in enumerate(beta, 1))
    h = eta - sum(v * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, v in enumerate(beta, 1))
    chi = math.asin(math.sin(p) / math.cosh(h))
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    lat = chi + sum(d * math.sin(2 * j * chi) for j, d in enumerate(delta, 1))
    return (epsg % 100) * 6 - 183 + math.degrees(math.atan2(math.sinh(h), math.cos(p))), math.degrees(lat)
