"""Map projections as expressions: ellipsoidal Albers and transverse Mercator (Snyder, USGS Professional Paper 1395)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# GRS 80 and the equal-area projection of the conterminous United States.
A, E2 = 6378137.0, 0.00669438002290
E = math.sqrt(E2)
LAT1, LAT2, LAT0, LON0 = (math.radians(d) for d in (29.5, 45.5, 23.0, -96.0))
K0 = 0.9996


def _q(s, log):
    return (1 - E2) * (s / (1 - E2 * s * s) - log((1 - E * s) / (1 + E * s)) / (2 * E))


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - E2 * math.sin(lat) ** 2)


_Q1, _Q2, _Q0 = (_q(math.sin(lat), math.log) for lat in (LAT1, LAT2, LAT0))
_N = (_m(LAT1) ** 2 - _m(LAT2) ** 2) / (_Q2 - _Q1)
_C = _m(LAT1) ** 2 + _N * _Q1
_M0, _M2 = 1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256, 3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024
_M4, _M6 = 15 * E2**2 / 256 + 45 * E2**3 / 1024, 35 * E2**3 / 3072
_RHO0 = A * math.sqrt(_C - _N * _Q0) / _N


def to_albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Degrees to metres of the equal-area projection."""
    q = _q(F.sin(F.radians(lat)), F.log)
    rho = A * F.sqrt(_C - _N * q) / _N
    theta = _N * (F.radians(lon) - LON0)
    return rho * F.sin(theta), _RHO0 - rho * F.cos(theta)


def from_albers(x: Column, y: Column, rounds: int = 6) -> tuple[Column, Column]:
    """Metres to degrees; the latitude by a fixed number of iterations."""
    rho = F.sqrt(x * x + (_RHO0 - y) * (_RHO0 - y))
    theta = F.atan2(x, _RHO0 - y)
    q = (_C - rho * rho * _N * _N / (A * A)) / _N

    def closer(lat, _):
        s = F.sin(lat)
        return lat + (1 - E2 * s * s) * (1 - E2 * s * s) / (2 * F.cos(lat)) * (q / (1 - E2) - s / (1 - E2 * s * s) + F.log((1 - E * s) / (1 + E * s)) / (2 * E))

    lat = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.asin(q / 2), closer)
    return F.degrees(F.lit(LON0) + theta / _N), F.degrees(lat)


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, 32600).otherwise(32700) + utm_zone(lon)


def to_utm(lon: Column, lat: Column, zone: Column | int | None = None, south: Column | bool | None = None) -> tuple[Column, Column]:
    """Degrees to metres, by the series to the sixth order: in the point's own zone and half, or in those given."""
    zone = utm_zone(lon) if zone is None else F.lit(zone)
    south = (lat < 0) if south is None else F.lit(south)
    phi, second = F.radians(lat), E2 / (1 - E2)
    central = F.radians((zone - 1) * 6 - 180 + 3)
    n = A / F.sqrt(1 - E2 * F.sin(phi) * F.sin(phi))
    t, c = F.pow(F.tan(phi), F.lit(2.0)), second * F.pow(F.cos(phi), F.lit(2.0))
    a = F.cos(phi) * (F.radians(lon) - central)
    m = A * (_M0 * phi - _M2 * F.sin(2 * phi) + _M4 * F.sin(4 * phi) - _M6 * F.sin(6 * phi))
    x = K0 * n * (a + (1 - t + c) * F.pow(a, F.lit(3.0)) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * second) * F.pow(a, F.lit(5.0)) / 120) + 500000
    y = K0 * (m + n * F.tan(phi) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(a, F.lit(4.0)) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * second) * F.pow(a, F.lit(6.0)) / 720))
    return x, F.when(south, y + 10000000).otherwise(y)


def from_utm(x: Column, y: Column, zone: Column | int, south: Column | bool = False) -> tuple[Column, Column]:
    """Metres of a zone to degrees, by way of the footpoint latitude."""
    second, root = E2 / (1 - E2), math.sqrt(1 - E2)
    e1 = (1 - root) / (1 + root)
    m = F.when(F.lit(south), y - 10000000).otherwise(y) / K0
    mu = m / (A * _M0)
    phi = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu)
    sine = F.sin(phi)
    n = A / F.sqrt(1 - E2 * sine * sine)
    r = A * (1 - E2) / F.pow(1 - E2 * sine * sine, F.lit(1.5))
    t, c = F.pow(F.tan(phi), F.lit(2.0)), second * F.pow(F.cos(phi), F.lit(2.0))
    d = (x - 500000) / (n * K0)
    lat = phi - n * F.tan(phi) / r * (
        d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * second) * F.pow(d, F.lit(4.0)) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * second - 3 * c * c) * F.pow(d, F.lit(6.0)) / 720
    )
    lon = (d - (1 + 2 * t + c) * F.pow(d, F.lit(3.0)) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * second + 24 * t * t) * F.pow(d, F.lit(5.0)) / 120) / F.cos(phi)
    return F.degrees(lon) + (F.lit(zone) - 1) * 6 - 180 + 3, F.degrees(lat)


def is_geographic(epsg: int) -> bool:
    return epsg in (4326, 4269)


def project(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """Coordinates of one reference system (EPSG: degrees, the equal-area projection, the UTM zones) in another one.

    The datums' difference, below two metres, is left out. An unknown system is an error.
    """
    if source == target or (is_geographic(source) and is_geographic(target)):
        return x, y
    lon, lat = x, y
    if source == 5070:
        lon, lat = from_albers(x, y)
    elif 32600 < source <= 32660 or 32700 < source <= 32760:
        lon, lat = from_utm(x, y, source % 100, source >= 32700)
    elif not is_geographic(source):
        raise ValueError(f"Unsupported reference system: EPSG:{source}")
    if is_geographic(target):
        return lon, lat
    if target == 5070:
        return to_albers(lon, lat)
    if 32600 < target <= 32660 or 32700 < target <= 32760:
        return to_utm(lon, lat, target % 100, target >= 32700)
    raise ValueError(f"Unsupported reference system: EPSG:{target}")


def moved(df: DataFrame, x: str, y: str, source: int, target: int) -> DataFrame:
    """df with its columns x and y in another reference system, by way of degrees that are a step of their own.

    Within one expression each step would repeat the one before it many times.
    """
    for a, b in ((source, 4326), (4326, target)) if source != target else ():
        px, py = project(F.col(x), F.col(y), a, b)
        df = df.withColumns({"_px": px, "_py": py}).withColumns({x: F.col("_px"), y: F.col("_py")}).drop("_px", "_py")
    return df
