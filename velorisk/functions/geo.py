"""Distances on plain longitude/latitude columns, all of them JVM expressions."""

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from velorisk import constants as C


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle metres."""
    half_lat = F.sin(F.radians(lat2 - lat1) / F.lit(2.0))
    half_lon = F.sin(F.radians(lon2 - lon1) / F.lit(2.0))
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2.0 * C.EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def planar_degrees_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Degrees of the plane times a constant: circles come out squeezed east to west."""
    dx, dy = lon2 - lon1, lat2 - lat1
    return F.sqrt(dx * dx + dy * dy) * F.lit(C.PLANAR_METRES_PER_DEGREE)


def equirectangular_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Flat length with longitude shrunk by the cosine of the first latitude."""
    scale = F.lit(C.PLANAR_METRES_PER_DEGREE)
    dx = (lon2 - lon1) * scale * F.cos(F.radians(lat1))
    dy = (lat2 - lat1) * scale
    return F.sqrt(dx * dx + dy * dy)


METRICS = {
    "great_circle": haversine_m,
    "planar_deg": planar_degrees_m,
    "equirectangular": equirectangular_m,
}


# Two cheaper forms of the same distances, for tests that run once per candidate
# pair. The trigonometry moves to columns computed once per point or segment; what
# remains per pair is a few multiplications.


def unit_vector(lon: Column, lat: Column) -> tuple[Column, Column, Column]:
    """The point as a vector on the unit sphere."""
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def chord_limit(radius_m: float) -> float:
    """Squared straight-line distance on the unit sphere that corresponds to an arc of ``radius_m``."""
    return (2.0 * math.sin(radius_m / (2.0 * C.EARTH_RADIUS_M))) ** 2


def squared_gap(first: Sequence[Column], second: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for a, b in zip(first, second):
        total = total + (a - b) * (a - b)
    return total


def segment_plane(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> tuple[Column, Column, Column]:
    """Metres per degree of longitude at the segment's mid latitude, and the segment A–B in metres."""
    per_lon = F.lit(C.METRES_PER_DEGREE) * F.cos(F.radians(midpoint(lat_a, lat_b)))
    return per_lon, (lon_b - lon_a) * per_lon, (lat_b - lat_a) * F.lit(C.METRES_PER_DEGREE)


def squared_segment_gap(
    lon: Column, lat: Column, lon_a: Column, lat_a: Column, per_lon: Column, dx: Column, dy: Column
) -> Column:
    """Squared metres from a point to a segment, given the segment's plane."""
    px, py = (lon - lon_a) * per_lon, (lat - lat_a) * F.lit(C.METRES_PER_DEGREE)
    along, squared = px * dx + py * dy, dx * dx + dy * dy
    across = px * dy - py * dx
    return (
        F.when(along <= F.lit(0.0), px * px + py * py)
        .when(along >= squared, (px - dx) * (px - dx) + (py - dy) * (py - dy))
        .otherwise(across * across / squared)
    )


def segment_distance_m(
    lon: Column, lat: Column, lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column
) -> Column:
    """Metres from a point to the segment A–B, in the plane tangent at its mid latitude."""
    return F.sqrt(squared_segment_gap(lon, lat, lon_a, lat_a, *segment_plane(lon_a, lat_a, lon_b, lat_b)))


def midpoint(first: Column, second: Column) -> Column:
    return (first + second) / F.lit(2.0)


def in_box(lon: Column, lat: Column) -> Column:
    """Inside the area of interest, edges included."""
    return lon.between(C.LON_MIN, C.LON_MAX) & lat.between(C.LAT_MIN, C.LAT_MAX)
