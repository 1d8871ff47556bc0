"""Geospatial column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import ColumnOrName, col

EARTH_RADIUS_KM = 6371.0

# Fixed values: (name, lat_min, lat_max, lon_min, lon_max) boxes of the
# national territory used by the geofence.
TERRITORY_BOXES: tuple[tuple[str, float, float, float, float], ...] = (
    ("peninsula", 35.5, 44.5, -9.5, 4.5),
    ("baleares", 38.5, 40.3, 1.0, 4.5),
    ("canarias", 27.0, 29.6, -18.5, -13.0),
    ("ceuta", 35.8, 36.1, -5.5, -5.1),
    ("melilla", 35.2, 35.5, -3.1, -2.8),
)
# The single national box used for the out-of-range list.
NATIONAL_BOX = (26.0, 45.0, -20.0, 6.0)


def haversine_km(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName,
                 form: str = "atan2", radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance; ``form`` 'atan2' or 'asin' (same value)."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dphi = p2 - p1
    dlmb = F.radians(col(lon2)) - F.radians(col(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    if form == "asin":
        return F.lit(2 * radius_km) * F.asin(F.sqrt(a))
    return F.lit(2 * radius_km) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def planar_distance(x1: ColumnOrName, y1: ColumnOrName, x2: ColumnOrName, y2: ColumnOrName) -> Column:
    """Euclidean distance in degrees."""
    return F.sqrt(F.pow(col(x1) - col(x2), 2) + F.pow(col(y1) - col(y2), 2))


def in_box(lat: ColumnOrName, lon: ColumnOrName, lat_min: float, lat_max: float,
           lon_min: float, lon_max: float) -> Column:
    """inside one closed bounding box."""
    return col(lat).between(lat_min, lat_max) & col(lon).between(lon_min, lon_max)


def in_any_box(lat: ColumnOrName, lon: ColumnOrName,
               boxes: Sequence[tuple[str, float, float, float, float]] = TERRITORY_BOXES) -> Column:
    """inside any of the boxes; null coordinates count as outside."""
    cond = None
    for _, a, b, c, d in boxes:
        one = in_box(lat, lon, a, b, c, d)
        cond = one if cond is None else (cond | one)
    return F.coalesce(cond, F.lit(False))


def box_label(lat: ColumnOrName, lon: ColumnOrName,
              boxes: Sequence[tuple[str, float, float, float, float]] = TERRITORY_BOXES) -> Column:
    """Name of the first box containing the point (null when none)."""
    expr = None
    for name, a, b, c, d in boxes:
        cond = in_box(lat, lon, a, b, c, d)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def bbox_centroid(north: ColumnOrName, south: ColumnOrName, east: ColumnOrName,
                  west: ColumnOrName) -> tuple[Column, Column]:
    """Centre of a bounding box; null when any side is null."""
    return (col(north) + col(south)) / 2, (col(east) + col(west)) / 2
