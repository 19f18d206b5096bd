"""Distances, bounding boxes and grid cells on plain latitude/longitude columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from mastlight.fixed_values import CITIES, EARTH_RADIUS_KM

KM_PER_DEGREE = math.pi * EARTH_RADIUS_KM / 180


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the spherical law of cosines, clamped so rounding cannot break it."""
    cosine = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(
        F.radians(lon2) - F.radians(lon1)
    ) + F.sin(F.radians(lat1)) * F.sin(F.radians(lat2))
    return F.lit(float(EARTH_RADIUS_KM)) * F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def half_widths(lat: float, radius_km: float) -> tuple[float, float]:
    """Degrees of latitude and longitude that surely contain a circle round a point."""
    reach = radius_km / KM_PER_DEGREE * 1.0001 + 1e-6
    edge = abs(lat) + reach
    if edge >= 89.9:
        return reach, 360.0
    ratio = math.sin(math.radians(reach)) / math.cos(math.radians(lat))
    return reach, (math.degrees(math.asin(ratio)) * 1.0001 + 1e-6 if ratio < 1 else 360.0)


def near_box(lat: Column, lon: Column, at_lat: float, at_lon: float, radius_km: float) -> Column:
    """Cheap, pushable superset of "within ``radius_km``"; longitude is dropped near the date line."""
    dlat, dlon = half_widths(at_lat, radius_km)
    box = lat.between(at_lat - dlat, at_lat + dlat)
    if at_lon - dlon > -180 and at_lon + dlon < 180:
        box = box & lon.between(at_lon - dlon, at_lon + dlon)
    return box


def nearest_city(lat: Column, lon: Column) -> Column:
    """City centre with the least squared distance in degrees; earlier entries win ties."""
    candidates = [
        F.struct(
            ((F.lit(clat) - lat) * (F.lit(clat) - lat) + (F.lit(clon) - lon) * (F.lit(clon) - lon)).alias("d2"),
            F.lit(rank).alias("rank"),
            F.lit(name).alias("name"),
        )
        for rank, (name, clat, clon) in enumerate(CITIES)
    ]
    return F.least(*candidates).getField("name")
