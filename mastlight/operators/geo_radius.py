"""Points within a radius of destinations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastlight.functions.geo import KM_PER_DEGREE, distance_km

#: Grid step in degrees; about the largest allowed radius, so a circle meets few cells.
GRID_DEGREES = 0.5


def _grid(value: str) -> str:
    return f"cast(floor(({value}) / {GRID_DEGREES}D) AS int)"


def covering_cells(destinations: DataFrame) -> DataFrame:
    """Destinations (dest_id, lat, lon, radius_km) repeated for every grid cell their circle may meet."""
    # Half height and half width in degrees of a box that surely holds the circle.
    high = f"(radius_km / {KM_PER_DEGREE!r}D * 1.0001D + 1E-6D)"
    ratio = "sin(radians(_high)) / cos(radians(lat))"
    wide = (
        f"CASE WHEN abs(lat) + _high >= 89.9D OR {ratio} >= 1 THEN 180D "
        f"ELSE degrees(asin({ratio})) * 1.0001D + 1E-6D END"
    )
    rows = f"sequence({_grid('greatest(-90D, lat - _high)')}, {_grid('least(90D, lat + _high)')})"
    # Longitudes lie on a circle: shift the box by whole turns and keep what falls in -180..180.
    west, east = "greatest(lon - _wide + turn, -180D)", "least(lon + _wide + turn, 180D)"
    columns = (
        "array_distinct(flatten(transform(array(-360D, 0D, 360D), turn -> "
        f"CASE WHEN {west} <= {east} THEN sequence({_grid(west)}, {_grid(east)}) ELSE cast(array() AS array<int>) END)))"
    )
    kept = destinations.columns
    return (
        destinations.selectExpr("*", f"{high} AS _high")
        .selectExpr("*", f"{wide} AS _wide")
        .selectExpr(*kept, f"{rows} AS _rows", f"{columns} AS _columns")
        .selectExpr(*kept, "_columns", "explode(_rows) AS gy")
        .selectExpr(*kept, "gy", "explode(_columns) AS gx")
    )


def within_radius(
    destinations: DataFrame, points: DataFrame, carry: Sequence[str]
) -> DataFrame:
    """Pairs of destination and point at most ``radius_km`` apart: dest_id, carry..., distance_km.

    Equi-join on grid cells, then a strip of latitude, then the exact distance.  Reduce points (one row per site) before, and
    sum up after: what is summed right behind the join leaves its task as one row per destination and cell, not as pairs.
    """
    cells = covering_cells(destinations.select("dest_id", "lat", "lon", "radius_km")).select(
        "dest_id", "radius_km", "gy", "gx", F.col("lat").alias("_dlat"), F.col("lon").alias("_dlon")
    )
    placed = points.selectExpr("*", f"{_grid('lat')} AS gy", f"{_grid('lon')} AS gx")
    apart = distance_km(F.col("_dlat"), F.col("_dlon"), F.col("lat"), F.col("lon"))
    # Points off the circle's strip cost no trigonometry.
    strip = F.abs(F.col("_dlat") - F.col("lat")) <= F.col("radius_km") / F.lit(KM_PER_DEGREE) * 1.0001 + 1e-6
    return (
        placed.join(cells, ["gy", "gx"])
        .filter(strip)
        .withColumn("distance_km", apart)
        .filter(F.col("distance_km") <= F.col("radius_km"))
        .select("dest_id", *carry, "distance_km")
    )
