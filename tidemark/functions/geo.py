"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), F.lit(2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))
