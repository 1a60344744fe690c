"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: mean radius of the earth in miles.
EARTH_MILES = 3958.7613


def unit_vector(lat: Column, lng: Column) -> tuple[Column, Column, Column]:
    """Point on the unit sphere of a latitude and longitude in degrees."""
    phi, lam = F.radians(lat), F.radians(lng)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def arc_miles(chord: Column) -> Column:
    """Miles along the surface for a chord of the unit sphere, taken into 0 to 2."""
    return 2 * EARTH_MILES * F.asin(F.greatest(F.lit(0.0), F.least(F.lit(2.0), chord)) / 2)


def haversine_miles(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    a = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lng2) - F.radians(lng1)) / 2), 2)
    return 2 * EARTH_MILES * F.asin(F.sqrt(a))
