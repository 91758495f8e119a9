"""Expressions on coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEMISPHERE = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([NSEW])\s*$"


def signed_degrees(c: Column) -> Column:
    """``57.05N`` -> 57.05, ``10.33W`` -> -10.33. South and west are negative; other texts give null."""
    size = F.regexp_extract(c, HEMISPHERE, 1).try_cast("double")
    return F.when(F.regexp_extract(c, HEMISPHERE, 2).isin("S", "W"), -size).otherwise(size)


def lon_lat(c: Column) -> tuple[Column, Column]:
    """``"lon, lat"`` as two doubles, each null when it is missing or not a number."""
    parts = F.split(c, r",\s*")
    return F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The point on the unit sphere; nearest in straight line is also nearest along the ground."""
    a, b = F.radians(lat), F.radians(lon)
    return F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)
