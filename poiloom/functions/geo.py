"""Distances and grid cells on a sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371000.0
#: Beyond this latitude a band is one cell.
POLAR = 89.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres of points in degrees; null if one is unknown."""
    a1, a2 = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (a1 - a2) / 2.0, (F.radians(lon1) - F.radians(lon2)) / 2.0
    a = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(half_lon), F.lit(2.0))
    # least and greatest pass over nulls, so they are kept out
    return F.when(a.isNotNull(), 2.0 * EARTH_M * F.asin(F.sqrt(F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0)))))


def band(lat: Column, radius_m: float) -> Column:
    """Number of the latitude band; bands are a little higher than the radius."""
    step = math.degrees(radius_m / EARTH_M) * 1.0001
    return F.floor((lat + 90.0) / step).cast("long")


def columns_of(band_: Column, radius_m: float) -> Column:
    """How many cells a band has around the sphere: each at least the radius wide, everywhere in the band and its neighbours."""
    step = math.degrees(radius_m / EARTH_M) * 1.0001
    edge = F.greatest(F.abs(band_ * step - 90.0), F.abs((band_ + 1) * step - 90.0)) + step
    width = step / F.cos(F.radians(edge)) * 1.001
    return F.when(edge >= POLAR, F.lit(1)).otherwise(F.greatest(F.floor(360.0 / width), F.lit(1))).cast("long")


def column(lon: Column, count: Column) -> Column:
    """Number of the cell in a band of count cells; longitudes wrap around."""
    return F.pmod(F.floor((lon + 180.0) / 360.0 * count).cast("long"), count)


def cell(lat: Column, lon: Column, radius_m: float) -> Column:
    b = band(lat, radius_m)
    return F.struct(b.alias("band"), column(lon, columns_of(b, radius_m)).alias("column"))


def cells_around(lat: Column, lon: Column, radius_m: float) -> Column:
    """The distinct cells in which points within the radius can lie."""
    b = band(lat, radius_m)

    def row(k: int) -> list[Column]:
        n = columns_of(b + k, radius_m)
        c = column(lon, n)
        return [F.struct((b + k).alias("band"), F.pmod(c + j, n).alias("column")) for j in (-1, 0, 1)]

    return F.array_distinct(F.array(*[c for k in (-1, 0, 1) for c in row(k)]))
