"""Distances as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: kilometres per minute of arc (one nautical mile) times 60 minutes.
KM_PER_DEGREE = 1.852 * 60


def planar_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column, geo: bool = True) -> Column:
    """Equirectangular distance in km: 1.852*60*sqrt(x^2 + y^2).

    x = (lon1 - lon2) * cos(mean latitude), y = lat1 - lat2, all in degrees.
    ``geo=True`` converts the mean latitude to radians before the cosine;
    ``geo=False`` passes degrees to the cosine as the original formula does.
    The result is never below KM_PER_DEGREE * |lat1 - lat2| in either mode.
    """
    mean_lat = (lat1 + lat2) / F.lit(2.0)
    factor = F.cos(F.radians(mean_lat)) if geo else F.cos(mean_lat)
    x = (lon1 - lon2) * factor
    y = lat1 - lat2
    return F.lit(KM_PER_DEGREE) * F.sqrt(x * x + y * y)


def squared_distance(a: Column, b: Column) -> Column:
    """Sum of squared differences of two double arrays, summed left to right:
    0 + (a1-b1)^2 + (a2-b2)^2 + ... The caller checks that the lengths agree."""
    sq = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(sq, F.lit(0.0), lambda acc, z: acc + z)
