"""Distances and the repair of stored positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000


def haversine_m(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    h = F.pow(F.sin(F.radians(lat_b - lat_a) / 2), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(F.sin(F.radians(lng_b - lng_a) / 2), 2)
    h = F.least(F.lit(1.0), F.greatest(F.lit(0.0), h))
    return 2 * EARTH_M * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def dist_to_sim(metres: Column) -> Column:
    """Halves every 50 metres."""
    return F.pow(F.lit(0.5), metres / 50)


def repair_scaled(c: Column) -> Column:
    """Coordinates stored as whole numbers: 6 digits are tenfold short of hundred-thousandths, 7 are those, 8 are millionths.

    Numbers with decimals pass; whole numbers of other lengths become null.
    """
    whole, size = c == F.floor(c), F.length(F.abs(c).cast("decimal(20,0)").cast("string"))
    return F.when(~whole, c).when(size == 6, c * 10 / 1e5).when(size == 7, c / 1e5).when(size == 8, c / 1e6)


def fix_pole(lat: Column) -> Column:
    """A latitude of 90 as -90, as some feeds mean it."""
    return F.when(lat == 90, -90.0).otherwise(lat)


def parse_point(c: Column) -> tuple[Column, Column]:
    """(lat, lng) of a point written as text "(lng,lat)"; null where it doesn't parse."""
    pat = r"^\(\s*(-?[\d.]+)\s*,\s*(-?[\d.]+)\s*\)$"
    return F.regexp_extract(c, pat, 2).try_cast("double"), F.regexp_extract(c, pat, 1).try_cast("double")
