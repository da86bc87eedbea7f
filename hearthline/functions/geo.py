"""Distances and map coordinates as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline import schema as S

# Mean earth radius (km), miles per km, web-mercator sphere (m).
EARTH_RADIUS_KM = 6371.0088
MILES_PER_KM = 0.621371192
MERCATOR_RADIUS_M = 6378137.0

EARTH_RADIUS_MILES = EARTH_RADIUS_KM * MILES_PER_KM


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in miles; null or NaN when a coordinate is."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # Not least(): it skips a null, and NaN counts as larger than any number;
    # both would answer half the earth's girth.
    bounded = F.when((chord > 1.0) & ~F.isnan(chord), 1.0).otherwise(chord)
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(bounded))


def miles_to_meters(miles: Column) -> Column:
    return miles * F.lit(S.METERS_PER_MILE)


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float] = S.MAP_BOX) -> Column:
    lat_min, lat_max, lon_min, lon_max = box
    return lat.between(lat_min, lat_max) & lon.between(lon_min, lon_max)


def mercator_x(lon: Column) -> Column:
    return F.radians(lon) * F.lit(MERCATOR_RADIUS_M)


def mercator_y(lat: Column) -> Column:
    quarter_turn = F.pi() / 4
    return F.log(F.tan(quarter_turn + F.radians(lat) / 2)) * F.lit(MERCATOR_RADIUS_M)


def web_mercator(lat: Column, lon: Column) -> Column:
    """Struct of map x and y in metres."""
    return F.struct(mercator_x(lon).alias("x"), mercator_y(lat).alias("y"))


def normalize(
    value: Column, low: float = S.MAP_PRICE_SCALE[0], high: float = S.MAP_PRICE_SCALE[1], clip: bool = False
) -> Column:
    """Position of a value on the colour scale; outside 0..1 unless clipped."""
    scaled = (value - F.lit(low)) / F.lit(high - low)
    if clip:
        # least and greatest skip nulls, hence the guard.
        return F.when(value.isNotNull(), F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)))
    return scaled


def missing(coordinate: Column) -> Column:
    """Null or NaN: both mean that there is no coordinate."""
    return coordinate.isNull() | F.isnan(coordinate)
