"""Attaching coordinates to addresses and tiers to places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.geo import haversine_miles

# Rows without a usable key are spread over this many dummy keys.
_SPREAD = 4096


def spread_missing(df: DataFrame, usable: Column, key: Column) -> Column:
    """A join key in which rows without a usable key do not share one value.

    Null keys (or the unlisted sentinel) match nothing, yet a shuffle would
    send all of them to one task. They get one of many dummy text keys, chosen
    by row content so that a recomputed task picks the same one.
    """
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    dummy = F.concat(F.lit("\0"), F.pmod(row_hash, F.lit(_SPREAD)).cast("string"))
    return F.when(usable, key).otherwise(dummy)


def geocode_lookup(
    listings: DataFrame,
    geocode: DataFrame,
    address: str = "full_address",
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Left join of listings to known coordinates by address.

    The dimension is cut to one row per address first, so listings never
    multiply. Unlisted addresses, the one hot value of this column, have no
    coordinates and are spread over dummy keys. Which join is used is left to
    the measured size of the dimension; popular addresses are split by the
    adaptive skew join.
    """
    text = F.col(f"`{address}`")
    usable = text.isNotNull() & (text != S.ADDRESS_MISSING)
    known = (
        geocode.filter(F.col("address").isNotNull() & (F.col("address") != S.ADDRESS_MISSING))
        .groupBy(F.col("address").alias("_address"))
        .agg(F.min(F.struct("lat", "lng")).alias("_at"))
    )
    keyed = listings.withColumn("_key", spread_missing(listings, usable, text))
    joined = keyed.join(known, F.col("_key") == F.col("_address"), "left")
    return joined.withColumns({lat: F.col("_at.lat"), lon: F.col("_at.lng")}).drop("_key", "_address", "_at")


def store_tier_label(
    places: DataFrame, keywords: Sequence[tuple[str, str]] = S.STORE_KEYWORDS, name: str = "name"
) -> DataFrame:
    """One row per place and keyword that its name contains, with the tier.

    The keyword list is a job parameter of a few entries, so it is tested as a
    literal array inside the scan: no join and no shuffle. A place that two
    keywords hit appears twice.
    """
    entries = F.array(
        *[
            F.struct(F.lit(tier).alias("tier"), F.lit(word).alias("keyword"), F.lit(i).alias("keyword_order"))
            for i, (tier, word) in enumerate(keywords)
        ]
    )
    lowered = F.lower(F.col(name))
    hits = F.filter(entries, lambda e: lowered.contains(F.lower(e["keyword"])))
    # Outer plus filter: the plain form would test every name twice.
    return places.select("*", F.inline_outer(hits)).filter(F.col("keyword_order").isNotNull())


def within_radius(
    places: DataFrame,
    centre: tuple[float, float] = S.SEARCH_CENTRE,
    radius_miles: float = S.SEARCH_RADIUS_MILES,
    lat: str = "lat",
    lon: str = "lng",
) -> DataFrame:
    """Places within a radius of a point.

    A latitude band goes first: it is a plain range that reaches the scan. A
    degree of latitude is at least 68.7 miles, so the band never cuts a hit.
    """
    centre_lat, centre_lon = centre
    band = radius_miles / 68.7
    distance = haversine_miles(F.lit(centre_lat), F.lit(centre_lon), F.col(lat), F.col(lon))
    return (
        places.filter(F.col(lat).between(centre_lat - band, centre_lat + band))
        .withColumn("distance_miles", distance)
        .filter(F.col("distance_miles") <= radius_miles)
    )


def store_search_radius(
    places: DataFrame,
    keywords: Sequence[tuple[str, str]] = S.STORE_KEYWORDS,
    centre: tuple[float, float] = S.SEARCH_CENTRE,
    radius_miles: float = S.SEARCH_RADIUS_MILES,
    name: str = "name",
) -> DataFrame:
    """Stores near a centre whose name contains one of the keywords."""
    return store_tier_label(within_radius(places, centre, radius_miles), keywords, name)
