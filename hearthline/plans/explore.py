"""The exploration set over one cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.geo import normalize, web_mercator
from hearthline.operators.filters import bbox_filter, conjunctive_filter
from hearthline.operators.profile import flag_distribution
from hearthline.operators.projection import flag_or

# The columns that are correlated with the price.
CORRELATED = ["price", "square_feet"] + [
    f for f in S.FLAGS if f not in ("monthly", "apartment", "house")
] + [S.distance_column(t) for t in S.TIERS]


def price_map_points(df: DataFrame, key: str, price: str = "price") -> DataFrame:
    """Listings inside the map box: map x, y and position on the price scale."""
    boxed = bbox_filter(df)
    at = web_mercator(F.col("latitude"), F.col("longitude"))
    return boxed.select(
        key, at["x"].alias("x"), at["y"].alias("y"), F.col(price).alias("price"), normalize(F.col(price)).alias("shade")
    )


def laundry_gap(df: DataFrame) -> DataFrame:
    """Listings that say nothing about laundry, as flag distributions.

    First the in-unit washers among them, then the hookups among those left.
    """
    merged = flag_or(df, ["laundry_in_bldg", "laundry_on_site"], "laundry_available")
    silent = conjunctive_filter(merged, F.col("no_laundry_on_site") == 0, F.col("laundry_available") == 0)
    still = conjunctive_filter(silent, F.col("washer_dryer_in_unit") == 0)
    return flag_distribution(silent, ["washer_dryer_in_unit"]).unionByName(
        flag_distribution(still, ["washer_dryer_hookups"])
    )
