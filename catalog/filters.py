"""Row filters over listings and attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.tables import ATTRIBUTE_ROWS_SQL, FEE_SQL, FOLDED_COUNTS_SQL, LISTINGS, RAW_LISTINGS, duck
from hearthline import schema as S
from hearthline.operators import attributes as A
from hearthline.operators import filters as Fi
from hearthline.operators.nearest import nearest_store_wide
from hearthline.operators.projection import flag_or

_RAW, _CLEAN = duck(RAW_LISTINGS), duck(LISTINGS)


@query(f"""select "id", "Title", "Price" from {_RAW} where "Title" is distinct from '{S.TITLE_MISSING}'""")
def drop_sentinel_title(t):
    return Fi.drop_sentinel_title(t.raw_listings).select("id", "Title", "Price")


@query(f"""select "id", "Title", "Price" from {_RAW} where "Title" = '{S.TITLE_MISSING}'""")
def rejected_titles(t):
    return Fi.rejected_titles(t.raw_listings).select("id", "Title", "Price")


@query(f"""select "id", "full_address" from {_CLEAN} where "full_address" is distinct from '{S.ADDRESS_MISSING}'""")
def drop_unlisted_address(t):
    return Fi.drop_unlisted_address(t.listings).select("id", "full_address")


@query(f"""select "id", "square_feet" from {_CLEAN} where "square_feet" is not null""")
def drop_null_sqft(t):
    return Fi.drop_null_sqft(t.listings).select("id", "square_feet")


@query(
    f"""select "id", round("latitude", 6) as latitude, round("longitude", 6) as longitude from {_CLEAN}
    where "latitude" between 33.95::double and 34.08::double and "longitude" between -118.5::double and -118.35::double"""
)
def bbox_filter(t):
    return Fi.bbox_filter(t.listings).select(
        "id", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude")
    )


@query(
    f"""select "id", "washer_dryer_hookups" from {_CLEAN} where "no_laundry_on_site" = 0
    and ("laundry_in_bldg" | "laundry_on_site") = 0 and "washer_dryer_in_unit" = 0"""
)
def conjunctive_filter(t):
    merged = flag_or(t.listings, ["laundry_in_bldg", "laundry_on_site"], "laundry_available")
    silent = Fi.conjunctive_filter(merged, F.col("no_laundry_on_site") == 0, F.col("laundry_available") == 0)
    return Fi.conjunctive_filter(silent, F.col("washer_dryer_in_unit") == 0).select("id", "washer_dryer_hookups")


@query(f"select event_id, attribute from ({ATTRIBUTE_ROWS_SQL}) where {FEE_SQL}")
def regex_fee_filter(t):
    rows = A.attribute_rows(t.attribute_lists, keep=["event_id"])
    return A.regex_fee_filter(rows)


@query(f"""select attribute, sum("count")::bigint as "count" from ({FOLDED_COUNTS_SQL}) group by 1 having sum("count") >= 3""")
def min_count_filter(t):
    return A.min_count_filter(A.collapse_fee_group(A.attribute_counts(t.attribute_lists)))


_GUARD = "c_custkey % 10 = 0"


@query(
    f"""select c_custkey as "id", case when {_GUARD} then 'N/A' else 'placed' end as label,
    case when {_GUARD} then 0 else 1 end as has_distance from customer"""
)
def null_guard(t):
    wide = nearest_store_wide(t.homes, t.stores)
    label, distance = S.store_column("budget"), S.distance_column("budget")
    return wide.select(
        "id",
        F.when(F.col(label) == S.STORE_MISSING, F.col(label)).otherwise("placed").alias("label"),
        F.when(F.col(distance).isNull(), 0).otherwise(1).alias("has_distance"),
    )
