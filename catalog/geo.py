"""Distances, nearest stores, coordinate lookups and keyword search."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.tables import (
    ATTRIBUTE_ROWS_SQL,
    FEE_SQL,
    HOMES,
    LISTINGS,
    PLACE_KEYWORDS,
    PLACES,
    STORES,
    duck,
)
from hearthline import schema as S
from hearthline.functions import geo as G
from hearthline.functions.text import concat_label as to_label
from hearthline.operators import attributes as A
from hearthline.operators import lookup as L
from hearthline.operators import nearest as N
from hearthline.operators import rows as R
from hearthline.plans.explore import price_map_points as map_points
from hearthline.sources.readers import places_from_json

_HOMES, _STORES, _PLACES, _CLEAN = duck(HOMES), duck(STORES), duck(PLACES), duck(LISTINGS)


def miles_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"""(2 * 6371.0088::double * 0.621371192::double * asin(sqrt(
      power(sin(radians({lat2} - {lat1}) / 2), 2)
      + cos(radians({lat1})) * cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2))))"""


_MILES = miles_sql("h.latitude", "h.longitude", "s.lat", "s.lng")
NEAREST_SQL = f"""
select h.id, s.tier, s.name || ' - ' || s.address as store, {_MILES} as distance, s.store_order,
  row_number() over (partition by h.id, s.tier order by round({_MILES}, 9), s.store_order) as rank
from {_HOMES} h cross join {_STORES} s where h.latitude is not null"""
_BEST = f"select id, tier, store, round(distance, 6) as distance from ({NEAREST_SQL}) where rank = 1"


@query(
    f"""select h.id, t.tier, b.distance, case when h.latitude is null then 'N/A' else b.store end as store
    from {_HOMES} h cross join (values ('budget'), ('midTier'), ('premium')) t(tier)
    left join ({_BEST}) b on b.id = h.id and b.tier = t.tier"""
)
def nearest_store(t):
    long = N.nearest_store(t.homes, t.stores)
    return long.select("id", "tier", F.round("distance", 6).alias("distance"), "store")


_WIDE = ", ".join(
    f"""max(case when b.tier = '{x}' then b.distance end) as "{S.distance_column(x)}",
    case when any_value(h.latitude) is null then 'N/A' else max(case when b.tier = '{x}' then b.store end) end
      as "{S.store_column(x)}" """
    for x in S.TIERS
)
NEAREST_WIDE_SQL = f"select h.id, {_WIDE} from {_HOMES} h left join ({_BEST}) b on b.id = h.id group by h.id"


@query(NEAREST_WIDE_SQL)
def nearest_store_wide(t):
    wide = N.nearest_store_wide(t.homes, t.stores)
    return wide.select(
        "id",
        *[c for x in S.TIERS for c in (F.round(S.distance_column(x), 6).alias(S.distance_column(x)), S.store_column(x))],
    )


@query(NEAREST_WIDE_SQL)
def nearest_store_refined(t):
    """The same with small shards of stores, so that places meet several of them."""
    wide = N.nearest_store_wide(t.homes, t.stores, shard=16)
    return wide.select(
        "id",
        *[c for x in S.TIERS for c in (F.round(S.distance_column(x), 6).alias(S.distance_column(x)), S.store_column(x))],
    )


@query(
    """select l_suppkey, l_extendedprice, l_orderkey, l_linenumber from (
    select *, row_number() over (partition by l_suppkey order by l_extendedprice, l_orderkey, l_linenumber) as rank
    from lineitem) where rank = 1"""
)
def nearest_argmin(t):
    return N.nearest_argmin(t.lineitem, ["l_suppkey"], "l_extendedprice", "l_orderkey", ["l_linenumber"])


# Addresses: ten streets share most orders, every tenth address is unknown.
_ADDRESS = "case when o_orderkey % 3 = 0 then 'None listed' else cast(o_custkey as string) || ' Elm St' end"


@query(
    f"""select o.o_orderkey, a.address, c.lat as latitude, c.lng as longitude from orders o
    join (select o_orderkey, {_ADDRESS} as address from orders) a using (o_orderkey)
    left join (select cast(c_custkey as string) || ' Elm St' as address, c_custkey / 100.0::double as lat,
      c_custkey / 50.0::double as lng from customer where c_custkey % 10 <> 0) c on a.address = c.address"""
)
def geocode_lookup(t):
    street = F.concat(F.col("c_custkey").cast("string"), F.lit(" Elm St"))
    once = t.customer.filter("c_custkey % 10 <> 0").select(
        street.alias("address"),
        (F.col("c_custkey") / 100.0).alias("lat"),
        (F.col("c_custkey") / 50.0).alias("lng"),
    )
    listings = t.orders.select("o_orderkey", F.expr(_ADDRESS).alias("address"))
    # The dimension holds every address twice; listings must not multiply.
    return L.geocode_lookup(listings, once.unionByName(once), address="address")


_KEYWORDS = ", ".join(f"('{tier}', '{word}', {i})" for i, (tier, word) in enumerate(PLACE_KEYWORDS))
_HITS = f"""{_PLACES} p join (values {_KEYWORDS}) k(tier, keyword, keyword_order)
  on contains(lower(p.name), lower(k.keyword))"""
_CENTRE_MILES = miles_sql("34.0259::double", "-118.4965::double", "p.lat", "p.lng")


@query(
    f"""select p.place_id, p.name, k.tier, k.keyword, k.keyword_order, round({_CENTRE_MILES}, 6) as distance_miles
    from {_HITS} where {_CENTRE_MILES} <= 3.6::double"""
)
def store_search_radius(t):
    found = L.store_search_radius(t.places, PLACE_KEYWORDS)
    return found.select(
        "place_id", "name", "tier", "keyword", "keyword_order", F.round("distance_miles", 6).alias("distance_miles")
    )


@query(f"select p.place_id, p.name, k.tier, k.keyword, k.keyword_order from {_HITS}")
def store_tier_label(t):
    return L.store_tier_label(t.places, PLACE_KEYWORDS).select("place_id", "name", "tier", "keyword", "keyword_order")


@query(
    f"""select tier, count(*) as stores, min(store_order) as first_store, max(store_order) as last_store
    from {_STORES} group by tier"""
)
def union_store_tiers(t):
    by_tier = {x: t.stores.filter(F.col("tier") == x).drop("tier") for x in S.TIERS}
    stores = R.union_store_tiers(by_tier)
    return stores.groupBy("tier").agg(
        F.count("*").alias("stores"), F.min("store_order").alias("first_store"), F.max("store_order").alias("last_store")
    )


_VOCABULARY_SQL = f"select attribute from ({ATTRIBUTE_ROWS_SQL}) where not {FEE_SQL} group by 1 having count(*) >= 3"


def _vocabulary(t):
    counts = A.min_count_filter(A.collapse_fee_group(A.attribute_counts(t.attribute_lists)))
    return counts.filter(F.col("attribute") != S.FEE_ATTRIBUTE).select("attribute")


def _attribute_rows(t):
    return A.attribute_rows(t.attribute_lists, keep=["event_id"])


@query(f"select event_id, attribute from ({ATTRIBUTE_ROWS_SQL}) where attribute in ({_VOCABULARY_SQL})")
def vocab_semi_join(t):
    return A.vocab_semi_join(_attribute_rows(t), _vocabulary(t)).select("event_id", "attribute")


@query(f"select event_id, attribute from ({ATTRIBUTE_ROWS_SQL}) where attribute not in ({_VOCABULARY_SQL})")
def vocab_anti_join(t):
    return A.vocab_anti_join(_attribute_rows(t), _vocabulary(t)).select("event_id", "attribute")


@query(
    f"""select "id", round({miles_sql("34.0315::double", "-118.461::double", "latitude", "longitude")}, 6) as miles
    from {_CLEAN}"""
)
def haversine_miles(t):
    miles = G.haversine_miles(F.lit(34.0315), F.lit(-118.461), F.col("latitude"), F.col("longitude"))
    return t.listings.select("id", F.round(miles, 6).alias("miles"))


@query(f"""select "id", "{S.distance_column("budget")}" * 1609.34::double as meters from {_CLEAN}""")
def miles_to_meters(t):
    return t.listings.select("id", G.miles_to_meters(F.col(S.distance_column("budget"))).alias("meters"))


@query(
    f"""select "id", round(radians("longitude") * 6378137, 3) as x,
    round(ln(tan(pi() / 4 + radians("latitude") / 2)) * 6378137, 3) as y from {_CLEAN}"""
)
def web_mercator(t):
    at = G.web_mercator(F.col("latitude"), F.col("longitude"))
    return t.listings.select("id", F.round(at["x"], 3).alias("x"), F.round(at["y"], 3).alias("y"))


@query(
    f"""select "id", round(("price" - 1500) / 3500.0::double, 6) as shade,
    round(least(greatest(("price" - 1500) / 3500.0::double, 0), 1), 6) + 0.0::double as clipped from
    (select "id", coalesce("price", null) as price from {_CLEAN}) where price is not null
    union all select "id", null, null from {_CLEAN} where "price" is null"""
)
def normalize_clip(t):
    price = F.col("price")
    return t.listings.select(
        "id",
        F.round(G.normalize(price), 6).alias("shade"),
        (F.round(G.normalize(price, clip=True), 6) + 0.0).alias("clipped"),
    )


@query(
    f"""select "id", round(radians("longitude") * 6378137, 3) as x,
    round(ln(tan(pi() / 4 + radians("latitude") / 2)) * 6378137, 3) as y, round("price", 6) as price,
    round(("price" - 1500) / 3500.0::double, 6) as shade from {_CLEAN}
    where "latitude" between 33.95::double and 34.08::double and "longitude" between -118.5::double and -118.35::double"""
)
def price_map_points(t):
    points = map_points(t.listings, "id")
    return points.select(
        "id",
        F.round("x", 3).alias("x"),
        F.round("y", 3).alias("y"),
        F.round("price", 6).alias("price"),
        F.round("shade", 6).alias("shade"),
    )


@query(
    f"""select place_id, name || ' - ' || coalesce(nullif(address, 'Brand#7'), 'Address not provided') as label
    from {_PLACES}"""
)
def concat_label(t):
    address = F.nullif(F.col("address"), F.lit("Brand#7"))
    return t.places.select("place_id", to_label(F.col("name"), address).alias("label"))


def _search_answer(t):
    """Places as a search answer: two results in one JSON text, every fifth empty."""

    def place(name, vicinity):
        return F.struct(
            name.alias("name"),
            vicinity.alias("vicinity"),
            F.struct(F.struct(F.col("lat"), F.col("lng")).alias("location")).alias("geometry"),
        )

    two = F.array(
        place(F.col("name"), F.when(F.col("place_id") % 4 != 0, F.col("address"))),
        place(F.concat(F.col("name"), F.lit(' "2"')), F.col("address")),
    )
    results = F.when(F.col("place_id") % 5 != 0, two).otherwise(F.filter(two, lambda p: F.lit(False)))
    return t.places.select("place_id", F.to_json(F.struct(results.alias("results"))).alias("answer"))


@query(
    f"""select place_id, name, case when place_id % 4 = 0 then 'Address not provided' else address end as address,
      round(lat, 6) as lat, round(lng, 6) as lng from {_PLACES} where place_id % 5 <> 0
    union all select place_id, name || ' "2"', address, round(lat, 6), round(lng, 6) from {_PLACES} where place_id % 5 <> 0"""
)
def json_path(t):
    places = places_from_json(_search_answer(t), "answer")
    return places.select(
        "place_id", "name", "address", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng")
    )
