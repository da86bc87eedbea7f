"""Projections and column-set operators over listings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.tables import ATTRIBUTE_TEXTS, LISTINGS, RAW_LISTINGS, duck
from hearthline import schema as S
from hearthline.operators import projection as P
from hearthline.sources.readers import first_location

_RAW, _CLEAN = duck(RAW_LISTINGS), duck(LISTINGS)


def _columns(names, prefix=""):
    return ", ".join(f'{prefix}"{n}"' for n in names)


_PICKED = ["id", "Price", "Full Address", "cats are OK - purrr"]


@query(f"select {_columns(_PICKED)} from {_RAW}")
def project_columns(t):
    return P.project_columns(t.raw_listings, _PICKED)


_HISTORY = ["date_added", "Full Address", "Title", "Price", "id"]


@query(f"select {_columns(_HISTORY)} from {_RAW}")
def reorder_columns(t):
    return P.reorder_columns(t.raw_listings, _HISTORY)


@query(
    "select " + ", ".join(f'"{c}" as "{S.RENAMES.get(c, c)}"' for c in ["id", *S.MASTER_COLUMNS]) + f" from {_RAW}"
)
def rename_map(t):
    return P.rename_map(t.raw_listings)


_DROPPED = ["title", "house", "monthly", "Bedrooms"] + [S.store_column(x) for x in S.TIERS]


@query(f"""select * exclude ({_columns(_DROPPED)}) from {_CLEAN}""")
def drop_columns(t):
    return P.drop_columns(t.listings, _DROPPED)


@query(f"""select "id", "Title", "Price", 0 as sauna, 0 as "roof deck" from {_RAW}""")
def fill_missing_columns(t):
    return P.fill_missing_columns(t.raw_listings.select("id", "Title", "Price"), ["id", "Price", "sauna", "roof deck"])


_GIVEN = ["Title", "Price", "apartment", "house", "date_added"]


@query(
    "select " + ", ".join(f'"{c}"' if c in _GIVEN else f'0 as "{c}"' for c in S.MASTER_COLUMNS) + f" from {_RAW}"
)
def master_schema_project(t):
    return P.master_schema_project(t.raw_listings.select("id", *_GIVEN))


_ORDERS = ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]


@query(
    " union all ".join(
        f"""select '{c}' as "column", 'left' as side, count("{c}") as filled_rows from orders""" for c in _ORDERS[:2] + _ORDERS[3:]
    )
    + """ union all select 'clerk' as "column", 'right' as side, count(o_orderkey % 7) as filled_rows from orders"""
)
def schema_diff(t):
    other = t.orders.select("o_orderkey", (F.col("o_orderkey") % 7).alias("clerk"))
    return P.schema_diff_profile(t.orders, other)


@query(f"""select "id", "Title", date '2024-05-31' as date_added from {_RAW}""")
def add_ingest_date(t):
    return P.add_ingest_date(t.raw_listings.select("id", "Title"), dt.date(2024, 5, 31))


@query(f"""select {_columns(["id", *S.FLAGS])} from {_CLEAN}""")
def cast_flags_int(t):
    # Flags arrive as decimals after a union with gaps, and leave as integers.
    decimals = t.listings.select("id", *[P.quoted(f).cast("double").alias(f) for f in S.FLAGS])
    return P.cast_flags_int(decimals)


_VOCABULARY = ["click", "view", "signup", "w/d in unit", "1br"]


@query(
    "select event_id, "
    + ", ".join(
        f"""list_contains(string_split(attribute_text, '|'), '{v}')::int as "{v}" """ for v in _VOCABULARY
    )
    + f"from {duck(ATTRIBUTE_TEXTS)}"
)
def multi_hot_encode(t):
    return P.multi_hot_encode(t.attribute_lists, "attributes", _VOCABULARY).select(
        "event_id", *[P.quoted(v) for v in _VOCABULARY]
    )


_ANSWER_LAT = "'33.' || lpad(cast(c_custkey * 37 % 10000 as string), 4, '0')"
_ANSWER_LNG = "'-118.' || lpad(cast(c_custkey * 53 % 10000 as string), 4, '0')"
GEOCODE_ANSWERS = f"""
select c_custkey as id, case when c_custkey % 10 = 0 then '[]'
  else '[{{{{"geometry":{{{{"location":{{{{"lat":' || {_ANSWER_LAT} || ',"lng":' || {_ANSWER_LNG} || '}}}}}}}}}}}},{{{{}}}}]' end as answer
from {{customer}}"""
_ANSWERS = "(" + GEOCODE_ANSWERS.format(customer="customer") + ")"


def _answers(t):
    # JSON text holds double quotes and braces, so it is built in the API.
    lat = F.concat(F.lit("33."), F.lpad((F.col("c_custkey") * 37 % 10000).cast("string"), 4, "0"))
    lng = F.concat(F.lit("-118."), F.lpad((F.col("c_custkey") * 53 % 10000).cast("string"), 4, "0"))
    hit = F.concat(F.lit('[{"geometry":{"location":{"lat":'), lat, F.lit(',"lng":'), lng, F.lit("}}},{}]"))
    answer = F.when(F.col("c_custkey") % 10 == 0, F.lit("[]")).otherwise(hit)
    return t.customer.select(F.col("c_custkey").alias("id"), answer.alias("answer"))


@query(
    f"""select id, cast(answer->'$[0].geometry.location.lat' as double) as latitude,
    cast(answer->'$[0].geometry.location.lng' as double) as longitude from {_ANSWERS}"""
)
def tuple_assign(t):
    pair = first_location(F.col("answer"))
    return P.tuple_assign(_answers(t), pair, ["latitude", "longitude"]).drop("answer")


@query(
    f"""select "id", "laundry_in_bldg" | "laundry_on_site" as laundry_available from {_CLEAN}"""
)
def flag_or(t):
    flags = t.listings.select("id", "laundry_in_bldg", "laundry_on_site")
    return P.flag_or(flags, ["laundry_in_bldg", "laundry_on_site"], "laundry_available")


_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


@query(
    " union all ".join(
        f"""select '{c}' as "column", '{k}' as type, count("{c}") as filled_rows from lineitem""" for c, k in _TYPES.items()
    )
)
def column_types(t):
    return P.column_types(t.lineitem)


_FEATURES = ["square_feet"] + [f for f in S.FLAGS if f not in S.NOT_FEATURES] + [S.distance_column(x) for x in S.TIERS]


@query(
    "select \"id\", " + ", ".join(f'cast("{c}" as double) as "{c}"' for c in [*_FEATURES, "price"]) + f" from {_CLEAN}"
)
def feature_select(t):
    return P.feature_select(t.listings, keep=["id"])


