"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.tables import LISTINGS, RAW_LISTINGS, duck
from hearthline import schema as S
from hearthline.functions import text as X
from hearthline.functions.numbers import round2 as half_even

_RAW, _CLEAN = duck(RAW_LISTINGS), duck(LISTINGS)


@query(f"""select "id", try_cast(replace(replace("Price", '$', ''), ',', '') as double) as price from {_RAW}""")
def money_parse(t):
    return t.raw_listings.select("id", X.money_parse(F.col("Price")).alias("price"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_extendedprice as price from lineitem""")
def money_parse_large(t):
    """Formatted amounts with several commas back to numbers."""
    text = F.concat(F.lit("$"), F.format_number("l_extendedprice", 2))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", X.money_parse(text).alias("price"))


@query(f"""select "id", try_cast(try_cast("Square Feet" as double) as int) as square_feet from {_RAW}""")
def square_feet_parse(t):
    return t.raw_listings.select("id", X.square_feet_parse(F.col("Square Feet")).alias("square_feet"))


@query(f"""select "id", try_cast(regexp_extract("Bedrooms", '^(\\d+)br', 1) as int) as bedrooms from {_RAW}""")
def bedrooms_parse(t):
    return t.raw_listings.select("id", X.bedrooms_parse(F.col("Bedrooms")).alias("bedrooms"))


@query("select o_orderkey, floor(o_totalprice)::int as postings from orders")
def count_text_parse(t):
    text = F.concat(F.format_number(F.floor("o_totalprice"), 0), F.lit(" postings"))
    return t.orders.select("o_orderkey", X.count_text_parse(text).alias("postings"))


@query("select o_orderkey, ceil(o_custkey / 120)::int as pages from orders")
def ceil_div_pages(t):
    return t.orders.select("o_orderkey", X.ceil_div_pages(F.col("o_custkey")).alias("pages"))


_PADDED = "chr(10) || chr(160) || ' ' || p_name || ' ' || chr(9) || chr(160)"


@query(r"""select p_partkey, regexp_replace(x, '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g') as name from
    (select p_partkey, """ + _PADDED + " as x from part)")
def strip_ws(t):
    return t.part.select("p_partkey", X.strip_ws(F.expr(_PADDED)).alias("name"))


@query("select p_partkey, string_split(p_name, ' ')[2] as second, string_split(p_name, ' ')[3] as third from part")
def split_index(t):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey", X.split_index(name, " ", 1).alias("second"), X.split_index(name, " ", 2).alias("third")
    )


@query("select c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'None listed') as segment from customer")
def default_if_missing(t):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return t.customer.select("c_custkey", X.default_if_missing(segment, S.ADDRESS_MISSING).alias("segment"))


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders")
def format_date(t):
    return t.orders.select("o_orderkey", X.format_date(F.col("o_orderdate")).alias("day"))


@query("""select l_orderkey, l_linenumber, l_partkey, round_even(l_extendedprice * l_discount, 2) as discount_value
    from lineitem""")
def round2(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", half_even(F.col("l_extendedprice") * F.col("l_discount")).alias("discount_value")
    )


@query(f"""select "id", case "cats_allowed" when 1 then 'Yes' when 0 then 'No' end as label,
    case "cats_allowed" when 1 then 'green' else 'red' end as colour from {_CLEAN}""")
def flag_label(t):
    flag = F.col("cats_allowed")
    return t.listings.select("id", X.flag_label(flag).alias("label"), X.flag_colour(flag).alias("colour"))
