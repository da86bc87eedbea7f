"""Deduplication, ordering, top rows and unions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.geo import miles_sql
from catalog.registry import query
from catalog.tables import ATTRIBUTE_ROWS_SQL, FOLDED_COUNTS_SQL, LOCATED_LISTINGS, RAW_LISTINGS, STORES, duck
from hearthline import schema as S
from hearthline.operators import attributes as A
from hearthline.operators import profile as P
from hearthline.operators import rows as R
from hearthline.operators.projection import project_columns
from hearthline.plans import daily
from hearthline.plans.history import merge_history as merge

_RAW = duck(RAW_LISTINGS)


@query("select distinct l_returnflag, l_linestatus, l_quantity, l_discount, l_tax from lineitem")
def dedup_rows(t):
    return R.dedup_rows(t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"))


@query("select count(*) > 0 as has_duplicates from (select 1 from lineitem group by l_orderkey, l_partkey having count(*) > 1)")
def has_duplicates(t):
    return R.has_duplicates(t.lineitem.select("l_orderkey", "l_partkey"))


# Pages again under a shared address, so that most addresses have many fetches.
_SHARED = "case when page_id % 3 = 0 then 'https://hot.example.org/' else 'https://example.org/' || cast(page_id % 50 as string) end"


@query(
    f"""select url, page_id, html from (select {_SHARED} as url, page_id, html,
      row_number() over (partition by {_SHARED} order by page_id desc) as rank from pages) where rank = 1"""
)
def dedup_by_url(t):
    # A third of all pages share one URL.
    pages = t.pages.select("page_id", F.expr(_SHARED).alias("url"), "html")
    return R.dedup_by_url(pages)


@query("select o_orderkey, cast(o_orderdate as date) as date_added from orders order by 2, 1")
def sort_by_date(t):
    dated = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("date_added"))
    return R.sort_by_date(dated, tiebreak=["o_orderkey"])


@query(f"""select attribute, sum("count")::bigint as "count" from ({FOLDED_COUNTS_SQL}) group by 1 order by 2 desc, 1""")
def sort_counts_desc(t):
    return R.sort_desc(A.collapse_fee_group(A.attribute_counts(t.attribute_lists)), "count", ["attribute"])


@query("select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey")
def sort_values_desc(t):
    return R.sort_desc(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", ["c_custkey"])


@query('select l_linenumber as "value", count(*) as "count" from lineitem group by 1 order by 1 desc')
def sort_index_desc(t):
    return R.sort_desc(P.value_counts(t.lineitem, "l_linenumber"), "value")


@query("select o_orderkey, o_totalprice from orders order by o_totalprice, o_orderkey limit 5")
def head_n(t):
    return R.head_n(t.orders.select("o_orderkey", "o_totalprice"), 5, "o_totalprice", "o_orderkey")


_HISTORY = ["id", "Title", "Price", "monthly", "house", "date_added"]


@query(
    f"""select "id", "Title", "Price", "monthly", "house", "date_added" from {_RAW}
    union all select "id" + 1000000000, "Title", "Price", "monthly", 0, date '2024-05-31' from {_RAW}"""
)
def union_history(t):
    # Today's rows lack a history column and bring one that history has not.
    history = project_columns(t.raw_listings, _HISTORY)
    today = t.raw_listings.select((F.col("id") + 1000000000).alias("id"), "Price", "Title", "monthly", "carport")
    return merge(history, today, dt.date(2024, 5, 31))


@query("select l_orderkey as k from lineitem union all select o_orderkey from orders union all select c_custkey from customer")
def union_rows(t):
    return R.union_rows(
        t.lineitem.select(F.col("l_orderkey").alias("k")),
        t.orders.select(F.col("o_orderkey").alias("k")),
        t.customer.select(F.col("c_custkey").alias("k")),
    )


_ONE_CLEAN = ", ".join(
    [
        """"Title" as title""",
        """try_cast(replace(replace("Price", '$', ''), ',', '') as double) as price""",
        '"Bedrooms"',
        """try_cast(try_cast("Square Feet" as double) as int) as square_feet""",
        '"Full Address" as full_address',
        *[f'"{n}" as "{S.RENAMES.get(n, n)}"' for n in S.RAW_FLAGS],
        '"date_added"',
        'round("latitude", 6) as latitude, round("longitude", 6) as longitude',
        *[
            f"""round("{S.distance_column(x)}", 6) as "{S.distance_column(x)}",
            nullif("{S.store_column(x)}", 'N/A') as "{S.store_column(x)}" """
            for x in S.TIERS
        ],
    ]
)
_CLEANED = f"""select distinct {_ONE_CLEAN} from {duck(LOCATED_LISTINGS)} where "Title" <> '{S.TITLE_MISSING}'"""


def _rounded(df):
    places = ["latitude", "longitude", *[S.distance_column(x) for x in S.TIERS]]
    return df.withColumns({c: F.round(c, 6) for c in places})


def _located(t):
    # Every row twice, so the full-row deduplication has work to do.
    located = t.located_listings.drop("id")
    return located.unionByName(located)


@query(f"""select * from ({_CLEANED}) where square_feet is not null and full_address <> 'None listed'""")
def cleaning_chain(t):
    return _rounded(daily.ready(daily.clean(_located(t))))


@query(f"""select * from ({_CLEANED}) where square_feet is not null""")
def cleaning_chain_keep_unlisted(t):
    return _rounded(daily.ready(daily.clean(_located(t)), keep_unlisted=True))


@query(f"select count(distinct attribute) as attributes from ({ATTRIBUTE_ROWS_SQL})")
def distinct_attributes(t):
    return P.row_count(A.attribute_counts(t.attribute_lists)).withColumnRenamed("rows", "attributes")


_DAILY_HOMES = f"""
select "id", {", ".join(f'"{n}"' for n in S.RAW_FLAGS)},
  case when "Title" = '{S.TITLE_MISSING}' then null else replace("Title", ', ', ' & ') || '!' end as title,
  try_cast(replace(replace("Price", '$', ''), ',', '') as double) as price,
  case when "Bedrooms" = '{S.BEDROOMS_MISSING}' then null
       else try_cast(try_cast("Square Feet" as double) as int) end as square_feet,
  "Bedrooms", "Full Address" as full_address,
  case when "Full Address" <> 'None listed' then
    33.95::double + (cast(string_split("Full Address", ' ')[1] as int) * 37 % 1300) / 10000.0::double end as latitude,
  case when "Full Address" <> 'None listed' then
    -118.5::double + (cast(string_split("Full Address", ' ')[1] as int) * 53 % 1500) / 10000.0::double end as longitude
from {_RAW}"""
_DAILY_MILES = miles_sql("h.latitude", "h.longitude", "s.lat", "s.lng")
_DAILY_BEST = f"""
select latitude, longitude, tier, round(distance, 6) as distance, store from (
  select h.latitude, h.longitude, s.tier, {_DAILY_MILES} as distance, s.name || ' - ' || s.address as store,
    row_number() over (partition by h.latitude, h.longitude, s.tier
                       order by round({_DAILY_MILES}, 9), s.store_order) as rank
  from (select distinct latitude, longitude from ({_DAILY_HOMES}) where latitude is not null) h
  cross join {duck(STORES)} s) where rank = 1"""


@query(
    f"""with best as ({_DAILY_BEST})
    select distinct h.title, h.price, h."Bedrooms", h.square_feet, h.full_address,
      {", ".join(f'h."{n}" as "{S.RENAMES.get(n, n)}"' for n in S.RAW_FLAGS)},
      date '2024-05-31' as date_added, round(h.latitude, 6) as latitude, round(h.longitude, 6) as longitude,
      {", ".join(f'{x}.distance as "{S.distance_column(x)}", {x}.store as "{S.store_column(x)}"' for x in S.TIERS)}
    from ({_DAILY_HOMES}) h
    {" ".join(f"left join best {x} on {x}.latitude = h.latitude and {x}.longitude = h.longitude and {x}.tier = '{x}'" for x in S.TIERS)}
    where h.title is not null and h.square_feet is not null"""
)
def daily_listings(t):
    """Pages to cleaned, located listings: the whole daily load."""
    street = F.concat(F.col("n").cast("string"), F.lit(" Elm St"))
    numbers = t.customer.select((F.col("c_custkey") % 900 + 1).alias("n")).distinct()
    geocode = numbers.select(
        street.alias("address"),
        (33.95 + (F.col("n") * 37 % 1300) / 10000.0).alias("lat"),
        (-118.5 + (F.col("n") * 53 % 1500) / 10000.0).alias("lng"),
    )
    listings = daily.daily_listings(t.listing_pages, geocode, t.stores, dt.date(2024, 5, 31))
    return _rounded(listings)
