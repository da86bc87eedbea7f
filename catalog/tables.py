"""The test tables, and listings, stores and places derived from them.

The derived views are SQL over the whole tables, written once and used by both
engines: names in double quotes become backticks for Spark, and ``{orders}``
style names become the Parquet scans.
"""

from __future__ import annotations

import math
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline import schema as S

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Rows that one task makes pages of, about.
_TASK_ROWS = 100_000

# Flag i of an order is 1 when (key * a + customer) has remainder 0 by b.
_FLAG_RULE = {name: (2 * i + 3, i % 7 + 2) for i, name in enumerate(S.RAW_FLAGS)}


def _flag(name: str) -> str:
    if name == "monthly":
        return "1"
    if name == "house":
        return "0"
    a, b = _FLAG_RULE[name]
    return f"cast(case when (o_orderkey * {a} + o_custkey) % {b} = 0 then 1 else 0 end as int)"


_LAT = "cast(33.95 as double) + (o_custkey * 37 % 1400) / cast(10000 as double)"
_LON = "cast(-118.5 as double) + (o_custkey * 53 % 1600) / cast(10000 as double)"

_COORDINATES = f"""
  case when o_orderkey % 13 = 0 then null else {_LAT} end as "latitude",
  case when o_orderkey % 13 = 0 then null else {_LON} end as "longitude" """


def _nearest_column(tier: str) -> str:
    i = S.TIERS.index(tier)
    distance = f"(o_custkey * {i + 2} % 300) / cast(100 as double) + (o_orderkey % 7) / cast(64 as double)"
    return f"""
  case when o_orderkey % 13 = 0 then null else {distance} end as "{S.distance_column(tier)}",
  case when o_orderkey % 13 = 0 then 'N/A' else 'Store ' || cast(o_custkey % 40 as string) || ' - Main St' end
    as "{S.store_column(tier)}" """


# 900 to 7899 dollars, with a thousands comma.
_AMOUNT = "(cast(floor(o_totalprice) as bigint) % 7000 + 900)"
_DOLLARS = f"""
  case when {_AMOUNT} < 1000 then cast({_AMOUNT} as string)
       else cast(cast(floor({_AMOUNT} / 1000) as int) as string) || ',' || lpad(cast({_AMOUNT} % 1000 as string), 3, '0')
  end"""

# Raw listings: 28 text and flag columns, with sentinels, empty and odd values.
# The square-feet text is sometimes written as a decimal.
RAW_LISTINGS = f"""
select o_orderkey as "id",
  case when o_orderkey % 20 = 0 then '{S.TITLE_MISSING}'
       else 'Home ' || cast(o_custkey % 97 as string) || ', ' || o_orderpriority end as "Title",
  case when o_orderkey % 33 = 0 then '{S.PRICE_MISSING}'
       else '$' || {_DOLLARS} || case when o_orderkey % 5 = 0 then '.50' else '' end end as "Price",
  case when o_orderkey % 25 = 3 then '{S.BEDROOMS_MISSING}'
       else cast(o_custkey % 3 + 1 as string) || 'br' end as "Bedrooms",
  case when o_orderkey % 14 = 0 then null
       when o_orderkey % 40 = 1 then '{S.SQUARE_FEET_MISSING}'
       else cast(400 + o_orderkey * 37 % 1200 as string)
            || case when o_orderkey % 9 = 0 then '.0' else '' end end as "Square Feet",
  case when o_orderkey % 13 = 0 then '{S.ADDRESS_MISSING}'
       else cast(o_custkey % 900 + 1 as string) || ' Elm St' end as "Full Address",
  {", ".join(f'{_flag(n)} as "{n}"' for n in S.RAW_FLAGS)},
  cast(o_orderdate as date) as "date_added"
from {{orders}}"""

LOCATED_LISTINGS = RAW_LISTINGS.replace(
    "\nfrom {orders}", f",\n{_COORDINATES}, {', '.join(_nearest_column(t) for t in S.TIERS)}\nfrom {{orders}}"
)

# Cleaned listings with typed columns under their clean names.
LISTINGS = f"""
select o_orderkey as "id",
  'Home ' || cast(o_custkey % 97 as string) as "title",
  case when o_orderkey % 33 = 0 then null else o_totalprice / 100 end as "price",
  cast(o_custkey % 3 + 1 as int) as "Bedrooms",
  case when o_orderkey % 14 = 0 then null else cast(400 + o_orderkey * 37 % 1200 as int) end as "square_feet",
  case when o_orderkey % 13 = 0 then '{S.ADDRESS_MISSING}'
       else cast(o_custkey % 900 + 1 as string) || ' Elm St' end as "full_address",
  {", ".join(f'{_flag(n)} as "{S.RENAMES.get(n, n)}"' for n in S.RAW_FLAGS)},
  cast(o_orderdate as date) as "date_added", {_COORDINATES},
  {", ".join(_nearest_column(t) for t in S.TIERS)}
from {{orders}}"""

# Homes with coordinates only, one per customer; every tenth has no latitude.
HOMES = """
select c_custkey as "id",
  case when c_custkey % 10 = 0 then null
       else cast(33.95 as double) + (c_custkey * 37 % 1300) / cast(10000 as double) end as "latitude",
  cast(-118.5 as double) + (c_custkey * 53 % 1500) / cast(10000 as double) as "longitude",
  c_acctbal as "price"
from {customer}"""

# Stores of three tiers, one per supplier.
STORES = """
select case s_nationkey % 3 when 0 then 'budget' when 1 then 'midTier' else 'premium' end as "tier",
  s_suppkey as "store_order", s_name as "name", 'Block ' || cast(s_nationkey as string) as "address",
  cast(33.95 as double) + (s_suppkey * 41 % 1300) / cast(10000 as double) as "lat",
  cast(-118.5 as double) + (s_suppkey * 59 % 1500) / cast(10000 as double) as "lng"
from {supplier}"""

# Places found by name, one per part, around the search centre.
PLACES = """
select p_partkey as "place_id", p_name as "name", p_brand as "address",
  cast(33.95 as double) + (p_partkey * 61 % 1500) / cast(10000 as double) as "lat",
  cast(-118.58 as double) + (p_partkey * 67 % 1700) / cast(10000 as double) as "lng"
from {part}"""

PLACE_KEYWORDS = [("premium", "Ring"), ("midTier", "widget"), ("budget", "small"), ("budget", "Gear")]

# Attribute lists, one per event, as text with a bar after every entry. Some
# hold a fee, some name the event type twice, some hold a rare entry.
ATTRIBUTE_TEXTS = """
select event_id, user_id,
  case when event_id % 19 = 0 then '' else event_type || '|' end
  || case when event_id % 11 = 0 then '$' || cast(event_id % 40 as string) || ' app fee|' else '' end
  || case when event_id % 17 = 0 then cast(event_id % 4 as string) || 'br|' else '' end
  || case when user_id % 5 = 0 then event_type || '|w/d in unit|' else '' end
  || case when event_id % 997 = 0 then 'rare ' || event_type || cast(user_id as string) || 'x|' else '' end
    as attribute_text
from {events}"""

# The same in DuckDB as one row per attribute, and its counts.
ATTRIBUTE_ROWS_SQL = f"""
select event_id, attribute from (
  select event_id, unnest(string_split(attribute_text, '|')) as attribute from ({ATTRIBUTE_TEXTS.format(events="events")})
) where attribute <> ''"""
FEE_SQL = r"regexp_matches(attribute, '\b\d+\b')"
FOLDED_COUNTS_SQL = f"""
select case when {FEE_SQL} then '{S.FEE_ATTRIBUTE}' else attribute end as attribute, count(*) as "count"
from ({ATTRIBUTE_ROWS_SQL}) group by 1"""

# Listing pages made from the raw listings, in the markup the extraction reads.
_PAGE_FLAGS = "\n  || ".join(
    f"""case when `{n}` = 1 then '<div class="attr x{i}"><span class="valu"> <a href="/q?{i}">{n}</a>\\n</span></div>' else '' end"""
    for i, n in enumerate(S.RAW_FLAGS)
    if n != S.FEE_ATTRIBUTE
)
LISTING_PAGES = f"""
select id as page_id, concat('https://homes.example.org/', id, '.html') as url, date_added,
  '<!DOCTYPE html><html><head><script>var s = "<span class=price>$1</span>";</script></head><body>'
  || '<!-- <span id="titletextonly">hidden</span> --><span class="postingtitletext">'
  || case when `Price` = '{S.PRICE_MISSING}' then '' else concat('<span class="price">', `Price`, '</span>') end
  || case when `Bedrooms` = '{S.BEDROOMS_MISSING}' then ''
          else concat('<span class="housing">/ ', `Bedrooms`, ' - ',
                      case when `Square Feet` is null then ''
                           else concat('<span>', `Square Feet`, 'ft<sup>2</sup></span> -') end, '</span>') end
  || case when `Title` = '{S.TITLE_MISSING}' then ''
          else concat('<span id="titletextonly">', replace(`Title`, ', ', ' &amp; '), '&#33;</span>') end
  || '</span>'
  || case when `Full Address` = '{S.ADDRESS_MISSING}' then ''
          else concat('<h2 class="street-address">\\n ', `Full Address`, '&nbsp;</h2>') end
  || '<div class="mapbox"><div class="attrgroup">' || {_PAGE_FLAGS}
  || case when `{S.FEE_ATTRIBUTE}` = 1 then '<div class="attr"><span class="valu">$35 application fee</span></div>' else '' end
  || '<div class="attr">no value</div></div></div></body></html>' as html
from {{raw}}"""


def duck(view: str) -> str:
    """A view as a DuckDB subquery."""
    return "(" + view.format(**{n: n for n in NAMES}) + ")"


class Tables:
    """Lazy scans of one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, sql: str) -> DataFrame:
        used = {n: getattr(self, n) for n in NAMES if f"{{{n}}}" in sql}
        return self.spark.sql(sql.replace('"', "`"), **used)

    @cached_property
    def raw_listings(self) -> DataFrame:
        return self.view(RAW_LISTINGS)

    @cached_property
    def located_listings(self) -> DataFrame:
        return self.view(LOCATED_LISTINGS)

    @cached_property
    def listings(self) -> DataFrame:
        return self.view(LISTINGS)

    @cached_property
    def homes(self) -> DataFrame:
        return self.view(HOMES)

    @cached_property
    def stores(self) -> DataFrame:
        return self.view(STORES)

    @cached_property
    def places(self) -> DataFrame:
        return self.view(PLACES)

    @cached_property
    def attribute_lists(self) -> DataFrame:
        """Events as listings: an id and an array of attribute texts."""
        entries = F.filter(F.split("attribute_text", r"\|"), lambda e: e != "")
        return self.view(ATTRIBUTE_TEXTS).select("event_id", "user_id", entries.alias("attributes"))

    @cached_property
    def listing_pages(self) -> DataFrame:
        raw = self.spark.sql(RAW_LISTINGS.replace('"', "`"), orders=self._spread(self.orders))
        return self.spark.sql(LISTING_PAGES, raw=raw)

    def _spread(self, df: DataFrame) -> DataFrame:
        """Over all cores, and over more tasks where there are many rows.

        The test tables are single files of few row groups. A split of such a
        file may hold no rows at all, so the number of splits tells nothing;
        everything made from them would be made on as many cores as there are
        row groups.
        """
        cores = self.spark.sparkContext.defaultParallelism
        # Whole rounds of tasks.
        return df.repartition(cores * max(1, math.ceil(df.count() / (_TASK_ROWS * cores))))
