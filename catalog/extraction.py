"""Fields, attributes and links out of page HTML."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.tables import RAW_LISTINGS, duck
from hearthline import schema as S
from hearthline.functions import html as H
from hearthline.operators import attributes as A
from hearthline.plans.listing_pages import cleaned_counts, extract_fields, page_to_listing_by_vocabulary
from hearthline.plans.listing_pages import page_to_listing as to_listing

_TITLE = f"""case when "Title" = '{S.TITLE_MISSING}' then "Title" else replace("Title", ', ', ' & ') || '!' end"""
_FEET = f"""case when "Bedrooms" = '{S.BEDROOMS_MISSING}' then '{S.SQUARE_FEET_MISSING}'
    else coalesce("Square Feet", '') end"""
_BASIC = f"""{_TITLE} as "Title", "Price", "Bedrooms", {_FEET} as "Square Feet", "Full Address" """
_PLAIN_FLAGS = [n for n in S.RAW_FLAGS if n != S.FEE_ATTRIBUTE]

# Entities that occur in the raw page titles: the ampersand, also without its
# semicolon, and the quote; the ampersand goes last.
_H1 = r"""regexp_replace(replace(trim(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)), '&quot;', '"'), '&amp;?', '&', 'g')"""


@query(f"select page_id, {_H1} as heading, '{S.ADDRESS_MISSING}' as address from pages")
def html_text_field(t):
    texts = H.html_texts(H.visible(F.col("html")), ("h1", None), ("h2", ("class", "street-address")))
    heading, address = (F.get("texts", F.lit(k)) for k in range(2))
    return t.pages.select("page_id", texts.alias("texts")).select(
        "page_id",
        H.text_or(heading, S.TITLE_MISSING).alias("heading"),
        H.text_or(address, S.ADDRESS_MISSING).alias("address"),
    )


@query(f'select "id" as page_id, "Bedrooms" as bedrooms, {_FEET} as square_feet from {duck(RAW_LISTINGS)}')
def html_housing_split(t):
    text = H.html_text(H.visible(F.col("html")), "span", ("class", "housing"))
    return t.listing_pages.select("page_id", H.html_housing_split(text).alias("h")).select("page_id", "h.*")


_FLAG_TEXT = "list_filter([" + ", ".join(f"""case when "{n}" = 1 then '{n}' end""" for n in _PLAIN_FLAGS) + (
    f""", case when "{S.FEE_ATTRIBUTE}" = 1 then '$35 application fee' end], lambda x: x is not null)"""
)


@query(f"""select "id" as page_id, array_to_string({_FLAG_TEXT}, '|') as attributes from {duck(RAW_LISTINGS)}""")
def html_attributes(t):
    found = H.html_attributes(H.visible(F.col("html")))
    return t.listing_pages.select("page_id", F.array_join(found, "|").alias("attributes"))


@query(
    r"""select page_id, unnest(regexp_extract_all(html, '<li><a\s[^>]*href="([^"]*)"', 1)) as link from pages"""
)
def html_result_links(t):
    links = H.html_result_links(H.visible(F.col("html")), ("li", None))
    return t.pages.select("page_id", F.explode_outer(links).alias("link")).filter("link is not null")


@query(
    f"""select page_id, case when page_id % 4 = 0 then '{S.POSTINGS_COUNT_MISSING}'
    else format('{{:,}}', len(html) * 10) || ' postings' end as postings from pages"""
)
def html_postings_count(t):
    # A result counter put in front of the page, absent from every fourth.
    bar = F.concat(
        F.lit('<div class="x cl-count-save-bar"><div>'),
        F.format_number(F.length("html") * 10, 0),
        F.lit(" postings</div><button>save</button></div>"),
    )
    page = F.when(F.col("page_id") % 4 == 0, F.col("html")).otherwise(F.concat(bar, "html"))
    return t.pages.select("page_id", H.html_postings_count(H.visible(page)).alias("postings"))


@query(
    f"""select {_BASIC}, {", ".join(f'"{n}"' for n in S.RAW_FLAGS)}, date '2024-05-31' as date_added
    from {duck(RAW_LISTINGS)}"""
)
def page_to_listing(t):
    return to_listing(t.listing_pages, day=dt.date(2024, 5, 31))


@query(
    f"""select {_BASIC}, {", ".join(f'"{n}"' for n in S.RAW_FLAGS if n != "house")}, date '2024-05-31' as date_added
    from {duck(RAW_LISTINGS)}"""
)
def page_to_listing_vocabulary(t):
    # No listing is a "house", so that flag gets no column.
    return page_to_listing_by_vocabulary(t.listing_pages, 1000, day=dt.date(2024, 5, 31))


@query(f'select "id" as page_id, {_BASIC} from {duck(RAW_LISTINGS)}')
def html_basic_columns(t):
    return extract_fields(t.listing_pages).drop("attributes", "url", "date_added")


@query(
    f"""select * from ({" union all ".join(f"""select '{n}' as attribute, sum("{n}")::bigint as "count" from {duck(RAW_LISTINGS)}""" for n in S.RAW_FLAGS)})
    where "count" > 0 or attribute = '{S.FEE_ATTRIBUTE}'"""
)
def page_attribute_counts(t):
    return cleaned_counts(extract_fields(t.listing_pages))


@query(f'select "id" as page_id, "{S.FEE_ATTRIBUTE}" as fee_needed from {duck(RAW_LISTINGS)}')
def page_fee_flags(t):
    return A.fee_flag_per_listing(extract_fields(t.listing_pages)).select("page_id", "fee_needed")
