"""Crawled pages to raw listing rows, in one projection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions import html as H
from hearthline.functions.text import strip_ws
from hearthline.operators import attributes as A
from hearthline.operators.projection import add_ingest_date, master_schema_project, multi_hot_encode
from hearthline.session import ensure_checkpoints


@dataclass(frozen=True)
class Selectors:
    """Where a page keeps its fields. The listing page markup."""

    title: H.Selector = ("span", ("id", "titletextonly"))
    price: H.Selector = ("span", ("class", "price"))
    housing: H.Selector = ("span", ("class", "housing"))
    address: H.Selector = ("h2", ("class", "street-address"))
    attribute: H.Selector = ("div", ("class", "attr"))
    attribute_value: H.Selector = ("span", ("class", "valu"))


def extract_fields(pages: DataFrame, at: Selectors = Selectors()) -> DataFrame:
    """Basic columns, the attribute list and the fee flag of every page.

    Comments and scripts are removed once; all fields are read from that, and
    their texts are decoded together.
    """
    kept = [c for c in pages.columns if c != "html"]
    single = (at.title, at.price, at.housing, at.address)
    found = H.html_fields(H.visible(F.col("html")), single, at.attribute, at.attribute_value)
    texts = pages.select(*kept, found.alias("_texts"))

    attributes = F.slice("_texts", len(single) + 1, F.size("_texts"))
    fields = texts.select(
        *kept,
        H.text_or(F.get("_texts", F.lit(0)), S.TITLE_MISSING).alias("Title"),
        H.text_or(F.get("_texts", F.lit(1)), S.PRICE_MISSING).alias("Price"),
        H.html_housing_split(F.get("_texts", F.lit(2))).alias("_housing"),
        H.text_or(F.get("_texts", F.lit(3)), S.ADDRESS_MISSING).alias("Full Address"),
        F.coalesce(F.transform(attributes, strip_ws), F.array()).alias("attributes"),
    )
    return fields.select(
        *kept,
        "Title",
        "Price",
        F.col("_housing.bedrooms").alias("Bedrooms"),
        F.col("_housing.square_feet").alias("Square Feet"),
        "Full Address",
        "attributes",
    )


def cleaned_counts(fields: DataFrame) -> DataFrame:
    """Attribute counts over all pages with the fee texts folded together."""
    return A.collapse_fee_group(A.attribute_counts(fields))


def encode_listings(
    fields: DataFrame, flags: Sequence[str], day: dt.date | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Extracted fields to raw listing rows with one 0/1 column per flag name.

    ``keep`` names columns of the pages that stay in front of them.
    """
    names = [*flags] if S.FEE_ATTRIBUTE in flags else [*flags, S.FEE_ATTRIBUTE]
    separated = A.fee_flag_per_listing(fields)
    encoded = multi_hot_encode(separated, "attributes", [n for n in names if n != S.FEE_ATTRIBUTE])
    flagged = encoded.withColumnRenamed("fee_needed", S.FEE_ATTRIBUTE)
    return master_schema_project(add_ingest_date(flagged, day), [*keep, *S.BASIC_COLUMNS, *names, "date_added"])


def page_to_listing(
    pages: DataFrame, at: Selectors = Selectors(), day: dt.date | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One raw listing row per page with the fixed master flags.

    A projection from start to end: pages never leave their task.
    """
    return encode_listings(extract_fields(pages, at), S.RAW_FLAGS, day, keep)


def page_to_listing_by_vocabulary(
    pages: DataFrame,
    most: int,
    at: Selectors = Selectors(),
    day: dt.date | None = None,
    at_least: int = S.MIN_ATTRIBUTE_COUNT,
) -> DataFrame:
    """The same with the flags that the pages themselves support, ``most`` of them.

    The vocabulary needs a count over all pages first. The extracted fields are
    kept in the shared folder in between, so every page is read once only.
    """
    ensure_checkpoints(pages.sparkSession)
    fields = extract_fields(pages, at).checkpoint()
    return encode_listings(fields, A.vocabulary(cleaned_counts(fields), most, at_least), day)
