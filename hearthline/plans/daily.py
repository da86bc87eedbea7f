"""The daily load: pages or raw listings to the cleaned, located table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.text import money_parse, square_feet_parse
from hearthline.operators import filters, lookup, nearest, projection, rows
from hearthline.plans.listing_pages import page_to_listing
from hearthline.session import ensure_checkpoints
from hearthline.sources.writers import append_listings, create_listing_table


def locate(raw: DataFrame, geocode: DataFrame, stores: DataFrame) -> DataFrame:
    """Raw listings plus coordinates and the nearest store of each tier."""
    placed = lookup.geocode_lookup(raw, geocode, address="Full Address")
    return nearest.nearest_store_wide(placed, stores)


def clean(located: DataFrame) -> DataFrame:
    """First cleaning: titles, price, names, flag types, duplicates.

    The store text ``N/A`` becomes null here, and square feet become a number.
    """
    titled = filters.drop_sentinel_title(located)
    named = projection.rename_map(titled.withColumn("Price", money_parse(F.col("Price"))))
    typed = projection.cast_flags_int(named)
    numbered = typed.withColumn("square_feet", square_feet_parse(F.col("square_feet")))
    stores = {c: F.nullif(F.col(c), F.lit(S.STORE_MISSING)) for c in map(S.store_column, S.TIERS) if c in located.columns}
    return rows.dedup_rows(numbered.withColumns(stores))


def ready(cleaned: DataFrame, keep_unlisted: bool = False) -> DataFrame:
    """Second cleaning: rows with square feet and, by default, an address."""
    return filters.drop_unlisted_address(filters.drop_null_sqft(cleaned), keep_unlisted=keep_unlisted)


def daily_listings(
    pages: DataFrame, geocode: DataFrame, stores: DataFrame, day: dt.date, keep_unlisted: bool = True
) -> DataFrame:
    """All steps from pages on; the daily load keeps unlisted addresses.

    Fields are read where a page is scanned, and only the narrow listing rows
    are deduplicated by URL, so page text is never shuffled. The raw listings
    are kept in the shared folder, as the store search reads them twice.
    """
    ensure_checkpoints(pages.sparkSession)
    listed = page_to_listing(pages, day=day, keep=("url", "page_id"))
    raw = rows.dedup_by_url(listed).drop("url", "page_id").checkpoint()
    return ready(clean(locate(raw, geocode, stores)), keep_unlisted)


def load_day(
    pages: DataFrame, geocode: DataFrame, stores: DataFrame, day: dt.date, table: str, load_id: str | None = None
) -> None:
    """Load a batch of pages of one day; makes the table if it is not there.

    ``load_id`` names the batch: another batch of the same day adds to it, the
    same one again replaces itself. A day that comes in one batch needs none.
    """
    create_listing_table(pages.sparkSession, table)
    append_listings(daily_listings(pages, geocode, stores, day), table, load_id or day.isoformat())
