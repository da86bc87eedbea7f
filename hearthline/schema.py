"""Column names, sentinels and types of the listing data model."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Texts, names and numbers that results must agree on.
# ---------------------------------------------------------------------------

TITLE_MISSING = "Title Not Found"
PRICE_MISSING = "Price Not Found"
BEDROOMS_MISSING = "Bedrooms Info Not Found"
SQUARE_FEET_MISSING = "Square Feet Not Found"
ADDRESS_MISSING = "None listed"
POSTINGS_COUNT_MISSING = "Postings count not found"
STORE_ADDRESS_MISSING = "Address not provided"
STORE_MISSING = "N/A"

FEE_ATTRIBUTE = "Fee Needed To Apply"
FEE_PATTERN = r"\b\d+\b"
MIN_ATTRIBUTE_COUNT = 3

BASIC_COLUMNS = ["Title", "Price", "Bedrooms", "Square Feet", "Full Address"]

RAW_FLAGS = [
    "monthly",
    "apartment",
    "cats are OK - purrr",
    "dogs are OK - wooof",
    "laundry on site",
    "air conditioning",
    "off-street parking",
    "EV charging",
    "w/d in unit",
    "carport",
    "no smoking",
    "attached garage",
    "detached garage",
    "laundry in bldg",
    "Fee Needed To Apply",
    "wheelchair accessible",
    "no parking",
    "furnished",
    "street parking",
    "no laundry on site",
    "house",
    "w/d hookups",
]

RENAMES = {
    "Title": "title",
    "Price": "price",
    "Square Feet": "square_feet",
    "Full Address": "full_address",
    "cats are OK - purrr": "cats_allowed",
    "dogs are OK - wooof": "dogs_allowed",
    "laundry on site": "laundry_on_site",
    "air conditioning": "air_conditioning",
    "off-street parking": "off_street_parking",
    "EV charging": "EV_charging",
    "w/d in unit": "washer_dryer_in_unit",
    "no smoking": "no_smoking",
    "attached garage": "attached_garage",
    "detached garage": "detached_garage",
    "laundry in bldg": "laundry_in_bldg",
    "Fee Needed To Apply": "fee_needed_to_apply",
    "wheelchair accessible": "wheelchair_accessible",
    "no parking": "no_parking",
    "street parking": "street_parking",
    "no laundry on site": "no_laundry_on_site",
    "w/d hookups": "washer_dryer_hookups",
}

TIERS = ["budget", "midTier", "premium"]

STORE_KEYWORDS = [
    ("premium", "Whole Foods Market"),
    ("premium", "Erewhon"),
    ("premium", "Bristol Farms"),
    ("midTier", "Ralphs Fresh Fare"),
    ("midTier", "Vons"),
    ("midTier", "Trader Joe's"),
    ("budget", "Costco Wholesale"),
    ("budget", "Smart and Final"),
]

SEARCH_CENTRE = (34.0259, -118.4965)
SEARCH_RADIUS_MILES = 3.6
METERS_PER_MILE = 1609.34

# lat_min, lat_max, lon_min, lon_max
MAP_BOX = (33.95, 34.08, -118.5, -118.35)
MAP_PRICE_SCALE = (1500.0, 5000.0)

POSTINGS_PER_PAGE = 120

STANDARDIZED = [
    "square_feet",
    "nearest_budget_grocery_store_distance",
    "nearest_midTier_grocery_store_distance",
    "nearest_premium_grocery_store_distance",
]

NOT_FEATURES = [
    "title",
    "nearest_budget_grocery_store",
    "nearest_midTier_grocery_store",
    "house",
    "monthly",
    "latitude",
    "nearest_premium_grocery_store",
    "Bedrooms",
    "full_address",
    "apartment",
    "price",
    "longitude",
]

# ---------------------------------------------------------------------------
# Derived from the above.
# ---------------------------------------------------------------------------

FLAGS = [RENAMES.get(name, name) for name in RAW_FLAGS]
MASTER_COLUMNS = BASIC_COLUMNS + RAW_FLAGS + ["date_added"]


def distance_column(tier: str) -> str:
    return f"nearest_{tier}_grocery_store_distance"


def store_column(tier: str) -> str:
    return f"nearest_{tier}_grocery_store"


NEAREST_COLUMNS = [f(t) for t in TIERS for f in (distance_column, store_column)]

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

RAW_LISTING = T.StructType(
    [T.StructField(c, T.StringType()) for c in BASIC_COLUMNS]
    + [T.StructField(c, T.IntegerType()) for c in RAW_FLAGS]
    + [T.StructField("date_added", T.DateType())]
)

GEOCODE = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
    ]
)

STORES = T.StructType(
    [
        T.StructField("tier", T.StringType()),
        T.StructField("store_order", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
    ]
)


def _located_fields() -> list[T.StructField]:
    fields = [T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())]
    for tier in TIERS:
        fields.append(T.StructField(distance_column(tier), T.DoubleType()))
        fields.append(T.StructField(store_column(tier), T.StringType()))
    return fields


# The table the daily load writes: 36 columns, flags as booleans.
LISTING_TABLE = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("Bedrooms", T.IntegerType()),
        T.StructField("square_feet", T.IntegerType()),
        T.StructField("full_address", T.StringType()),
    ]
    + [T.StructField(c, T.BooleanType()) for c in FLAGS]
    + [T.StructField("date_added", T.DateType())]
    + _located_fields()
)
