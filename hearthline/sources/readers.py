"""Scans. Every one takes an explicit schema: no inference pass over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline import schema as S

MODES = ("baseline", "daily")


def csv_options(multi_line: bool = False) -> dict[str, str]:
    """Header, doubled quotes and, on request, quoted line breaks.

    A file with quoted line breaks cannot be split, so one task reads it whole;
    without them a large file is read by many.
    """
    return {"header": "true", "escape": '"', "multiLine": str(multi_line).lower()}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).options(**csv_options(multi_line)).csv(path)


def scan_csv_strings(spark: SparkSession, path: str, columns: Sequence[str], multi_line: bool = False) -> DataFrame:
    """Every column as text; typing is left to the projection that follows."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return scan_csv(spark, path, schema, multi_line)


def scan_links(spark: SparkSession, path: str, column: str = "URL") -> DataFrame:
    """The URL list stays a frame; it is never turned into a driver list."""
    return scan_csv(spark, path, f"`{column}` string")


def choose_source(
    spark: SparkSession, mode: str, baseline: str, daily: str, schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    """The baseline or the daily file, with the same schema in both modes."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    return scan_csv(spark, daily if mode == "daily" else baseline, schema, multi_line)


def page_urls(pages: Column, base: Column | str) -> Column:
    """Result-page addresses 0..pages-1 as an array; empty for no pages."""
    start = F.lit(base) if isinstance(base, str) else base
    numbers = F.when(pages > 0, F.sequence(F.lit(0), pages - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda n: F.concat(start, F.lit("~list~"), n.cast("string"), F.lit("~0")))


GEOCODE_JSON = "array<struct<geometry:struct<location:struct<lat:double,lng:double>>>>"
PLACES_JSON = (
    "struct<results:array<struct<name:string,vicinity:string,"
    "geometry:struct<location:struct<lat:double,lng:double>>>>>"
)


def first_location(answer: Column) -> Column:
    """Struct(lat, lng) of the first hit in a geocoder's JSON answer.

    Null fields for an empty answer: no hit is not an error.
    """
    location = F.get(F.from_json(answer, GEOCODE_JSON), F.lit(0))["geometry"]["location"]
    return F.struct(location["lat"].alias("lat"), location["lng"].alias("lng"))


def places_from_json(df: DataFrame, answer: str) -> DataFrame:
    """One row per place in a search answer: name, address, lat, lng."""
    found = F.from_json(F.col(answer), PLACES_JSON)["results"]
    places = F.transform(
        found,
        lambda p: F.struct(
            p["name"].alias("name"),
            F.coalesce(p["vicinity"], F.lit(S.STORE_ADDRESS_MISSING)).alias("address"),
            p["geometry"]["location"]["lat"].alias("lat"),
            p["geometry"]["location"]["lng"].alias("lng"),
        ),
    )
    # Outer plus filter, so that the answer is parsed once.
    rows = df.select(*[c for c in df.columns if c != answer], F.inline_outer(places))
    return rows.filter(F.col("address").isNotNull())
