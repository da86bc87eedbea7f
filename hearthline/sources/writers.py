"""Sinks: CSV and Parquet paths, and the partitioned listing table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline import schema as S
from hearthline.functions.text import bedrooms_parse, square_feet_parse
from hearthline.operators.projection import quoted
from hearthline.sources.readers import MODES


#: Spark trims values on write unless told otherwise.
CSV_WRITE = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def sink_csv_overwrite(df: DataFrame, path: str) -> None:
    """Replace a CSV folder: header, doubled quotes, one file per task.

    Values are written as they are, with white space at their ends.
    """
    df.write.mode("overwrite").options(**CSV_WRITE).csv(path)


def sink_path(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write straight to any path the cluster's file systems know."""
    df.write.mode("overwrite").format(file_format).save(path)


def sink_routed(df: DataFrame, mode: str, targets: Mapping[str, str]) -> str:
    """Write to the target of the run mode; returns the path written."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    sink_csv_overwrite(df, targets[mode])
    return targets[mode]


def create_listing_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """The listing table if it is not there yet: Parquet, a partition for each day of a load.

    The load comes first in the partition path, so that a load can be replaced
    as a whole. The table itself says that an overwrite takes all partitions it
    names, whatever the session's own overwrite mode is.
    """
    columns = ",\n".join(f"  `{f.name}` {f.dataType.simpleString()}" for f in S.LISTING_TABLE.fields if f.name != "date_added")
    day = S.LISTING_TABLE["date_added"].dataType.simpleString()
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (\n{columns},\n  `load_id` string,\n  `date_added` {day}\n)"
        f" USING parquet OPTIONS (partitionOverwriteMode 'static') PARTITIONED BY (load_id, date_added){at}"
    )


def _to_type(name: str, have: T.DataType, want: T.DataType) -> Column:
    value = quoted(name)
    if have == want:
        return value
    if isinstance(have, T.StringType):
        if name == "Bedrooms":
            return bedrooms_parse(value)
        if name == "square_feet":
            return square_feet_parse(value)
        if isinstance(want, T.BooleanType):
            # 0/1 as text, as the daily file holds flags.
            return value.try_cast("int").cast("boolean")
    return value.cast(want) if not isinstance(have, T.StringType) else value.try_cast(want)


def to_listing_table(df: DataFrame) -> DataFrame:
    """Cleaned listings as the table's 36 typed columns, matched by name."""
    have = {f.name: f.dataType for f in df.schema.fields}
    lacking = [f.name for f in S.LISTING_TABLE.fields if f.name not in have]
    if lacking:
        raise ValueError(f"columns missing for the listing table: {lacking}")
    return df.select(
        *[_to_type(f.name, have[f.name], f.dataType).alias(f.name) for f in S.LISTING_TABLE.fields]
    )


def append_listings(df: DataFrame, table: str, load_id: str) -> None:
    """Add one load; the same load again replaces what it wrote before.

    Days hold the rows of all their loads, so a second batch of a day adds to
    the first. Only the partition of ``load_id`` is overwritten, with all its
    days: a rerun leaves the same table, and days that a rerun no longer has
    are gone. A rerun that fails midway leaves its own load incomplete, never
    another one; run it again. Rows are rebalanced by day before writing:
    small days share files, and a day with very many rows is split over
    several writers.
    """
    spark = df.sparkSession
    if [f.name for f in spark.table(table).schema.fields][-2:] != ["load_id", "date_added"]:
        raise ValueError(f"{table} is not partitioned by load_id and date_added; make it with create_listing_table")
    data = [f.name for f in S.LISTING_TABLE.fields if f.name != "date_added"]
    rows = to_listing_table(df).select(*[quoted(c) for c in data], "date_added").hint("rebalance", F.col("date_added"))
    named = load_id.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (load_id = '{named}', date_added) SELECT * FROM {{rows}}", rows=rows
    )
