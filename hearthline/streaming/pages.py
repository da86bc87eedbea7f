"""Crawled pages as they arrive: every fetch is written once, the last one of a URL is read.

The page table is partitioned by load and bucketed by ``part``, a run of at
most 32,768 rows that one task wrote in one load. Rows stay in the task that
read them, so page text is written without a shuffle. Which rows are the last
of their URL follows from the narrow columns alone; it comes back as a bitmap
for each part, which meets the pages in the buckets they already lie in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hearthline.operators.projection import quoted
from hearthline.streaming.incremental import drain

#: Rows of one part: as many as one bitmap of Spark's bitmap functions has bits.
PART_ROWS = 1 << 15
#: The table's own columns.
PART, PLACE, LOAD = "_part", "_place", "load_id"


def create_page_table(spark: SparkSession, table: str, schema: T.StructType, location: str | None = None, buckets: int = 200) -> None:
    """The page table if it is not there yet.

    Take as many buckets as tasks should read the whole table. Where the
    catalog does not outlive the session, name the location and have
    ``find_loads`` look for the loads that lie there already.
    """
    columns = ", ".join(f"{quoted_sql(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {PART} string, {PLACE} int, {LOAD} string) USING parquet"
        f" PARTITIONED BY ({LOAD}) CLUSTERED BY ({PART}) INTO {buckets} BUCKETS{at}"
    )


def find_loads(spark: SparkSession, table: str) -> None:
    """Make the loads at the table's location known to a new catalog."""
    spark.catalog.recoverPartitions(table)


def quoted_sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def append_pages(batch: DataFrame, table: str, load_id: str) -> None:
    """Add one load, without a shuffle; the same load again replaces itself alone."""
    spark = batch.sparkSession
    data = [f.name for f in spark.table(table).schema.fields if f.name not in (PART, PLACE, LOAD)]
    numbered = batch.select(*[quoted(c) for c in data], F.monotonically_increasing_id().alias(PLACE))
    # The number's upper bits are the task, its lower ones count the task's rows.
    part = F.concat(F.lit(f"{load_id}-"), F.expr(f"{PLACE} div {PART_ROWS}").cast("string"))
    rows = numbered.select(*[quoted(c) for c in data], part.alias(PART), (F.col(PLACE) % PART_ROWS).cast("int").alias(PLACE))
    named = load_id.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD} = '{named}') SELECT * FROM {{rows}}", rows=rows)


def load_pages(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Add every new micro-batch to the page table, then stop; the next run takes the rest.

    A batch that is repeated after a failure replaces its own load.
    """
    return drain(stream, checkpoint, lambda batch, load_id: append_pages(batch, table, load_id))


def _buckets(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{table} is not bucketed; make it with create_page_table")
    return int(rows[0]["data_type"])


def latest_pages(spark: SparkSession, table: str, url: str = "url", order: str = "page_id") -> DataFrame:
    """One row per URL over all loads, the one fetched last, in the columns of the pages.

    As in ``dedup_by_url``, a null URL is a URL of its own and a row without an
    order is the earliest; of rows equal in URL and order one stays, the same
    one in every read. Only URL, order and place are shuffled, combined before
    the shuffle, so a URL with very many fetches never gathers its rows.
    """
    # Loads may have come through another session, as those of a stream do.
    spark.catalog.refreshTable(table)
    pages = spark.table(table)
    data = [c for c in pages.columns if c not in (PART, PLACE, LOAD)]
    # Nulls come first in the order of structs, so any order is later than none.
    place = F.struct(quoted(order).alias("order"), F.col(PART), F.col(PLACE))
    last = pages.groupBy(quoted(url)).agg(F.max(place).alias("last"))
    last = last.select(F.col(f"last.{PART}").alias(PART), F.col(f"last.{PLACE}").alias(PLACE))
    # Dealt as the table's buckets are, so that the join moves no page.
    live = last.repartition(_buckets(spark, table), PART).groupBy(PART).agg(F.bitmap_construct_agg(F.col(PLACE).cast("long")).alias("_live"))
    octet = F.conv(F.hex(F.substring("_live", F.expr(f"{PLACE} div 8 + 1"), F.lit(1))), 16, 10).cast("long")
    joined = pages.join(live.hint("shuffle_hash"), PART)
    return joined.where(F.getbit(octet, F.col(PLACE) % 8) == 1).select(*[quoted(c) for c in data])
