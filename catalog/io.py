"""Sinks and the listing table: written, read back, compared."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.tables import LOCATED_LISTINGS, duck
from hearthline import schema as S
from hearthline.functions.text import money_parse
from hearthline.operators.projection import rename_map
from hearthline.session import fresh_dir
from hearthline.sources import readers as R
from hearthline.sources import writers as W


@query("select p_partkey, '  ' || p_name || chr(9) as p_name, p_retailprice from part")
def sink_csv_overwrite(t):
    # White space at the ends has to survive the file.
    path = fresh_dir(t.spark, "sink_csv")
    rows = t.part.select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit("\t")).alias("p_name"), "p_retailprice")
    W.sink_csv_overwrite(rows.union(rows), path)
    W.sink_csv_overwrite(rows, path)
    return R.scan_csv(t.spark, path, rows.schema)


@query("select s_suppkey, s_name, s_acctbal, mode from supplier, (values ('baseline'), ('daily')) m(mode)")
def sink_routed(t):
    targets = {m: fresh_dir(t.spark, f"routed-{m}") for m in R.MODES}
    rows = t.supplier.select("s_suppkey", "s_name", "s_acctbal")
    written = [W.sink_routed(rows.withColumn("mode", F.lit(m)), m, targets) for m in R.MODES]
    one, other = (R.scan_csv(t.spark, path, "s_suppkey bigint, s_name string, s_acctbal double, mode string") for path in written)
    return one.union(other)


@query("select * from orders")
def sink_hdfs_put(t):
    path = fresh_dir(t.spark, "sink_path")
    W.sink_path(t.orders, path)
    return t.spark.read.schema(t.orders.schema).parquet(path)


_TABLE_SQL = ", ".join(
    [
        '"Title" as title',
        """try_cast(replace(replace("Price", '$', ''), ',', '') as double) as price""",
        """try_cast(regexp_extract("Bedrooms", '^(\\d+)br', 1) as int) as "Bedrooms" """,
        """try_cast(try_cast("Square Feet" as double) as int) as square_feet""",
        '"Full Address" as full_address',
        *[f'"{n}"::boolean as "{S.RENAMES.get(n, n)}"' for n in S.RAW_FLAGS],
        """date_trunc('month', "date_added")::date as date_added""",
        'round("latitude", 6) as latitude, round("longitude", 6) as longitude',
        *[
            f"""round("{S.distance_column(x)}", 6) as "{S.distance_column(x)}", "{S.store_column(x)}" """
            for x in S.TIERS
        ],
    ]
)


def _priced(t):
    """Located listings ready to load, with one load a month."""
    month = F.trunc("date_added", "month")
    priced = t.located_listings.withColumns({"Price": money_parse(F.col("Price")), "date_added": month})
    return rename_map(priced)


def _rounded(df):
    places = ["latitude", "longitude", *[S.distance_column(x) for x in S.TIERS]]
    return df.withColumns({c: F.round(c, 6) for c in places})


@query(f"select {_TABLE_SQL} from {duck(LOCATED_LISTINGS)}")
def append_listings(t):
    """Two loads of the same days, the first one loaded twice: nothing is lost or doubled."""
    name = f"listings_{uuid.uuid4().hex}"
    W.create_listing_table(t.spark, name, fresh_dir(t.spark, "listing-table"))
    morning = F.col("id") % 3 == 0
    W.append_listings(_priced(t).filter(morning), name, "morning")
    W.append_listings(_priced(t).filter(~morning), name, "evening")
    W.append_listings(_priced(t).filter(morning), name, "morning")
    return _rounded(t.spark.table(name).drop("load_id"))


@query(f"""select date_added, count(*) as listings, count(price) as priced, sum(furnished::int)::bigint as furnished
    from (select {_TABLE_SQL} from {duck(LOCATED_LISTINGS)}) group by 1""")
def create_listing_table(t):
    name = f"listings_{uuid.uuid4().hex}"
    location = fresh_dir(t.spark, "listing-table")
    W.create_listing_table(t.spark, name, location)
    # Creating it again keeps the table that is there.
    W.create_listing_table(t.spark, name, location)
    W.append_listings(_priced(t), name, "all")
    return (
        t.spark.table(name)
        .groupBy("date_added")
        .agg(
            F.count("*").alias("listings"),
            F.count("price").alias("priced"),
            F.sum(F.col("furnished").cast("int")).alias("furnished"),
        )
    )
