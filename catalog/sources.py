"""Scans, page addresses, literal frames and incremental pick-up."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.tables import RAW_LISTINGS, duck
from hearthline.functions.html import page_ready
from hearthline.functions.text import ceil_div_pages, count_text_parse
from hearthline.operators.filters import page_ready_filter
from hearthline.operators.projection import empty_frame, frame_from_rows
from hearthline.operators.rows import union_rows
from hearthline.session import fresh_dir
from hearthline.sources import readers as R
from hearthline.sources import writers as W
from hearthline.streaming.incremental import load_available, new_files
from hearthline.streaming.pages import create_page_table, latest_pages, load_pages

_CUSTOMERS = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query(
    """select c_custkey, c_name || ', "' || c_mktsegment || '", ' || chr(10) || 'x' as c_name, c_nationkey, c_acctbal,
    nullif(c_mktsegment, 'BUILDING') as c_mktsegment from customer"""
)
def scan_csv(t):
    # Commas, doubled quotes, line breaks and nulls have to survive the file.
    awkward = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('", \n'), F.lit("x"))
    path = fresh_dir(t.spark, "scan_csv")
    W.sink_csv_overwrite(
        t.customer.withColumns({"c_name": awkward, "c_mktsegment": F.nullif("c_mktsegment", F.lit("BUILDING"))}), path
    )
    return R.scan_csv(t.spark, path, _CUSTOMERS, multi_line=True)


@query(
    """select p_partkey::varchar as p_partkey, p_name, p_size::varchar as p_size,
    p_size * 2 as doubled from part"""
)
def scan_csv_strings(t):
    path = fresh_dir(t.spark, "scan_csv_strings")
    W.sink_csv_overwrite(t.part.select("p_partkey", "p_name", "p_size"), path)
    text = R.scan_csv_strings(t.spark, path, ["p_partkey", "p_name", "p_size"])
    return text.withColumn("doubled", F.col("p_size").cast("int") * 2)


@query("select o_orderkey, o_orderstatus, loaded from orders, (values ('baseline'), ('daily')) m(loaded)")
def choose_source(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    baseline, daily = fresh_dir(t.spark, "baseline"), fresh_dir(t.spark, "daily")
    W.sink_csv_overwrite(rows.withColumn("loaded", F.lit("baseline")), baseline)
    W.sink_csv_overwrite(rows.withColumn("loaded", F.lit("daily")), daily)
    schema = "o_orderkey bigint, o_orderstatus string, loaded string"
    one, other = (R.choose_source(t.spark, mode, baseline, daily, schema) for mode in R.MODES)
    return one.union(other)


@query('select url as "URL" from pages')
def scan_links(t):
    path = fresh_dir(t.spark, "links")
    W.sink_csv_overwrite(t.pages.select(F.col("url").alias("URL")), path)
    return R.scan_links(t.spark, path)


@query(
    """select o_orderpriority, 'https://example.org/' || o_orderpriority || '~list~' || n || '~0' as url
    from (select o_orderpriority, unnest(range(0, ceil(count(*) / 120)::int)) as n from orders group by 1)"""
)
def page_urls(t):
    counts = t.orders.groupBy("o_orderpriority").agg(
        F.concat(F.format_number(F.count("*"), 0), F.lit(" postings")).alias("text")
    )
    base = F.concat(F.lit("https://example.org/"), "o_orderpriority")
    urls = R.page_urls(ceil_div_pages(count_text_parse(F.col("text"))), base)
    return counts.select("o_orderpriority", F.explode(urls).alias("url"))


query(
    """select o_orderstatus, m.meaning, count(*) as orders from orders
    left join (values ('F', 'finished'), ('O', 'open')) m(status, meaning) on o_orderstatus = m.status group by all""",
    name="frame_from_rows",
)(
    lambda t: t.orders.join(
        frame_from_rows(t.spark, [("F", "finished"), ("O", "open")], "status string, meaning string"),
        F.col("o_orderstatus") == F.col("status"),
        "left",
    )
    .groupBy("o_orderstatus", "meaning")
    .agg(F.count("*").alias("orders"))
)


query(
    "select o_orderpriority, count(*) as orders from orders group by 1",
    name="empty_frame",
)(
    lambda t: union_rows(empty_frame(t.spark, "o_orderpriority string"), t.orders.select("o_orderpriority"))
    .groupBy("o_orderpriority")
    .agg(F.count("*").alias("orders"))
)


@query(f"""select "id", "Title", "Price", "Full Address", "date_added" from {duck(RAW_LISTINGS)}""")
def incremental_files(t):
    """Two runs over a growing folder; the second reads only what is new."""
    spark = t.spark
    folder, target, checkpoint = (fresh_dir(spark, f"incremental-{p}") for p in ("in", "out", "state"))
    rows = t.raw_listings.select("id", "Title", "Price", "Full Address", "date_added")
    stream_schema = rows.schema
    late = F.col("date_added") >= "1997-01-01"
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").options(**W.CSV_WRITE).csv(folder)
        load_available(new_files(spark, folder, stream_schema), target, checkpoint)
    return spark.read.parquet(target).drop("load_id")


@query("select page_id, url from pages where contains(html, '<div class=\"ad\"')", name="page_ready_filter")
def _page_ready_filter(t):
    return page_ready_filter(t.pages, '<div class="ad"').select("page_id", "url")


@query("select contains(html, 'cl-static-search-results') as ready, count(*) as pages from pages group by 1")
def page_ready_counts(t):
    return t.pages.groupBy(page_ready(F.col("html")).alias("ready")).agg(F.count("*").alias("pages"))



_SHARED = """case when page_id % 3 = 0 then 'https://hot.example.org/'
    else 'https://example.org/' || cast(page_id % 50 as string) end"""


@query(
    f"""select url, page_id, html from (select {_SHARED} as url, page_id, html,
      row_number() over (partition by {_SHARED} order by page_id desc) as rank from pages) where rank = 1"""
)
def incremental_pages(t):
    """Crawl batches as they arrive: one document per URL within and across batches."""
    spark = t.spark
    folder, target, checkpoint = (fresh_dir(spark, f"pages-{p}") for p in ("in", "out", "state"))
    pages = t.pages.select("page_id", F.expr(_SHARED).alias("url"), "html")
    name = "pages_" + uuid.uuid4().hex
    create_page_table(spark, name, pages.schema, target, buckets=8)
    later = F.col("page_id") % 2 == 1
    for part in (pages.filter(~later), pages.filter(later)):
        part.write.mode("append").parquet(folder)
        load_pages(new_files(spark, folder, pages.schema, file_format="parquet"), name, checkpoint)
    return latest_pages(spark, name)
