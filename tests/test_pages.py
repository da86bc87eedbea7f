"""The page table: fetches written once, the last one of each URL read."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from hearthline.operators.rows import dedup_by_url
from hearthline.session import fresh_dir
from hearthline.streaming.incremental import new_files
from hearthline.streaming.pages import append_pages, create_page_table, find_loads, latest_pages, load_pages

SCHEMA = "page_id long, url string, html string"


@pytest.fixture
def made(spark):
    names = []

    def make(location=None):
        names.append("pages_" + uuid.uuid4().hex)
        schema = spark.createDataFrame([], SCHEMA).schema
        create_page_table(spark, names[-1], schema, location or fresh_dir(spark, "pages"), buckets=4)
        return names[-1]

    yield make
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_last_fetch_of_each_url_over_loads(spark, made):
    table = made()
    first = [(1, "a", "old"), (2, "b", "b"), (None, "c", "no order"), (None, "d", "only"), (3, None, "none"), (4, None, "none later")]
    second = [(5, "a", "new"), (1, "b", "older than b"), (0, "c", "c"), (9, "e", None)]
    append_pages(spark.createDataFrame(first, SCHEMA), table, "one")
    append_pages(spark.createDataFrame(second, SCHEMA), table, "two")
    want = [(5, "a", "new"), (2, "b", "b"), (0, "c", "c"), (None, "d", "only"), (4, None, "none later"), (9, "e", None)]
    assert rows(latest_pages(spark, table)) == sorted(want, key=str)


def test_a_load_replaces_itself_alone(spark, made):
    table = made()
    append_pages(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SCHEMA), table, "one's")
    for html in ("first try", "second try"):
        append_pages(spark.createDataFrame([(7, "b", html)], SCHEMA), table, "two")
    assert rows(latest_pages(spark, table)) == [(1, "a", "x"), (7, "b", "second try")]
    assert spark.table(table).count() == 3
    # A load that has nothing any more leaves the others as they were.
    append_pages(spark.createDataFrame([], SCHEMA), table, "two")
    assert rows(latest_pages(spark, table)) == [(1, "a", "x"), (2, "b", "y")]


def test_equal_url_and_order_stay_once(spark, made):
    table = made()
    append_pages(spark.createDataFrame([(1, "a", "x")] * 50, SCHEMA).repartition(5), table, "one")
    append_pages(spark.createDataFrame([(1, "a", "x")] * 50, SCHEMA), table, "two")
    assert rows(latest_pages(spark, table)) == [(1, "a", "x")]
    assert latest_pages(spark, made()).collect() == []


def test_parts_longer_than_a_bitmap_and_a_hot_url(spark, made):
    """More rows in a task than one bitmap holds, a third of all under one URL."""
    table = made()
    pages = spark.range(0, 100_000, 1, 2).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 40_000)).alias("url"),
        F.col("id").cast("string").alias("html"),
    )
    append_pages(pages.where("page_id % 2 = 0"), table, "even")
    append_pages(pages.where("page_id % 2 = 1"), table, "odd")
    assert rows(latest_pages(spark, table)) == rows(dedup_by_url(pages))


def test_table_is_found_again_at_its_location(spark, made):
    location = fresh_dir(spark, "pages")
    append_pages(spark.createDataFrame([(1, "a", "x")], SCHEMA), made(location), "one")
    again = made(location)
    find_loads(spark, again)
    append_pages(spark.createDataFrame([(2, "a", "y")], SCHEMA), again, "two")
    assert spark.table(again).count() == 2 and rows(latest_pages(spark, again)) == [(2, "a", "y")]


def test_stream_restarts_where_it_stopped(spark, made):
    folder, state, table = fresh_dir(spark, "in"), fresh_dir(spark, "state"), made()
    for n in (1, 2):
        spark.createDataFrame([(n, "a", f"a{n}"), (n, f"u{n}", "u")], SCHEMA).write.mode("append").parquet(folder)
        load_pages(new_files(spark, folder, spark.table(table).drop("_part", "_place", "load_id").schema, "parquet"), table, state)
    assert spark.table(table).count() == 4
    assert rows(latest_pages(spark, table)) == [(1, "u1", "u"), (2, "a", "a2"), (2, "u2", "u")]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_any_overwrite_mode(spark, made, mode):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        table = made()
        for load in ("one", "two", "one"):
            append_pages(spark.createDataFrame([(1, load, "x")], SCHEMA), table, load)
        assert rows(latest_pages(spark, table)) == [(1, "one", "x"), (1, "two", "x")]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_no_exchange_holds_page_text(spark, small, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        frame = entry_module.queries()["incremental_pages"](spark, small)
        text = frame._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = re.findall(r"\(\d+\) (?:Exchange|BroadcastExchange|Sort)\nInput \[\d+\]: \[([^\]]*)\]", text)
    assert moved and not any("html" in columns for columns in moved), text
    assert "Bucketed: true" in text


def test_write_moves_no_row(spark, made, monkeypatch):
    table, plans, sql = made(), [], type(spark).sql

    def explained(session, text, *args, **named):
        if text.startswith("INSERT"):
            plans.append(sql(session, f"EXPLAIN {text}", *args, **named).first()[0])
        return sql(session, text, *args, **named)

    monkeypatch.setattr(type(spark), "sql", explained)
    append_pages(spark.range(100).selectExpr("id as page_id", "'u' as url", "'h' as html"), table, "one")
    assert len(plans) == 1 and "Insert" in plans[0] and "Exchange" not in plans[0], plans
    assert spark.table(table).count() == 100
