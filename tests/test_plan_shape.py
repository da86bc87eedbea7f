"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from hearthline import schema as S
from hearthline.operators import rows
from hearthline.plans.listing_pages import page_to_listing

# No shuffle at all: one projection or filter over the scan.
MAPS = """
html_text_field html_attributes page_to_listing multi_hot_encode cast_flags_int rename_map master_schema_project
drop_sentinel_title bbox_filter money_parse haversine_miles price_map_points store_search_radius train_test_split
""".split()
# One shuffle of combined rows.
GROUPED = ["attribute_counts", "value_counts", "dedup_rows", "nearest_argmin"]
JOINED = ["geocode_lookup", "dedup_by_url", "daily_listings", "nearest_store_wide", "nearest_store_refined"]


def plan(spark, small, name):
    frame = entry_module.queries()[name](spark, small)
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", MAPS)
def test_rows_never_move(spark, small, name):
    text = plan(spark, small, name)
    # Pages made from the tables are dealt to the cores before the operator runs.
    moved = [line for line in text.splitlines() if " Exchange " in line and "RoundRobin" not in line]
    assert not moved and text.count("RoundRobin") <= (name in ("html_attributes", "page_to_listing"))
    assert "Eval" not in text and "MapInPandas" not in text


@pytest.mark.parametrize("name", GROUPED)
def test_one_shuffle(spark, small, name):
    assert plan(spark, small, name).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", JOINED)
def test_no_cross_join(spark, small, name):
    text = plan(spark, small, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_columns_are_pruned_and_filters_pushed(spark, small):
    text = plan(spark, small, "page_ready_filter")
    assert "StringContains(html" in text
    lines = plan(spark, small, "describe_numeric")
    assert "l_orderkey" not in lines and "l_shipdate" not in lines


def test_page_text_is_never_shuffled(spark):
    pages = spark.createDataFrame([(1, "u", "<p></p>")], S.PAGES)
    listed = rows.dedup_by_url(page_to_listing(pages, keep=("url", "page_id")))
    text = listed._jdf.queryExecution().executedPlan().toString()
    above = text[: text.rindex("Exchange")]
    assert "Exchange" in text and "html" not in above
    partial = text[text.rindex("Exchange") :].splitlines()[1:]
    # What the shuffle is given holds extracted fields only.
    first = next(line for line in partial if "Aggregate" in line)
    assert "html#" not in first.split("output=")[-1]
