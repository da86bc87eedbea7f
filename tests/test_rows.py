from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.operators import attributes as A
from hearthline.operators import filters as Fi
from hearthline.operators import lookup as L
from hearthline.operators import model as M
from hearthline.operators import projection as P
from hearthline.operators import rows as R
from hearthline.plans.history import merge_history


def test_dedup_treats_nulls_and_nans_as_equal(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, None), (nan, None), (1.0, "a"), (1.0, None)], "x double, s string")
    assert R.dedup_rows(df).count() == 3
    assert R.has_duplicates(df).first()[0] is True
    assert R.has_duplicates(R.dedup_rows(df)).first()[0] is False


def test_last_fetch_of_a_url_wins(spark):
    rows = [(1, "u", "old"), (3, "u", "new"), (2, "u", "mid"), (5, "v", "only"), (3, "u", "new")]
    got = R.dedup_by_url(spark.createDataFrame(rows, S.PAGES)).orderBy("url").collect()
    assert [tuple(r) for r in got] == [(3, "u", "new"), (5, "v", "only")]


def test_history_with_schema_drift(spark):
    history = spark.createDataFrame(
        [("a", 1, 1, dt.date(2024, 5, 1))], "Title string, carport int, sauna int, date_added date"
    )
    today = spark.createDataFrame([(1, "b", 7)], "carport int, Title string, extra int")
    merged = merge_history(history, today, dt.date(2024, 5, 2), ordered=True)
    assert merged.columns == history.columns
    assert [tuple(r) for r in merged.collect()] == [
        ("a", 1, 1, dt.date(2024, 5, 1)),
        ("b", 1, 0, dt.date(2024, 5, 2)),
    ]
    assert P.schema_diff(history.columns, today.columns) == [
        ("date_added", "left"),
        ("extra", "right"),
        ("sauna", "left"),
    ]


def test_union_refuses_other_columns(spark):
    left = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(R.SchemaMismatch, match="c"):
        R.union_history(left, spark.createDataFrame([(1, 2)], "a int, c int"))
    with pytest.raises(R.SchemaMismatch, match="order"):
        R.union_history(left, left.select("b", "a"))


def test_dedup_by_url_keeps_rows_without_url_or_order(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", None, "z"), (None, 1, "p"), (None, 3, "q"), ("c", None, None), ("c", 0, None)]
    got = R.dedup_by_url(spark.createDataFrame(rows, "url string, page_id int, html string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", 2, "y"), ("b", None, "z"), (None, 3, "q"), ("c", 0, None)], key=str)


def test_split_places_every_row(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("key"), F.col("id"))
    for share in (0.125, 0.2, 0.001):
        train, test = M.train_test_split(df, "key", share)
        assert train.count() + test.count() == 20000
        held = test.filter("key is not null").count()
        assert abs(held - 18000 * share) < 4 * (18000 * share) ** 0.5


def test_null_flag_fails_the_cast(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "f double")
    assert P.cast_flags_int(df.filter("f is not null"), ["f"]).first()[0] == 1
    with pytest.raises(Exception, match="flag f is null"):
        P.cast_flags_int(df, ["f"]).collect()


def test_sentinel_filters_keep_nulls_and_complement(spark):
    df = spark.createDataFrame([(S.TITLE_MISSING,), ("home",), (None,)], "Title string")
    kept, rejected = Fi.drop_sentinel_title(df), Fi.rejected_titles(df)
    assert {r[0] for r in kept.collect()} == {"home", None}
    assert kept.count() + rejected.count() == df.count()
    places = spark.createDataFrame([(S.ADDRESS_MISSING,), (None,)], "full_address string")
    assert Fi.drop_unlisted_address(places).collect()[0][0] is None
    assert Fi.drop_unlisted_address(places, keep_unlisted=True).count() == 2


def test_attributes(spark):
    rows = [(1, ["a", "a", "$50 fee"]), (2, ["b", "35"]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "id int, attributes array<string>")
    counts = {r["attribute"]: r["count"] for r in A.attribute_counts(df).collect()}
    assert counts == {"a": 2, "b": 1, "$50 fee": 1, "35": 1}
    folded = {r["attribute"]: r["count"] for r in A.collapse_fee_group(A.attribute_counts(df)).collect()}
    assert folded == {"a": 2, "b": 1, S.FEE_ATTRIBUTE: 2}
    flagged = {r["id"]: (r["fee_needed"], r["attributes"]) for r in A.fee_flag_per_listing(df).collect()}
    assert flagged == {1: (1, ["a", "a"]), 2: (1, ["b"]), 3: (0, []), 4: (0, None)}
    hot = {r["id"]: (r["a"], r["b"]) for r in P.multi_hot_encode(df, "attributes", ["a", "b"]).collect()}
    assert hot == {1: (1, 0), 2: (0, 1), 3: (0, 0), 4: (0, 0)}


def test_vocabulary_joins(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "c")], "id int, attribute string")
    names = spark.createDataFrame([("a",), ("c",)], "attribute string")
    inside = A.vocab_semi_join(rows, names)
    assert sorted((r["id"], r["attribute"]) for r in inside.collect()) == [(1, "a"), (2, "a"), (3, "c")]
    assert [(r["id"], r["attribute"]) for r in A.vocab_anti_join(rows, names).collect()] == [(1, "b")]


def test_too_many_names_stop_the_job(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 4)], "attribute string, count bigint")
    with pytest.raises(ValueError, match="columns"):
        A.vocabulary(counts, 1)


def test_fee_row_is_there_without_fees(spark):
    df = spark.createDataFrame([(["a"],)], "attributes array<string>")
    folded = A.collapse_fee_group(A.attribute_counts(df))
    assert {r["attribute"]: r["count"] for r in folded.collect()} == {"a": 1, S.FEE_ATTRIBUTE: 0}


def test_geocode_never_multiplies_and_never_places_the_unlisted(spark):
    listings = spark.createDataFrame(
        [(i, a) for i, a in enumerate(["x", "x", "y", S.ADDRESS_MISSING, None, "x"])], "id int, full_address string"
    )
    known = spark.createDataFrame(
        [("x", 1.0, 2.0), ("x", 1.0, 2.0), (S.ADDRESS_MISSING, 9.0, 9.0), (None, 8.0, 8.0)], S.GEOCODE
    )
    got = {r["id"]: (r["latitude"], r["longitude"]) for r in L.geocode_lookup(listings, known).collect()}
    none = (None, None)
    assert got == {0: (1.0, 2.0), 1: (1.0, 2.0), 2: none, 3: none, 4: none, 5: (1.0, 2.0)}


def test_store_search(spark):
    places = spark.createDataFrame(
        [(1, "VONS Market", 34.03, -118.49), (2, "Vons and Erewhon", 34.02, -118.50), (3, "Vons", 35.0, -118.5)],
        "id int, name string, lat double, lng double",
    )
    got = sorted((r["id"], r["tier"], r["keyword"]) for r in L.store_search_radius(places).collect())
    assert got == [(1, "midTier", "Vons"), (2, "midTier", "Vons"), (2, "premium", "Erewhon")]


def test_store_tiers(spark):
    one = spark.createDataFrame([("s",)], "name string")
    got = R.union_store_tiers({"budget": one, "premium": one})
    assert sorted(tuple(r) for r in got.collect()) == [("s", "budget"), ("s", "premium")]


def test_ordering(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 3)], "k string, n int")
    assert [r["k"] for r in R.sort_desc(df, "n", ["k"]).collect()] == ["b", "c", "a"]
    assert [r["k"] for r in R.head_n(df, 2, "n", "k").collect()] == ["a", "b"]


def test_projections(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `b/c.d` int")
    assert P.reorder_columns(df, ["b/c.d"]).columns == ["b/c.d"]
    assert P.master_schema_project(df, ["z", "b/c.d"]).first().asDict() == {"z": 0, "b/c.d": 2}
    assert P.fill_missing_columns(df, ["a", "n"]).first()["n"] == 0
    assert P.add_ingest_date(df).select(F.col("date_added") == F.current_date()).first()[0]
    pair = P.tuple_assign(df, F.struct(F.lit(1).alias("x"), F.lit("s").alias("y")), ["p", "q"])
    assert pair.select("p", "q").first() == (1, "s")
    with pytest.raises(TypeError):
        P.tuple_assign(df, F.lit(1), ["p"])


def test_duplicates_are_found_by_hashes(spark):
    """Whole rows of unique hashes do not travel; odd values and maps are told apart."""
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 50).alias("wide"), (F.col("id") % 2 == 0).alias("flag"))
    assert R.has_duplicates(df).first()[0] is False
    assert R.has_duplicates(df.union(df.limit(1))).first()[0] is True
    assert R.has_duplicates(df.limit(0)).first()[0] is False
    nulls = spark.createDataFrame([(None, "a"), ("a", None), (None, None)], "a string, b string")
    assert R.has_duplicates(nulls).first()[0] is False
    assert R.has_duplicates(nulls.union(nulls)).first()[0] is True
    arrays = spark.createDataFrame([([1, 2],), ([1], ), ([1, 2],)], "a array<int>")
    assert R.has_duplicates(arrays).first()[0] is True


def test_hot_day_is_sorted_by_many_tasks(spark):
    """Nine rows of ten on one day, a third of those equal."""
    days = spark.range(20_000).select(F.expr("date '2024-01-01' + if(id % 10 = 0, cast(id % 7 as int), 3)").alias("date_added"), F.expr("if(id % 3 = 0, 0, id)").alias("n"))
    some = days.withColumn("date_added", F.when(F.col("n") % 101 != 1, F.col("date_added"))).repartition(8)
    ordered = R.sort_by_date(some)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
        got = [r[0] for r in ordered.select("date_added").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == sorted(got, key=lambda d: (d is None, d or 0)) and len(got) == 20_000
    assert max(sizes) < 0.3 * 20_000
