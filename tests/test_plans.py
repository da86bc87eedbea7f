"""Whole jobs on small invented data, and the table they load."""

from __future__ import annotations

import datetime as dt
import uuid

import numpy as np
import pytest
from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.operators import model as M
from hearthline.operators.projection import feature_columns
from hearthline.plans import daily, price_model
from hearthline.session import fresh_dir
from hearthline.sources import readers as R
from hearthline.sources import writers as W
from hearthline.streaming.incremental import load_available, new_files

DAY = dt.date(2024, 5, 31)


def sample(spark):
    """96 raw listings: one full repeat, 7 unlisted, 7 without size, 3 both."""
    rows = []
    for i in range(95):
        flags = [int((i * (k + 3)) % (k % 5 + 2) == 0) for k, _ in enumerate(S.RAW_FLAGS)]
        rows.append(
            (
                f'Home "{i}", quiet',
                f"${1000 + 25 * i:,}" + (".00" if i % 40 == 0 else ""),
                "1br",
                None if i < 7 else str(500 + i),
                S.ADDRESS_MISSING if 4 <= i < 11 else f"{i} Elm St, LA",
                *flags,
                DAY,
            )
        )
    rows.append(rows[50])
    return spark.createDataFrame(rows, S.RAW_LISTING)


def stores(spark):
    rows = [(t, i, f"{t} shop", f"{i} Main St", 34.0 + i / 100, -118.4) for t in S.TIERS for i in range(3)]
    return spark.createDataFrame(rows, S.STORES)


def geocode(spark):
    rows = [(f"{i} Elm St, LA", 34.0 + i / 1000, -118.4) for i in range(95)]
    return spark.createDataFrame(rows, S.GEOCODE)


def located(spark):
    return daily.locate(sample(spark), geocode(spark), stores(spark))


def test_row_counts_of_both_cleanings(spark):
    cleaned = daily.clean(located(spark))
    assert cleaned.count() == 95
    assert daily.ready(cleaned).count() == 84
    assert daily.ready(cleaned, keep_unlisted=True).count() == 88


def test_cleaned_values(spark):
    cleaned = daily.clean(located(spark))
    unlisted = cleaned.filter(F.col("full_address") == S.ADDRESS_MISSING)
    assert unlisted.filter("latitude is not null or nearest_budget_grocery_store is not null").count() == 0
    row = cleaned.filter(F.col("title").startswith('Home "40"')).first()
    assert (row["price"], row["square_feet"]) == (2000.0, 540)
    assert row["nearest_budget_grocery_store"] == "budget shop - 2 Main St"


def test_csv_round_trip(spark):
    path = fresh_dir(spark, "csv")
    raw = sample(spark).withColumn("Title", F.concat(F.lit(" \t"), "Title", F.lit('"",\n"x" ')))
    W.sink_csv_overwrite(raw, path)
    back = R.scan_csv(spark, path, S.RAW_LISTING, multi_line=True)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, raw.collect()), key=repr)
    text = R.scan_csv_strings(spark, path, S.MASTER_COLUMNS, multi_line=True)
    assert text.filter(F.col("date_added") != "2024-05-31").count() == 0


def test_source_and_target_follow_the_mode(spark):
    paths = {m: fresh_dir(spark, m) for m in R.MODES}
    for mode in R.MODES:
        W.sink_routed(spark.createDataFrame([(mode,)], "m string"), mode, paths)
    for mode in R.MODES:
        got = R.choose_source(spark, mode, paths["baseline"], paths["daily"], "m string")
        assert [r["m"] for r in got.collect()] == [mode]
    with pytest.raises(ValueError):
        R.choose_source(spark, "weekly", "a", "b", "m string")


def test_a_rerun_leaves_the_same_table(spark):
    table = f"t_{uuid.uuid4().hex}"
    W.create_listing_table(spark, table, fresh_dir(spark, "table"))
    ready = daily.ready(daily.clean(located(spark)), keep_unlisted=True)
    W.append_listings(ready, table, "one")
    W.append_listings(ready, table, "one")
    loaded = spark.table(table)
    assert loaded.count() == 88
    assert sorted(loaded.columns) == sorted([*(f.name for f in S.LISTING_TABLE.fields), "load_id"])
    assert dict(loaded.dtypes)["furnished"] == "boolean"
    assert {r["Bedrooms"] for r in loaded.select("Bedrooms").distinct().collect()} == {1}
    # The same load with another day: the day that it no longer has is gone.
    W.append_listings(ready.withColumn("date_added", F.lit(dt.date(2024, 6, 1))), table, "one")
    assert [r[0] for r in spark.table(table).select("date_added").distinct().collect()] == [dt.date(2024, 6, 1)]
    assert spark.table(table).count() == 88
    # Another load of a day adds to it.
    W.append_listings(ready.limit(5), table, "two")
    assert spark.table(table).count() == 93
    spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("mode", ["STATIC", "DYNAMIC"])
def test_loads_keep_each_other_in_any_session(spark, mode):
    """Two loads of the same days, reruns, and names with odd characters."""
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        table = f"listings_{mode.lower()}"
        W.create_listing_table(spark, table, fresh_dir(spark, "table"))
        ready = daily.ready(daily.clean(located(spark)), keep_unlisted=True)
        days = [dt.date(2024, 6, d) for d in (1, 2, 3)]
        three = ready.limit(30).withColumn("date_added", F.lit(days)[F.pmod(F.xxhash64("title"), F.lit(3)).cast("int")]).cache()
        at = {d: three.filter(F.col("date_added") == d).count() for d in days}

        def counts():
            return {(r["load_id"], r["date_added"]): r["count"] for r in spark.table(table).groupBy("load_id", "date_added").count().collect()}

        odd = "it's \\ 50% a/b=c"
        W.append_listings(three, table, "morning")
        W.append_listings(three, table, odd)
        W.append_listings(three, table, "morning")
        both = {(name, d): n for name in ("morning", odd) for d, n in at.items() if n}
        assert counts() == both
        W.append_listings(three.filter(F.col("date_added") == days[0]), table, "morning")
        assert counts() == {k: n for k, n in both.items() if k[0] == odd or k[1] == days[0]}
        W.append_listings(three.limit(0), table, "morning")
        assert counts() == {k: n for k, n in both.items() if k[0] == odd}
        spark.sql(f"DROP TABLE {table}")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_table_load_names_missing_columns(spark):
    with pytest.raises(ValueError, match="price"):
        W.to_listing_table(spark.createDataFrame([("a",)], "title string"))


def test_text_flags_load_as_booleans(spark):
    ready = daily.ready(daily.clean(located(spark)))
    text = ready.select(*[F.col(c).cast("string").alias(c) for c in ready.columns])
    left = W.to_listing_table(text).orderBy("title").collect()
    right = W.to_listing_table(ready).orderBy("title").collect()
    assert left == right


def test_second_run_reads_only_new_files(spark):
    folder, target, state = (fresh_dir(spark, n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], "url string, n int").schema
    for n in (1, 2):
        rows = [(f"u{i}", n) for i in range(3)] * 2
        spark.createDataFrame(rows, schema).write.mode("append").option("header", True).csv(folder)
        query = load_available(
            new_files(spark, folder, schema), target, state, prepare=lambda df: df.dropDuplicates(["url"])
        )
        assert sum(p["numInputRows"] for p in query.recentProgress) == 6
    load_available(new_files(spark, folder, schema), target, state)
    got = sorted((r["url"], r["n"], r["load_id"].rsplit("-", 1)[1]) for r in spark.read.parquet(target).collect())
    assert got == [(f"u{i}", n, str(n - 1)) for i in range(3) for n in (1, 2)]
    # A new checkpoint counts from zero again and leaves the first load alone.
    load_available(new_files(spark, folder, schema), target, fresh_dir(spark, "state"))
    assert spark.read.parquet(target).count() == 18


def _linear(spark, n=400):
    rng = np.random.default_rng(9)
    a, b = rng.uniform(0, 10, n), rng.uniform(-5, 5, n)
    rows = [(i, float(x), float(y), float(3 * x + 2 * y + 1)) for i, (x, y) in enumerate(zip(a, b, strict=True))]
    return spark.createDataFrame(rows, "id long, a double, b double, price double")


def test_linear_model_recovers_its_coefficients(spark):
    train, test = M.train_test_split(_linear(spark), "id")
    model = M.fit(M.linear_regression(), train, ["a", "b"])
    assert list(model.stages[-1].coefficients) == pytest.approx([3, 2], abs=1e-9)
    assert model.stages[-1].intercept == pytest.approx(1, abs=1e-9)
    assert M.equation_string(model, ["a", "b"]) == "Price = 1.00 + (3.00) * a + (2.00) * b"
    table = [(r["feature"], r["coefficient"]) for r in M.coefficient_table(model, ["a", "b"], test).collect()]
    assert table == [("a", 3.0), ("b", 2.0)]
    assert [r["feature"] for r in M.sorted_coefficients(model, ["a", "b"], test).collect()] == ["a", "b"]
    metrics = M.regression_metrics(M.predict(model, test)).first()
    assert metrics["rmse"] == pytest.approx(0, abs=1e-8) and metrics["r2"] == pytest.approx(1)


def test_constant_feature_does_not_break_the_fit(spark):
    df = _linear(spark).withColumn("k", F.lit(1.0))
    model = M.fit(M.linear_regression(), df, ["a", "b", "k"])
    assert list(model.stages[-1].coefficients)[:2] == pytest.approx([3, 2], abs=1e-6)


def test_split_parts_are_disjoint_complete_and_stable(spark):
    df = _linear(spark)
    for exact in (False, True):
        train, test = M.train_test_split(df, "id", exact=exact)
        left, right = ({r["id"] for r in part.collect()} for part in (train, test))
        assert not left & right and len(left | right) == 400
        again = M.train_test_split(df.repartition(7), "id", exact=exact)[1]
        assert {r["id"] for r in again.collect()} == right
        if exact:
            assert len(right) == 80
    assert M.train_test_split(df.limit(7), "id", exact=True)[1].count() == 2


def test_standardized_moments(spark):
    df = _linear(spark).withColumn("k", F.lit(4.0))
    scaled = M.standardize(df, ["a", "k"])
    row = scaled.agg(F.avg("a"), F.stddev_pop("a"), F.max("k"), F.min("k")).first()
    assert tuple(row) == (pytest.approx(0, abs=1e-12), pytest.approx(1), 0.0, 0.0)
    train, _ = M.train_test_split(df, "id")
    fitted = M.standardize(train, ["a"], fit_on=train)
    assert fitted.agg(F.avg("a")).first()[0] == pytest.approx(0, abs=1e-12)


def test_trees_beat_the_mean(spark):
    train, test = M.train_test_split(_linear(spark), "id")
    scored = {}
    for name, estimator in {
        "random_forest": M.random_forest(trees=10, depth=8),
        "gradient_boosting": M.gradient_boosting(rounds=20),
    }.items():
        model = M.fit(estimator, train, ["a", "b"])
        scored[name] = M.predict(model, test)
        importances = M.feature_importance(model, ["a", "b"], test).collect()
        assert sum(r["importance"] for r in importances) == pytest.approx(1)
        assert importances[0]["feature"] == "a"
    for row in M.model_comparison(scored).collect():
        assert row["r2"] > 0.8, row
    residuals = M.residual_table(scored["random_forest"]).count()
    assert residuals == M.actual_vs_predicted(scored["random_forest"]).count() == test.count()


def test_model_parameters():
    forest, boosted = M.random_forest(), M.gradient_boosting()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (100, 30, 42)
    assert forest.getFeatureSubsetStrategy() == "all"
    assert (boosted.getMaxIter(), boosted.getStepSize(), boosted.getMaxDepth()) == (100, 0.1, 3)


def test_prepared_features(spark):
    listings = daily.ready(daily.clean(located(spark))).withColumn("id", F.xxhash64("title"))
    assert len([c for c in feature_columns(listings) if c != "id"]) == 23
    data = price_model.prepare(listings, "id")
    assert len(data.features) == 23 and "date_added" not in data.features
    assert data.train.count() + data.test.count() == 84
    on_train = price_model.prepare(listings, "id", fit_on_train=True)
    assert on_train.train.agg(F.avg("square_feet")).first()[0] == pytest.approx(0, abs=1e-9)


class _Seen(Estimator):
    """Notes how many rows each partition has that it is fitted on."""

    def _fit(self, dataset):
        self.rows = [r["count"] for r in dataset.groupBy(F.spark_partition_id()).count().collect()]
        return VectorAssembler(inputCols=["features"], outputCol="same")


def test_trees_are_fitted_by_all_cores(spark, monkeypatch):
    seen, train = _Seen(), spark.range(4000).coalesce(1).select(F.col("id").cast("double").alias("x"))
    M.fit(seen, train, ["x"])
    assert sum(seen.rows) == 4000 and len(seen.rows) == 8 and max(seen.rows) < 1000
    monkeypatch.setattr(M, "TASK_ROWS", 200)
    M.fit(seen, train, ["x"])
    assert sum(seen.rows) == 4000 and len(seen.rows) == 24
