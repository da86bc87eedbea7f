from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from hearthline import schema as S
from hearthline.operators import distributions as D
from hearthline.operators import profile as P
from hearthline.plans.explore import laundry_gap


def frame(spark, columns, kind="double"):
    data = [[None if v is None else v for v in values] for values in columns.values()]
    return spark.createDataFrame(list(zip(*data, strict=True)), ", ".join(f"{c} {kind}" for c in columns))


def test_correlation_of_a_fixture_with_a_gap(spark):
    df = frame(spark, {"x": [1.0, 2.0, 3.0, 4.0], "y": [2.0, 4.5, None, 7.0], "k": [1.0] * 4})
    target = {r["feature"]: r["r"] for r in P.correlation_with_target(df, "x", ["y", "k"]).collect()}
    assert target["y"] == pytest.approx(0.981981, abs=1e-6)
    assert target["k"] is None
    matrix = {(r["x"], r["y"]): r["r"] for r in P.correlation_matrix(df, ["x", "y", "k"]).collect()}
    assert len(matrix) == 9
    assert matrix["x", "y"] == matrix["y", "x"] == pytest.approx(0.981981, abs=1e-6)
    assert matrix["x", "x"] == pytest.approx(1)
    assert matrix["k", "x"] is None and matrix["k", "k"] is None


def test_correlation_against_pandas(spark):
    rng = np.random.default_rng(11)
    base = rng.normal(size=400)
    data = pd.DataFrame(
        {
            "a": base,
            "b": 1e6 + 3 * base + rng.normal(size=400),
            "c": np.where(rng.uniform(size=400) < 0.3, np.nan, base**2),
            "d": rng.integers(0, 2, 400).astype(float),
            "e": np.full(400, 1e9 + 0.1),
        }
    )
    df = spark.createDataFrame(data).repartition(5)
    expected = data.corr()
    for row in P.correlation_matrix(df, list(data)).collect():
        r = expected.loc[row["x"], row["y"]]
        assert row["r"] == (None if np.isnan(r) else pytest.approx(r, abs=1e-9)), row


def test_describe(spark):
    df = frame(spark, {"x": [1.0, 2.0, 3.0, 4.0], "y": [float("nan"), None, 1.0, 1.0]})
    rows = {r["column"]: r for r in P.describe_numeric(df, ["x", "y"]).collect()}
    x = rows["x"]
    assert (x["count"], x["mean"], x["p25"], x["p50"], x["max"]) == (4, 2.5, 1.75, 2.5, 4.0)
    assert x["std"] == pytest.approx(1.290994, abs=1e-6)
    assert rows["y"]["count"] == 2
    moments = P.standardize_stats(df, ["x"]).first()
    assert moments["std"] == pytest.approx(1.118034, abs=1e-6)


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (2, None, "a"), (3, 1.0, "b")], "k int, x double, s string")
    assert {r["column"]: r["nulls"] for r in P.null_profile(df).collect()} == {"k": 0, "x": 2, "s": 1}


def test_value_counts_leave_out_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "s string")
    got = {r["value"]: r["count"] for r in P.value_counts(df, "s").collect()}
    assert got == {"a": 2, "b": 1}
    assert sum(got.values()) == 3


def test_flags(spark):
    df = frame(spark, {"p": [1, 0, 1], "q": [1, 1, 1]}, "int")
    odd = frame(spark, {"p": [1, 0, 1, 2, None], "q": [1, 1, 1, None, None]}, "int")
    rows = [(r["flag"], r["value"], r["label"], r["count"]) for r in P.flag_distribution(odd, ["p", "q"]).collect()]
    assert sorted(rows) == [("p", 0, "No", 1), ("p", 1, "Yes", 2), ("p", 2, None, 1), ("q", 1, "Yes", 3)]
    assert [tuple(r) for r in P.flag_cardinality(df, ["p", "q"]).collect()] == [("p", 2), ("q", 1)]


def test_listed(spark):
    df = spark.createDataFrame([(S.ADDRESS_MISSING,), ("1 Elm St",), (None,)], "full_address string")
    assert [tuple(r) for r in P.listed_vs_unlisted(df).collect()] == [("None Listed", 1), ("Listed", 2)]


def test_laundry_gap(spark):
    names = ["laundry_in_bldg", "laundry_on_site", "no_laundry_on_site", "washer_dryer_in_unit", "washer_dryer_hookups"]
    rows = [(1, 0, 0, 0, 0), (0, 1, 0, 1, 0), (0, 0, 1, 0, 0), (0, 0, 0, 1, 0), (0, 0, 0, 0, 1), (0, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names))
    got = {(r["flag"], r["value"]): r["count"] for r in laundry_gap(df).collect()}
    assert got == {
        ("washer_dryer_in_unit", 1): 1,
        ("washer_dryer_in_unit", 0): 2,
        ("washer_dryer_hookups", 1): 1,
        ("washer_dryer_hookups", 0): 1,
    }


@pytest.mark.parametrize("values", [list(range(101)), [0.0, 0.0, 10.0], [7.0] * 5, list(np.random.default_rng(3).normal(size=500))])
def test_histogram_against_numpy(spark, values):
    df = frame(spark, {"x": [float(v) for v in values] + [None]})
    rows = D.histogram_equal_width(df, "x", 10).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=10)
    assert [r["count"] for r in rows] == list(counts)
    assert [r["low"] for r in rows] == pytest.approx(list(edges[:-1]))
    assert rows[-1]["high"] == pytest.approx(edges[-1])


def test_box(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, None]
    df = frame(spark, {"x": values})
    box = D.box_stats(df, "x").first()
    q1, median, q3 = np.quantile(values[:-1], [0.25, 0.5, 0.75])
    assert (box["q1"], box["median"], box["q3"]) == (q1, median, q3)
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 5.0, 1)
    assert [r["x"] for r in D.box_outliers(df, "x").collect()] == [100.0]


def _kde(values, points, cut):
    h = len(values) ** -0.2 * np.std(values, ddof=1)
    grid = np.linspace(min(values) - cut * h, max(values) + cut * h, points)
    z = (grid[:, None] - np.asarray(values)[None, :]) / h
    return grid, np.exp(-0.5 * z * z).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))


def test_density(spark):
    rng = np.random.default_rng(5)
    values = [float(v) for v in np.round(np.concatenate([rng.normal(0, 1, 300), rng.normal(6, 2, 200)]), 2)]
    df = frame(spark, {"x": values + [None]})
    grid, expected = _kde(values, 100, 2.0)
    exact = D.kde_density(df, "x").orderBy("point").toPandas()
    assert np.allclose(exact["x"], grid) and np.allclose(exact["density"], expected, rtol=1e-9)
    binned = D.kde_density(df, "x", bins=2048).orderBy("point").toPandas()
    assert np.allclose(binned["density"], expected, rtol=1e-2, atol=expected.max() * 1e-4)
    # Almost all mass lies on the grid.
    assert np.trapezoid(expected, grid) == pytest.approx(1, abs=0.02)
