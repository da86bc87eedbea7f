from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthline.operators import profile as P
from hearthline.operators import quantiles as Q

FRACTIONS = [0.0, 0.25, 0.333, 0.5, 0.75, 0.9, 1.0]


def frame(spark, **columns):
    rows = list(zip(*[[None if v is None else float(v) for v in values] for values in columns.values()], strict=True))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))


def check(df, **columns):
    got = {(r["column"], r["fraction"]): r["value"] for r in Q.exact_quantiles(df, list(columns), FRACTIONS).collect()}
    for name, values in columns.items():
        known = [v for v in values if v is not None and not np.isnan(v)]
        for fraction in FRACTIONS:
            expected = np.quantile(known, fraction) if known else None
            assert got[name, fraction] == (None if expected is None else pytest.approx(expected, rel=1e-12, abs=1e-12))


@pytest.fixture(params=["ranked at once", "one scan", "several scans", "halved"])
def path(request, monkeypatch):
    if request.param != "ranked at once":
        monkeypatch.setattr(Q, "RANKED_ROWS", 200 if request.param == "one scan" else 20)
        # A sketch this coarse never tightens a bracket.
        monkeypatch.setattr(Q, "ACCURACY", 1 if request.param == "halved" else 100)
        monkeypatch.setattr(Q, "SKETCH", 8 if request.param == "halved" else 64)
    return request.param


def test_many_shapes_at_once(spark, path):
    rng = np.random.default_rng(7)
    n = 3000
    columns = {
        "even": rng.uniform(size=n),
        "tail": np.exp(rng.normal(0, 4, n)),
        # A third of all rows hold one value.
        "hot": np.where(np.arange(n) % 3 == 0, 5.0, rng.uniform(0, 10, n)),
        "flag": rng.integers(0, 2, n).astype(float),
        "same": np.full(n, 3.0),
        "gaps": [None if i % 4 == 0 else float("nan") if i % 7 == 0 else float(i) for i in range(n)],
    }
    check(frame(spark, **columns), **columns)


def test_small_columns(spark, path):
    check(frame(spark, x=[1, 2, 3, 4], y=[1, None, None, 2]), x=[1.0, 2.0, 3.0, 4.0], y=[1.0, None, None, 2.0])
    check(frame(spark, x=[1], y=[None]), x=[1.0], y=[None])


def test_value_at_rank(spark, path):
    values = np.random.default_rng(8).permutation(2000).astype(float)
    df = frame(spark, x=values)
    for rank in (0, 1, 777, 1999):
        assert Q.value_at_rank(df, "x", rank).first()[0] == rank
    with pytest.raises(ValueError):
        Q.value_at_rank(df, "x", 2000)


def test_three_scans(spark, tmp_path):
    """Facts with a sketch, counts, ranking: the table is read three times."""
    path = str(tmp_path / "rows")
    spark.range(50_000).select((F.col("id") * 7919 % 50_021).cast("double").alias("x"), F.sqrt("id").alias("y")).write.parquet(path)
    spark.sparkContext.setJobGroup("scans", "scans")
    try:
        described = P.describe_numeric(spark.read.schema("x double, y double").parquet(path), ["x", "y"])
        eager = len(spark.sparkContext.statusTracker().getJobIdsForGroup("scans"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Two aggregates of one row; each runs its scan and its final step as jobs.
    assert eager <= 4 and described._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan") == 1
    want = np.quantile(np.arange(50_000) * 7919 % 50_021, [0.25, 0.5, 0.75])
    row = {r["column"]: r for r in described.collect()}["x"]
    assert [row["p25"], row["p50"], row["p75"]] == want.tolist()


def test_integer_columns(spark, path):
    df = spark.range(1001).select(F.col("id").cast("int").alias("x"))
    got = {r["fraction"]: r["value"] for r in Q.exact_quantiles(df, ["x"], [0.25, 0.5]).collect()}
    assert got == {0.25: 250.0, 0.5: 500.0}
