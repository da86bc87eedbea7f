"""The data behind histograms, box plots and density curves."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.operators.quantiles import clean_number, exact_quantiles


def _one(row: DataFrame, column: str) -> Column:
    """A one-row result as a scalar, so no join is needed to use it."""
    return row.select(column).scalar()


def histogram_equal_width(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(bin, low, high, count) over [min, max]; the last bin is closed.

    Empty bins are present. If all values are equal the range is widened by a
    half on both sides, so one bin holds everything.
    """
    value = clean_number(column)
    ends = df.agg(F.min(value).alias("a"), F.max(value).alias("b")).select(
        F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("low"),
        F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("high"),
    )
    low, width = _one(ends, "low"), (_one(ends, "high") - _one(ends, "low")) / bins
    index = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.filter(value.isNotNull()).groupBy(index.alias("bin")).agg(F.count("*").alias("count"))
    frame = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (low + F.col("id") * width).alias("low"),
        (low + (F.col("id") + 1) * width).alias("high"),
    )
    # Without values there is no range, hence no bins.
    return (
        frame.filter(F.col("low").isNotNull())
        .join(counts, "bin", "left")
        .select("bin", "low", "high", F.coalesce("count", F.lit(0)).alias("count"))
    )


def _quartiles(df: DataFrame, column: str) -> DataFrame:
    def at(fraction: float) -> Column:
        return F.max(F.when(F.col("fraction") == fraction, F.col("value")))

    return exact_quantiles(df, [column], [0.25, 0.5, 0.75]).agg(
        at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3")
    )


def box_stats(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers clipped to data inside the fences, outlier count."""
    quartiles = _quartiles(df, column)
    value = clean_number(column)
    q1, median, q3 = (_one(quartiles, c) for c in ("q1", "median", "q3"))
    low_fence, high_fence = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
    fenced = df.select(
        value.alias("value"), value.between(low_fence, high_fence).alias("inside")
    ).agg(
        F.min(F.when(F.col("inside"), F.col("value"))).alias("least"),
        F.max(F.when(F.col("inside"), F.col("value"))).alias("most"),
        F.count_if(~F.col("inside")).alias("outliers"),
    )
    # A whisker never ends inside the box.
    return fenced.select(
        q1.alias("q1"),
        median.alias("median"),
        q3.alias("q3"),
        F.least("least", q1).alias("whisker_low"),
        F.greatest("most", q3).alias("whisker_high"),
        "outliers",
    )


def box_outliers(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """The rows beyond the fences."""
    quartiles = _quartiles(df, column)
    q1, q3 = _one(quartiles, "q1"), _one(quartiles, "q3")
    value = clean_number(column)
    return df.filter((value < q1 - reach * (q3 - q1)) | (value > q3 + reach * (q3 - q1)))


def kde_density(
    df: DataFrame, column: str, points: int = 100, cut: float = 2.0, bins: int | None = None
) -> DataFrame:
    """(point, x, density): Gaussian kernel density on an even grid.

    Bandwidth by Scott's rule, the grid reaching ``cut`` bandwidths beyond the
    data. Every task adds the kernels of its rows up at each grid point, so it
    ships one number a point however many rows it read. With ``bins`` the
    values are first counted in that many equal-width bins and the bins weigh
    in at their centres: the cost is then fixed whatever the size of the table,
    at a relative error of about (bin width / bandwidth) squared / 24.
    """
    value = clean_number(column)
    facts = df.agg(
        F.count(value).alias("n"), F.min(value).alias("a"), F.max(value).alias("b"), F.stddev_samp(value).alias("std")
    ).select("n", "a", "b", (F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"))
    known = df.filter(value.isNotNull())
    if bins is None:
        weighted = known.select(value.alias("place"), F.lit(1.0).alias("weight"))
    else:
        a, b = _one(facts, "a"), _one(facts, "b")
        width = (b - a) / bins
        place = a + (F.least(F.floor((value - a) / width), F.lit(bins - 1)) + 0.5) * width
        weighted = known.groupBy(place.alias("place")).agg(F.count("*").cast("double").alias("weight"))
    n, low, high, h = facts.first()
    if not n or not h:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    start = low - cut * h
    step = ((high + cut * h) - start) / (points - 1)
    grid = start + np.arange(points) * step

    def kernels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(points)
        for batch in batches:
            places, weights = batch["place"].to_numpy(), batch["weight"].to_numpy()
            for at in range(0, len(places), 1024):
                z = (grid[:, None] - places[None, at : at + 1024]) / h
                sums += np.exp(-0.5 * z * z) @ weights[at : at + 1024]
        yield pd.DataFrame({"point": np.arange(points, dtype="int32"), "x": grid, "total": sums})

    folded = weighted.mapInPandas(kernels, "point int, x double, total double")
    return folded.groupBy("point", "x").agg((F.sum("total") / F.lit(n * h * math.sqrt(2 * math.pi))).alias("density"))
