"""Price models: preparation, three regressors, and what is read off them."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.numbers import round2
from hearthline.operators.projection import frame_from_rows, quoted
from hearthline.operators.quantiles import clean_number, value_at_rank
from hearthline.session import ensure_checkpoints

# Seed and hyper-parameters of the compared models.
SEED = 42
TREES = 100
BOOSTING_ROUNDS = 100
LEARNING_RATE = 0.1
BOOSTING_DEPTH = 3
TEST_SHARE = 0.2
#: Quantiles that a continuous feature may be split at.
BINS = 256
#: Rows that one task reads when trees are grown, about.
TASK_ROWS = 250_000


def standardize(df: DataFrame, columns: Sequence[str] = tuple(S.STANDARDIZED), fit_on: DataFrame | None = None) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes 0.

    The moments are fitted on the whole frame unless another one is given (the
    train part, to keep the test part out of them).
    """
    fitted = df if fit_on is None else fit_on
    moments = fitted.agg(
        *[F.avg(clean_number(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(clean_number(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).select(
        *[f"m{i}" for i, _ in enumerate(columns)],
        *[F.when(F.col(f"s{i}") == 0, 1.0).otherwise(F.col(f"s{i}")).alias(f"s{i}") for i, _ in enumerate(columns)],
    )
    return df.withColumns(
        {
            c: (quoted(c) - moments.select(f"m{i}").scalar()) / moments.select(f"s{i}").scalar()
            for i, c in enumerate(columns)
        }
    )


def _split_hash(key: Column) -> Column:
    """0 to 16**13 from a hash of the key, exact as a double and the same in every run.

    Rows without a key share one hash, so they stay together in one part.
    """
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double")


def train_test_split(
    df: DataFrame, key: str, test_share: float = TEST_SHARE, exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of a unique key; no shuffle, no random state.

    ``exact`` gives the test part ceil(share * n) rows: the hash of that rank
    is looked up, and rows below it are the test part.
    """
    if not exact:
        held_out = _split_hash(quoted(key)) < test_share * 16.0**13
        return df.filter(~held_out), df.filter(held_out)
    hashed = df.withColumn("_hash", _split_hash(quoted(key)))
    rows = hashed.count()
    size = -int(-test_share * rows // 1)
    if size >= rows or size == 0:
        return (df.limit(0), df) if size else (df, df.limit(0))
    # The first hash that is not part of the test rows.
    edge = value_at_rank(hashed, "_hash", size).scalar()
    held_out = F.col("_hash") < edge
    return hashed.filter(~held_out).drop("_hash"), hashed.filter(held_out).drop("_hash")


def _dealt(train: DataFrame) -> DataFrame:
    """The rows over all cores, in more tasks where there are many.

    How many splits a scan has says little: of a file of few row groups most
    splits hold no rows, and all work would be done by as many tasks.
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    return train.repartition(cores * max(1, math.ceil(train.count() / (TASK_ROWS * cores))))


def fit(estimator: Estimator, train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Assemble the features and fit.

    Least squares reads the train part once. Trees read it once per level or
    round, so for them it is dealt out evenly and kept in executor memory,
    spilling to disk; a lost copy is recomputed.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    pipeline = Pipeline(stages=[assembler, estimator])
    if isinstance(estimator, LinearRegression):
        return pipeline.fit(train)
    # Fitting cuts its lineage every few rounds if there is a folder for it.
    ensure_checkpoints(train.sparkSession)
    kept = _dealt(train).persist()
    try:
        return pipeline.fit(kept)
    finally:
        kept.unpersist()


def linear_regression(label: str = "price") -> LinearRegression:
    """Least squares with intercept by the normal equations, one pass."""
    return LinearRegression(labelCol=label, solver="normal", regParam=0.0, standardization=False)


def random_forest(
    label: str = "price", depth: int = 30, trees: int = TREES, bins: int = BINS
) -> RandomForestRegressor:
    """Forest over all features, grown until leaves are pure.

    30 is the deepest level that is allowed. A full-depth tree has about as
    many leaves as there are rows; on very large tables give a smaller depth.
    Continuous features are split at ``bins`` quantiles; the statistics that
    every level shuffles grow with it.
    """
    return RandomForestRegressor(
        labelCol=label,
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        minInstancesPerNode=1,
        featureSubsetStrategy="all",
        seed=SEED,
        # Each row remembers its node, so deep trees are not shipped to every task.
        cacheNodeIds=True,
    )


def gradient_boosting(label: str = "price", rounds: int = BOOSTING_ROUNDS) -> GBTRegressor:
    return GBTRegressor(
        labelCol=label, maxIter=rounds, stepSize=LEARNING_RATE, maxDepth=BOOSTING_DEPTH, lossType="squared", seed=SEED
    )


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features")


def residual(label: str = "price") -> Column:
    return F.col(label) - F.col("prediction")


def residual_table(scored: DataFrame, label: str = "price") -> DataFrame:
    return scored.select("prediction", residual(label).alias("residual"))


def actual_vs_predicted(scored: DataFrame, label: str = "price") -> DataFrame:
    return scored.select(F.col(label).alias("actual"), F.col("prediction").alias("predicted"))


def regression_metrics(scored: DataFrame, label: str = "price") -> DataFrame:
    """One row: mae, mse, rmse, r2, in one aggregate."""
    error = residual(label)
    sums = scored.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(label).alias("_variance"),
    )
    return sums.select(
        "mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.try_divide("mse", "_variance")).alias("r2")
    )


def model_comparison(scored: Mapping[str, DataFrame], label: str = "price") -> DataFrame:
    """The metrics of several models, one row each."""
    rows = [regression_metrics(frame, label).withColumn("model", F.lit(name)) for name, frame in scored.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out.select("model", "mae", "mse", "rmse", "r2")


def _named(df: DataFrame, features: Sequence[str], values, column: str) -> DataFrame:
    # A few dozen model parameters, already on the driver.
    rows = [(name, float(v)) for name, v in zip(features, values, strict=True)]
    return frame_from_rows(df.sparkSession, rows, f"feature string, {column} double")


def coefficient_table(model: PipelineModel, features: Sequence[str], like: DataFrame) -> DataFrame:
    """(feature, coefficient) rounded half-to-even to two places."""
    table = _named(like, features, model.stages[-1].coefficients, "coefficient")
    return table.select("feature", round2(F.col("coefficient")).alias("coefficient"))


def sorted_coefficients(model: PipelineModel, features: Sequence[str], like: DataFrame) -> DataFrame:
    return _named(like, features, model.stages[-1].coefficients, "coefficient").orderBy(F.desc("coefficient"), "feature")


def feature_importance(model: PipelineModel, features: Sequence[str], like: DataFrame) -> DataFrame:
    importances = model.stages[-1].featureImportances.toArray()
    return _named(like, features, importances, "importance").orderBy(F.desc("importance"), "feature")


def equation_string(model: PipelineModel, features: Sequence[str], target: str = "Price") -> str:
    fitted = model.stages[-1]
    terms = " ".join(f"+ ({c:.2f}) * {name}" for c, name in zip(fitted.coefficients, features, strict=True))
    return f"{target} = {fitted.intercept:.2f} {terms}"
