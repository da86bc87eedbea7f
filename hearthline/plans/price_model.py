"""Standardize, split, fit three regressors, compare."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from hearthline import schema as S
from hearthline.operators import model as M
from hearthline.operators.projection import feature_columns, feature_select


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    features: list[str]
    label: str


def prepare(
    df: DataFrame,
    key: str,
    label: str = "price",
    scaled: Sequence[str] = tuple(S.STANDARDIZED),
    fit_on_train: bool = False,
) -> Prepared:
    """z-scores, feature choice and the hash split.

    Rows without label or features cannot be fitted and are left out, as the
    second cleaning does. The scaler sees all rows unless ``fit_on_train``.
    """
    chosen = feature_select(df, label, keep=[key]).dropna()
    features = [c for c in feature_columns(chosen, label) if c != key]
    train_rows = M.train_test_split(chosen, key)[0] if fit_on_train else None
    ready = M.standardize(chosen, [c for c in scaled if c in features], fit_on=train_rows)
    train, test = M.train_test_split(ready, key)
    return Prepared(train, test, features, label)


def fit_all(data: Prepared) -> dict[str, PipelineModel]:
    estimators = {
        "linear": M.linear_regression(data.label),
        "random_forest": M.random_forest(data.label),
        "gradient_boosting": M.gradient_boosting(data.label),
    }
    return {name: M.fit(e, data.train, data.features) for name, e in estimators.items()}


def compare(data: Prepared, models: dict[str, PipelineModel]) -> DataFrame:
    return M.model_comparison({name: M.predict(m, data.test) for name, m in models.items()}, data.label)
