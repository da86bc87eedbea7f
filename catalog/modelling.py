"""Scaling, splitting, regressors and their read-outs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.aggregates import near
from catalog.registry import query
from catalog.tables import LISTINGS, duck
from hearthline import schema as S
from hearthline.operators import model as M
from hearthline.operators.profile import target_range
from hearthline.operators.projection import frame_from_rows
from hearthline.plans import price_model as Plan

_CLEAN = duck(LISTINGS)
_STATS = ", ".join(
    f'avg("{c}") as m{i}, case when stddev_pop("{c}") = 0 then 1 else stddev_pop("{c}") end as s{i}'
    for i, c in enumerate(S.STANDARDIZED)
)


@query(
    f"""with t as (select * from {_CLEAN}), f as (select {_STATS} from t)
    select "id", {", ".join(f'round(("{c}" - m{i}) / s{i}, 6) + 0.0::double as "{c}"' for i, c in enumerate(S.STANDARDIZED))}
    from t, f"""
)
def standardize(t):
    scaled = M.standardize(t.listings)
    return scaled.select("id", *[near(c, 6) for c in S.STANDARDIZED])


def _below(key: str, share: float) -> str:
    """Whether the hash of a key lies in the first part of its range."""
    return f"('0x' || substr(md5(coalesce(({key})::varchar, '')), 1, 13))::bigint::double < {share} * pow(16.0::double, 13)"


@query(f"select o_orderkey, case when {_below("nullif(o_orderkey % 50, 7)", 0.125)} then 'test' else 'train' end as part from orders")
def train_test_split(t):
    # Some rows without a key, and a share that is no whole percent.
    keyed = t.orders.select("o_orderkey", F.nullif(F.col("o_orderkey") % 50, F.lit(7)).alias("key"))
    train, test = (part.drop("key") for part in M.train_test_split(keyed, "key", 0.125))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    """select o_orderkey, case when row_number() over (order by substr(md5(o_orderkey::varchar), 1, 13))
    <= ceil(count(*) over () * 0.2) then 'test' else 'train' end as part from orders"""
)
def train_test_split_exact(t):
    train, test = M.train_test_split(t.orders.select("o_orderkey"), "o_orderkey", exact=True)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


# Line items: price by quantity and discount, split by a key of order and line.
_FEATURES = ["l_quantity", "l_discount"]
_KEYED = "select *, l_orderkey * 10 + l_linenumber as line_key from lineitem"
_TRAIN = f"select * from ({_KEYED}) where not ({_below('line_key', 0.2)})"
_TEST = f"select * from ({_KEYED}) where {_below('line_key', 0.2)}"
# Least squares for two features in closed form.
_OLS = f"""with train as ({_TRAIN}), test as ({_TEST}), m as (
    select covar_pop(l_extendedprice, l_quantity) as ya, covar_pop(l_extendedprice, l_discount) as yb,
    var_pop(l_quantity) as aa, var_pop(l_discount) as bb, covar_pop(l_quantity, l_discount) as ab,
    avg(l_extendedprice) as y0, avg(l_quantity) as a0, avg(l_discount) as b0 from train), c as (
    select (ya * bb - yb * ab) / (aa * bb - ab * ab) as ka, (yb * aa - ya * ab) / (aa * bb - ab * ab) as kb, * from m),
  k as (select ka, kb, y0 - ka * a0 - kb * b0 as k0 from c),
  p as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice as price,
    k0 + ka * l_quantity + kb * l_discount as prediction from test, k)"""


def _lines(t):
    keyed = t.lineitem.withColumn("line_key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    chosen = keyed.select(
        "line_key", "l_orderkey", "l_linenumber", "l_partkey", *_FEATURES, F.col("l_extendedprice").alias("price")
    )
    return M.train_test_split(chosen, "line_key")


def _linear(t):
    train, test = _lines(t)
    return M.fit(M.linear_regression(), train.select(*_FEATURES, "price"), _FEATURES), test


@query(_OLS + "select round(k0, 4) as intercept, round(ka, 4) as l_quantity, round(kb, 4) as l_discount from k")
def linear_regression(t):
    model, _ = _linear(t)
    fitted = model.stages[-1]
    values = (float(fitted.intercept), *[float(c) for c in fitted.coefficients])
    frame = frame_from_rows(t.spark, [values], "intercept double, l_quantity double, l_discount double")
    return frame.select(*[near(c, 4) for c in frame.columns])


@query(
    _OLS
    + """select 'l_quantity' as feature, round_even(ka, 2) as coefficient from k
    union all select 'l_discount', round_even(kb, 2) from k"""
)
def coefficient_table(t):
    model, test = _linear(t)
    return M.coefficient_table(model, _FEATURES, test)


@query(
    _OLS
    + """select * from (select 'l_quantity' as feature, round(ka, 4) as coefficient from k
    union all select 'l_discount', round(kb, 4) from k) order by 2 desc"""
)
def sorted_coefficients(t):
    model, test = _linear(t)
    return M.sorted_coefficients(model, _FEATURES, test).select("feature", near("coefficient", 4))


@query(_OLS + "select format('Price = {:.2f} + ({:.2f}) * l_quantity + ({:.2f}) * l_discount', k0, ka, kb) as equation from k")
def equation_string(t):
    model, _ = _linear(t)
    return frame_from_rows(t.spark, [(M.equation_string(model, _FEATURES),)], "equation string")


@query(_OLS + "select l_orderkey, l_linenumber, l_partkey, round(prediction, 4) as prediction from p")
def predict(t):
    model, test = _linear(t)
    return M.predict(model, test).select("l_orderkey", "l_linenumber", "l_partkey", near("prediction", 4))


@query(_OLS + "select l_orderkey, l_partkey, round(price - prediction, 4) + 0.0::double as residual from p")
def residual(t):
    model, test = _linear(t)
    scored = M.predict(model, test).withColumn("residual", M.residual())
    return scored.select("l_orderkey", "l_partkey", near("residual", 4))


@query(_OLS + "select round(prediction, 4) as prediction, round(price - prediction, 4) + 0.0::double as residual from p")
def residual_table(t):
    model, test = _linear(t)
    return M.residual_table(M.predict(model, test)).select(near("prediction", 4), near("residual", 4))


@query(_OLS + "select price as actual, round(prediction, 4) as predicted from p")
def actual_vs_predicted(t):
    model, test = _linear(t)
    return M.actual_vs_predicted(M.predict(model, test)).select("actual", near("predicted", 4))


@query(_OLS + "select min(price) as \"min\", max(price) as \"max\" from p")
def actual_range(t):
    """Ends of the diagonal in the actual-versus-predicted picture."""
    _, test = _lines(t)
    return target_range(test, "price")


_METRICS = """round(avg(abs(price - prediction)), 4) as mae, round(avg(pow(price - prediction, 2)), 2) as mse,
  round(sqrt(avg(pow(price - prediction, 2))), 4) as rmse,
  round(1 - sum(pow(price - prediction, 2)) / (var_pop(price) * count(*)), 8) as r2"""


@query(_OLS + f"select {_METRICS} from p")
def regression_metrics(t):
    model, test = _linear(t)
    metrics = M.regression_metrics(M.predict(model, test))
    return metrics.select(near("mae", 4), near("mse", 2), near("rmse", 4), near("r2", 8))


# All listings, with a price that follows two flags in steps and holds no noise.
# The right answers can then be told in SQL: trees that are grown until their
# leaves are pure predict every price exactly, a feature's importance is the
# share of the price's variance that it explains, first the flag that explains
# more, then the other one for what is left, and other features have none.
_FIRST, _SECOND = "washer_dryer_in_unit", "furnished"
_STEPS = {_FIRST: 800, _SECOND: 500}
_FEATURE_NAMES = [*map(S.distance_column, S.TIERS), "square_feet", *[f for f in S.FLAGS if f not in S.NOT_FEATURES]]
_PRICED = f"""(select "id", {" + ".join(f'{w} * "{f}"' for f, w in _STEPS.items())} + 1500.0::double as price, "{_FIRST}", "{_SECOND}"
  from {_CLEAN} where {" and ".join(f'"{f}" is not null' for f in _FEATURE_NAMES)})"""
_TRAIN_PART, _TEST_PART = (f"(select * from {_PRICED} where {'not ' * held}({_below('id', M.TEST_SHARE)}))" for held in (True, False))
_SHARES = f"""with train as (select * from {_TRAIN_PART}), means as (
    select "{_FIRST}", avg(price) as price, count(*) as n from train group by 1), whole as (
    select var_pop(price) as var, avg(price) as mean, count(*) as n from train), share as (
    select sum(m.n * pow(m.price - w.mean, 2)) / any_value(w.n * w.var) as first from means m, whole w)
  select f.feature, round(case f.feature when '{_FIRST}' then first when '{_SECOND}' then 1 - first else 0 end, {{digits}}) as importance
  from share, (select unnest({_FEATURE_NAMES}) as feature) f"""


def _prepared(t):
    price = sum((w * F.col(f) for f, w in _STEPS.items()), F.lit(1500.0))
    return Plan.prepare(t.listings.withColumn("price", price), "id")


def _scored(t, estimator):
    data = _prepared(t)
    model = M.fit(estimator, data.train, data.features)
    return data, model


_PREDICTED = f"select id, price, price as prediction from {_TEST_PART}"


def _predicted(t, estimator):
    data, model = _scored(t, estimator)
    return M.predict(model, data.test).select("id", near("price", 4), near("prediction", 4))


@query(_PREDICTED)
def random_forest(t):
    return _predicted(t, M.random_forest())


@query(_PREDICTED)
def gradient_boosting(t):
    return _predicted(t, M.gradient_boosting())


@query(_SHARES.format(digits=1))
def feature_importance(t):
    # Every tree has a sample of its own, so its shares are near the whole table's.
    data, model = _scored(t, M.random_forest())
    return M.feature_importance(model, data.features, data.test).select("feature", near("importance", 1))


@query(_SHARES.format(digits=6))
def feature_importance_boosting(t):
    data, model = _scored(t, M.gradient_boosting())
    return M.feature_importance(model, data.features, data.test).select("feature", near("importance", 6))


_PERFECT = ", ".join(f"0.0::double as {m}" for m in ("mae", "mse", "rmse"))


@query(
    f"""select unnest(['linear', 'random_forest', 'gradient_boosting']) as model, {_PERFECT},
    (select count(*) > 1 and var_pop(price) > 0 from {_TEST_PART})::int::double as r2"""
)
def model_comparison(t):
    # The price is a sum of flags, so least squares finds it too, as nearly as it converges.
    data = _prepared(t)
    compared = Plan.compare(data, Plan.fit_all(data))
    return compared.select("model", *[near(m, 2) for m in ("mae", "mse", "rmse")], near("r2", 5))
