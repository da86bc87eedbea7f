"""Counting, profiling and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.tables import ATTRIBUTE_ROWS_SQL, ATTRIBUTE_TEXTS, FEE_SQL, FOLDED_COUNTS_SQL, LISTINGS, duck
from hearthline import schema as S
from hearthline.operators import attributes as A
from hearthline.operators import distributions as D
from hearthline.operators import profile as P
from hearthline.plans.explore import CORRELATED
from hearthline.plans.explore import laundry_gap as silent_laundry

_CLEAN = duck(LISTINGS)


def near(column, digits: int):
    """Rounded, with minus zero as zero."""
    return (F.round(column, digits) + F.lit(0.0)).alias(column)


@query(f"""select attribute, count(*) as "count" from ({ATTRIBUTE_ROWS_SQL}) group by 1""")
def attribute_counts(t):
    return A.attribute_counts(t.attribute_lists)


@query(FOLDED_COUNTS_SQL)
def collapse_fee_group(t):
    return A.collapse_fee_group(A.attribute_counts(t.attribute_lists))


@query(
    f"""select e.event_id, coalesce(bool_or({FEE_SQL}), false)::int as fee_needed,
    coalesce(string_agg(attribute, '|' order by attribute) filter (not {FEE_SQL}), '') as attributes
    from {duck(ATTRIBUTE_TEXTS)} e left join ({ATTRIBUTE_ROWS_SQL}) a on a.event_id = e.event_id group by 1"""
)
def fee_flag_per_listing(t):
    flagged = A.fee_flag_per_listing(t.attribute_lists)
    return flagged.select("event_id", "fee_needed", F.array_join(F.sort_array("attributes"), "|").alias("attributes"))


@query("""select l_returnflag as "value", count(*) as "count" from lineitem where l_returnflag is not null group by 1""")
def value_counts(t):
    return P.value_counts(t.lineitem, "l_returnflag")


@query(
    f"""select flag, "value", case "value" when 1 then 'Yes' else 'No' end as label, count(*) as "count"
    from (unpivot (select {", ".join(f'"{f}"' for f in S.FLAGS)} from {_CLEAN}) on * into name flag value "value")
    group by all"""
)
def flag_distribution(t):
    return P.flag_distribution(t.listings, S.FLAGS)


@query(
    f"""select flag, count(distinct "value") as distinct_values
    from (unpivot (select {", ".join(f'"{f}"' for f in S.FLAGS)} from {_CLEAN}) on * into name flag value "value")
    group by all"""
)
def flag_cardinality(t):
    return P.flag_cardinality(t.listings, S.FLAGS)


@query(
    f"""with c as (select count(*) filter ("full_address" = 'None listed') as hit, count(*) as n from {_CLEAN})
    select 'None Listed' as label, hit as "count" from c union all select 'Listed', n - hit from c"""
)
def listed_vs_unlisted(t):
    return P.listed_vs_unlisted(t.listings)


@query("select count(*) as rows from lineitem")
def row_count(t):
    return P.row_count(t.lineitem)


@query(
    " union all ".join(
        f"""select '{c}' as "column", count(*) - count("{c}") as nulls from {_CLEAN}"""
        for c in ["id", "title", "price", "Bedrooms", "square_feet", "full_address", *S.FLAGS, "date_added", "latitude", "longitude", *S.NEAREST_COLUMNS]
    )
)
def null_profile(t):
    return P.null_profile(t.listings)


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(source: str, columns: list[str]) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", count("{c}") as "count", round(avg("{c}"), 6) as mean,
        round(stddev_samp("{c}"), 6) as std, round(min("{c}"), 6) as "min",
        round(quantile_cont("{c}"::double, 0.25), 6) as p25, round(quantile_cont("{c}"::double, 0.5), 6) as p50,
        round(quantile_cont("{c}"::double, 0.75), 6) as p75, round(max("{c}")::double, 6) as "max" from {source}"""
        for c in columns
    )


_ROUNDED = [(c, 6) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]


@query(_describe_sql("lineitem", _MEASURES))
def describe_numeric(t):
    described = P.describe_numeric(t.lineitem, _MEASURES)
    return described.select("column", "count", *[near(c, d) for c, d in _ROUNDED])


_LISTING_MEASURES = ["price", "square_feet", "latitude", S.distance_column("budget")]


@query(_describe_sql(_CLEAN, _LISTING_MEASURES))
def describe_listings(t):
    """Columns with nulls."""
    described = P.describe_numeric(t.listings, _LISTING_MEASURES)
    return described.select("column", "count", *[near(c, d) for c, d in _ROUNDED])


def _r_sql(a: str, b: str) -> str:
    return f"""case when isnan(corr("{a}", "{b}")) then null else round(corr("{a}", "{b}"), 6) + 0.0::double end"""


_PAIRS = ", ".join(f"{{'x': '{a}', 'y': '{b}', 'r': {_r_sql(a, b)}}}" for a in CORRELATED for b in CORRELATED)


@query(f"select unnest([{_PAIRS}], recursive := true) from {_CLEAN}")
def correlation_matrix(t):
    return P.correlation_matrix(t.listings, CORRELATED).select("x", "y", near("r", 6))


_TARGET = ", ".join(f"{{'feature': '{f}', 'r': {_r_sql(f, 'price')}}}" for f in [*CORRELATED[1:], "house"])


@query(f"select unnest([{_TARGET}], recursive := true) from {_CLEAN}")
def correlation_with_target(t):
    # "house" is constant: its r is null, not an error.
    return P.correlation_with_target(t.listings, "price", [*CORRELATED[1:], "house"]).select("feature", near("r", 6))


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""with e as (select min("{column}") as a, (max("{column}") - min("{column}")) / {bins} as w from {source}),
    n as (select least(floor(("{column}" - a) / w), {bins - 1})::int as bin, count(*) as c
          from {source}, e where "{column}" is not null group by 1)
    select b.bin, round(a + b.bin * w, 6) as low, round(a + (b.bin + 1) * w, 6) as high, coalesce(c, 0) as "count"
    from (select unnest(range({bins}))::int as bin) b cross join e left join n on n.bin = b.bin"""


@query(_histogram_sql("orders", "o_totalprice", 10))
def histogram_equal_width(t):
    bins = D.histogram_equal_width(t.orders, "o_totalprice", 10)
    return bins.select("bin", near("low", 6), near("high", 6), "count")


@query(_histogram_sql("lineitem", "l_extendedprice", 30))
def histogram_30_bins(t):
    bins = D.histogram_equal_width(t.lineitem, "l_extendedprice", 30)
    return bins.select("bin", near("low", 6), near("high", 6), "count")


_BOX = """with q as (select quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median, quantile_cont(v, 0.75) as q3
  from events_v), f as (select *, q1 - 1.5::double * (q3 - q1) as lo, q3 + 1.5::double * (q3 - q1) as hi from q)"""
# Squared event values have a long tail, hence outliers.
_BOX_SOURCE = "with events_v as (select event_id, value * value as v from events), "


@query(
    _BOX_SOURCE
    + _BOX.removeprefix("with ")
    + """select round(any_value(q1), 6) as q1, round(any_value(median), 6) as median, round(any_value(q3), 6) as q3,
    round(least(min(v) filter (v between lo and hi), any_value(q1)), 6) as whisker_low,
    round(greatest(max(v) filter (v between lo and hi), any_value(q3)), 6) as whisker_high,
    count(*) filter (not v between lo and hi) as outliers from events_v, f"""
)
def box_stats(t):
    squared = t.events.select("event_id", (F.col("value") * F.col("value")).alias("v"))
    box = D.box_stats(squared, "v")
    return box.select(*[near(c, 6) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "outliers")


@query(
    _BOX_SOURCE + _BOX.removeprefix("with ") + "select event_id, round(v, 6) as v from events_v, f where v < lo or v > hi"
)
def box_outliers(t):
    squared = t.events.select("event_id", (F.col("value") * F.col("value")).alias("v"))
    return D.box_outliers(squared, "v").select("event_id", near("v", 6))


def _kde_sql(place: str) -> str:
    return f"""with f as (select count(o_totalprice) as n, min(o_totalprice) as a, max(o_totalprice) as b,
      stddev_samp(o_totalprice) * pow(count(o_totalprice), -0.2::double) as h from orders),
    w as (select {place} as place, count(*) as weight from orders, f group by 1),
    g as (select p::int as point, a - 2 * h + p * ((b + 2 * h - (a - 2 * h)) / 99) as x, n, h
          from f, (select unnest(range(100)) as p))
    select point, round(any_value(x), 4) as x,
    round(sum(weight * exp(-0.5::double * pow((x - place) / h, 2))) / any_value(n * h * sqrt(2 * pi())) * 1e6, 6) as density
    from g, w group by point"""


def _curve(density):
    return density.select("point", near("x", 4), (F.round(F.col("density") * 1e6, 6) + 0.0).alias("density"))


@query(_kde_sql("o_totalprice"))
def kde_density(t):
    return _curve(D.kde_density(t.orders, "o_totalprice"))


@query(_kde_sql("a + (least(floor((o_totalprice - a) / ((b - a) / 2048)), 2047) + 0.5::double) * ((b - a) / 2048)"))
def kde_density_binned(t):
    return _curve(D.kde_density(t.orders, "o_totalprice", bins=2048))


@query('select min(l_extendedprice) as "min", max(l_extendedprice) as "max" from lineitem')
def target_range(t):
    return P.target_range(t.lineitem, "l_extendedprice")


@query(
    " union all ".join(
        f"""select '{c}' as "column", round(avg("{c}"), 6) as mean, round(stddev_pop("{c}"), 6) as std from {_CLEAN}"""
        for c in S.STANDARDIZED
    )
)
def standardize_stats(t):
    return P.standardize_stats(t.listings, S.STANDARDIZED).select("column", near("mean", 6), near("std", 6))


_MERGED = '("laundry_in_bldg" | "laundry_on_site") = 0 and "no_laundry_on_site" = 0'


@query(
    f"""select 'washer_dryer_in_unit' as flag, "washer_dryer_in_unit" as "value",
      case "washer_dryer_in_unit" when 1 then 'Yes' else 'No' end as label, count(*) as "count"
    from {_CLEAN} where {_MERGED} group by all
    union all select 'washer_dryer_hookups', "washer_dryer_hookups",
      case "washer_dryer_hookups" when 1 then 'Yes' else 'No' end, count(*)
    from {_CLEAN} where {_MERGED} and "washer_dryer_in_unit" = 0 group by all"""
)
def laundry_gap(t):
    return silent_laundry(t.listings)
