from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions import text as X
from hearthline.functions.html import html_housing_split
from hearthline.functions.numbers import round2
from hearthline.sources.readers import first_location, page_urls, places_from_json


def values(spark, inputs, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("x"))).collect()]


def test_money(spark):
    texts = ["$2,650", "$3295.00", S.PRICE_MISSING, None, "", "$1,234,567.89", "12d", " $7 "]
    assert values(spark, texts, X.money_parse) == [2650.0, 3295.0, None, None, None, 1234567.89, None, 7.0]


def test_square_feet(spark):
    texts = ["850", "850.0", "", S.SQUARE_FEET_MISSING, None, "99999999999"]
    assert values(spark, texts, X.square_feet_parse) == [850, 850, None, None, None, None]


def test_bedrooms(spark):
    assert values(spark, ["1br", "12br", S.BEDROOMS_MISSING, "br", None], X.bedrooms_parse) == [1, 12, None, None, None]


def test_counts_and_pages(spark):
    assert values(spark, ["2,400 postings", "7 postings", "none"], X.count_text_parse) == [2400, 7, None]
    assert values(spark, [0, 1, 120, 121, 2400], X.ceil_div_pages, "int") == [0, 1, 1, 2, 20]


def test_page_urls(spark):
    got = values(spark, [0, 2], lambda n: page_urls(n, "https://h/x#search=1"), "int")
    assert got == [[], ["https://h/x#search=1~list~0~0", "https://h/x#search=1~list~1~0"]]


def test_strip_removes_what_python_strips(spark):
    texts = ["\n a\t", "  a b  ", "\x1c\x1fa\x85", "", "   ", "a", None, "　x "]
    assert values(spark, texts, X.strip_ws) == [None if t is None else t.strip() for t in texts]


def test_split_index(spark):
    assert values(spark, ["a/b", "a", "a/b/c", None], lambda c: X.split_index(c, "/", 1)) == ["b", None, "b", None]
    assert values(spark, ["a.b|c"], lambda c: X.split_index(c, ".", 1)) == ["b|c"]


def test_housing(spark):
    both = (S.BEDROOMS_MISSING, S.SQUARE_FEET_MISSING)
    cases = {
        "/ 1br - 850ft2 -": ("1br", "850"),
        "/ 1br -": ("1br", ""),
        "/ 1br": both,
        "- 850ft2": both,
        "\n / 2br -\n 700ft2 - ": ("2br", "700"),
        "": both,
        None: both,
    }
    got = values(spark, list(cases), html_housing_split)
    assert [tuple(r) for r in got] == list(cases.values())


def test_fee_pattern(spark):
    texts = ["$50 app fee", "application fee 35 per person", "1br", "w/d in unit", "35", "a1 b2"]
    assert values(spark, texts, X.is_fee) == [True, True, False, False, True, False]


def test_labels(spark):
    assert values(spark, [1, 0, None], X.flag_label, "int") == ["Yes", "No", None]
    assert values(spark, [1, 0], X.flag_colour, "int") == ["green", "red"]
    assert values(spark, ["Shop", "Shop"], lambda c: X.concat_label(c, F.lit("1 Main St"))) == ["Shop - 1 Main St"] * 2
    assert values(spark, ["Shop"], lambda c: X.concat_label(c, F.lit(None))) == ["Shop - Address not provided"]


def test_date_and_rounding(spark):
    assert values(spark, [dt.date(2024, 5, 31)], X.format_date, "date") == ["2024-05-31"]
    numbers = [2.675, 0.125, -1.005, 3.0, 1.015, 1e9 / 3]
    assert values(spark, numbers, round2, "double") == list(np.round(numbers, 2))


def test_geocode_answers(spark):
    hit = '[{"geometry":{"location":{"lat":34.5,"lng":-118.25}}},{"geometry":{"location":{"lat":1,"lng":2}}}]'
    got = values(spark, [hit, "[]", None, "oops"], first_location)
    assert [tuple(r) for r in got] == [(34.5, -118.25), (None, None), (None, None), (None, None)]


def test_place_answers(spark):
    answer = (
        '{"results":[{"name":"A","vicinity":"1 St","geometry":{"location":{"lat":1.5,"lng":2.5}}},'
        '{"name":"B","geometry":{"location":{"lat":3,"lng":4}}}]}'
    )
    frame = spark.createDataFrame([(1, answer), (2, '{"results":[]}'), (3, None)], "k int, answer string")
    rows = [tuple(r) for r in places_from_json(frame, "answer").orderBy("name").collect()]
    assert rows == [(1, "A", "1 St", 1.5, 2.5), (1, "B", "Address not provided", 3.0, 4.0)]
