from __future__ import annotations

import datetime as dt
import html as stdlib_html
import html.entities
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions import html as H
from hearthline.operators.attributes import vocabulary
from hearthline.plans.listing_pages import (
    cleaned_counts,
    extract_fields,
    page_to_listing,
    page_to_listing_by_vocabulary,
)

PAGE = """<html><head><script>document.write('<span class="price">$9</span>')</script>
<style>.price{{}}</style></head><body><!-- <span class="price">$8</span> -->
<span class="postingtitletext"><span class='x price big'>{price}</span>
<span class="housing">/ 1br - <b>850</b>ft<sup>2</sup> - </span>
<span class="z" id="titletextonly">Sunny <span>nested <span>deep</span></span> &amp; quiet&#x21;</span></span>
<h2 class="street-address">\n 12 Elm&nbsp;St, <i>LA</i> </h2>
<div class="attrgroup"><div class="attr important"><span class="valu"> cats are OK - purrr\n</span></div>
<div class="attr"><span class="labl">fee</span><span class="valu"><a href="#">$45 app fee</a></span></div>
<div class="attr">nothing</div><div class="attribute"><span class="valu">not an attr</span></div>
<div class="attr"><span class="valu">furnished</span></div><div class="attr"><span class="valu">furnished</span></div>
</div></body></html>"""


def frame(spark, *pages):
    rows = [(i, f"https://x/{i}", page) for i, page in enumerate(pages)]
    return spark.createDataFrame(rows, S.PAGES)


def test_fields_of_a_full_page(spark):
    row = extract_fields(frame(spark, PAGE.format(price="$2,650"))).first()
    assert row["Title"] == "Sunny nested deep & quiet!"
    assert row["Price"] == "$2,650"
    assert (row["Bedrooms"], row["Square Feet"]) == ("1br", "850")
    assert row["Full Address"] == "12 Elm St, LA"
    assert row["attributes"] == ["cats are OK - purrr", "$45 app fee", "furnished", "furnished"]


def test_absent_and_empty_fields(spark):
    rows = extract_fields(frame(spark, "<p>gone</p>", '<span class="price"> </span><span id="titletextonly"></span>'))
    gone, empty = rows.orderBy("page_id").collect()
    assert [gone[c] for c in S.BASIC_COLUMNS] == [
        S.TITLE_MISSING,
        S.PRICE_MISSING,
        S.BEDROOMS_MISSING,
        S.SQUARE_FEET_MISSING,
        S.ADDRESS_MISSING,
    ]
    assert gone["attributes"] == []
    assert (empty["Title"], empty["Price"]) == ("", "")


def test_class_is_matched_as_a_token(spark):
    pages = frame(spark, '<span class="prices">a</span><span class="price-x">b</span><span class=price>c</span>')
    got = pages.select(H.html_text_field(F.col("html"), "span", ("class", "price"), "none")).first()[0]
    assert got == "c"


def test_listing_row(spark):
    pages = frame(spark, PAGE.format(price="$1"), "<p></p>")
    full, bare = page_to_listing(pages, day=dt.date(2024, 5, 31)).orderBy(F.desc("Price")).collect()[::-1]
    assert full.__fields__ == S.MASTER_COLUMNS
    assert full["cats are OK - purrr"] == full["furnished"] == full[S.FEE_ATTRIBUTE] == 1
    assert sum(full[f] for f in S.RAW_FLAGS) == 3
    assert sum(bare[f] for f in S.RAW_FLAGS) == 0
    assert full["date_added"] == dt.date(2024, 5, 31)


def test_vocabulary_from_the_data(spark):
    pages = frame(spark, *[PAGE.format(price=f"${i}") for i in range(2)], "<p></p>")
    counts = cleaned_counts(extract_fields(pages))
    got = {r["attribute"]: r["count"] for r in counts.collect()}
    assert got == {"cats are OK - purrr": 2, "furnished": 4, S.FEE_ATTRIBUTE: 2}
    assert vocabulary(counts, 10, at_least=3) == ["furnished"]
    listing = page_to_listing_by_vocabulary(pages, 10)
    assert listing.columns == S.BASIC_COLUMNS + ["furnished", S.FEE_ATTRIBUTE, "date_added"]


def test_entities_match_the_standard_library(spark):
    texts = [
        "a &amp; b", "&lt;p&gt;", "&amp;lt;", "caf&eacute;", "&#233;&#xE9;", "&nbsp;", "&copy 1", "&amp", "&am", "&unknown;",
        "& &", "&#128512;", "R&D", "&quot;&#39;", "x&&amp;y", "", "&euro;5",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [r[0] for r in rows.select(H.unescape(F.col("t"))).collect()]
    assert got == [stdlib_html.unescape(t) for t in texts]


def test_every_standard_reference(spark):
    names = [*html.entities.html5]
    texts = [f"a&{name} b" for name in names] + [f"&{name}x1;" for name in names if not name.endswith(";")]
    texts += [f"&#{n};" for n in (*range(0, 256), 0xD800, 0xFDD0, 0xFFFE, 0x1FFFF, 0x10FFFF, 0x110000, 10**12)]
    texts += [f"&#x{n:x}" for n in range(120, 170)] + ["&#x0000000041;", "&#00065", "&notit;", "&apos;", "&dollar;", "&#;", "&#x;", "&"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(8)
    got = {r["i"]: r["u"] for r in rows.select("i", H.unescape(F.col("t")).alias("u")).collect()}
    wrong = [(t, got[i]) for i, t in enumerate(texts) if got[i] != stdlib_html.unescape(t)]
    assert wrong == []


def test_any_depth(spark):
    for depth in (0, 3, 4, 12, 60):
        inner = "".join(f"{k}<span>" for k in range(depth)) + "x" + "</span>" * depth
        block = "<div>" * depth + '<span class="valu">cats</span>' + "</div>" * depth
        page = f'<span id="titletextonly">A{inner}Z</span><div class="attr">{block}</div><div class="attr"><span class="valu">dogs</span></div>'
        row = extract_fields(frame(spark, page)).first()
        assert row["Title"] == "A" + "".join(map(str, range(depth))) + "xZ"
        assert row["attributes"] == ["cats", "dogs"]
        links = "<li>" + "<li>" * depth + '<a href="/deep">l</a>' + "</li>" * depth + '<a href="/after">m</a></li><a href="/out">n</a>'
        got = frame(spark, links).select(H.html_result_links(F.col("html"), ("li", None))).first()[0]
        assert got == ["/deep", "/after"]


def test_counter_takes_its_own_child(spark):
    bars = {
        "<span><div>wrong</div></span><div>10 postings</div>": "10 postings",
        "<br><img src=x><div>a <div>b</div> c</div><div>no</div>": "a b c",
        "<p>text</p>": S.POSTINGS_COUNT_MISSING,
    }
    pages = frame(spark, *[f'<div class="cl-count-save-bar">{bar}</div><div>after</div>' for bar in bars], "<div>none</div>")
    got = [r[0] for r in pages.orderBy("page_id").select(H.html_postings_count(F.col("html"))).collect()]
    assert got == [*bars.values(), S.POSTINGS_COUNT_MISSING]


class _Reference(HTMLParser):
    """Plain reading of a page: first h1 text and the links in list items."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.heading, self.links, self.inside, self.items = None, [], False, 0

    def handle_starttag(self, tag, attrs):
        if tag == "h1" and self.heading is None:
            self.heading, self.inside = "", True
        if tag == "li":
            self.items += 1
        if tag == "a" and self.items:
            self.links.append(dict(attrs).get("href"))

    def handle_endtag(self, tag):
        if tag == "h1":
            self.inside = False
        if tag == "li":
            self.items -= 1

    def handle_data(self, data):
        if self.inside:
            self.heading += data


def test_raw_pages_against_a_parser(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    page = H.visible(F.col("html"))
    got = pages.select(
        "html",
        H.html_text_field(page, "h1", None, "none").alias("heading"),
        H.html_result_links(page, ("li", None)).alias("links"),
    ).collect()
    assert len(got) > 0
    for row in got:
        reference = _Reference()
        reference.feed(row["html"])
        assert row["heading"] == (reference.heading or "none").strip()
        assert row["links"] == reference.links


def test_postings_count(spark):
    pages = frame(spark, '<div class="cl-count-save-bar"><b>x</b><div>1,234 postings</div><div>no</div></div>', "<div>1</div>")
    got = [r[0] for r in pages.orderBy("page_id").select(H.html_postings_count(F.col("html"))).collect()]
    assert got == ["1,234 postings", S.POSTINGS_COUNT_MISSING]


def test_long_page_does_not_overflow(spark):
    body = "<p>word <b>bold</b> &amp; more</p>" * 20_000
    page = f'<div class="attr">{body}<span class="valu">deep</span></div><span class="price">$5</span>'
    row = extract_fields(frame(spark, page)).first()
    assert row["attributes"] == ["deep"]
    assert row["Price"] == "$5"


def _random_pages(n):
    pick = random.Random(3).choice
    tags = ['<span class="price">', "<SPAN class='x valu'>", '<div class="attr">', "<div class=attr\n>", '<span id="titletextonly">', "<span>"]
    tags += ["<div>", "</span>", "</Span >", "</div>", "</div>", "<spanx>", "</spanx>", "<b>", "<", "<span", '<div class="attr', "</span/", ">"]
    return ["".join(pick(tags) if k % 3 else pick("ab& ") for k in range(pick((2, 9, 40)))) for _ in range(n)]


def test_patterns_find_what_the_token_table_holds(spark):
    pages = frame(spark, *_random_pages(1500), "", None)
    single = (("span", ("class", "price")), ("span", ("id", "titletextonly")), ("div", None))
    pair = (("div", ("class", "attr")), ("span", ("class", "valu")))
    table = H.Tokens(F.col("t"), (*single, *pair))
    by_table = F.concat(F.array(*[H.html_element(table, *s) for s in single]), H.html_attribute_elements(table, *pair))
    cut = pages.select("html", H.tokens(F.col("html"), *single, *pair).alias("t"))
    rows = cut.select("html", by_table.alias("a"), H._elements(F.col("html"), single, pair).alias("b")).collect()
    assert [r["html"] for r in rows if r["a"] != r["b"]] == []
    assert sum(len(r["a"] or []) > len(single) for r in rows) > 100


def test_listing_pages_need_no_token_table(spark):
    # A token table costs several times as much as the patterns; only deep nesting ends a match with a bracket.
    pages = frame(spark, PAGE.format(price="$1"))
    at = (("span", ("id", "titletextonly")), ("span", ("class", "housing")), ("div", ("class", "attrgroup")), ("div", ("class", "attr")))
    found = pages.select(*[F.regexp_extract("html", H._whole(s), 0) for s in at]).first()
    assert all(found) and not any(text.endswith("<") for text in found)
    assert found[0].endswith(" &amp; quiet&#x21;")
