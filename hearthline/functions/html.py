"""Reading fields out of page HTML with built-in expressions.

A page is cut once into a token table: the pieces between ``<`` characters and
the tag name that each piece begins with. All selectors read that table, so
elements may be nested to any depth and further fields cost little. Fields of
pages whose elements are hardly nested are found by one pattern each, without
the table. The work stays in the JVM and a page's text is not copied to a worker.
"""

from __future__ import annotations

import html.entities
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.text import split_index, strip_ws

_HIDDEN = r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>)"
_REFERENCE = r"^(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?"

# The standard's character references as a hash table: a name lies in the bucket
# of its checksum, as mark, name, mark, characters, mark. Names that are also
# accepted without the closing semicolon are in it both ways. Numbers 128 to 159
# stand for the characters that Windows-1252 has there.
_BEFORE, _AFTER, _BUCKET = "\x01", "\x02", "\x03"
_BUCKETS = 4096


def _replaced_numbers() -> dict[str, str]:
    """Numbers that do not stand for their own character, and the ones written most."""
    found = {f"#{n};": chr(n) for n in (*range(32, 127), *range(160, 256))}
    nothing = (*range(1, 9), 11, *range(14, 32), 127, *range(0xFDD0, 0xFDF0))
    nothing += tuple(plane << 16 | last for plane in range(17) for last in (0xFFFE, 0xFFFF))
    found |= {f"#{n}": "" for n in nothing} | {"#0": "\ufffd", "#13": "\r"}
    for n in range(128, 160):
        text = bytes([n]).decode("cp1252", "ignore")
        found[f"#{n}"] = text or chr(n)
    return found


def _table() -> str:
    buckets = [""] * _BUCKETS
    for name, text in (html.entities.html5 | _replaced_numbers()).items():
        place = zlib.crc32(name.encode()) % _BUCKETS
        buckets[place] = f"{buckets[place] or _BEFORE}{name}{_AFTER}{text}{_BEFORE}"
    return _BUCKET.join(buckets)


_TABLE = _table()
_SHORT = max(len(name) for name in html.entities.html5 if not name.endswith(";"))


def visible(page: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(page, _HIDDEN, "")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed one time however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _look_up(name: str) -> str:
    """SQL: the characters of a reference's name, null if there is no such name."""
    bucket = f"get(bound.names, cast(pmod(crc32(cast({name} as binary)), {_BUCKETS}) as int))"
    key = f"concat('{_BEFORE}', {name}, '{_AFTER}')"
    return f"if(contains({bucket}, {key}), split_part(split_part({bucket}, {key}, 2), '{_BEFORE}', 1), null)"


def _decoder() -> str:
    """SQL lambda from a struct of the table and some texts to the decoded texts.

    Written as SQL because it is large and always the same: the parser makes
    the expression at once, where a column call for each part takes seconds.
    """
    # More digits than the last character has: out of range all the same.
    hexa = "conv(substring(ltrim('0', substring(name, 3)), 1, 12), 16, 10)"
    decimal = "conv(substring(ltrim('0', substring(name, 2)), 1, 12), 10, 10)"
    number = f"coalesce(cast(if(lower(name) like '#x%', {hexa}, {decimal}) as bigint), 0)"
    character = f"""coalesce({_look_up("concat('#', cast(number as string))")},
        if(number > 1114111 or number between 55296 and 57343, '\ufffd', decode(unhex(lpad(conv(number, 10, 16), 8, '0')), 'UTF-32')))"""
    # The longest beginning that is a name, and the rest as it is.
    beginnings = f"""filter(transform(sequence({_SHORT}, 2, -1), n -> if(length(name) > n,
        concat({_look_up("substring(name, 1, n)")}, substring(name, n + 1)), null)), found -> found is not null)"""
    known = f"""coalesce({_look_up("name")},
        case when name = '' then null when name like '#%' then get(transform(array({number}), number -> {character}), 0)
             else get({beginnings}, 0) end)"""
    piece = f"""get(transform(array(regexp_extract(after, r'{_REFERENCE}', 0)), name ->
        concat(coalesce({known}, concat('&', name)), substring(after, length(name) + 1))), 0)"""
    joined = f"array_join(transform(split(text, '&'), (after, place) -> if(place = 0, after, {piece})), '')"
    return f"bound -> transform(bound.texts, text -> if(contains(text, '&'), {joined}, text))"


_DECODER = _decoder()


def unescape_all(texts: Column) -> Column:
    """Replace character references in an array of texts; texts without one are left untouched."""
    # The table is one literal of the plan, bound once for all texts.
    bound = F.struct(F.split(F.lit(_TABLE), _BUCKET).alias("names"), texts.alias("texts"))
    return F.get(F.call_function("transform", F.array(bound), F.expr(_DECODER)), F.lit(0))


def unescape(text: Column) -> Column:
    """Replace character references in one text."""
    return F.get(unescape_all(F.array(text)), F.lit(0))


def plain_texts(elements: Column) -> Column:
    """Elements of a visible page to text: tags dropped, references decoded."""
    return unescape_all(F.transform(elements, lambda element: F.regexp_replace(element, r"<[^>]*+>", "")))


def _attribute(name: str, value: str) -> str:
    """An attribute that equals the value, or for a class holds it as a token."""
    wanted = re.escape(value)
    if name == "class":
        inner = rf"(?:[^\"'<>]*\s)?{wanted}(?:\s[^\"'<>]*)?"
    else:
        inner = wanted
    return rf"\s{name}\s*=\s*(?:\"{inner}\"|'{inner}'|{wanted}(?=[\s>]))"


#: Elements without content and end tag; fixed values.
_VOID = "area base br col embed hr img input link meta param source track wbr".split()
#: Tags that are looked at first for the end of an element.
_NEAR = 16


#: A tag name, and an attribute that has a value (a class: holds it) or None.
Selector = tuple[str, tuple[str, str] | None]


@dataclass(frozen=True)
class Tokens:
    """A page as the pieces that begin at ``<``, and the tag name of each piece.

    Names are in small letters, of end tags with a slash in front; the text
    before the first tag has an empty name. ``marks`` holds a number for each
    start tag that one of the selectors wants: its place, and a bit for each
    selector, from one pass over the names for all of them.
    """

    column: Column
    selectors: tuple[Selector, ...]

    @property
    def pieces(self) -> Column:
        return self.column["pieces"]

    @property
    def names(self) -> Column:
        return self.column["names"]

    def element(self, span: Column) -> Column:
        return F.concat(F.lit("<"), F.array_join(F.slice(self.pieces, span["first"] + 1, span["length"]), "<"))

    def starts(self, selector: Selector) -> Column:
        """Places of the start tags of such elements."""
        bit = 1 << self.selectors.index(selector)
        held = F.filter(self.column["marks"], lambda mark: mark.bitwiseAND(F.lit(bit).cast("long")) != 0)
        return F.transform(held, lambda mark: F.shiftright(mark, len(self.selectors)).cast("int"))


def _opening(attribute: tuple[str, str] | None) -> str:
    """A piece after its ``<``: a start tag that is closed and has the attribute."""
    return r"(?is)^[^>]*+>" if attribute is None else rf"(?is)^[^>]*?{_attribute(*attribute)}[^>]*+>"


def tokens(page: Column, *selectors: Selector) -> Column:
    """The token table of a visible page; keep it as a column to read several fields from it."""

    def named(pieces: Column) -> Column:
        names = F.transform(
            pieces, lambda piece, k: F.when(k == 0, "").otherwise(F.lower(F.regexp_extract(piece, r"^/?[A-Za-z][^\s/>]*", 0)))
        )
        return F.struct(pieces.alias("pieces"), names.alias("names"))

    def marked(table: Column) -> Column:
        def mark(name: Column, k: Column) -> Column:
            piece, found = F.get(table["pieces"], k), None
            for tag in dict.fromkeys(tag for tag, _ in selectors):
                bits = F.shiftleft(k.cast("long"), len(selectors))
                for place, (wanted, attribute) in enumerate(selectors):
                    if wanted == tag:
                        # Most tags are told by the plain text, without the pattern.
                        held = F.contains(piece, F.lit(attribute[1] if attribute else ">"))
                        bits = bits + F.when(held & piece.rlike(_opening(attribute)), 1 << place).otherwise(0)
                found = F.when(name == tag, bits) if found is None else found.when(name == tag, bits)
            return found

        any_bit = F.lit((1 << len(selectors)) - 1).cast("long")
        marks = F.filter(F.transform(table["names"], mark), lambda m: m.bitwiseAND(any_bit) != 0)
        return F.struct(table["pieces"].alias("pieces"), table["names"].alias("names"), marks.alias("marks"))

    cut = _once(F.split(page, "<"), named)
    return F.when(page.isNotNull(), _once(cut, marked) if selectors else cut)


def _read(page: Column | Tokens, selectors: tuple[Selector, ...], use: Callable[[Tokens], Column]) -> Column:
    if isinstance(page, Tokens):
        return use(page)
    return _once(tokens(page, *selectors), lambda column: use(Tokens(column, selectors)))


def _length(names: Column, tag: str, first: Column) -> Column:
    """Pieces of the element that starts at a place, without its end tag.

    The next end tag of the name closes it where no such element begins before
    that; else start tags count up and end tags count down. An element that is
    not closed reaches to the end.
    """

    def folded(rest: Column) -> Column:
        start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("length"))

        def step(state: Column, name: Column) -> Column:
            depth = state["depth"] + F.when(name == tag, 1).when(name == f"/{tag}", -1).otherwise(0)
            inside = state["depth"] > 0
            return F.struct(
                F.when(inside, depth).otherwise(0).alias("depth"), (state["length"] + inside.cast("int")).alias("length")
            )

        return F.aggregate(rest, start, step, lambda state: state["length"] + (state["depth"] > 0).cast("int"))

    def near(rest: Column) -> Column:
        def ends(closes: Column) -> Column:
            opens = F.array_contains(F.slice(rest, 1, F.greatest(closes - 1, F.lit(0)).cast("int")), tag)
            return F.when((closes > 0) & ~opens, closes.cast("int")).otherwise(folded(F.slice(names, first + 2, F.size(names))))

        return _once(F.array_position(rest, f"/{tag}"), ends)

    return _once(F.slice(names, first + 2, F.lit(_NEAR)), near)


def _span(t: Tokens, tag: str, first: Column) -> Column:
    return F.struct(first.alias("first"), _length(t.names, tag, first).alias("length"))


def _outermost(spans: Column) -> Column:
    """Spans in page order without those that lie inside another one."""

    def after(one: Column, other: Column) -> Column:
        return other["first"] >= one["first"] + one["length"]

    def chosen(found: Column) -> Column:
        nested = F.exists(F.transform(found, lambda span, k: (k > 0) & ~after(F.get(found, k - 1), span)), lambda inner: inner)
        none = F.slice(found, 1, 0)
        outer = F.aggregate(
            found, none, lambda kept, span: F.when((F.size(kept) == 0) | after(F.get(kept, F.size(kept) - 1), span), F.concat(kept, F.array(span))).otherwise(kept)
        )
        return F.when(nested, outer).otherwise(found)

    return _once(spans, chosen)


def _spans(t: Tokens, selector: Selector) -> Column:
    return _outermost(F.transform(t.starts(selector), lambda first: _span(t, selector[0], first)))


def html_elements(page: Column | Tokens, tag: str, attribute: tuple[str, str] | None = None) -> Column:
    """All such elements, outermost and in page order, without their end tag."""
    wanted = (tag, attribute)
    return _read(page, (wanted,), lambda t: F.transform(_spans(t, wanted), t.element))


def html_element(page: Column | Tokens, tag: str, attribute: tuple[str, str] | None = None) -> Column:
    """The first such element with its start tag, null when the page has none."""

    def found(t: Tokens) -> Column:
        start = F.get(t.starts((tag, attribute)), F.lit(0))
        return _once(start, lambda first: F.when(first.isNotNull(), t.element(_span(t, tag, first))))

    return _read(page, ((tag, attribute),), found)


def html_child(element: Column, tag: str) -> Column:
    """The first element of the name that lies directly in the given one."""

    def child(t: Tokens) -> Column:
        # Depth inside the element, whose own start tag is piece 1.
        start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("place"), F.lit(-1).alias("first"))

        def step(state: Column, name: Column) -> Column:
            change = F.when((name == "") | F.ltrim(name, F.lit("/")).isin(_VOID), 0).when(name.startswith("/"), -1).otherwise(1)
            direct = (state["first"] < 0) & (state["depth"] == 0) & (name == tag)
            return F.struct(
                F.greatest(state["depth"] + change, F.lit(0)).alias("depth"),
                (state["place"] + 1).alias("place"),
                F.when(direct, state["place"] + 2).otherwise(state["first"]).alias("first"),
            )

        inner = F.slice(t.names, 3, F.greatest(F.size(t.names) - 2, F.lit(0)))
        place = F.aggregate(inner, start, step, lambda state: F.when(state["first"] >= 0, state["first"]))
        return _once(place, lambda first: F.when(first.isNotNull(), t.element(_span(t, tag, first))))

    return _read(element, (), child)


#: The end of a tag's name: white space, a slash, ``>``, the next tag or the page's end.
_NAME_END = r"(?![^\s/><])"
#: Elements of one name inside each other that the pattern of a whole element follows.
_DEEP = 2


def _whole(selector: Selector) -> str:
    """An element with its start tag, up to its end tag or the page's end.

    Where elements of its name are nested deeper than the pattern follows, or
    are not closed, it stops behind the ``<`` of such a start tag.
    """
    tag, attribute = selector
    start, end = rf"<{tag}{_NAME_END}", rf"</{tag}{_NAME_END}"
    other = rf"[^<]*+(?:<(?!/?{tag}{_NAME_END})[^<]*+)*+"
    inside = other
    for _ in range(_DEEP):
        inside = rf"{other}(?:{start}{inside}{end}{other})*+"
    if attribute is None:
        opening = rf"{start}[^<>]*+>"
    else:
        opening = rf"<(?={tag}{_NAME_END})(?=[^<]*(?-i:{re.escape(attribute[1])}))[^<>]*?{_attribute(*attribute)}[^<>]*+>"
    return rf"(?is){opening}{inside}(?:<(?={tag}{_NAME_END}))?"


def _elements(page: Column, single: tuple[Selector, ...], pair: tuple[Selector, Selector] | None = None) -> Column:
    """The first element of each selector, null where there is none, and the pair's ``html_attribute_elements``, as an array.

    One pattern finds a whole element where few of its name are nested; only a
    page with deeper ones is cut into a token table.
    """
    selectors = single + (pair or ())

    def by_tokens(t: Tokens) -> Column:
        first = F.array(*[html_element(t, *selector) for selector in single])
        return F.concat(first, html_attribute_elements(t, *pair)) if pair else first

    def deep(element: Column) -> Column:
        # Also said of text that happens to end so, which costs time only.
        return element.endswith("<")

    def chosen(page: Column, found: Column) -> Column:
        known = F.transform(found, lambda element: F.when(element != "", element))
        return F.when(F.exists(found, deep), _read(page, selectors, by_tokens)).otherwise(known)

    def read(page: Column) -> Column:
        first = F.array(*[F.regexp_extract(page, _whole(selector), 0) for selector in single])
        if pair is None:
            return _once(first, lambda found: chosen(page, found))

        def inner_of(element: Column) -> Column:
            return F.when(deep(element), element).otherwise(F.regexp_extract(element, _whole(pair[1]), 0))

        outer = F.regexp_extract_all(page, F.lit(_whole(pair[0])), F.lit(0))
        inner = F.filter(F.transform(outer, inner_of), lambda element: element != "")
        return _once(F.concat(first, inner), lambda found: chosen(page, found))

    if pair and pair[0][0] == pair[1][0]:
        # The pattern of the inner one would find the outer one.
        return _read(page, selectors, by_tokens)
    return _once(page, read)


def html_fields(page: Column, single: tuple[Selector, ...], outer: Selector, inner: Selector) -> Column:
    """Texts of ``html_texts`` for the single selectors, followed by the unstripped ones of ``html_attributes``."""
    return plain_texts(_elements(page, single, (outer, inner)))


def html_texts(page: Column | Tokens, *selectors: Selector) -> Column:
    """Unstripped text of the first element of each selector, as an array; null where a page has none.

    All texts are decoded together, so ask for all fields of a page at once.
    """
    if not isinstance(page, Tokens):
        return plain_texts(_elements(page, selectors))
    return plain_texts(F.array(*[html_element(page, *selector) for selector in selectors]))


def html_text(page: Column | Tokens, tag: str, attribute: tuple[str, str] | None = None) -> Column:
    """Unstripped text of the first such element of a visible page, else null."""
    return F.get(html_texts(page, (tag, attribute)), F.lit(0))


def text_or(text: Column, sentinel: str) -> Column:
    """A field's text without white space at its ends, or the sentinel."""
    return F.coalesce(strip_ws(text), F.lit(sentinel))


def html_text_field(page: Column | Tokens, tag: str, attribute: tuple[str, str] | None, sentinel: str) -> Column:
    """Stripped text of the first such element, else the sentinel."""
    return text_or(html_text(page, tag, attribute), sentinel)


def html_housing_split(housing: Column) -> Column:
    """``/ 1br - 850ft2 -`` -> struct(bedrooms, square_feet).

    Both become sentinels together as soon as one separator is absent.
    """

    def parts(text: Column) -> Column:
        after_slash = split_index(text, "/", 1)
        after_dash = split_index(text, "-", 1)
        bedrooms = strip_ws(split_index(after_slash, "-", 0))
        square_feet = strip_ws(split_index(after_dash, "ft", 0))
        readable = after_slash.isNotNull() & after_dash.isNotNull()
        return F.struct(
            F.when(readable, bedrooms).otherwise(F.lit(S.BEDROOMS_MISSING)).alias("bedrooms"),
            F.when(readable, square_feet).otherwise(F.lit(S.SQUARE_FEET_MISSING)).alias("square_feet"),
        )

    return _once(housing, parts)


def html_attribute_elements(
    page: Column | Tokens, outer: Selector = ("div", ("class", "attr")), inner: Selector = ("span", ("class", "valu"))
) -> Column:
    """The first inner element of every outer element, as an array."""

    def found(t: Tokens) -> Column:
        def first_in(inside: Column, span: Column) -> Column:
            end = span["first"] + span["length"]
            start = F.get(F.filter(inside, lambda k: (k > span["first"]) & (k < end)), F.lit(0))

            def cut(first: Column) -> Column:
                length = F.least(_length(t.names, inner[0], first), end - first)
                return F.when(first.isNotNull(), t.element(F.struct(first.alias("first"), length.alias("length"))))

            return _once(start, cut)

        held = _once(t.starts(inner), lambda inside: F.transform(_spans(t, outer), lambda span: first_in(inside, span)))
        return F.filter(held, lambda element: element.isNotNull())

    return _read(page, (outer, inner), found)


def html_attributes(
    page: Column | Tokens, outer: Selector = ("div", ("class", "attr")), inner: Selector = ("span", ("class", "valu"))
) -> Column:
    """The first inner element's text of every outer element, as an array."""
    elements = html_attribute_elements(page, outer, inner) if isinstance(page, Tokens) else _elements(page, (), (outer, inner))
    return F.transform(plain_texts(elements), strip_ws)


def html_result_links(page: Column | Tokens, item: Selector) -> Column:
    """Link targets inside the list items of a result page, as an array."""
    hrefs = F.transform(
        html_elements(page, *item),
        lambda block: F.regexp_extract_all(
            block, F.lit(r"(?is)<a\b[^>]*?\shref\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1)
        ),
    )
    return unescape_all(F.flatten(hrefs))


def html_postings_count(page: Column | Tokens) -> Column:
    """Text of the first div directly inside the result counter."""
    counter = html_element(page, "div", ("class", "cl-count-save-bar"))
    return F.coalesce(F.get(plain_texts(F.array(html_child(counter, "div"))), F.lit(0)), F.lit(S.POSTINGS_COUNT_MISSING))


def page_ready(page: Column, marker: str = "cl-static-search-results") -> Column:
    return page.contains(marker)
