"""Scalar text functions: trimming, splitting and parsing scraped values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline import schema as S

# Every character that a Unicode-aware strip removes, that is
# the white space of the standard and the four information separators.
_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def strip_ws(text: Column) -> Column:
    """Remove all Unicode white space at both ends."""
    return F.btrim(text, F.lit(_SPACE))


def split_index(text: Column, separator: str, index: int) -> Column:
    """Element ``index`` of the split text, null when there is none.

    The separator is literal, so it is quoted for the regex engine.
    """
    return F.get(F.split(text, rf"\Q{separator}\E"), F.lit(index))


def default_if_missing(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def number_or_null(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes null."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def money_parse(text: Column) -> Column:
    """``$2,650`` -> 2650.0; text without a number -> null."""
    bare = F.replace(F.replace(text, F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    return number_or_null(bare)


def square_feet_parse(text: Column) -> Column:
    """``850`` and ``850.0`` -> 850; empty or other text -> null."""
    return number_or_null(text).try_cast("int")


def bedrooms_parse(text: Column) -> Column:
    """``1br`` -> 1; other text -> null."""
    return F.regexp_extract(text, r"^\s*(\d+)\s*br", 1).try_cast("int")


def count_text_parse(text: Column) -> Column:
    """``2,400 postings`` -> 2400."""
    bare = F.replace(F.replace(text, F.lit(" postings"), F.lit("")), F.lit(","), F.lit(""))
    return strip_ws(bare).try_cast("int")


def ceil_div_pages(postings: Column, per_page: int = S.POSTINGS_PER_PAGE) -> Column:
    """Result pages needed to show all postings."""
    return F.ceil(postings / F.lit(per_page)).cast("int")


def is_fee(attribute: Column) -> Column:
    """A standalone whole number in an attribute marks a fee."""
    return attribute.rlike(S.FEE_PATTERN)


def concat_label(name: Column, address: Column) -> Column:
    return F.concat(name, F.lit(" - "), F.coalesce(address, F.lit(S.STORE_ADDRESS_MISSING)))


def flag_label(flag: Column) -> Column:
    return F.when(flag == 1, "Yes").when(flag == 0, "No")


def flag_colour(flag: Column) -> Column:
    return F.when(flag == 1, "green").otherwise("red")


def format_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")
