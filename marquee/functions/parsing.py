"""Lenient parsing of text cells. Bad input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as blank around a cell.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_DIGITS = r"\d+(_\d+)*"
_WHOLE = rf"^[+-]?{_DIGITS}$"
_NUMBER = rf"^[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
_SPECIAL = r"^(?i)[+-]?(inf|infinity|nan)$"


def strip(cell: Column) -> Column:
    return F.btrim(cell, F.lit(BLANKS))


def text_or_null(cell: Column) -> Column:
    """The stripped cell, NULL when blank."""
    return F.nullif(strip(cell), F.lit(""))


def _as_double(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit("")).try_cast("double")


def to_int(cell: Column) -> Column:
    """Truncates decimals; blanks, words, infinities and NaN give NULL."""
    text = strip(cell)
    return F.when(text.rlike(_NUMBER), _as_double(text)).try_cast("int")


def to_whole(cell: Column) -> Column:
    """Whole numbers only; anything else gives NULL."""
    text = strip(cell)
    return F.when(text.rlike(_WHOLE), F.replace(text, F.lit("_"), F.lit(""))).try_cast("int")


def to_float(cell: Column) -> Column:
    """Accepts infinities and NaN; blanks and words give NULL."""
    text = strip(cell)
    special = F.when(F.lower(text).contains("nan"), F.lit(float("nan"))).otherwise(
        F.when(text.startswith("-"), float("-inf")).otherwise(float("inf"))
    )
    return F.when(text.rlike(_NUMBER), _as_double(text)).when(text.rlike(_SPECIAL), special)


def to_decimal(cell: Column, kind: str) -> Column:
    """A number rounded to ``kind``; NULL when it does not fit."""
    return to_float(cell).try_cast(kind)


def to_bool(cell: Column) -> Column:
    """True only for the word ``true`` in any case."""
    return F.coalesce(F.lower(strip(cell)) == "true", F.lit(False))


def iso_date(cell: Column) -> Column:
    return F.try_to_timestamp(strip(cell), F.lit("yyyy-M-d")).cast("date")


def long_date(cell: Column) -> Column:
    """Dates such as ``July 5, 2022``."""
    return F.try_to_timestamp(F.initcap(strip(cell)), F.lit("MMMM d, yyyy")).cast("date")


def parse_list(cell: Column) -> Column:
    """The entries of a list written as text, blanks dropped.

    Reads bracketed or parenthesised lists of quoted strings or numbers; any
    other text is split on commas and freed of stray quotes and brackets.
    """
    text = strip(cell)
    is_tuple = text.rlike(r"(?s)^\(.*,.*\)$")
    inner = F.regexp_replace(F.substring(text, 2, 2**30), r",?\s*\)$", "]")
    listed = F.from_json(
        F.when(is_tuple, F.concat(F.lit("["), inner)).when(text.startswith("["), text),
        "array<string>",
        {"allowSingleQuotes": "true"},
    )
    bare = F.transform(F.split(text, ","), lambda part: F.btrim(part, F.lit(" '\"[]")))
    entries = F.coalesce(F.transform(listed, strip), bare, F.array().cast("array<string>"))
    return F.filter(entries, lambda entry: entry != "")
