"""Expressions on codes, labels and identifiers. All are pure ``Column -> Column``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mark a dictionary label as unusable, and the labels written instead.
BAD_COUNTRY_MARKS = ["INVALID: ", "No Country Code ", "should not show"]
BAD_PORT_MARKS = ["No PORT Code "]
NOT_IN_DICTIONARY = "NOT_IN_{col}_DICTIONARY"
BAD_COUNTRY_LABEL = "IN_{col}_DICTIONARY_BUT_INVALID_UNKNOWN_NOTSHOW"
BAD_PORT_LABEL = "IN_{col}_DICTIONARY_BUT_NO_PORT_CODE"


def remap_matching(c: Column, marks: Sequence[str], sentinel: str) -> Column:
    """``sentinel`` where the text contains any of ``marks``, else the text itself."""
    return F.when(reduce(Column.__or__, [c.contains(m) for m in marks]), F.lit(sentinel)).otherwise(c)


def fill_sentinel(c: Column, name: str, sentinel: str = NOT_IN_DICTIONARY) -> Column:
    """Replace null by a label that names the column."""
    return F.coalesce(c, F.lit(sentinel.format(col=name)))


def code(c: Column) -> Column:
    """A whole-number code stored as double, as integer; null when it is not a number."""
    return c.try_cast("int")


def id_text(c: Column) -> Column:
    """An identifier stored as double, as text without decimals."""
    return c.try_cast("bigint").cast("string")


def place_key(city: Column, state: Column) -> Column:
    """``CITY, ST``. A null part is skipped together with the comma."""
    return F.concat_ws(", ", F.upper(city), F.upper(state))


def split_item(c: Column, sep_regex: str, index: int) -> Column:
    """Part ``index`` (from 0) of a split text; null when there are not that many parts."""
    return F.get(F.split(c, sep_regex), F.lit(index))


def strip_pattern(c: Column, regex: str) -> Column:
    """Remove every match of ``regex``."""
    return F.regexp_replace(c, regex, "")


def nan_to_null(c: Column) -> Column:
    """Averages skip null but not NaN, so missing measurements become null on read."""
    return F.when(~F.isnan(c), c)


def hash_key(*cols: Column) -> Column:
    """MD5 of the concatenated texts; null if any part is null."""
    return F.md5(F.concat(*[c.cast("string") for c in cols]))
