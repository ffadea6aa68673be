"""Variants of place names."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _mark_table() -> tuple[str, str]:
    """Letters up to U+024F that decompose to one base letter and marks, and those base letters."""
    given, base = "", ""
    for point in range(0xC0, 0x250):
        plain = "".join(c for c in unicodedata.normalize("NFD", chr(point)) if unicodedata.category(c) != "Mn")
        if len(plain) == 1 and plain != chr(point):
            given, base = given + chr(point), base + plain
    return given, base


_GIVEN, _BASE = _mark_table()
_MARKS = "".join(chr(p) for p in range(0x300, 0x370))


def strip_marks(text: Column) -> Column:
    """Text without diacritics, for letters of the Latin blocks; letters such as ß and ø stay."""
    return F.translate(text, _GIVEN + _MARKS, _BASE)


def strip_marks_any(text: Column) -> Column:
    """As ``strip_marks``, for every script."""

    @F.pandas_udf("string")
    def plain(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: s if s is None else "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn"))

    return plain(text)


# Spellings that stand for each other, each applied by itself.
SPELLINGS = (("ö", "o"), ("ö", "oe"), ("ä", "a"), ("ä", "ae"), ("ü", "u"), ("ü", "ue"), ("ß", "ss"))


def comparison_variants(name: Column) -> Column:
    """Lower-case spellings to compare by, the name's own first."""
    text = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    return F.array_distinct(F.array(text, strip_marks(text), *[F.replace(text, F.lit(a), F.lit(b)) for a, b in SPELLINGS]))


# A name, and what its first bracket holds.
BRACKET = r"(.+?)\s*\((.+?)\)"


def bracket_variants(name: Column) -> Column:
    """The name; what stands before its first bracket, if that differs; what stands inside."""
    before, inside = F.regexp_extract(name, BRACKET, 1), F.regexp_extract(name, BRACKET, 2)
    before, inside = F.trim(before), F.trim(inside)
    return F.array_compact(F.array(name, F.when((before != "") & (before != name), before), F.when(inside != "", inside)))


def lookup_variants(name: Column) -> Column:
    """Every bracket variant, each followed by its form without diacritics where that differs."""
    pairs = F.transform(bracket_variants(name), lambda v: F.array_distinct(F.array(v, strip_marks(v))))
    return F.flatten(pairs)


def fill_empty(first: Column, second: Column) -> Column:
    """``first`` unless it is blank, else ``second``, else ''."""
    return F.when(F.trim(F.coalesce(first, F.lit(""))) != "", first).otherwise(F.coalesce(second, F.lit("")))


def casefold_order(text: Column) -> list[Column]:
    """Sort keys that order as case-folded text does."""
    return [F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), text]
