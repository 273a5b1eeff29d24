r"""Text expressions. All are JVM-side but ``fold_ascii``, which needs Unicode decomposition.

Null in gives null out unless said otherwise. Numbers and white space are ASCII unless a pattern says ``(?U)``.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a missing cell in profiles.
BLANKS = ("", "null", "none", "nan", "[]", "{}")


def strip(c: Column) -> Column:
    """Leading and trailing white space of any kind off (``trim`` takes blanks only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def nullify(c: Column) -> Column:
    """Empty text becomes null."""
    return F.nullif(c, F.lit(""))


def lower_text(c: Column) -> Column:
    return F.lower(strip(c))


def brand_text(c: Column) -> Column:
    """Lower case, white space collapsed, apostrophes kept."""
    return F.lower(squeeze(c))


def prefix_text(c: Column) -> Column:
    """Lower case with hyphens and apostrophes as blanks: the text in which a brand prefix is looked for."""
    return squeeze(F.translate(F.lower(c), "-'", "  "))


def category_text(c: Column) -> Column:
    return squeeze(F.regexp_replace(F.replace(F.lower(c), F.lit("&"), F.lit(" and ")), "[,;./]", " "))


def is_numeric_id(c: Column) -> Column:
    """One or more of the digits 0-9 and nothing else; null is not numeric."""
    return F.coalesce(c.rlike(r"\A[0-9]+\z"), F.lit(False))


def is_blank(c: Column) -> Column:
    """Null, empty or white space."""
    return F.coalesce(c.rlike(r"(?U)\A\s*\z"), F.lit(True))


def is_missing(c: Column) -> Column:
    """Blank, or a spelling of a missing cell."""
    return F.coalesce(lower_text(c), F.lit("")).isin(*BLANKS)


def longest_prefix(text: Column, names: list[str]) -> Column:
    """The longest of ``names`` that the text equals or begins with at a word bound; null if none."""
    hits = F.filter(F.array(*map(F.lit, names)), lambda n: F.startswith(F.concat(text, F.lit(" ")), F.concat(n, F.lit(" "))))
    by_length = F.array_sort(hits, lambda x, y: F.char_length(y) - F.char_length(x))
    return F.try_element_at(by_length, F.lit(1))


def strip_fences(c: Column) -> Column:
    """A text without the code fence round it."""
    return strip(F.regexp_replace(strip(c), r"\A```[A-Za-z]*\s*|\s*```\z", ""))


def number_text(c: Column) -> Column:
    """A double as text, whole numbers without a fraction."""
    whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def percent(part: Column, whole: Column) -> Column:
    """Share in per cent to two places, 0 for an empty whole."""
    return F.coalesce(F.round(100.0 * part / F.nullif(whole, F.lit(0)), 2), F.lit(0.0))


def relative_gap(a: Column, b: Column) -> Column:
    """Difference over the larger magnitude; 0 if both are 0."""
    most = F.greatest(F.abs(a), F.abs(b))
    return F.when(most == 0, F.lit(0.0)).otherwise(F.abs(a - b) / F.nullif(most, F.lit(0.0)))


def fold_ascii(c: Column) -> Column:
    """Lower case ASCII letters and digits with single blanks; accents and trade-mark words off, ``&`` as ``and``."""

    @F.pandas_udf("string")
    def decompose(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())

    plain = F.lower(decompose(c))
    plain = F.replace(F.replace(plain, F.lit("&"), F.lit(" and ")), F.lit("'"), F.lit(" "))
    plain = F.regexp_replace(plain, r"\b(?:tm|r|reg|registered|trademark)\b", " ")
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))
