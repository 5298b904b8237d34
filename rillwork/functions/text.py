"""Deterministic text normalisation as Spark columns.

Only NFKC and case folding of texts beyond ASCII run in Python, in Arrow
batches; a text of ASCII is lower-cased by the JVM and never leaves it.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# White space as the normalisation counts it, beyond Java's class.
WHITE = "[\\s\\x1c-\\x1f]"


@pandas_udf(StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold())


def unicode_normalize(c: Column) -> Column:
    """NFKC; null as the empty string."""

    @pandas_udf(StringType())
    def nfkc(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.coalesce(nfkc(F.when(~is_ascii(text), text)), text)


def is_ascii(c: Column) -> Column:
    return c.rlike("^[\\x00-\\x7F]*$")


def casefolded(c: Column) -> Column:
    """NFKC and case folding; null as the empty string."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.coalesce(_folded(F.when(~is_ascii(text), text)), F.lower(text))


def stripped(c: Column) -> Column:
    """White space, by Unicode, off both ends."""
    return F.regexp_replace(c, f"(?U)^{WHITE}+|{WHITE}+$", "")


def single_spaced(c: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"(?U){WHITE}+", " "))


def is_blank(c: Column) -> Column:
    return c.isNull() | (stripped(c) == "")


def punctuation_free(folded: Column) -> Column:
    """Letters a-z and digits, all else as single spaces. folded: case-folded text."""
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))


def compact(folded: Column) -> Column:
    return F.regexp_replace(folded, "[^a-z0-9]+", "")


def tokens(norm: Column) -> Column:
    """Tokens of punctuation-free text; none of the empty text."""
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def sorted_token_string(norm: Column) -> Column:
    """Tokens in code-point order, repeats kept, joined by spaces."""
    return F.array_join(F.array_sort(F.split(norm, " ")), " ")


def numbers(folded: Column) -> Column:
    """Runs of decimal digits of any script."""
    return F.regexp_extract_all(folded, F.lit("(\\p{Nd}+)"), 1)


def number_string(folded: Column) -> Column:
    return F.array_join(numbers(folded), " ")


def alpha_token_string(norm: Column) -> Column:
    return F.array_join(F.filter(tokens(norm), lambda t: t.rlike("^[a-z]+$")), " ")


def house_number(folded: Column) -> Column:
    """The first number, or the empty string."""
    return F.regexp_extract(folded, "(\\p{Nd}+)", 1)


def postal_token_string(folded: Column, at_least: int = 4) -> Column:
    return F.array_join(F.filter(numbers(folded), lambda t: F.length(t) >= at_least), " ")


def token_overlap(a: Column, b: Column) -> Column:
    """Distinct tokens in common. Splitting the empty string gives one empty token, so two empty strings share one."""
    split = lambda c: F.split(F.trim(F.coalesce(c, F.lit(""))), " ")
    return F.size(F.array_intersect(split(a), split(b)))
