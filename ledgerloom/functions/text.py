"""Cleaning of text columns that hold lists, units or null words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for a missing value.
NULL_WORDS = ("", "null", "nan")


def clean_token(text: Column) -> Column:
    """NULL for the null words, else the text as it is."""
    return F.when(~F.lower(F.trim(text)).isin(*NULL_WORDS), text)


def present(text: Column) -> Column:
    """True where the text is neither NULL nor a null word, never NULL itself."""
    return clean_token(text).isNotNull()


def elements(text: Column) -> Column:
    """Comma list to an array of trimmed elements; NULL for an empty list."""
    return F.split(F.trim(clean_token(text)), r"\s*,\s*")


def list_size(text: Column) -> Column:
    """Number of elements, 0 for an empty list."""
    return F.coalesce(F.size(F.split(clean_token(text), ",")), F.lit(0))


def element_numbers(text: Column) -> Column:
    """Comma list to an array of whole numbers; an element that is none is NULL."""
    return F.transform(elements(text), lambda part: part.try_cast("int"))


def unit_number(text: Column, to: str) -> Column:
    """Leading number of a text such as '23.4 km' or '32 minutes'; else NULL.

    A whole number is made of the digits before the point; a number too large is NULL.
    """
    digits = F.regexp_extract(text, r"^\s*(\d+)(\.\d+)?", 1 if to == "int" else 0)
    return F.nullif(F.trim(digits), F.lit("")).try_cast(to)
