"""Text cleaning and token expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(c: Column) -> Column:
    """Lower-case, keep letters and digits, single spaces, trimmed.

    Replacing every run of other characters by one space does in one pass what "blank the
    symbols, then squeeze white space" does in two.
    """
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def clean_or_empty(c: Column) -> Column:
    return clean(F.coalesce(c, F.lit("")))


def missing_flag(c: Column) -> Column:
    return c.isNull().cast("int")


def combined(title: Column, ocr: Column, asr: Column) -> Column:
    """Joined text; an empty middle part leaves its two separators standing."""
    return F.trim(F.concat_ws(" ", title, ocr, asr))


def token_count(c: Column) -> Column:
    """Pieces between single spaces: gaps count, and empty text is one piece."""
    return F.size(F.split(c, " "))


def present_flag(missing: Column) -> Column:
    return (missing == 0).cast("int")


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")
