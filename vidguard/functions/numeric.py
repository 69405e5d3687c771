"""Casts that never throw, finite checks, order-preserving buckets."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(c: Column) -> Column:
    """Text or number to int, fraction cut off, unreadable becomes NULL."""
    return c.try_cast("double").try_cast("int")


def to_float(c: Column) -> Column:
    return c.try_cast("float")


def to_bool(c: Column) -> Column:
    return c.try_cast("boolean")


def to_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp")


def finite(c: Column) -> Column:
    """True for a finite number; NaN counts as larger than infinity, NULL gives NULL."""
    return F.abs(c) < float("inf")


def not_finite(c: Column) -> Column:
    return ~F.coalesce(finite(c), F.lit(False))


def finite_or_zero(c: Column) -> Column:
    x = c.cast("double")
    return F.when(finite(x), x).otherwise(0.0)


def bool_to_int(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0))


def one_hot(c: Column, value: str) -> Column:
    return (F.coalesce(c, F.lit("unknown")) == value).cast("int")


def order_bucket(c: Column) -> Column:
    """Monotone map of any finite double to a small integer.

    64 buckets per power of two of (1 + |x|): equal or larger values never get a smaller bucket,
    so ranks and running totals can be taken bucket by bucket.
    """
    return F.floor(F.signum(c) * F.log2(F.abs(c) + 1.0) * 64).cast("int")


def unit_clip(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
