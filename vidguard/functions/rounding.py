"""Decimal rounding that decides ties on the exact binary value.

Spark's ``round`` works on the shortest decimal text, so 0.5565 goes up although the stored double
lies below it. Scores here are compared after rounding, so the tie has to fall on the right side:
the value is split into a 24-bit head and its exact rest, both products with the power of ten are
exact, and the sign of the distance to the half-way point decides (even on a true tie).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(c: Column, digits: int) -> Column:
    """Half-even rounding of the stored double. The input is evaluated once, so roundings nest."""
    p = float(10**digits)

    def rounded(x: Column) -> Column:
        head = x.cast("float").cast("double")
        low = F.floor(x * p).cast("double")
        distance = (head * p - (low + 0.5)) + (x - head) * p
        up = (distance > 0) | ((distance == 0) & (low % 2 != 0))
        return (low + up.cast("double")) / p

    return F.get(F.transform(F.array(c.cast("double")), rounded), F.lit(0))


def decimal_text(c: Column, digits: int) -> Column:
    """Shortest text of a value already rounded to ``digits`` places: 0.5, 1.0, 0.0003."""
    text = c.cast(f"decimal(18,{digits})").cast("string")
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1")


def percent_text(c: Column) -> Column:
    return F.format_string("%.2f%%", round_exact(c * 100.0, 2))
