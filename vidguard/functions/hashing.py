"""Pseudo-random draws that depend only on (row key, position, seed), never on partitioning."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_M31 = 2147483648


def hash_int(*parts: Column | str) -> Column:
    """31-bit integer from the md5 of the parts joined by ':'."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    text = F.concat_ws(":", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % _M31


def uniform(*parts: Column | str) -> Column:
    """Uniform draw in [0, 1) from the md5 of the parts."""
    return hash_int(*parts).cast("double") / float(_M31)


def position_uniform(row_hash: Column, position: Column) -> Column:
    """Cheap draw for one array position: mixes a row hash with the index in 31-bit arithmetic."""
    x = (row_hash + position.cast("long") * 1103515245) % _M31
    mixed = F.shiftright(x, 15).bitwiseXOR(x) * 739982445 % _M31
    return mixed.cast("double") / float(_M31)


def order_hash(key: Column, seed: int) -> Column:
    """Text hash used as a stable random order of rows."""
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def hash_bucket(hashed: Column, digits: int = 3) -> Column:
    """Leading hex digits of an order hash; buckets sort as the hashes do."""
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("int")
