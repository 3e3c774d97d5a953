"""Repeatable draws: functions of (seed, epoch, tag, id), the same on any layout."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c if isinstance(c, Column) else F.lit(c)


def hash_key(seed: int, epoch, tag: str, ident) -> Column:
    """Hex md5 of `seed|epoch|tag|id`; its order is a permutation of the ids."""
    parts = [F.lit(str(seed)), col(epoch).cast("string"), F.lit(tag), col(ident).cast("string")]
    return F.md5(F.concat_ws("|", *parts))


def key_uniform(key: Column) -> Column:
    """First 52 bits of a hex digest as a double in [0, 1): every row of a table of up to 2^52 rows can be drawn."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def hash_uniform(seed: int, epoch, tag: str, ident) -> Column:
    """Uniform draw in [0, 1) for one (seed, epoch, tag, id)."""
    return key_uniform(hash_key(seed, epoch, tag, ident))
