"""The (weekday, hour, category) key: as text, parsed back, and as a hash bucket."""

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

KEYS = ("order_dow", "order_hour_of_day", "category")


def join_key(columns: Sequence[str] = KEYS) -> Column:
    """``dow:hour:category``."""
    return F.concat_ws(":", *[F.col(c).cast("string") for c in columns])


def split_key(key: Column) -> list[Column]:
    """The typed parts of ``dow:hour:category``.

    The category comes last, so colons inside it survive.
    """
    parts = F.split(key, ":", 3)
    return [
        F.get(parts, 0).try_cast("int").alias(KEYS[0]),
        F.get(parts, 1).try_cast("int").alias(KEYS[1]),
        F.get(parts, 2).alias(KEYS[2]),
    ]


def hash_bucket(columns: Sequence[str], buckets: int, seed: int = 42) -> Column:
    """A bucket number that depends on nothing but the key values and the seed."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets
