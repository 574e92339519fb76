"""Train/test split by key hash: the same rows whatever the partitioning."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import KEYS, hash_bucket

BUCKETS = 1000


def label_split(
    df: DataFrame, test_share: float = 0.1, keys: Sequence[str] = KEYS, seed: int = 42
) -> DataFrame:
    """Adds ``split``: ``'test'`` for about ``test_share`` of the keys, else ``'train'``."""
    in_test = hash_bucket(keys, BUCKETS, seed) < round(test_share * BUCKETS)
    return df.withColumn("split", F.when(in_test, "test").otherwise("train"))


def hash_split(
    df: DataFrame, test_share: float = 0.1, keys: Sequence[str] = KEYS, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test); row-local filters, no shuffle."""
    labelled = label_split(df, test_share, keys, seed)
    return tuple(
        labelled.filter(F.col("split") == name).drop("split") for name in ("train", "test")
    )
