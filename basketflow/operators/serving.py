"""The prediction cache: one value per (weekday, hour, category), last version wins."""

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..errors import MalformedKey
from ..functions.keys import KEYS, join_key, split_key


def cache_rows(predictions: DataFrame, model_version: int) -> DataFrame:
    """Scored rows as cache rows of one model version, one per key.

    Equal keys have equal features and so one prediction; ``max`` only settles ties in
    predictions that were made elsewhere.
    """
    return (
        predictions.groupBy(*KEYS)
        .agg(F.max("prediction").alias("prediction"))
        .select(
            join_key().alias("key"),
            *KEYS,
            "prediction",
            F.lit(model_version).cast("int").alias("model_version"),
        )
    )


def latest_per_key(cache: DataFrame) -> DataFrame:
    """The newest prediction of every key; keys of older versions stay until replaced."""
    return (
        cache.groupBy(*KEYS)
        .agg(
            F.max_by("prediction", "model_version").alias("prediction"),
            F.max("model_version").alias("model_version"),
        )
        .select(join_key().alias("key"), *KEYS, "prediction", "model_version")
    )


def latest_version_only(cache: DataFrame, version: int) -> DataFrame:
    """Only what the given model version predicted, one row per key."""
    return latest_per_key(cache.filter(F.col("model_version") == version))


def lookup(cache: DataFrame, key: str) -> DataFrame:
    """The row of one ``dow:hour:category`` key, found by three typed predicates."""
    try:
        dow, hour, category = key.split(":", 2)
        dow, hour = int(dow), int(hour)
    except ValueError as error:
        raise MalformedKey(key) from error
    return cache.filter(
        (F.col("order_dow") == dow)
        & (F.col("order_hour_of_day") == hour)
        & (F.col("category") == category)
    )


def list_keys(cache: DataFrame) -> DataFrame:
    return cache.select("key").distinct()


def parse_keys(keys: DataFrame) -> DataFrame:
    return keys.select("key", *split_key(F.col("key")))


def serve(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests with the cached prediction and whether there was one.

    ``cache`` must hold one row per key. Spark broadcasts it when its size on disk is
    below ``spark.sql.autoBroadcastJoinThreshold``; past that, the sort-merge join's
    skew splitting takes care of keys that many requests ask for.
    """
    hits = cache.select(*KEYS, "prediction").withColumn("cache_hit", F.lit(True))
    return requests.join(hits, [*KEYS], "left").withColumn(
        "cache_hit", F.coalesce("cache_hit", F.lit(False))
    )


def missing_keys(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Each key that is asked for and not cached, once."""
    return requests.select(*KEYS).distinct().join(cache.select(*KEYS), [*KEYS], "left_anti")


def serve_all(
    requests: DataFrame, cache: DataFrame, predict: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``serve``, with the misses predicted: once per missing key, not once per request.

    ``predict`` adds an INT ``prediction`` to rows of keys.
    """
    cached = cache.select(*KEYS, "prediction", F.lit(True).alias("cache_hit"))
    scored = predict(missing_keys(requests, cache)).select(
        *KEYS, "prediction", F.lit(False).alias("cache_hit")
    )
    return requests.join(cached.unionByName(scored), [*KEYS], "left")
