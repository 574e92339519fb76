"""Prediction cache queries.

Predictions come from the category-mean model, so that SQL can check what is served. Two
model versions are cached, both trained on all events: the first scores a fifth of the keys, the
second another tenth, by another seed of the split. Keys that only the first one scored stay in
the cache.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import serving
from ..operators.aggregate import basket_totals
from ..operators.metrics import apply_category_means, category_mean_model, round_prediction
from ..operators.sampling import label_split
from ..plans.scoring import prediction_cache, refresh_cache
from ..session import working_dir
from ..sources.models import ModelStore
from ..sources.tables import BatchTable
from .inputs import EVENT_FACTS_SQL, EVENT_IDS, event_baskets, event_totals_sql, table

# Version, share of the test set, seed of the split.
VERSIONS = ((1, 0.2, 7), (2, 0.1, 42))


def _filled_cache(spark: SparkSession, sf_dir: str, label: str) -> tuple[BatchTable, DataFrame]:
    """The cache after two model versions, and the second version's category means."""
    base = working_dir(spark, label)
    store, cache = ModelStore(spark, f"{base}/splits"), prediction_cache(spark, f"{base}/cache")
    everything = basket_totals(event_baskets(spark, sf_dir), EVENT_IDS)
    for version, share, seed in VERSIONS:
        store.save_split(version, label_split(everything, share, seed=seed))
        means = category_mean_model(store.split(version, "train"))
        scored = round_prediction(apply_category_means(store.split(version, "test"), means))
        refresh_cache(cache, scored, version)
    return cache, category_mean_model(store.split(2, "train"))


def all_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filled_cache(spark, sf_dir, "prediction_cache")[0].read()


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.latest_version_only(_filled_cache(spark, sf_dir, "cache_latest")[0].rows(), 2)


def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache, _ = _filled_cache(spark, sf_dir, "cache_compacted")
    cache.compact()
    cache.vacuum()
    return cache.read()


def cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache, _ = _filled_cache(spark, sf_dir, "cache_keys")
    return serving.parse_keys(serving.list_keys(cache.rows()))


def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first key of the cache, looked up again."""
    cache, _ = _filled_cache(spark, sf_dir, "cache_lookup")
    cache.compact()
    key = serving.list_keys(cache.rows()).agg(F.min("key")).first()[0]
    return serving.lookup(cache.read(), key)


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event asks for the prediction of its own weekday, hour and kind."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        (F.dayofweek("ts") - 1).alias("order_dow"),
        F.hour("ts").alias("order_hour_of_day"),
        F.col("event_type").alias("category"),
    )


def cache_serve(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache, _ = _filled_cache(spark, sf_dir, "cache_serve")
    cache.compact()
    return serving.serve(_requests(spark, sf_dir), cache.read())


def cache_serve_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``cache_serve``, and what the cache lacks is predicted."""
    cache, means = _filled_cache(spark, sf_dir, "cache_serve_all")
    cache.compact()
    return serving.serve_all(
        _requests(spark, sf_dir),
        cache.read(),
        lambda keys: round_prediction(apply_category_means(keys, means)),
    )


def _version_sql(version: int, seed: int, limit: int) -> str:
    bucket = (
        f"CAST('0x' || substr(md5(concat_ws(':', '{seed}', order_dow, order_hour_of_day, category)), 1, 8)"
        " AS BIGINT) % 1000"
    )
    return f"""
    SELECT concat_ws(':', order_dow, order_hour_of_day, category) AS key,
           order_dow, order_hour_of_day, category,
           CAST(round(prediction) AS INTEGER) AS prediction, {version} AS model_version
    FROM (SELECT *, avg(items) FILTER ({bucket} >= {limit}) OVER (PARTITION BY category) AS prediction,
                 {bucket} AS bucket
          FROM ({event_totals_sql()}))
    WHERE bucket < {limit}
    """


_VERSION_1_SQL = _version_sql(1, 7, 200)
_VERSION_2_SQL = _version_sql(2, 42, 100)

CACHE_SQL = f"""
    SELECT * FROM (({_VERSION_1_SQL}) UNION ALL ({_VERSION_2_SQL}))
    QUALIFY row_number() OVER (PARTITION BY key ORDER BY model_version DESC) = 1
"""

REQUESTS_SQL = f"""
    SELECT event_id AS request_id, order_dow, order_hour_of_day, category FROM ({EVENT_FACTS_SQL})
"""

SERVE_SQL = f"""
    SELECT r.*, c.prediction, c.key IS NOT NULL AS cache_hit
    FROM ({REQUESTS_SQL}) r LEFT JOIN ({CACHE_SQL}) c USING (order_dow, order_hour_of_day, category)
"""

SERVE_ALL_SQL = f"""
    SELECT s.* REPLACE (coalesce(s.prediction, m.prediction) AS prediction)
    FROM ({SERVE_SQL}) s
    LEFT JOIN (SELECT DISTINCT category, prediction FROM ({_VERSION_2_SQL})) m USING (category)
"""

QUERIES = {
    "prediction_cache": (all_predictions, CACHE_SQL),
    "cache_latest_version": (latest_version, _VERSION_2_SQL),
    "cache_compacted": (compacted, CACHE_SQL),
    "cache_keys": (cache_keys, f"SELECT key, order_dow, order_hour_of_day, category FROM ({CACHE_SQL})"),
    "cache_lookup": (cache_lookup, f"SELECT * FROM ({CACHE_SQL}) ORDER BY key LIMIT 1"),
    "cache_serve": (cache_serve, SERVE_SQL),
    "cache_serve_all": (cache_serve_all, SERVE_ALL_SQL),
}
