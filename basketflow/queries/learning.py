"""Split, features, forest and metrics queries."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import KEYS, join_key
from ..operators import metrics
from ..operators.features import category_encoder, category_indexer, feature_pipeline, unseen_categories
from ..operators.forest import forest_nodes, forest_scores
from ..operators.sampling import hash_split, label_split
from ..plans.scoring import predict, prediction_cache, refresh_if_retrained, score, score_and_cache
from ..plans.training import ForestSettings, fit_forest, train_model
from ..session import working_dir
from ..sinks.keyvalue import folder_pairs, stream_keyvalue
from ..sinks.runlog import read_run_log
from ..sources import files
from ..sources.models import ModelStore
from ..sources.tables import BatchTable
from ..streaming.scoring import FACT_SCHEMA, cache_stream, read_fact_stream, score_stream
from .inputs import ORDER_TOTALS_SQL, event_totals, event_totals_sql, order_totals, split_sql


def stored_split(spark: SparkSession, totals: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(train, test), written once so that the aggregate is not computed per reader."""
    store = ModelStore(spark, working_dir(spark, label))
    store.save_split(1, label_split(totals))
    return store.split(1, "train"), store.split(1, "test")


def split_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_split(order_totals(spark, sf_dir))[0]


def split_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_split(order_totals(spark, sf_dir))[1]


TRAIN_SQL = split_sql(ORDER_TOTALS_SQL, "train")
TEST_SQL = split_sql(ORDER_TOTALS_SQL, "test")


def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = stored_split(spark, order_totals(spark, sf_dir), "category_index")
    indexed = category_indexer().fit(train).transform(train.select("category").distinct())
    return indexed.select("category", F.col("cat_idx").cast("bigint").alias("cat_idx"))


CATEGORY_INDEX_SQL = f"""
    SELECT category, row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS cat_idx
    FROM ({TRAIN_SQL}) GROUP BY category
"""


def _slots(vector: str):
    """A vector of whole numbers as text."""
    numbers = F.transform(vector_to_array(F.col(vector)), lambda x: x.cast("bigint").cast("string"))
    return F.array_join(numbers, ",")


def category_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One slot per known category; in strict mode the rarest one has none."""
    train, _ = stored_split(spark, order_totals(spark, sf_dir), "category_onehot")
    categories = train.select("category").distinct()

    def encoded(strict: bool, alias: str) -> DataFrame:
        indexer = category_indexer(strict).fit(train)
        rows = indexer.transform(categories)
        vectors = category_encoder().fit(indexer.transform(train)).transform(rows)
        return vectors.select("category", _slots("cat_vec").alias(alias))

    return encoded(False, "slots").join(encoded(True, "slots_strict"), "category")


CATEGORY_ONEHOT_SQL = f"""
    WITH indexed AS ({CATEGORY_INDEX_SQL}), total AS (SELECT count(*) AS n FROM indexed)
    SELECT category,
           array_to_string(list_transform(range(n), lambda i: CASE WHEN i = cat_idx THEN 1 ELSE 0 END), ',') AS slots,
           array_to_string(list_transform(range(n - 1), lambda i: CASE WHEN i = cat_idx THEN 1 ELSE 0 END), ',')
               AS slots_strict
    FROM indexed, total
"""


def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = stored_split(spark, order_totals(spark, sf_dir), "feature_vector")
    vectors = feature_pipeline().fit(train).transform(test)
    return vectors.select(*KEYS, "items", _slots("features").alias("features"))


FEATURE_VECTOR_SQL = f"""
    WITH onehot AS ({CATEGORY_ONEHOT_SQL})
    SELECT order_dow, order_hour_of_day, category, items,
           concat_ws(',', order_dow, order_hour_of_day, slots) AS features
    FROM ({TEST_SQL}) JOIN onehot USING (category)
"""


def unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows of the one category that training was not shown."""
    train, test = stored_split(spark, event_totals(spark, sf_dir), "unseen_categories")
    return unseen_categories(test, train.filter("category <> 'signup'"))


UNSEEN_SQL = f"SELECT * FROM ({split_sql(event_totals_sql(), 'test')}) WHERE category = 'signup'"


# --- the category-mean model ---------------------------------------------------------


def mean_predictions(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    train, test = stored_split(spark, order_totals(spark, sf_dir), label)
    return metrics.apply_category_means(test, metrics.category_mean_model(train))


MEAN_PREDICTIONS_SQL = f"""
    SELECT order_dow, order_hour_of_day, category, items, prediction
    FROM ({TEST_SQL})
    JOIN (SELECT category, avg(items) AS prediction FROM ({TRAIN_SQL}) GROUP BY category) USING (category)
"""


def mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = mean_predictions(spark, sf_dir, "mse")
    return metrics.mean_squared_error(scored).select(F.round("mse", 6).alias("mse"))


MSE_SQL = f"SELECT round(avg(power(items - prediction, 2)), 6) AS mse FROM ({MEAN_PREDICTIONS_SQL})"


def round_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.round_prediction(mean_predictions(spark, sf_dir, "round_prediction"))


ROUND_PREDICTION_SQL = f"""
    SELECT * REPLACE (CAST(round(prediction) AS INTEGER) AS prediction) FROM ({MEAN_PREDICTIONS_SQL})
"""


def preview_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = mean_predictions(spark, sf_dir, "preview_top20")
    first = metrics.preview(scored, [*KEYS, "items", "prediction"])
    return first.withColumn("prediction", F.round("prediction", 6))


PREVIEW_SQL = f"""
    SELECT * REPLACE (round(prediction, 6) AS prediction) FROM ({MEAN_PREDICTIONS_SQL})
    ORDER BY order_dow, order_hour_of_day, category LIMIT 20
"""


# --- the forest ----------------------------------------------------------------------


def trained(spark: SparkSession, sf_dir: str, label: str) -> ModelStore:
    store = ModelStore(spark, f"{working_dir(spark, label)}/models")
    train_model(spark, order_totals(spark, sf_dir), store)
    return store


def rf_train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the sets, and whether the forest beats the best constant on the test set."""
    store = trained(spark, sf_dir, "rf_train_metrics")
    mean = store.split(1, "train").agg(F.avg("items")).first()[0]
    constant = store.split(1, "test").agg(F.avg(F.pow(F.col("items") - mean, 2))).first()[0]
    return store.metrics().select(
        "n_train",
        "n_test",
        "n_unseen",
        F.round(F.lit(constant), 4).alias("mse_of_constant"),
        (F.col("mse") < 0.98 * constant).alias("better"),
    )


RF_METRICS_SQL = f"""
    WITH train AS ({TRAIN_SQL}), test AS ({TEST_SQL})
    SELECT (SELECT count(*) FROM train) AS n_train, count(*) AS n_test,
           count(*) FILTER (category NOT IN (SELECT category FROM train)) AS n_unseen,
           round(avg(power(items - (SELECT avg(items) FROM train), 2)), 4) AS mse_of_constant, TRUE AS better
    FROM test
"""


def rf_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = trained(spark, sf_dir, "rf_predict")
    return score(spark, store, f"{store.root}-predictions")


def rf_predict_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test row is scored, within the range of the training labels."""
    store = trained(spark, sf_dir, "rf_predict_range")
    low, high = store.split(1, "train").agg(F.min("items"), F.max("items")).first()
    scored = score(spark, store, f"{store.root}-predictions")
    return scored.select(
        *KEYS, "items", F.col("prediction").between(low, high).alias("within_range")
    )


def rf_scores_by_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest evaluated by joins with its node table, against the model's own scores."""
    store = trained(spark, sf_dir, "rf_scores_by_joins")
    model, test = store.load(1), store.split(1, "test")
    joined = forest_scores(test, model, forest_nodes(store.nodes(1)))
    own = model.transform(test).select(*KEYS, F.col("prediction").alias("own"))
    return joined.join(own, [*KEYS]).select(*KEYS, "items", F.expr("prediction <=> own").alias("as_model"))


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test set as a stream: every row scored once, and as the batch job scores it."""
    store = trained(spark, sf_dir, "stream_score")
    base = f"{store.root}-stream"
    store.split(1, "test").write.parquet(f"{base}/requests")
    rows = read_fact_stream(spark, f"{base}/requests")
    stream = score_stream(rows, store, f"{base}/scored", f"{base}/checkpoint")
    stream.trigger(availableNow=True).start().awaitTermination()
    batch = predict(store.load(), store.split(1, "test"))
    return (
        spark.read.parquet(f"{base}/scored")
        .join(batch.select(*KEYS, F.col("prediction").alias("batch_prediction")), [*KEYS], "left")
        .select(*KEYS, "items", (F.col("prediction") == F.col("batch_prediction")).alias("as_batch"))
    )


def rf_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored and cached in one job: the cache holds what the predictions table holds."""
    store = trained(spark, sf_dir, "rf_cache")
    cache = prediction_cache(spark, f"{store.root}-cache")
    stored = score_and_cache(spark, store, f"{store.root}-predictions", cache)
    return _agreement(cache, stored)


def stream_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache kept by a stream of rows, against the batch predictions."""
    store = trained(spark, sf_dir, "stream_cache")
    base = f"{store.root}-stream"
    store.split(1, "test").write.parquet(f"{base}/rows")
    cache = prediction_cache(spark, f"{base}/cache")
    writer = cache_stream(read_fact_stream(spark, f"{base}/rows"), store, cache, f"{base}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return _agreement(cache, predict(store.load(), store.split(1, "test")))


def cache_after_retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model trained again with another split: every cached key gets the new version's score."""
    store = trained(spark, sf_dir, "cache_after_retrain")
    cache = prediction_cache(spark, f"{store.root}-cache")
    refresh_if_retrained(spark, store, f"{store.root}-predictions", cache)
    totals = order_totals(spark, sf_dir)
    train_model(spark, totals, store, ForestSettings(seed=7, num_trees=10))
    for _ in range(2):  # the second finds nothing to do
        refresh_if_retrained(spark, store, f"{store.root}-predictions", cache)
    expected = predict(store.load(2), totals).select(*KEYS, F.col("prediction").alias("expected"))
    return cache.read().join(expected, [*KEYS]).select(
        "key", "model_version", F.expr("prediction <=> expected").alias("agrees")
    )


def cache_mixed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream brings the keys of one weekday to version 2, a refresh all others; then none is left."""
    store = trained(spark, sf_dir, "cache_mixed_versions")
    base = f"{store.root}-stream"
    cache = prediction_cache(spark, f"{store.root}-cache")
    refresh = lambda: refresh_if_retrained(spark, store, f"{store.root}-predictions", cache)
    refresh()
    totals = order_totals(spark, sf_dir)
    train_model(spark, totals, store, ForestSettings(seed=7, num_trees=10))
    store.split(1, "test").filter("order_dow = 3").write.parquet(f"{base}/rows")
    writer = cache_stream(read_fact_stream(spark, f"{base}/rows"), store, cache, f"{base}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    first, second = refresh(), refresh()
    expected = predict(store.load(2), totals).select(*KEYS, F.col("prediction").alias("expected"))
    return cache.read().join(expected, [*KEYS]).select(
        "key",
        "model_version",
        F.expr("prediction <=> expected").alias("agrees"),
        F.lit(f"{first}, then {second}").alias("refreshed"),
    )


CACHE_AFTER_RETRAIN_SQL = f"""
    SELECT concat_ws(':', order_dow, order_hour_of_day, category) AS key, 2 AS model_version, TRUE AS agrees
    FROM (SELECT * FROM ({TEST_SQL}) UNION SELECT * FROM ({split_sql(ORDER_TOTALS_SQL, "test", 7)}))
"""


CACHE_MIXED_SQL = f"SELECT *, '2, then None' AS refreshed FROM ({CACHE_AFTER_RETRAIN_SQL})"


def stream_to_keyvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions streamed to a key-value store in three batches; the last one is repeated."""
    train, test = stored_split(spark, order_totals(spark, sf_dir), "stream_keyvalue")
    base = working_dir(spark, "stream_keyvalue_run")
    means = metrics.category_mean_model(train)
    for part in range(3):
        rows = test.filter(F.pmod(F.col("order_hour_of_day"), F.lit(3)) == part)
        rows.coalesce(1).write.mode("append").parquet(f"{base}/rows")
    reader = spark.readStream.schema(FACT_SCHEMA).option("maxFilesPerTrigger", 1)
    for _ in range(2):
        scored = metrics.round_prediction(metrics.apply_category_means(reader.parquet(f"{base}/rows"), means))
        pairs = scored.select(join_key().alias("key"), "prediction")
        stream = stream_keyvalue(pairs, "folder", f"{base}/checkpoint", folder=f"{base}/store")
        stream.trigger(availableNow=True).start().awaitTermination()
        files.remove_dir(spark, f"{base}/checkpoint/commits/2")
        files.remove_dir(spark, f"{base}/checkpoint/commits/.2.crc")
    return folder_pairs(spark, f"{base}/store")


STREAM_KEYVALUE_SQL = f"""
    SELECT concat_ws(':', order_dow, order_hour_of_day, category) AS key,
           CAST(CAST(round(prediction) AS INTEGER) AS VARCHAR) AS value
    FROM ({MEAN_PREDICTIONS_SQL})
"""


def score_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run log tells of a scoring run with a model that does not know one category."""
    store = ModelStore(spark, f"{working_dir(spark, 'score_counts')}/models")
    version = store.claim_version()
    store.save_split(version, label_split(event_totals(spark, sf_dir)))
    model = fit_forest(store.split(version, "train").filter("category <> 'signup'"), ForestSettings(num_trees=2))
    store.save_model(version, model)
    score(spark, store, f"{store.root}-predictions", version=version, run_log=f"{store.root}-log")
    return read_run_log(spark, f"{store.root}-log").select("job", "status", "rows", "unseen")


SCORE_COUNTS_SQL = f"""
    SELECT 'score' AS job, 'done' AS status, count(*) AS rows, count(*) FILTER (category = 'signup') AS unseen
    FROM ({split_sql(event_totals_sql(), 'test')})
"""


def _agreement(cache: BatchTable, predictions: DataFrame) -> DataFrame:
    expected = predictions.select(*KEYS, F.col("prediction").alias("expected"))
    return (
        cache.read()
        .join(expected, [*KEYS], "full")
        .select("key", "model_version", F.expr("prediction <=> expected").alias("agrees"))
    )


RF_CACHE_SQL = f"""
    SELECT concat_ws(':', order_dow, order_hour_of_day, category) AS key,
           1 AS model_version, TRUE AS agrees
    FROM ({TEST_SQL})
"""

QUERIES = {
    "split_train": (split_train, TRAIN_SQL),
    "split_test": (split_test, TEST_SQL),
    "category_index": (category_index, CATEGORY_INDEX_SQL),
    "category_onehot": (category_onehot, CATEGORY_ONEHOT_SQL),
    "feature_vector": (feature_vector, FEATURE_VECTOR_SQL),
    "unseen_categories": (unseen, UNSEEN_SQL),
    "mse": (mse, MSE_SQL),
    "round_prediction": (round_prediction, ROUND_PREDICTION_SQL),
    "preview_top20": (preview_top20, PREVIEW_SQL),
    "rf_train_metrics": (rf_train_metrics, RF_METRICS_SQL),
    "rf_predict": (rf_predict, None),
    "rf_predict_range": (rf_predict_range, f"SELECT *, TRUE AS within_range FROM ({TEST_SQL})"),
    "rf_scores_by_joins": (rf_scores_by_joins, f"SELECT *, TRUE AS as_model FROM ({TEST_SQL})"),
    "rf_cache": (rf_cache, RF_CACHE_SQL),
    "stream_cache": (stream_cache, RF_CACHE_SQL),
    "cache_after_retrain": (cache_after_retrain, CACHE_AFTER_RETRAIN_SQL),
    "cache_mixed_versions": (cache_mixed_versions, CACHE_MIXED_SQL),
    "stream_keyvalue": (stream_to_keyvalue, STREAM_KEYVALUE_SQL),
    "score_counts": (score_counts, SCORE_COUNTS_SQL),
    "stream_score": (stream_score, f"SELECT *, TRUE AS as_batch FROM ({TEST_SQL})"),
}
