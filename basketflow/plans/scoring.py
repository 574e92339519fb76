"""Batch scoring, the predictions table and the prediction cache."""

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.keys import KEYS
from ..operators.metrics import round_prediction
from ..operators.serving import cache_rows, latest_per_key
from ..sinks.csv import export_csv
from ..sinks.keyvalue import write_keyvalue
from ..sinks.runlog import logged_run
from ..sources.models import ModelStore
from ..sources.tables import BatchTable

# Working columns of the pipeline that a prediction row does not carry.
WORKING_COLUMNS = ("cat_idx", "cat_vec", "features")

CACHE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("order_dow", T.IntegerType()),
        T.StructField("order_hour_of_day", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("model_version", T.IntegerType()),
    ]
)


def category_count(model: PipelineModel) -> int:
    """How many categories the model's indexer knows; an unseen one gets this index."""
    return len(model.stages[0].labels)


def predict(model: PipelineModel, rows: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Rows with ``prediction`` rounded to INT; streaming rows work as well.

    ``counts`` gets the numbers of ``rows`` and of those with an ``unseen`` category, one that the
    model was not trained on, from the job that uses the predictions; no scan of its own.
    """
    scored = model.transform(rows)
    if counts is not None:
        unseen = F.count_if(F.col("cat_idx") >= category_count(model))
        scored = scored.observe(counts, F.count(F.lit(1)).alias("rows"), unseen.alias("unseen"))
    return round_prediction(scored.drop(*WORKING_COLUMNS))


def prediction_cache(spark: SparkSession, path: str) -> BatchTable:
    """The cache table, a batch per refresh.

    Files are laid out by weekday, so a lookup of one key reads one weekday; in a fold they are
    sorted by key, so it skips row groups.
    """
    return BatchTable(spark, path, CACHE_SCHEMA, latest_per_key, partition_by=("order_dow",), keys=KEYS)


def score(
    spark: SparkSession,
    store: ModelStore,
    output: str,
    rows: DataFrame | None = None,
    version: int | None = None,
    csv_output: str | None = None,
    run_log: str | None = None,
) -> DataFrame:
    """Score ``rows`` (by default the test set kept with the model) into ``output``.

    Every run gets a folder of its own, ``v=N/run=ID``, so one that repeats a score does not
    pull files from under a reader. Returns the predictions as stored.
    """
    with logged_run(spark, run_log, "score") as log:
        version = store.current() if version is None else version
        model = store.load(version)
        rows = store.split(version, "test") if rows is None else rows
        path = f"{output}/v={version}/run={uuid.uuid4().hex}"
        counts = Observation()
        predict(model, rows, counts).write.mode("overwrite").parquet(path)
        predictions = spark.read.parquet(path)
        if csv_output:
            export_csv(predictions, csv_output)
        # Spark leaves the numbers out where it finds that there is nothing to count.
        seen = {"rows": 0, "unseen": 0} | counts.get
        log("done", batch_id=version, output=path, rows=seen["rows"], unseen=seen["unseen"])
    return predictions


def score_and_cache(
    spark: SparkSession,
    store: ModelStore,
    output: str,
    cache: BatchTable,
    rows: DataFrame | None = None,
    version: int | None = None,
    csv_output: str | None = None,
    run_log: str | None = None,
    client: str | None = None,
    **client_options,
) -> DataFrame:
    """``score``, then refresh the cache from the stored predictions.

    The model runs once; the cache and, with ``client``, the external store read the
    predictions table.
    """
    version = store.current() if version is None else version
    predictions = score(spark, store, output, rows, version, csv_output, run_log)
    refresh_cache(cache, predictions, version)
    if client:
        write_keyvalue(cache_rows(predictions, version), client, **client_options)
    return predictions


def refresh_cache(
    cache: BatchTable, predictions: DataFrame, version: int, compact_every: int = 50
) -> None:
    """Add the predictions of one model version to the cache, as a batch of their own.

    Readers are not disturbed. Adding the same predictions twice changes nothing, as the last
    version of a key wins. Every ``compact_every`` batches the cache is folded, and what the fold
    before made superfluous is deleted, so a lookup never opens many folders.
    """
    batch = cache.append(cache_rows(predictions, version))
    if (batch + 1) % compact_every == 0:
        cache.vacuum()
        cache.compact()


def not_at_version(rows: DataFrame, cached: DataFrame, version: int) -> DataFrame:
    """Rows whose key has no prediction of this version or a later one in the cache."""
    current = cached.filter(F.col("model_version") >= version).select(*[F.col(k).alias(f"_{k}") for k in KEYS])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    return rows.join(current, same, "left_anti")


def refresh_if_retrained(
    spark: SparkSession,
    store: ModelStore,
    output: str,
    cache: BatchTable,
    rows: DataFrame | None = None,
    run_log: str | None = None,
    **more,
) -> int | None:
    """Score and cache what is not yet at the published version; returns it, or None if all is.

    ``rows`` are the rows the cache serves; without them, the version's test set and every key
    that is in the cache already. Key by key: what a stream or another refresh has brought to
    this version meanwhile is not scored again, and no key stays behind because others are ahead.
    """
    version = store.current()
    cached = cache.read().select(*KEYS, "model_version")
    if rows is None:
        test = store.split(version, "test").select(*KEYS, "items")
        behind = cached.filter(F.col("model_version") < version).select(*KEYS, F.lit(None).cast("bigint").alias("items"))
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
        others = behind.join(test.select(*[F.col(k).alias(f"_{k}") for k in KEYS]), same, "left_anti")
        rows = test.unionByName(others)
    stale = not_at_version(rows, cached, version)
    if stale.isEmpty():
        with logged_run(spark, run_log, "refresh") as log:
            log("idle")
        return None
    score_and_cache(spark, store, output, cache, stale, version, run_log=run_log, **more)
    return version
