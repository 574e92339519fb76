"""Scoring of a stream of rows with a published model."""

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import DataStreamWriter

from ..plans.scoring import predict, refresh_cache
from ..sources.models import ModelStore
from ..sources.tables import BatchTable

FACT_SCHEMA = T.StructType(
    [
        T.StructField("order_dow", T.IntegerType()),
        T.StructField("order_hour_of_day", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("items", T.LongType()),
    ]
)


def read_fact_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(FACT_SCHEMA).parquet(path)


def score_stream(
    rows: DataFrame, store: ModelStore, output: str, checkpoint: str, version: int | None = None
) -> DataStreamWriter:
    """Scored rows appended to ``output``, every input row exactly once."""
    scored = predict(store.load(version), rows)
    return (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def cache_stream(
    rows: DataFrame, store: ModelStore, cache: BatchTable, checkpoint: str
) -> DataStreamWriter:
    """Adds new rows to the cache: each micro-batch is scored with the newest model.

    Rows scored by an older version stay at it; ``refresh_if_retrained`` scores them again, beside
    this stream if need be. Start the stream with ``trigger(processingTime="20 seconds")``, or
    with ``trigger(availableNow=True)`` for a single run.
    """

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        version = store.current()
        refresh_cache(cache, predict(store.load(version), batch), version)

    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply_batch)
