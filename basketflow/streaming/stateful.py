"""Running totals in a state store: each micro-batch brings the totals of the keys it has changed.

Where ``IncrementalAggregation`` keeps the sums of every batch and merges them on read, here the
stream holds one row per key, and readers find finished totals. Late days and second files are new
rows like any others. What is rejected is not listed; the incremental job does that.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..errors import EmptyInput
from ..functions.keys import KEYS
from ..operators.aggregate import KEY_FIELDS, SUM_FIELDS, basket_partials, finish_totals
from ..sources import files
from ..sources.baskets import MALFORMED, csv_options, malformed_schema
from ..sources.tables import BatchTable

TOTALS_SCHEMA = T.StructType([*KEY_FIELDS, *SUM_FIELDS, T.StructField("batch_id", T.LongType())])


def latest_sums(rows: DataFrame) -> DataFrame:
    """One row per key: what the last batch that changed it brought."""
    sums = F.struct(*[f.name for f in SUM_FIELDS])
    last = rows.groupBy(*KEYS).agg(F.max_by(sums, "batch_id").alias("sums"), F.max("batch_id").alias("batch_id"))
    return last.select(*KEYS, "sums.*", "batch_id")


class StatefulTotals:
    """A streaming aggregate in update mode; changed keys are laid over the totals, batch by batch.

    The state store is partitioned by key and has a row for each, at most weekdays x hours x
    categories; its number of partitions is that of ``spark.sql.shuffle.partitions`` at the first start.
    A repeated batch starts from the state before it, so it brings the same totals again and
    replaces its own rows. Partial sums meet before the exchange, so a hot key is a row per task.
    """

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        state: str,
        id_columns: Sequence[str],
        columns: Sequence[str],
        max_files_per_trigger: int | None = None,
        compact_every: int = 100,
    ):
        self.spark = spark
        self.landing = landing
        self.checkpoint = f"{state}/checkpoint"
        self.id_columns = list(id_columns)
        self.columns = list(columns)
        self.max_files_per_trigger = max_files_per_trigger
        self.compact_every = compact_every
        self.table = BatchTable(spark, f"{state}/totals", TOTALS_SCHEMA, latest_sums, keys=KEYS)

    def run_available(self) -> None:
        """Count what has arrived, then stop."""
        self._writer().trigger(availableNow=True).start().awaitTermination()

    def run_every(self, interval: str = "4 seconds") -> StreamingQuery:
        return self._writer().trigger(processingTime=interval).start()

    def totals(self) -> DataFrame:
        """The aggregate table over everything counted so far."""
        return finish_totals(self.table.read())

    def _writer(self):
        if not files.exists(self.spark, self.landing):
            raise EmptyInput(self.landing)
        reader = csv_options(self.spark.readStream, keep_malformed=True).schema(malformed_schema(self.columns))
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("maxFileAge", "36500d")
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        baskets = reader.csv(self.landing).filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
        sums = basket_partials(baskets, self.id_columns)
        return (
            sums.writeStream.outputMode("update")
            .option("checkpointLocation", self.checkpoint)
            .foreachBatch(self._lay_over)
        )

    def _lay_over(self, changed: DataFrame, batch_id: int) -> None:
        self.table.write(batch_id, changed.withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        if (batch_id + 1) % self.compact_every == 0:
            self.table.vacuum()
            self.table.compact()
