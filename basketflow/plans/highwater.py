"""Incremental aggregation by a strict high-water mark.

Days at or below the mark are never read again, so a day that arrives late is left out.
``IncrementalAggregation`` takes late days in; this is for callers who need the strict
rule. Both keep the same tables, so either state can be trained on.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.aggregate import basket_ledger
from ..sinks.runlog import logged_run
from ..sources.baskets import ARRIVAL_DAY, MALFORMED, available_days, day_folders, read_days
from .state import AggregationState, day_table, pending_days


class HighWaterAggregation(AggregationState):
    job = "highwater"

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        state: str,
        id_columns: Sequence[str],
        compact_every: int = 100,
    ):
        super().__init__(spark, state, landing, compact_every)
        self.id_columns = list(id_columns)

    def mark(self) -> int:
        """The last processed day, -1 before the first run."""
        return self.processed_days().agg(F.coalesce(F.max("day"), F.lit(-1))).first()[0]

    def available(self) -> DataFrame:
        return day_table(self.spark, available_days(self.spark, self.landing))

    def skipped_days(self) -> DataFrame:
        """Days that arrived below the mark and so will not be read."""
        late = pending_days(self.available(), self.processed_days())
        return late.filter(F.col("day") < self.mark())

    def run(self) -> list[int]:
        """Aggregate the days above the mark; returns them."""
        generation, mark = self.generation(), self.mark()
        with logged_run(self.spark, self.log_path, self.job) as log:
            above = [d for d in day_folders(self.spark, self.landing) if d > mark]
            days = available_days(self.spark, self.landing, among=above)
            if not days:
                log("idle")
                return []
            batch_id = max([self.manifest.base(), *self.manifest.batches()], default=-1) + 1
            baskets = read_days(self.spark, self.landing, days, keep_malformed=True)
            ledger = basket_ledger(baskets, self.id_columns, [ARRIVAL_DAY], malformed=MALFORMED)
            self.write_batch(generation, batch_id, ledger)
            self.record_quiet_days(days)
            return days
