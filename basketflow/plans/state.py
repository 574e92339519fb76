"""What the incremental jobs keep: sums, rejects, processed days and the run log."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.aggregate import (
    LEDGER_SCHEMA,
    ledger_files,
    ledger_rejects,
    ledger_totals,
    merge_ledger,
    without_files,
)
from ..sinks.runlog import append_run, compact_run_log, read_run_log
from ..sources import files
from ..sources.baskets import ARRIVAL_DAY, available_days, day_folders, marked_path, marked_time
from ..sources.tables import BatchTable, literal_rows

DAY_SCHEMA = T.StructType([T.StructField("day", T.IntegerType())])
MANIFEST_SCHEMA = T.StructType(
    [T.StructField("day", T.IntegerType()), T.StructField("batch_id", T.LongType())]
)
# Files that were counted, with the milliseconds of their last change before that.
FILE_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("changed", T.LongType())])
# Sums and rejects are kept per arrival day.
DAILY_SCHEMA = T.StructType([T.StructField(ARRIVAL_DAY, T.IntegerType()), *LEDGER_SCHEMA.fields])


def day_table(spark: SparkSession, days: Iterable[int]) -> DataFrame:
    return literal_rows(spark, [(d,) for d in days], DAY_SCHEMA)


def first_batches(manifest: DataFrame) -> DataFrame:
    """One row per day: the first batch it was part of."""
    return manifest.groupBy("day").agg(F.min("batch_id").alias("batch_id"))


def counted_files(ledger: DataFrame) -> DataFrame:
    """The files that a batch's ledger was made from."""
    mark = F.col("file")
    return first_change(ledger_files(ledger).select(marked_path(mark).alias("path"), marked_time(mark).alias("changed")))


def first_change(files: DataFrame) -> DataFrame:
    return files.groupBy("path").agg(F.min("changed").alias("changed"))


def pending_days(available: DataFrame, processed: DataFrame) -> DataFrame:
    """Days that arrived and were not processed yet."""
    return available.join(processed.select("day"), "day", "left_anti")


class AggregationState:
    """Tables of one generation under ``state/gen=N``; both incremental jobs write them.

    Every ``compact_every`` batches the tables are folded into one, so that readers do not have
    to open ever more folders. What was folded before the last time is deleted then: readers of
    the fold before keep their files.
    """

    job = "incremental"

    def __init__(self, spark: SparkSession, state: str, landing: str = "", compact_every: int = 100):
        self.spark = spark
        self.landing = landing
        self.state = state
        self.compact_every = compact_every
        self.log_path = f"{state}/run_log"

    def generation(self) -> int:
        """Number of resets so far; each generation has its own checkpoint and tables."""
        return max(files.numbered_dirs(self.spark, self.state, prefix="gen="), default=0)

    def reset(self) -> None:
        """Start over: an empty checkpoint and empty tables, in one step."""
        files.make_dirs(self.spark, f"{self.state}/gen={self.generation() + 1}")

    @property
    def partials(self) -> BatchTable:
        return self._partials(self.generation())

    @property
    def manifest(self) -> BatchTable:
        return self._manifest(self.generation())

    def version(self) -> str:
        """Names what has been processed so far, from listings alone; folding does not change it."""
        generation = self.generation()
        late = self._partials(generation, "late/").last()
        return f"{generation}/{self._partials(generation).last()}" + (f"/{late}" if late >= 0 else "")

    def totals(self) -> DataFrame:
        """The aggregate table over everything processed so far."""
        return ledger_totals(self.ledger())

    def ledger(self) -> DataFrame:
        """Sums and rejects of all batches, and of files that came too late for them."""
        generation = self.generation()
        rows, late = self._partials(generation).rows(), self._partials(generation, "late/")
        return rows.unionByName(late.rows(self._files(generation, "late/").last())) if late.last() >= 0 else rows

    def files(self) -> DataFrame:
        """``(path, changed)``: the files counted so far, where the job notes them."""
        generation = self.generation()
        return first_change(self._files(generation).rows().unionByName(self._files(generation, "late/").rows()))

    def quarantine(self) -> DataFrame:
        """Everything processed so far that did not count; see ``ledger_rejects``."""
        return ledger_rejects(self.ledger())

    def processed_days(self) -> DataFrame:
        """One row per processed day with the first batch it was part of."""
        quiet = self._quiet(self.generation()).rows()
        return first_batches(self.manifest.rows().unionByName(quiet))

    def pending_days(self) -> DataFrame:
        done = {r.day for r in self.processed_days().collect()}
        unknown = set(day_folders(self.spark, self.landing)) - done
        return day_table(self.spark, available_days(self.spark, self.landing, among=unknown))

    def run_log(self) -> DataFrame:
        return read_run_log(self.spark, self.log_path)

    def compact(self) -> None:
        """Delete what earlier folds made superfluous, then fold."""
        generation = self.generation()
        tables = [self._partials(generation), self._manifest(generation), self._quiet(generation), self._files(generation)]
        late = [self._partials(generation, "late/"), self._files(generation, "late/")]
        if late[0].last() == late[1].last():  # else a batch of late files was begun and not finished
            tables += late
        for table in tables:
            table.vacuum()
            table.compact()
        compact_run_log(self.spark, self.log_path)

    def write_batch(self, generation: int, batch_id: int, ledger: DataFrame, note_files: bool = False) -> list[int]:
        """Write one batch and the days (and files) it has read; writing it again replaces what it wrote."""
        partials, manifest = self._partials(generation), self._manifest(generation)
        partials.write(batch_id, ledger)
        counted = F.col("reason").isNull()
        days, rows = partials.read_batch(batch_id).agg(
            F.collect_set(ARRIVAL_DAY), F.count_if(counted)
        ).first()
        if note_files:
            self._files(generation).write(batch_id, counted_files(partials.read_batch(batch_id)))
        manifest.write(batch_id, literal_rows(self.spark, [(d, batch_id) for d in sorted(days)], MANIFEST_SCHEMA))
        append_run(self.spark, self.log_path, self.job, "done", batch_id, sorted(days), rows, partials.path)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact()
        return sorted(days)

    def record_quiet_days(self, days: Iterable[int]) -> None:
        """Note days whose files hold no basket at all; no batch can tell of them."""
        days = set(days) - {r.day for r in self.processed_days().collect()}
        if days:
            quiet = self._quiet(self.generation())
            last = max([self.manifest.base(), *self.manifest.batches()], default=0)
            rows = literal_rows(self.spark, [(d, max(last, 0)) for d in sorted(days)], MANIFEST_SCHEMA)
            quiet.write(max([quiet.base(), *quiet.batches()], default=-1) + 1, rows)

    def _partials(self, generation: int, kind: str = "") -> BatchTable:
        path = f"{self.state}/gen={generation}/{kind}partials"
        fold = lambda rows: merge_ledger(without_files(rows), [ARRIVAL_DAY])
        return BatchTable(self.spark, path, DAILY_SCHEMA, fold)

    def _files(self, generation: int, kind: str = "") -> BatchTable:
        path = f"{self.state}/gen={generation}/{kind}files"
        return BatchTable(self.spark, path, FILE_SCHEMA, first_change)

    def _manifest(self, generation: int) -> BatchTable:
        path = f"{self.state}/gen={generation}/manifest"
        return BatchTable(self.spark, path, MANIFEST_SCHEMA, first_batches)

    def _quiet(self, generation: int) -> BatchTable:
        path = f"{self.state}/gen={generation}/quiet"
        return BatchTable(self.spark, path, MANIFEST_SCHEMA, first_batches)
