"""Incremental aggregation of day folders with a file stream.

Progress is the stream's checkpoint, file by file. A day that arrives late, a second
file for a day already processed, or a second week are all just new files.
"""

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..errors import EmptyInput
from ..operators.aggregate import basket_ledger, facts_ledger
from ..plans.state import AggregationState, counted_files
from ..sinks.runlog import append_run, logged_run
from ..sources import files
from ..sources.baskets import (
    ARRIVAL_DAY,
    FILE_MARK,
    MALFORMED,
    available_days,
    csv_options,
    day_folders,
    day_of_file,
    file_mark,
    line_place,
    malformed_schema,
    marked_path,
    melt_drifting_lines,
)

# By default the file source ignores files a week older than the newest one, which is
# just what a day that arrives late may be.
UNBOUNDED_AGE = "36500d"
AGE_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}


def age_in_ms(age: str) -> int:
    """Milliseconds of an age such as ``90s``, ``30m``, ``1h`` or ``7d``."""
    found = re.fullmatch(r"([0-9]+)([smhd])", age)
    if not found:
        raise ValueError(f"an age is a number and one of s, m, h, d, not {age!r}")
    return int(found[1]) * AGE_SECONDS[found[2]] * 1000


class IncrementalAggregation(AggregationState):
    """Sums and rejects per micro-batch, written under the batch id, merged on read.

    ``columns`` is the header of the basket files. Without it the files may differ in
    their categories and column order, and each file's own header counts.

    The stream remembers every file it has seen, unless ``max_file_age`` bounds that: then it forgets
    files that are so much older than the newest one, and ignores what is older. So every batch
    notes its files in a table (``files``). A file that is older than the bound and not in the table
    is counted apart (``count_late_files``); one that was counted, forgotten and changed since is
    not counted again. With ``archive``, a folder that processed files are moved to, a trigger
    does not list them again.
    """

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        state: str,
        id_columns: Sequence[str],
        columns: Sequence[str] | None = None,
        max_files_per_trigger: int | None = None,
        compact_every: int = 100,
        max_file_age: str | None = None,
        archive: str | None = None,
    ):
        super().__init__(spark, state, landing, compact_every)
        self.id_columns = list(id_columns)
        self.columns = list(columns) if columns else None
        self.max_files_per_trigger = max_files_per_trigger
        self.max_file_age = max_file_age
        self.archive = archive
        self.failed_batch: int | None = None

    def run_available(self) -> list[int]:
        """Process what has arrived, then stop; returns the ids of the new batches."""
        with logged_run(self.spark, self.log_path, self.job) as log:
            done = {r.day for r in self.processed_days().collect()}
            unknown = set(day_folders(self.spark, self.landing)) - done
            arrived = available_days(self.spark, self.landing, among=unknown)
            before = set(self.manifest.batches())
            self._writer(self.apply_batch).trigger(availableNow=True).start().awaitTermination()
            new = sorted(set(self.manifest.batches()) - before)
            late = self.count_late_files()
            if new or late:
                self.record_quiet_days(arrived)
            else:
                log("idle")
        return new

    def run_every(self, interval: str = "4 seconds") -> StreamingQuery:
        """Keep processing: one micro-batch at a time, no backlog of missed triggers.

        A listener notes idle triggers and failures in the run log, and days without baskets.
        """
        listener = RunListener(self)
        self.spark.streams.addListener(listener)
        query = self._writer(self._logged_batch).trigger(processingTime=interval).start()
        listener.query = str(query.id)
        return query

    def apply_batch(self, batch: DataFrame, batch_id: int, generation: int | None = None) -> None:
        """Write one micro-batch; writing it again replaces what it wrote before."""
        generation = self.generation() if generation is None else generation
        ledger = self._ledger_of(batch, generation)
        if self.max_file_age:
            ledger = self._of_new_files(ledger, batch, batch_id, generation)
        self.write_batch(generation, batch_id, ledger, note_files=bool(self.max_file_age))

    def count_late_files(self) -> int:
        """Count files that the stream ignores for their age; returns how many there were.

        The newest file noted so far, less the age, is at or below the time before which the stream
        takes no file, now or later; so no file is counted by both. A batch of late files holds
        once its files are noted, which is its last step; until then it is written anew.
        """
        if not self.max_file_age:
            return 0
        generation, known = self.generation(), self.files()
        newest = self._files(generation).rows().agg(F.max("changed")).first()[0]
        if newest is None:
            return 0
        old = self._listing().filter(F.col("changed") < newest - age_in_ms(self.max_file_age))
        late = old.join(known.select("path"), "path", "left_anti").collect()
        if not late:
            return 0
        partials, noted = self._partials(generation, "late/"), self._files(generation, "late/")
        batch = noted.last() + 1
        reader = self._options(self.spark.read)
        # A path is a pattern to Spark.
        paths = [re.sub(r"([\\\[\]{}*?])", r"\\\1", row.name) for row in late]
        partials.write(batch, self._ledger_of(self._rows(reader, paths), generation))
        days, rows = partials.read_batch(batch).agg(
            F.collect_set(ARRIVAL_DAY), F.count_if(F.col("reason").isNull())
        ).first()
        noted.write(batch, self.spark.createDataFrame([(row.path, row.changed) for row in late], noted.schema))
        self.record_quiet_days(days)
        append_run(self.spark, self.log_path, self.job, "late", batch, sorted(days), rows, partials.path)
        return len(late)

    # --- parts ----------------------------------------------------------------------

    def _ledger_of(self, batch: DataFrame, generation: int) -> DataFrame:
        mark = FILE_MARK if FILE_MARK in batch.columns else None
        if self.columns:
            malformed = MALFORMED if MALFORMED in batch.columns else None
            return basket_ledger(batch, self.id_columns, [ARRIVAL_DAY], malformed=malformed, file=mark)
        headers_at = f"{self.state}/gen={generation}/headers"
        facts = melt_drifting_lines(
            batch, self.id_columns, (ARRIVAL_DAY,), rejects=True, headers_at=headers_at, mark=mark, keyed=True
        )
        return facts_ledger(facts, [ARRIVAL_DAY])

    def _of_new_files(self, ledger: DataFrame, batch: DataFrame, batch_id: int, generation: int) -> DataFrame:
        """The ledger without files that were counted before, which is made anew if there are any.

        Its own rows name the files, so that the batch need not be read for them.
        """
        draft = f"{self.state}/gen={generation}/draft"
        ledger.write.mode("overwrite").parquet(draft)
        ledger = self.spark.read.schema(ledger.schema).parquet(draft)
        before = self._files(generation).rows(batch_id - 1).unionByName(self._files(generation, "late/").rows())
        again = counted_files(ledger).join(before.select("path"), "path", "left_semi").select(F.col("path").alias("_path"))
        if again.isEmpty():
            return ledger
        new = batch.join(again, marked_path(F.col(FILE_MARK)) == F.col("_path"), "left_anti")
        return self._ledger_of(new, generation)

    def _listing(self) -> DataFrame:
        """``(path, changed, name)`` of the files in the landing folder; nothing in them is read."""
        found = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.csv")
            .load(self.landing)
        )
        changed = F.unix_millis(F.col("_metadata.file_modification_time"))
        return found.select(F.col("_metadata.file_path").alias("path"), changed.alias("changed"), F.col("path").alias("name"))

    def _options(self, reader):
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
        return csv_options(reader, keep_malformed=True).schema(malformed_schema(self.columns)) if self.columns else reader

    def _rows(self, reader, path: str | list[str]) -> DataFrame:
        """The rows, or lines, of files with their day and, where files are noted, their file."""
        day = day_of_file().alias(ARRIVAL_DAY)
        mark = [file_mark().alias(FILE_MARK)] if self.max_file_age else []
        if self.columns:
            return reader.csv(path).select("*", day, *mark)
        return reader.text(path).select("value", *line_place(), day, *mark)

    def _logged_batch(self, batch: DataFrame, batch_id: int, generation: int) -> None:
        try:
            self.apply_batch(batch, batch_id, generation)
        except Exception:
            self.failed_batch = batch_id
            append_run(self.spark, self.log_path, self.job, "failed", batch_id)
            raise

    def _stream(self) -> DataFrame:
        if not files.exists(self.spark, self.landing):
            raise EmptyInput(self.landing)
        reader = self._options(self.spark.readStream).option("maxFileAge", self.max_file_age or UNBOUNDED_AGE)
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        if self.archive:
            reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", self.archive)
        return self._rows(reader, self.landing)

    def _writer(self, apply: Callable[[DataFrame, int, int], None]) -> DataStreamWriter:
        generation = self.generation()
        return (
            self._stream()
            .writeStream.option("checkpointLocation", f"{self.state}/gen={generation}/checkpoint")
            .foreachBatch(lambda batch, batch_id: apply(batch, batch_id, generation))
        )


class RunListener(StreamingQueryListener):
    """Notes what no batch can tell of: idle triggers, failures between batches, quiet days.

    A day with files that an earlier event has seen and that is not processed now holds no basket:
    a trigger has listed its files since then.
    """

    def __init__(self, job: IncrementalAggregation):
        self.job = job
        self.query: str | None = None
        self.seen: set[int] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.query:
            self._note_days()

    def onQueryIdle(self, event) -> None:
        if str(event.id) == self.query:
            self.job.count_late_files()
            self._note_days()
            append_run(self.job.spark, self.job.log_path, self.job.job, "idle")

    def onQueryTerminated(self, event) -> None:
        if str(event.id) != self.query:
            return
        if event.exception and self.job.failed_batch is None:
            append_run(self.job.spark, self.job.log_path, self.job.job, "failed")

    def _note_days(self) -> None:
        job = self.job
        done = {r.day for r in job.processed_days().collect()}
        job.record_quiet_days(self.seen - done)
        unknown = set(day_folders(job.spark, job.landing)) - done - self.seen
        self.seen = set(available_days(job.spark, job.landing, among=unknown))
