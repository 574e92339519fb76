"""Tables that a run adds one numbered batch to."""

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import files


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A few rows known to the driver, as literals: no Python worker, one partition."""
    structs = [
        F.struct(
            *[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema.fields, row, strict=True)]
        )
        for row in rows
    ]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


# Files of recent batches up to this size, compressed, are broadcast by key to be laid over a base.
OVERLAY_BYTES = 4 << 20


class BatchTable:
    """Parquet folders ``batches/batch=N``, and now and then a folded ``base/upto=N``.

    Writing a batch again replaces it, so a retried run cannot count twice. Readers see
    the newest complete base and the batches after it; partition pruning keeps folded
    batches out of the scan.

    ``keys``: folding gives one row per key from the rows of that key alone. Then a base is sorted
    by key, in ranges, and ``read`` lays recent batches over it instead of folding it again.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        fold: Callable[[DataFrame], DataFrame],
        partition_by: tuple[str, ...] = (),
        keys: tuple[str, ...] = (),
    ):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.fold = fold
        self.partition_by = partition_by
        self.keys = keys

    def write(self, batch: int, rows: DataFrame) -> None:
        self._save(rows, f"{self.path}/batches/batch={batch}")

    def append(self, rows: DataFrame) -> int:
        """Write ``rows`` as a batch of their own; no two writers get the same number."""
        batch = files.claim_number(
            self.spark, f"{self.path}/claims", self.last
        )
        self.write(batch, rows)
        return batch

    def read_batch(self, batch: int) -> DataFrame:
        return self._read(f"{self.path}/batches/batch={batch}")

    def batches(self) -> list[int]:
        return files.numbered_dirs(
            self.spark, f"{self.path}/batches", prefix="batch=", marker="_SUCCESS"
        )

    def base(self) -> int:
        """The last batch folded into the base, -1 without a base."""
        return max(
            files.numbered_dirs(
                self.spark, f"{self.path}/base", prefix="upto=", marker="_SUCCESS"
            ),
            default=-1,
        )

    def last(self) -> int:
        """The number of the last batch, folded or not; -1 before the first one."""
        return max([self.base(), *self.batches()], default=-1)

    def rows(self, last: int | None = None) -> DataFrame:
        """Base rows and the batches after it (up to ``last``), not folded together."""
        upto = self.base()
        recent = self._recent(upto, max(self.batches(), default=-1) if last is None else last)
        return recent if upto < 0 else self._read_base(upto).unionByName(recent)

    def _recent(self, upto: int, last: int) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])
        return (
            read_or_empty(self.spark, f"{self.path}/batches", schema)
            .filter((F.col("batch") > upto) & (F.col("batch") <= last))
            .select(*self.schema.names)
        )

    def read(self) -> DataFrame:
        """All rows folded; a plain scan where nothing came after the base.

        With ``keys``, rows of the base whose key no recent batch holds stay as they are: they are
        told apart by a join with the recent keys, which are broadcast if their files are small
        (``OVERLAY_BYTES``), so the base is neither shuffled nor sorted. Only rows with a recent key
        are folded.
        """
        upto = self.base()
        newer = [batch for batch in self.batches() if batch > upto]
        if upto >= 0 and not newer:
            return self._read_base(upto)
        if upto < 0 or not self.keys:
            return self.fold(self.rows())
        recent, base = self._recent(upto, newer[-1]), self._read_base(upto)
        touched = recent.select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()
        size = sum(files.size(self.spark, f"{self.path}/batches/batch={batch}") for batch in newer)
        if size <= OVERLAY_BYTES:
            touched = F.broadcast(touched)
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        changed = self.fold(recent.unionByName(base.join(touched, same, "left_semi")))
        return base.join(touched, same, "left_anti").unionByName(changed.select(*self.schema.names))

    def compact(self) -> int:
        """Fold what was written so far into a new base; returns the last batch.

        A batch that someone is still writing, and those after it, wait for the next time. A
        claim of a day ago belongs to a writer that has died.
        """
        done, base = self.batches(), self.base()
        last = max(done, default=-1)
        claims = files.claimed_numbers(self.spark, f"{self.path}/claims")
        waiting = [
            c for c in set(claims) - set(done) if c > base and not files.older(self.spark, f"{self.path}/claims/{c}{{,-*}}", 86400)
        ]
        upto = min([last, *[c - 1 for c in waiting]])
        if upto > base:
            rows = self.fold(self.rows(upto))
            if self.keys:
                rows = rows.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys)
            self._save(rows, f"{self.path}/base/upto={upto}")
        return last

    def vacuum(self) -> None:
        """Delete folded batches and older bases, once no reader uses them."""
        upto = self.base()
        for batch in self.batches():
            if batch <= upto:
                files.remove_dir(self.spark, f"{self.path}/batches/batch={batch}")
        for claim in files.claimed_numbers(self.spark, f"{self.path}/claims"):
            if claim < upto:
                for ticket in files.glob(self.spark, f"{self.path}/claims/{claim}{{,-*}}"):
                    files.remove_dir(self.spark, ticket)
        for old in files.numbered_dirs(self.spark, f"{self.path}/base", prefix="upto="):
            if old < upto:
                files.remove_dir(self.spark, f"{self.path}/base/upto={old}")

    def _read_base(self, upto: int) -> DataFrame:
        return self._read(f"{self.path}/base/upto={upto}")

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(path).select(*self.schema.names)

    def _save(self, rows: DataFrame, path: str) -> None:
        writer = rows.select(*self.schema.names).write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(path)
