"""One row per run of a job."""

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from ..sources import files
from ..sources.tables import literal_rows, read_or_empty

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("days", T.ArrayType(T.IntegerType())),
        T.StructField("rows", T.LongType()),
        T.StructField("output", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("unseen", T.LongType()),
    ]
)


def append_run(
    spark: SparkSession,
    path: str,
    job: str,
    status: str,
    batch_id: int | None = None,
    days: Sequence[int] | None = None,
    rows: int | None = None,
    output: str | None = None,
    unseen: int | None = None,
) -> None:
    """Note a run; ``unseen`` counts its rows whose category the model did not know."""
    now = dt.datetime.now(dt.timezone.utc)
    row = (uuid.uuid4().hex, job, batch_id, days, rows, output, status, now, unseen)
    literal_rows(spark, [row], RUN_LOG_SCHEMA).write.mode("append").parquet(path)


@contextlib.contextmanager
def logged_run(spark: SparkSession, path: str | None, job: str, **fields) -> Iterator[Callable]:
    """A run of a job: an error leaves a row ``failed``. Yields a function to note other ends.

    Without ``path`` nothing is noted.
    """

    def log(status: str, **more) -> None:
        if path:
            append_run(spark, path, job, status, **{**fields, **more})

    try:
        yield log
    except Exception:
        log("failed")
        raise


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """A row per run; one that is being folded just now may lie in two files."""
    return read_or_empty(spark, path, RUN_LOG_SCHEMA).dropDuplicates(["run_id"])


def compact_run_log(spark: SparkSession, path: str, at_least: int = 50) -> None:
    """One file instead of many: the rows are written anew, then the files read are deleted."""
    old = files.glob(spark, f"{path}/part-*")
    if len(old) >= at_least:
        rows = spark.read.schema(RUN_LOG_SCHEMA).parquet(*old).dropDuplicates(["run_id"])
        rows.coalesce(1).write.mode("append").parquet(path)
        for name in old:
            files.remove_dir(spark, name)
