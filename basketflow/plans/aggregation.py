"""The weekday split and the full aggregation."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..errors import EmptyInput, MalformedBaskets
from ..operators.aggregate import LEDGER_SCHEMA, basket_ledger, ledger_rejects, ledger_totals
from ..operators.reshape import valid_keys
from ..sinks.csv import export_csv, write_day_folders
from ..sinks.runlog import logged_run
from ..sources import files
from ..sources.baskets import MALFORMED, available_days, csv_columns, read_csv, read_days, text_schema

# Fixed value: a raw basket row starts with this many id columns.
LEADING_ID_COLUMNS = 4
KEY_COLUMNS = ("order_dow", "order_hour_of_day")


def leading_id_columns(columns: Sequence[str]) -> list[str]:
    """The columns that stand before the categories in a raw file, the keys among them."""
    ids = list(columns[:LEADING_ID_COLUMNS])
    missing = [c for c in KEY_COLUMNS if c not in ids]
    if missing:
        raise MalformedBaskets(f"{missing} not among the first columns {ids}; name the id columns")
    return ids


def split_orders(
    spark: SparkSession,
    orders: str,
    output: str,
    quarantine: str | None = None,
    rebalance: bool = False,
    run_log: str | None = None,
) -> None:
    """Wide orders CSV to one folder per weekday, and one per reason for what fits none.

    One pass; every line goes to one folder. ``quarantine`` is a Parquet table of the lines that
    fit no weekday, read back from their folders.
    """
    with logged_run(spark, run_log, "split", output=output) as log:
        write_day_folders(read_csv(spark, orders, keep_malformed=True), output, rebalance=rebalance)
        if quarantine:
            bad = quarantined_rows(spark, output, csv_columns(spark, orders))
            bad.write.mode("overwrite").parquet(quarantine)
        log("done")


def quarantined_rows(spark: SparkSession, output: str, columns: Sequence[str]) -> DataFrame:
    """What ``split_orders`` put into no weekday folder, with ``reason``.

    A malformed line stands in ``MALFORMED`` as it was, its other columns are NULL.
    """
    paths = files.glob(spark, f"{output}/day{{=,_*=}}[a-z]*")
    if paths:
        rows = read_csv(spark, paths, text_schema(columns), folders=True)
        reason = F.regexp_extract(F.col("_metadata.file_path"), "/day_*=([a-z_]+)/[^/]*$", 1)
        rows = rows.withColumn("reason", reason)
    else:
        rows = spark.createDataFrame([], text_schema([*columns, "reason"]))
    first, broken = columns[0], F.col("reason") == "malformed_line"
    line = F.when(broken, F.col(first)).alias(MALFORMED)
    return rows.select(F.when(~broken, F.col(first)).alias(first), *columns[1:], line, "reason")


def full_aggregation(
    spark: SparkSession,
    raw_root: str,
    output: str,
    id_columns: Sequence[str] | None = None,
    csv_output: str | None = None,
    quarantine: str | None = None,
    run_log: str | None = None,
) -> DataFrame:
    """Every day folder under ``raw_root`` to the aggregate table (Parquet, CSV on request).

    The input is read once; what did not count is kept beside the sums in ``{output}_ledger`` and
    written to ``quarantine`` on request.
    """
    with logged_run(spark, run_log, "full", output=output) as log:
        days = available_days(spark, raw_root)
        if not days:
            raise EmptyInput(raw_root)
        baskets = read_days(spark, raw_root, days, with_day=False, keep_malformed=True)
        ids = list(id_columns or leading_id_columns(baskets.columns))
        ledger_path = f"{output}_ledger"
        basket_ledger(baskets, ids, malformed=MALFORMED).write.mode("overwrite").parquet(ledger_path)
        ledger = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
        ledger_totals(ledger).write.mode("overwrite").parquet(output)
        totals = spark.read.parquet(output)
        if csv_output:
            export_csv(totals, csv_output)
        if quarantine:
            ledger_rejects(ledger).write.mode("overwrite").parquet(quarantine)
        log("done", days=days)
    return totals


def weekday(baskets: DataFrame, day: int) -> DataFrame:
    """Baskets of one weekday."""
    return valid_keys(baskets).filter(f"order_dow = {int(day)}")
