"""CSV outputs: the export and the day folders."""

from pyspark.sql import DataFrame, functions as F

from ..operators.quality import key_reason
from ..operators.reshape import quoted
from ..sources.baskets import DAY_FOLDER, MALFORMED


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV, replacing what is there; a file per task.

    ``single_file`` brings the result through one task, behind an exchange; it is for aggregate
    tables, whose size is bounded by the number of keys.
    """
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_day_folders(
    baskets: DataFrame,
    path: str,
    day: str = "order_dow",
    hour: str = "order_hour_of_day",
    rebalance: bool = False,
) -> None:
    """One pass over wide baskets into ``day=0`` .. ``day=6``, every column as it was read.

    Rows whose weekday or hour cannot be used go to a folder named by the reason instead, such
    as ``day=order_dow_missing``; each row goes to one folder. With a column ``MALFORMED``,
    lines with too few or too many fields go to ``day=malformed_line``; the first column then
    holds the line as it was. ``quarantined_rows`` reads those folders. If a column of the baskets is
    called ``day``, the folders are called ``day_=0`` and so on; readers know both.

    By default each task writes its own file per day, without a shuffle. ``rebalance`` shuffles
    by day first: small files are merged, and a day too large for one task is spread over
    several (AQE).
    """
    columns = [c for c in baskets.columns if c != MALFORMED]
    reason = key_reason(baskets, day, hour)
    kept = [F.col(quoted(c)) for c in columns]
    if MALFORMED in baskets.columns:
        broken = F.col(MALFORMED).isNotNull()
        reason = F.when(broken, "malformed_line").otherwise(reason)
        kept = [F.when(~broken, c).alias(name) for c, name in zip(kept, columns, strict=True)]
        kept[0] = F.when(broken, F.col(MALFORMED)).otherwise(F.col(quoted(columns[0])).cast("string")).alias(columns[0])
    number = F.trim(F.col(quoted(day)).cast("string")).try_cast("int").cast("string")
    folder = DAY_FOLDER
    while folder.lower() in [c.lower() for c in columns]:
        folder += "_"
    out = baskets.select(*kept, F.coalesce(reason, number).alias(folder))
    if rebalance:
        out = out.hint("rebalance", F.col(folder))
    writer = out.write.mode("overwrite").partitionBy(folder).option("header", True)
    # Blanks around a value belong to it.
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(side, False)
    writer.csv(path)
