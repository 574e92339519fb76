"""Row numbers within large groups, without bringing a group, or the rows of one key, to one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.tables import keep


def drawn(*columns: str) -> Column:
    """A pseudo-random order of rows that any SQL engine can repeat: the MD5 of their text form."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def in_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` sorted by ``keys`` across tasks, with ``_part`` and the ``_place`` in it.

    Rows with equal keys, however many, are parted by their number. Finding the ranges is a pass of
    its own over ``df``, which had better be a table.
    """
    order = [*keys, "_row"]
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row")
    rows = rows.withColumn("_part", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id())
    return keep(rows, "ranges")


def ranked(df: DataFrame, group: str, order: str, ties: list[str], name: str = "rank") -> DataFrame:
    """``df`` with each row's place (from 0) in its group, by ``order`` then ``ties``.

    Groups and keys may span many tasks. A row's place in its task is counted from where its group
    begins there, and the rows of the group in the tasks before, a table of a row per group and
    task, are added. A null group is a group.
    """
    parts = in_ranges(df.withColumn("_group", F.coalesce(F.col(group).cast("string"), F.lit("\0"))), ["_group", order, *ties])
    spans = parts.groupBy("_group", "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("_group", "_part", (F.col("_first") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_from"))
    numbered = parts.join(spans, ["_group", "_part"]).withColumn(name, F.col("_place") - F.col("_from"))
    return numbered.drop("_group", "_part", "_place", "_from")
