"""Scans of wide basket CSV files, one folder per arrival day."""

import csv
import re
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..errors import EmptyInput, MalformedBaskets
from ..operators.aggregate import FILES, RESERVED, ledger_key
from ..session import working_dir
from . import files

# A day folder is called ``3`` or ``day=3``; ``day_=3`` where a category is called ``day``.
DAY_FOLDER = "day"
DAY_OF_PATH = r"/(?:day_*=)?([0-9]+)/[^/]*$"
MALFORMED = "_malformed_line"
# The folder's day next to a basket's columns; a category may well be called ``day``.
ARRIVAL_DAY = "_arrival_day"
# When a file was last changed, and its path; see ``file_mark``.
FILE_MARK = "_file_mark"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names in the header line of the first file that matches."""
    try:
        return spark.read.option("header", True).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise EmptyInput(path) from error
        raise


def malformed_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([*text_schema(columns).fields, T.StructField(MALFORMED, T.StringType())])


def csv_options(reader, keep_malformed: bool = False):
    """Header on, and a header that differs from the schema is an error.

    ``keep_malformed`` fills ``MALFORMED`` with the text of lines that have too few or too many
    fields; field counts are only checked when every column is parsed.
    """
    reader = reader.option("header", True).option("sep", ",").option("enforceSchema", False)
    if keep_malformed:
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
    return reader


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    keep_malformed: bool = False,
    folders: bool = False,
) -> DataFrame:
    """CSV files or globs as text columns, under one explicit schema.

    Without ``schema``, the first file's header names the columns; every other file has
    to agree with it. ``keep_malformed`` adds a column with the text of lines that have
    too few or too many fields. ``folders``: the paths are folders; their files need not be
    listed one by one to name them.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None:
        schema = text_schema(csv_columns(spark, f"{paths[0]}/*.csv" if folders else paths[0]))
    reader = csv_options(spark.read, keep_malformed)
    if keep_malformed:
        schema = malformed_schema(schema.names)
    if folders:
        reader = reader.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    try:
        return reader.schema(schema).csv(paths)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise EmptyInput(", ".join(paths)) from error
        raise


def day_of_file():
    """The arrival day, taken from the folder a row was read from."""
    return F.regexp_extract(F.col("_metadata.file_path"), DAY_OF_PATH, 1).try_cast("int")


def file_mark() -> Column:
    """A row's file: milliseconds of its last change, a blank, its path."""
    changed = F.unix_millis(F.col("_metadata.file_modification_time"))
    return F.concat_ws(" ", changed.cast("string"), F.col("_metadata.file_path"))


def marked_path(mark: Column) -> Column:
    return F.regexp_extract(mark, "^[0-9]+ (.*)$", 1)


def marked_time(mark: Column) -> Column:
    return F.substring_index(mark, " ", 1).cast("bigint")


def days_glob(root: str, days: Iterable[int]) -> str:
    names = ",".join(f"{day},day={day},day_*={day}" for day in sorted(set(days)))
    return f"{root}/{{{names}}}/*.csv"


def _folder_names(spark: SparkSession, root: str) -> dict[int, list[str]]:
    """Folders of each day, from one listing of the root."""
    found: dict[int, list[str]] = {}
    for path in files.glob(spark, f"{root}/*"):
        day = re.fullmatch(r"(?:day_*=)?([0-9]+)", path.rsplit("/", 1)[-1])
        if day:
            found.setdefault(int(day[1]), []).append(path)
    return found


def day_folders(spark: SparkSession, root: str) -> list[int]:
    """Days that have a folder, with or without files."""
    return sorted(_folder_names(spark, root))


def available_days(spark: SparkSession, root: str, among: Iterable[int] | None = None) -> list[int]:
    """Days (``among`` the given ones) whose folder holds at least one CSV file.

    One listing of the root and one of each folder asked for.
    """
    days = day_folders(spark, root) if among is None else among
    return sorted(d for d in days if files.exists(spark, days_glob(root, [d])))


def read_days(
    spark: SparkSession,
    root: str,
    days: Iterable[int],
    schema: T.StructType | None = None,
    with_day: bool = True,
    keep_malformed: bool = False,
) -> DataFrame:
    """The union of the given day folders in one scan; folders that are absent are skipped.

    ``with_day`` adds the folder's day as ``ARRIVAL_DAY``.
    """
    found = _folder_names(spark, root)
    paths = [path for day in sorted(set(days)) for path in found.get(day, [])]
    if not paths:
        raise EmptyInput(root)
    if schema is None:
        with_files = (p for p in paths if files.exists(spark, f"{p}/*.csv"))
        first = next(with_files, None)
        if first is None:
            raise EmptyInput(root)
        schema = text_schema(csv_columns(spark, f"{first}/*.csv"))
    baskets = read_csv(spark, paths, schema, keep_malformed, folders=True)
    return baskets.withColumn(ARRIVAL_DAY, day_of_file()) if with_day else baskets


def union_days(tables: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column one table lacks is NULL there."""
    tables = list(tables)
    if not tables:
        raise EmptyInput("no tables to unite")
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result


def melt_drifting_files(
    spark: SparkSession,
    path: str | list[str],
    id_columns: Sequence[str] = ("order_dow", "order_hour_of_day"),
    rejects: bool = False,
    keyed: bool = False,
) -> DataFrame:
    """``melt_drifting_lines`` over CSV files."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise EmptyInput(str(path)) from error
        raise
    return melt_drifting_lines(lines.select("value", *line_place()), id_columns, rejects=rejects, keyed=keyed)


def line_place() -> list[Column]:
    """``file`` and ``block`` of a line: its file, and where the part of it begins that a task reads."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]


def header_fields(line: str) -> list[str]:
    return next(csv.reader([line]))


# A comma with an even number of quotes after it; nothing is tried twice.
FIELD_END = r',(?=(?:[^"]*+"[^"]*+")*+[^"]*+$)'


def _may_be_header(id_columns: Sequence[str]) -> Column:
    """Whether a line has all names among its fields; most lines fail the first, cheap look."""
    names = F.array(*[F.lit(name.strip('"')) for name in id_columns])
    fields = F.transform(F.split("value", FIELD_END), lambda f: F.replace(F.trim(f, F.lit('"')), F.lit('""'), F.lit('"')))
    return F.when(
        F.contains("value", F.lit(id_columns[0].replace('"', '""'))), F.size(F.array_except(names, fields)) == 0
    ).otherwise(False)


def melt_drifting_lines(
    lines: DataFrame,
    id_columns: Sequence[str] = ("order_dow", "order_hour_of_day"),
    keep: Sequence[str] = (),
    rejects: bool = False,
    headers_at: str | None = None,
    mark: str | None = None,
    keyed: bool = False,
) -> DataFrame:
    """Long facts from CSV lines (``file``, ``block``, ``value``) whose files differ in their headers.

    Columns may come in any order, and any column but ``id_columns`` is a category. A header is a
    line that has all id columns among its fields; it holds for the lines after it in its file, up
    to the next one, so exports may follow each other in a file. Lines before the first header have
    no facts, nor do files without one. The text is read twice: the first pass writes headers and
    their places to ``headers_at`` (default: a working folder). Files are joined to theirs by
    a hash of the path, an array per file, which Spark broadcasts while that is small; the
    headers that differ, a few, are literals. ``keep`` names further columns of ``lines`` to retain.

    A line with fewer or more fields than its header has no facts. With ``rejects`` it
    comes as one row, its text as ``items`` and the ``fault`` ``malformed_line``, and so does every
    line without a header, with ``header_missing``; every other line
    comes with one more row that has neither category nor fault. ``mark`` names a text column: then each
    line comes with one more row yet, its value as ``items`` and the ``fault`` ``(file)``.
    ``keyed`` adds the key that ``facts_ledger`` sums by (``keep`` included), made once a line and
    not once a cell.
    """
    spark = lines.sparkSession
    # Numbers ascend within a block, and are the same whenever the lines are read.
    placed = lines.withColumn("line", F.monotonically_increasing_id())
    headers_at = headers_at or working_dir(spark, "headers")
    likely = placed.filter(_may_be_header(id_columns)).select(
        F.xxhash64("file").alias("of"), F.struct("block", "line").alias("at"), F.xxhash64("value").alias("header"), "value"
    )
    likely.write.mode("overwrite").parquet(headers_at)
    likely = spark.read.schema(likely.schema).parquet(headers_at)
    headers = {
        r.header: r.value
        for r in likely.select("header", "value").distinct().collect()
        if set(id_columns) <= set(header_fields(r.value))
    }
    if any(RESERVED in header_fields(line) for line in headers.values()):
        raise MalformedBaskets(f"no column may be called {RESERVED}")
    width = max((len(header_fields(line)) for line in headers.values()), default=1)

    def fields(line: Column) -> Column:
        # One field more than any header has, so that surplus cells show. The lambda keeps the
        # optimizer from parsing a line anew for every field of the struct.
        parsed = F.from_csv(line, ", ".join(f"c{i} string" for i in range(width + 1)))
        quoted = F.transform(F.array(parsed), lambda p: F.array(*[p[f"c{i}"] for i in range(width + 1)]))
        return F.when(F.contains(line, F.lit('"')), F.get(quoted, F.lit(0))).otherwise(F.split(line, ","))

    # A column without a name is no category, but it has its place.
    own = [
        F.transform(F.slice(fields(F.lit(line)), 1, len(header_fields(line))), lambda c: F.coalesce(c, F.lit("")))
        for line in headers.values()
    ]
    names_of = dict(zip(headers, spark.range(1).select(F.array(*own)).first()[0], strict=True)) if headers else {}
    in_file = likely.filter(F.col("header").isin(*headers)).groupBy("of").agg(
        F.sort_array(F.collect_list(F.struct("at", "header"))).alias("all")
    )
    # A header that repeats the one before it in its file changes nothing.
    new = lambda mark, i: (i == 0) | (mark["header"] != F.get("all", i - 1)["header"])
    marks = in_file.select("of", F.filter("all", new).alias("marks"))
    is_header = F.contains("value", F.lit(id_columns[0])) & F.col("value").isin(*headers.values())
    cells = placed.filter(~is_header & (F.col("value") != "")).withColumn("of", F.xxhash64("file"))
    # Without rejects, lines that have no header have no facts and need not be kept.
    here, only = F.struct("block", "line"), F.get("marks", F.lit(0))
    past = F.filter("marks", lambda mark: mark["at"] < here)
    header = F.when(F.size("marks") == 1, F.when(only["at"] < here, only["header"])).otherwise(
        F.try_element_at(past, F.lit(-1))["header"]
    )
    joined = cells.join(marks, "of", "left" if rejects else "inner").withColumns(
        {"header": header, "cells": fields(F.col("value"))}
    )
    names = F.lit(None).cast("array<string>")
    for code, own_names in names_of.items():
        names = F.when(F.col("header") == code, F.array(*map(F.lit, own_names))).otherwise(names)
    joined = joined.withColumn("names", names)
    ids = [F.get("cells", F.array_position("names", name).cast("int") - 1).alias(name) for name in id_columns]
    # Quoted commas make a line look longer, never shorter; beyond the header a cell tells.
    known = F.size("names")
    headless = F.col("header").isNull()
    bad = headless | (F.size(F.split("value", ",")) < known) | (F.coalesce(F.get("cells", known), F.lit("")) != "")
    pair = lambda name, cell: F.struct(name.cast("string").alias("names"), cell.cast("string").alias("cells"))
    whole = F.arrays_zip("names", F.slice("cells", F.lit(1), known).alias("cells"))
    if rejects:
        file = [pair(F.lit(RESERVED), F.col(mark))] if mark else []
        line = F.array(pair(F.lit(None), F.col("value")), *file)
        fault = F.when(headless, "header_missing").when(bad, "malformed_line")
        cell = F.when(bad, line).otherwise(F.concat(whole, F.array(pair(F.lit(""), F.lit(None)), *file)))
    else:
        cell = whole
        joined = joined.filter(~bad)
        fault = F.lit(None).cast("string")
    # Ids, fault and key are columns before the cells are, so that no cell makes them again. No list
    # of cells is empty; a plain explode would make them all twice, to look for those that are.
    by_line = joined.select(*keep, *ids, fault.alias("fault"), cell.alias("cell"))
    key = []
    if keyed:
        key = [RESERVED]
        by_line = by_line.withColumn(RESERVED, ledger_key(by_line, extra=keep))
    facts = by_line.select(*keep, *id_columns, "fault", *key, F.explode_outer("cell").alias("cell")).select(
        *keep, *id_columns, F.col("cell.names").alias("category"), F.nullif("cell.cells", F.lit("")).alias("items"), "fault", *key
    )
    if mark:
        is_mark = F.col("category").eqNullSafe(F.lit(RESERVED))
        facts = facts.withColumns(
            {"fault": F.when(is_mark, F.lit(FILES)).otherwise(F.col("fault")), "category": F.nullif("category", F.lit(RESERVED))}
        )
    named = F.col("category").isNotNull() & (F.col("category") != "") & ~F.col("category").isin(*id_columns)
    if not rejects:
        return facts.drop("fault").filter(named)
    return (
        facts.filter(named | F.col("fault").isNotNull() | (F.col("category") == ""))
        .withColumn("category", F.nullif("category", F.lit("")))
    )
