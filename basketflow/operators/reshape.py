"""Wide baskets to long facts."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..errors import MalformedBaskets
from ..functions.quantity import is_int, parse_int

WEEKDAYS = range(7)


def quoted(name: str) -> str:
    """A column name that Spark takes literally, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def category_columns(df: DataFrame, id_columns: Sequence[str]) -> list[str]:
    """Every column that is not an id column."""
    missing = [c for c in id_columns if c not in df.columns]
    if missing:
        raise MalformedBaskets(f"id columns {missing} not among {df.columns}")
    categories = [c for c in df.columns if c not in set(id_columns)]
    if not categories:
        raise MalformedBaskets(f"no category column besides {list(id_columns)}")
    return categories


def melt_baskets(
    df: DataFrame,
    id_columns: Sequence[str],
    keep: Sequence[str] = ("order_dow", "order_hour_of_day"),
) -> DataFrame:
    """One row (keep..., category, items) per basket and category column.

    The cells are gathered into an array first and exploded in a second step. Only the
    first step then sees the full width: a table of more than 100 columns would keep
    ``unpivot`` or ``stack`` out of generated code for every cell.
    """
    categories = category_columns(df, id_columns)
    kept = [F.col(quoted(c)) for c in keep]
    cells = df.select(*kept, F.array(*[F.col(quoted(c)) for c in categories]).alias("_cells"))
    exploded = cells.select(*kept, F.posexplode("_cells").alias("_position", "items"))
    names = F.array(*[F.lit(c) for c in categories])
    return exploded.select(*kept, F.get(names, F.col("_position")).alias("category"), "items")


def has_valid_keys(df: DataFrame, dow: str = "order_dow", hour: str = "order_hour_of_day") -> Column:
    """Whether a row's weekday is 0..6 and its hour an integer.

    Typed columns are compared as they are, so that the test reaches the Parquet scan.
    """
    conditions = []
    for name, low, high in ((dow, WEEKDAYS[0], WEEKDAYS[-1]), (hour, -(2**31), 2**31 - 1)):
        column, dtype = F.col(quoted(name)), df.schema[name].dataType
        if isinstance(dtype, T.IntegralType):
            wide = isinstance(dtype, T.LongType)
            conditions.append(column.isNotNull() & column.between(low, high) if wide or name == dow else column.isNotNull())
        else:
            conditions.append(F.when(is_int(column, dtype), column.try_cast("int").between(low, high)))
    return conditions[0] & conditions[1]


def valid_keys(
    df: DataFrame, dow: str = "order_dow", hour: str = "order_hour_of_day"
) -> DataFrame:
    """Rows whose weekday is 0..6 and whose hour is an integer, keys typed."""
    typed = {name: parse_int(F.col(quoted(name)), df.schema[name].dataType) for name in (dow, hour)}
    return df.filter(has_valid_keys(df, dow, hour)).withColumns(typed)
