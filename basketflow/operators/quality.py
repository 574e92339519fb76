"""What the positive-quantity and weekday filters leave out, with the reason."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.quantity import MOST, is_blank, parse_int, quantity
from .reshape import WEEKDAYS, melt_baskets, quoted


def key_reason(df: DataFrame, dow: str, hour: str) -> Column:
    """NULL for a usable key; otherwise the first thing wrong with it."""
    dow_type, hour_type = df.schema[dow].dataType, df.schema[hour].dataType
    dow_column, hour_column = F.col(quoted(dow)), F.col(quoted(hour))
    day = parse_int(dow_column, dow_type)
    return (
        F.when(is_blank(dow_column, dow_type), "order_dow_missing")
        .when(day.isNull(), "order_dow_not_integer")
        .when(~day.between(WEEKDAYS[0], WEEKDAYS[-1]), "order_dow_out_of_range")
        .when(is_blank(hour_column, hour_type), "order_hour_missing")
        .when(parse_int(hour_column, hour_type).isNull(), "order_hour_not_integer")
    )


def items_reason(items: Column, dtype: T.DataType) -> Column:
    """NULL for a number that a DECIMAL holds; otherwise what is wrong with a filled cell."""
    number = quantity(items, dtype)
    return F.when(number.isNull(), "items_not_numeric").when(number >= F.lit(MOST), "items_too_large")


def quarantined_facts(
    facts: DataFrame,
    dow: str = "order_dow",
    hour: str = "order_hour_of_day",
    items: str = "items",
) -> DataFrame:
    """Non-empty cells that cannot be counted, raw values kept, with ``reason``.

    Zero and negative quantities are not errors and are not listed.
    """
    filled = facts.filter(~is_blank(F.col(items), facts.schema[items].dataType))
    reason = F.coalesce(key_reason(filled, dow, hour), items_reason(F.col(items), filled.schema[items].dataType))
    return filled.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def quarantined_cells(baskets: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """``quarantined_facts`` for wide baskets, melted first."""
    return quarantined_facts(melt_baskets(baskets, id_columns))


def quarantined_baskets(
    baskets: DataFrame,
    dow: str = "order_dow",
    hour: str = "order_hour_of_day",
    malformed: str | None = None,
) -> DataFrame:
    """Whole basket rows that no weekday folder takes in, with ``reason``.

    ``malformed`` names the column that holds the text of lines the CSV reader could
    not fit to the schema; such lines are reported as they stand.
    """
    reason = key_reason(baskets, dow, hour)
    if malformed:
        reason = F.when(F.col(malformed).isNotNull(), "malformed_line").otherwise(reason)
    return baskets.withColumn("reason", reason).filter(F.col("reason").isNotNull())
