"""Sums of item counts per key, in one go or as partial sums that merge."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..errors import MalformedBaskets
from ..functions.keys import KEYS
from ..functions.quantity import (
    FRACTION,
    WHOLE,
    ZEROS,
    fraction_part,
    is_blank,
    is_positive,
    large_part,
    parse_int,
    quantity,
    whole_part,
)
from .quality import items_reason, key_reason
from .reshape import category_columns, melt_baskets, quoted, valid_keys

# Exact sums, so the grouping of rows into batches cannot change a total.
SUM_FIELDS = [
    T.StructField("whole", T.LongType()),
    T.StructField("large", WHOLE),
    T.StructField("fraction", FRACTION),
    T.StructField("facts", T.LongType()),
]

# What did not count: why, and the raw values, NULL in rows that did.
REJECT_FIELDS = [
    T.StructField("reason", T.StringType()),
    T.StructField("raw_dow", T.StringType()),
    T.StructField("raw_hour", T.StringType()),
    T.StructField("raw_items", T.StringType()),
]

KEY_FIELDS = [
    T.StructField("order_dow", T.IntegerType()),
    T.StructField("order_hour_of_day", T.IntegerType()),
    T.StructField("category", T.StringType()),
]

LEDGER_SCHEMA = T.StructType([*KEY_FIELDS, *REJECT_FIELDS, *SUM_FIELDS])
LEDGER_KEYS = tuple(f.name for f in [*KEY_FIELDS, *REJECT_FIELDS])

# The reason of the row that counts input baskets; it rejects nothing.
BASKETS = "(baskets)"
# The reason of rows that name the files read; they reject nothing either.
FILES = "(file)"
# Where a wide table's keys travel through the melt; no category may be called so.
RESERVED = "_basketflow_key"

# Stands for a sum past the digits of a DECIMAL; no BIGINT holds it either.
BEYOND = "9" * 38
LARGEST_TOTAL = 2**63 - 1


def positive_items(df: DataFrame, items: str = "items") -> DataFrame:
    """Rows with a quantity of at least one; adds it as DOUBLE ``quantity``."""
    dtype = df.schema[items].dataType
    return df.filter(is_positive(F.col(items), dtype)).withColumn(
        "quantity", quantity(F.col(items), dtype)
    )


def _large_sum(large: Column) -> Column:
    return F.when(F.count(large) > 0, F.coalesce(F.try_sum(large), F.lit(BEYOND).cast(WHOLE)))


def _sums(amount: Column, dtype: T.DataType, kept: Column | None = None) -> list[Column]:
    """The sum columns of ``amount``, of the rows in ``kept`` only if given."""

    def of(part: Column) -> Column:
        return part if kept is None else F.when(kept, part)

    fraction = F.lit(None).cast(FRACTION)
    if not isinstance(dtype, T.IntegralType):
        fraction = F.sum(of(fraction_part(amount, dtype)))
    return [
        F.coalesce(F.sum(of(whole_part(amount, dtype))), F.lit(0).cast("bigint")).alias("whole"),
        _large_sum(of(large_part(amount, dtype))).alias("large"),
        fraction.alias("fraction"),
        F.count(F.lit(1)).alias("facts"),
    ]


def partial_totals(facts: DataFrame, keys: Sequence[str] = KEYS, items: str = "items") -> DataFrame:
    """Positive quantities of ``facts`` summed per key, not yet truncated."""
    dtype = facts.schema[items].dataType
    amount = F.col(items)
    return facts.filter(is_positive(amount, dtype)).groupBy(*keys).agg(*_sums(amount, dtype))


def merge_partials(partials: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Partial sums of several batches folded into one row per key."""
    return partials.groupBy(*keys).agg(
        F.sum("whole").alias("whole"),
        _large_sum(F.col("large")).alias("large"),
        F.sum("fraction").alias("fraction"),
        F.sum("facts").alias("facts"),
    )


def _carried() -> Column:
    return F.coalesce(F.floor("fraction").cast("bigint"), F.lit(0).cast("bigint"))


def _exact_total() -> Column:
    """The total as DECIMAL, NULL past its digits."""
    whole = (F.col("whole") + _carried()).cast(WHOLE)
    return F.when(F.col("large") < F.lit(BEYOND).cast(WHOLE), F.try_add("large", whole))


def _overflows() -> Column:
    """Whether a total is more than BIGINT holds; sums without large parts never are."""
    return F.coalesce(
        F.col("large").isNotNull() & F.coalesce(_exact_total() > LARGEST_TOTAL, F.lit(True)), F.lit(False)
    )


def finish_totals(partials: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``items`` as BIGINT: whole sum plus the whole items the fractions add up to.

    A total that BIGINT cannot hold is left out here and listed by ``overflowed_totals``.
    """
    small = F.col("whole") + _carried()
    total = F.when(F.col("large").isNull(), small).otherwise(_exact_total().try_cast("bigint"))
    return partials.filter(~_overflows()).select(*keys, total.alias("items"))


def overflowed_totals(partials: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The keys whose total BIGINT cannot hold: keys as text, the total (NULL past 38 digits), cells."""
    return partials.filter(_overflows()).select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        _exact_total().cast("string").alias("items"),
        F.lit("total_too_large").alias("reason"),
        F.col("facts").alias("cells"),
    )


def total_items(facts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sum of the positive quantities of long facts per key."""
    return finish_totals(partial_totals(facts, keys), keys)


def basket_partials(
    baskets: DataFrame, id_columns: Sequence[str], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Wide baskets to partial sums: type the keys, melt, keep positives, sum.

    ``keys`` may name further id columns to sum by.
    """
    kept = [k for k in keys if k != "category"]
    return partial_totals(melt_baskets(valid_keys(baskets), id_columns, kept), keys)


def basket_totals(baskets: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """Wide baskets to the aggregate table, one row per weekday, hour and category."""
    return finish_totals(basket_partials(baskets, id_columns))


# --- sums and rejects in one pass ---------------------------------------------------


def ledger_key(
    df: DataFrame,
    dow: str = "order_dow",
    hour: str = "order_hour_of_day",
    extra: Sequence[str] = (),
    malformed: Column | None = None,
) -> Column:
    """Typed keys, or the reason and the raw values where they cannot be typed."""
    reason = key_reason(df, dow, hour)
    day, time = F.col(quoted(dow)), F.col(quoted(hour))
    good = reason.isNull()
    return F.struct(
        *[F.col(quoted(name)).alias(name) for name in extra],
        F.when(good, parse_int(day, df.schema[dow].dataType)).alias("order_dow"),
        F.when(good, parse_int(time, df.schema[hour].dataType)).alias("order_hour_of_day"),
        reason.alias("reason"),
        F.when(~good, day.cast("string")).alias("raw_dow"),
        F.when(~good, time.cast("string")).alias("raw_hour"),
        (F.lit(None).cast("string") if malformed is None else malformed).alias("malformed"),
    ).alias(RESERVED)


def _ledger(cells: DataFrame, extra: Sequence[str]) -> DataFrame:
    """Cells ``(RESERVED, category, items, fault)`` summed, or counted by what is wrong."""
    key, amount, dtype = F.col(RESERVED), F.col("items"), cells.schema["items"].dataType
    marker = F.col("category").isNull() & F.col("fault").isNull()
    worth_a_look = key["reason"].isNotNull() | F.col("fault").isNotNull()
    filled = ~is_blank(amount, dtype)
    if isinstance(dtype, T.StringType):
        filled = filled & (worth_a_look | ~amount.isin(*ZEROS))
    cell = ~marker & F.col("fault").isNull()  # not a whole line or basket
    broken = key["malformed"].isNotNull()
    reason = (
        F.when(marker, F.when(broken, "malformed_line").otherwise(BASKETS))
        .otherwise(F.coalesce("fault", key["reason"], items_reason(amount, dtype)))
    )
    noted = F.col("fault").eqNullSafe(F.lit(FILES))
    rows = cells.filter(marker | noted | (filled & ~broken)).select(
        *[key[name].alias(name) for name in extra],
        F.when(cell, key["order_dow"]).alias("order_dow"),
        F.when(cell, key["order_hour_of_day"]).alias("order_hour_of_day"),
        "category",
        reason.alias("reason"),
        F.when(cell, key["raw_dow"]).alias("raw_dow"),
        F.when(cell, key["raw_hour"]).alias("raw_hour"),
        "items",
        F.when(marker, key["malformed"]).alias("line"),
    )
    bad = F.col("reason").isNotNull()
    raw = F.when(bad, F.coalesce("line", F.col("items").cast("string")))
    counted = rows.filter(bad | is_positive(F.col("items"), dtype)).withColumn("raw_items", raw)
    return counted.groupBy(*extra, *LEDGER_KEYS).agg(*_sums(F.col("items"), dtype, ~bad))


def basket_ledger(
    baskets: DataFrame,
    id_columns: Sequence[str],
    extra: Sequence[str] = (),
    dow: str = "order_dow",
    hour: str = "order_hour_of_day",
    malformed: str | None = None,
    file: str | None = None,
) -> DataFrame:
    """Wide baskets to sums and rejects, in one pass and one exchange.

    Rows without ``reason`` are partial sums. The others say what was left out, with the raw
    values and how many cells had them; one per distinct value, so a fault in every row stays
    small. A row with the reason ``(baskets)`` per ``extra`` key counts the baskets, so a key
    without any positive quantity shows as well. ``malformed`` names the column that holds the
    text of lines with too few or too many fields; such a line is listed as it stands, and its
    cells do not count. ``file`` names a text column that tells the files apart: each of its values
    is listed once, with the reason ``(file)``, the value as ``raw_items`` and its lines as ``facts``.
    """
    ids = [*id_columns, *[name for name in (malformed, file) if name]]
    categories = category_columns(baskets, [*ids, *extra])
    if RESERVED in baskets.columns:
        raise MalformedBaskets(f"no column may be called {RESERVED}")
    for name in (dow, hour):
        if name not in id_columns:
            raise MalformedBaskets(f"{name} is not among the id columns {list(id_columns)}")
    text = bool(file) or any(isinstance(baskets.schema[c].dataType, T.StringType) for c in categories)
    as_text = [F.col(quoted(c)).cast("string") if text else F.col(quoted(c)) for c in categories]
    line = F.col(quoted(malformed)) if malformed else None
    cells = F.array(*as_text, F.lit(None), *([F.col(quoted(file))] if file else []))
    rows = baskets.select(ledger_key(baskets, dow, hour, extra, line), cells.alias("cells"))
    exploded = rows.select(RESERVED, F.posexplode("cells").alias("position", "items"))
    names = F.array(*[F.lit(c) for c in categories])
    fault = F.lit(None).cast("string")
    if file:
        fault = F.when(F.col("position") > len(categories), F.lit(FILES))
    melted = exploded.select(RESERVED, F.get(names, F.col("position")).alias("category"), "items", fault.alias("fault"))
    return _ledger(melted, extra)


def ledger_files(ledger: DataFrame) -> DataFrame:
    """``(file, lines)``: the files that a ledger was made from, where it was told them."""
    named = ledger.filter(F.col("reason") == FILES).withColumnRenamed("raw_items", "file")
    return named.groupBy("file").agg(F.sum("facts").alias("lines"))


def without_files(ledger: DataFrame) -> DataFrame:
    return ledger.filter(~F.col("reason").eqNullSafe(F.lit(FILES)))


def facts_ledger(facts: DataFrame, extra: Sequence[str] = (), dow: str = "order_dow", hour: str = "order_hour_of_day") -> DataFrame:
    """As ``basket_ledger``, for long facts with a column ``fault``; see ``melt_drifting_lines``.

    Facts that were melted with ``keyed`` bring their key along.
    """
    key = F.col(RESERVED) if RESERVED in facts.columns else ledger_key(facts, dow, hour, extra)
    return _ledger(facts.select(key, "category", "items", "fault"), extra)


def merge_ledger(ledger: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return merge_partials(ledger, [*extra, *LEDGER_KEYS])


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """The aggregate table of a ledger."""
    return finish_totals(merge_partials(ledger.filter("reason IS NULL")))


def ledger_rejects(ledger: DataFrame) -> DataFrame:
    """``(order_dow, order_hour_of_day, category, items, reason, cells)``: all that did not count.

    Raw values, and how many cells had them; totals too large for BIGINT come with their key.
    """
    raw = ledger.filter(F.col("reason").isNotNull() & ~F.col("reason").isin(BASKETS, FILES))
    cells = raw.select(
        F.coalesce("raw_dow", F.col("order_dow").cast("string")).alias("order_dow"),
        F.coalesce("raw_hour", F.col("order_hour_of_day").cast("string")).alias("order_hour_of_day"),
        "category",
        F.col("raw_items").alias("items"),
        "reason",
        "facts",
    )
    listed = cells.groupBy("order_dow", "order_hour_of_day", "category", "items", "reason").agg(F.sum("facts").alias("cells"))
    return listed.unionByName(overflowed_totals(merge_partials(ledger.filter("reason IS NULL"))))


def basket_totals_by_column(baskets: DataFrame, id_columns: Sequence[str]) -> DataFrame:
    """The same table with the sums taken per category column before the melt.

    One hash update per basket instead of one per non-empty cell, at the price of an
    aggregate row as wide as the baskets, which is slower on every width measured.
    """
    categories = category_columns(baskets, id_columns)
    keys = list(KEYS[:2])

    def cell_sums(name):
        dtype = baskets.schema[name].dataType
        amount = F.col(quoted(name))
        kept = is_positive(amount, dtype)
        sums = _sums(amount, dtype, kept)
        return F.struct(*sums[:3], F.count_if(kept).alias("facts")).alias(name)

    per_column = valid_keys(baskets).groupBy(*keys).agg(*[cell_sums(c) for c in categories])
    melted = per_column.unpivot(keys, [quoted(c) for c in categories], "category", "sums")
    return finish_totals(melted.select(*KEYS, "sums.*").filter("facts > 0"))
