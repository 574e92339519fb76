"""Parsing of item counts and integer keys that arrive as text.

A quantity is kept in up to three columns that add up exactly, in any order, so the sum over any
batching of the input equals the sum over all of it at once: its whole part as BIGINT, or as
DECIMAL from ``LARGE`` on, and its fraction, if there is one, as DECIMAL. Nearly all cells are
small whole numbers and never touch decimal arithmetic; their BIGINT sum has room for
9 * 10**12 cells a key.
"""

from pyspark.sql import Column, functions as F, types as T

# Plain decimal notation, and the most digits a DECIMAL holds.
NUMBER_PATTERN = r"^\s*[+-]?[0-9]+([.][0-9]*)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
LARGE = 1_000_000
MOST = 1e38

# How an empty cell is usually written where it is not left empty.
ZEROS = ("0", "0.0")

FRACTION = T.DecimalType(38, 18)
WHOLE = T.DecimalType(38, 0)


def is_int(column: Column, dtype: T.DataType) -> Column:
    """Whether the text of a column has the form of an integer.

    The pattern comes before any cast of text that may be anything: a failing
    ``try_cast`` raises and catches an exception inside the task, a hundred times the
    price of the pattern.
    """
    if isinstance(dtype, T.StringType):
        return column.rlike(INTEGER_PATTERN)
    return column.isNotNull()


def parse_int(column: Column, dtype: T.DataType, to: str = "int") -> Column:
    """Integer value of a column, NULL where its text is no integer or out of range."""
    if isinstance(dtype, T.StringType):
        return F.when(is_int(column, dtype), column.try_cast(to))
    return column.try_cast(to)


def quantity(column: Column, dtype: T.DataType) -> Column:
    """The quantity as DOUBLE, NULL where the cell holds no number."""
    if isinstance(dtype, T.StringType):
        return F.when(column.rlike(NUMBER_PATTERN), column.try_cast("double"))
    return column.cast("double")


def is_positive(column: Column, dtype: T.DataType) -> Column:
    """The positive-quantity rule: at least 1, and no more digits than a DECIMAL has.

    Most cells of a wide table are empty or zero; they are told apart by a comparison of
    bytes and never parsed.
    """
    if isinstance(dtype, T.IntegralType):
        return column >= 1
    number = column.try_cast("double")
    in_range = (number >= 1) & (number < F.lit(MOST))
    if isinstance(dtype, T.StringType):
        in_range = F.when(column.rlike(NUMBER_PATTERN), in_range).otherwise(False)
        for zero in reversed(ZEROS):
            in_range = (column != zero) & in_range
    return in_range


def whole_part(column: Column, dtype: T.DataType) -> Column:
    """Whole part, as BIGINT, of a quantity that passed ``is_positive``; NULL from ``LARGE`` on."""
    if isinstance(dtype, T.IntegralType):
        return F.when(column < LARGE, column.cast("bigint"))
    number = column.try_cast("double")
    return F.when(number < LARGE, F.floor(number))


def large_part(column: Column, dtype: T.DataType) -> Column:
    """Whole part, as DECIMAL, of a quantity of ``LARGE`` or more; NULL below."""
    if isinstance(dtype, T.StringType):
        digits = F.regexp_extract(column, r"([0-9]+)", 1)
        return F.when(column.try_cast("double") >= LARGE, digits.try_cast(WHOLE))
    if isinstance(dtype, T.IntegralType):
        return F.when(column >= LARGE, column.cast(WHOLE))
    # A DOUBLE of this size may have a fraction; DECIMAL is cut below, never rounded up.
    return F.when(column >= LARGE, F.floor(column).try_cast(WHOLE))


def fraction_part(column: Column, dtype: T.DataType) -> Column:
    """What the whole part leaves over, NULL where that is nothing."""
    if isinstance(dtype, T.IntegralType):
        return F.lit(None).cast(FRACTION)
    if isinstance(dtype, T.StringType):
        digits = F.regexp_extract(column, r"[.]([0-9]*)", 1)
        parsed = F.concat(F.lit("0."), digits).try_cast(FRACTION)
        return F.when(column.contains("."), F.nullif(parsed, F.lit(0).cast(FRACTION)))
    number = column.try_cast("double")
    exact = column.try_cast(FRACTION)
    return F.when(number != F.floor(number), (exact - F.floor(exact)).cast(FRACTION))


def is_blank(column: Column, dtype: T.DataType) -> Column:
    """An empty cell: nothing was ordered, and nothing is wrong."""
    if isinstance(dtype, T.StringType):
        return column.isNull() | (F.trim(column) == "")
    return column.isNull()
