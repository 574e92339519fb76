"""Model output: rounding, squared error and a preview."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import KEYS


def round_prediction(df: DataFrame, column: str = "prediction") -> DataFrame:
    """Prediction as INT, halves away from zero."""
    return df.withColumn(column, F.round(column).cast("int"))


def squared_error(df: DataFrame, label: str = "items", prediction: str = "prediction") -> DataFrame:
    return df.withColumn("squared_error", F.pow(F.col(label) - F.col(prediction), F.lit(2)))


def mean_squared_error(
    df: DataFrame, label: str = "items", prediction: str = "prediction"
) -> DataFrame:
    """One row, one column ``mse``."""
    return squared_error(df, label, prediction).agg(F.avg("squared_error").alias("mse"))


def preview(df: DataFrame, columns: Sequence[str], order: Sequence[str] = KEYS, rows: int = 20) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*order).limit(rows).select(*columns)


def category_mean_model(training: DataFrame) -> DataFrame:
    """(category, prediction): the mean of ``items`` per category.

    A baseline to hold the forest against, and a model plain SQL can express.
    """
    return training.groupBy("category").agg(F.avg("items").alias("prediction"))


def apply_category_means(rows: DataFrame, means: DataFrame) -> DataFrame:
    """Adds ``prediction`` from the category means; NULL for an unseen category."""
    return rows.join(means, "category", "left")
