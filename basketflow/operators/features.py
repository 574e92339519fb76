"""Category index, one-hot vector and feature vector."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..functions.quantity import parse_int

NUMERIC_FEATURES = ("order_dow", "order_hour_of_day")


def cast_features(df: DataFrame) -> DataFrame:
    """Weekday and hour as INT, items as BIGINT; what is no integer becomes NULL."""
    return df.withColumns(
        {
            name: parse_int(F.col(name), df.schema[name].dataType, to)
            for name, to in (("order_dow", "int"), ("order_hour_of_day", "int"), ("items", "bigint"))
        }
    )


def category_indexer(strict: bool = False) -> StringIndexer:
    """Index by descending frequency, ties in alphabetical order.

    ``strict`` fails on a category that training did not see; otherwise it gets the
    one index after the last known label.
    """
    return StringIndexer(
        inputCol="category",
        outputCol="cat_idx",
        stringOrderType="frequencyDesc",
        handleInvalid="error" if strict else "keep",
    )


def category_encoder() -> OneHotEncoder:
    """One slot per index but the last.

    After a strict indexer the last index is the rarest known category. After a lenient
    one it is the index for unseen categories, so every known category has its slot.
    """
    return OneHotEncoder(inputCols=["cat_idx"], outputCols=["cat_vec"], dropLast=True)


def feature_assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=[*NUMERIC_FEATURES, "cat_vec"], outputCol="features")


def feature_stages(strict: bool = False) -> list:
    return [category_indexer(strict), category_encoder(), feature_assembler()]


def feature_pipeline(strict: bool = False) -> Pipeline:
    return Pipeline(stages=feature_stages(strict))


def unseen_categories(scoring: DataFrame, training: DataFrame) -> DataFrame:
    """Rows to score whose category the training rows do not hold."""
    return scoring.join(training.select("category").distinct(), "category", "left_anti")
