"""Working tables in the shared folder, and the few columns all operators derive alike."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.session import working_dir


def keep(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared working folder and read again.

    Cuts the lineage: later steps and retries read files instead of computing again.
    """
    path = working_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: str = "text") -> Column:
    """A text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
