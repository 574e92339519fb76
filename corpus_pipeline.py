"""From raw documents to training records: each stage works on all that the one before kept."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import mixing, records
from basketflow.llm.decontaminate import keep_clean
from basketflow.llm.simhash import keep_first
from basketflow.llm.tables import documents, keep
from basketflow.llm.toxicity import keep_civil
from basketflow.session import working_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is low."""
    return keep_civil(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return keep_first(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mix."""
    return mixing.in_mixed_order(docs, mixing.TARGET_PARTS, mixing.BLOCK_ROWS)


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as a record of token ids, in the order in which the mix was written.

    ``docs`` is a Parquet table; the rows are read back from the record files.
    """
    folder = working_dir(spark, "training-records")
    records.write_records(docs, folder, records.tokenizer_path(), mixing.written_order())
    read = records.read_digests(spark, folder)
    return read.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32", "shard", "position")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
    ("token_records", token_records),
]

# Neither regression nor fingerprints can be said in SQL; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage reads the table that the one before wrote."""
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = keep(docs, f"stage-{number}-{name}")
    return docs
