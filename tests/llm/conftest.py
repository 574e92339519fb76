import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows, partitions=3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make


@pytest.fixture
def sf_dir_of(spark, tmp_path):
    """Writes tables as {name}.parquet into a folder and returns the folder."""

    def make(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
