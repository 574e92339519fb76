"""Versioned model directory: fitted model, its data split and its metrics."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, types as T

from ..errors import EmptyInput, ModelNotFound
from . import files

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("model_version", T.IntegerType()),
        T.StructField("n_train", T.LongType()),
        T.StructField("n_test", T.LongType()),
        T.StructField("n_unseen", T.LongType()),
        T.StructField("mse", T.DoubleType()),
    ]
)


class ModelStore:
    """``v=N/{split,model,metrics}`` under one root.

    A version is published by its metrics, which are written last. A reader that resolves
    a version once gets a model and a test set that belong together, however many
    trainings finish meanwhile.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def claim_version(self) -> int:
        """A version of one's own: trainings that run at once get different ones."""
        return files.claim_number(
            self.spark,
            f"{self.root}/claims",
            lambda: max(files.numbered_dirs(self.spark, self.root, prefix="v="), default=0),
        )

    def versions(self) -> list[int]:
        return files.numbered_dirs(
            self.spark, self.root, prefix="v=", marker="metrics/_SUCCESS"
        )

    def current(self) -> int:
        versions = self.versions()
        if not versions:
            raise ModelNotFound(self.root)
        return versions[-1]

    def save_split(self, version: int, labelled: DataFrame) -> None:
        """Write the rows with their ``split`` label once; training and scoring read it."""
        labelled.write.mode("overwrite").partitionBy("split").parquet(f"{self._dir(version)}/split")

    def split(self, version: int, name: str) -> DataFrame:
        path = f"{self._dir(version)}/split"
        if not files.exists(self.spark, f"{path}/split={name}"):
            raise EmptyInput(f"{path}/split={name}")
        return self.spark.read.parquet(path).filter(f"split = '{name}'").drop("split")

    def save_model(self, version: int, model: PipelineModel) -> None:
        model.write().overwrite().save(f"{self._dir(version)}/model")

    def load(self, version: int | None = None) -> PipelineModel:
        version = self.current() if version is None else version
        path = f"{self._dir(version)}/model"
        if not files.exists(self.spark, path):
            raise ModelNotFound(path)
        return PipelineModel.load(path)

    def nodes(self, version: int | None = None) -> DataFrame:
        """The forest's nodes as they were saved, one row each; see ``operators.forest``."""
        version = self.current() if version is None else version
        found = files.glob(self.spark, f"{self._dir(version)}/model/stages/*/treesMetadata")
        if not found:
            raise ModelNotFound(f"{self._dir(version)}/model")
        return self.spark.read.parquet(f"{found[0].rsplit('/', 1)[0]}/data")

    def publish(self, version: int, metrics: DataFrame) -> None:
        metrics.write.mode("overwrite").parquet(f"{self._dir(version)}/metrics")

    def save_input(self, version: int, fingerprint: str) -> None:
        """Note what the version was trained on; before ``publish``."""
        row = self.spark.createDataFrame([(fingerprint,)], "fingerprint string")
        row.coalesce(1).write.mode("overwrite").text(f"{self._dir(version)}/input")

    def input(self, version: int | None = None) -> str | None:
        version = self.current() if version is None else version
        path = f"{self._dir(version)}/input"
        if not files.exists(self.spark, path):
            return None
        return self.spark.read.text(path).first()[0]

    def save_state(self, version: int, state: str) -> None:
        """Note the version of the kept state whose totals this model was found to be trained on."""
        files.write_text(self.spark, f"{self._dir(version)}/_state", state)

    def state(self, version: int) -> str | None:
        return files.read_text(self.spark, f"{self._dir(version)}/_state")

    def metrics(self, version: int | None = None) -> DataFrame:
        version = self.current() if version is None else version
        return self.spark.read.schema(METRICS_SCHEMA).parquet(f"{self._dir(version)}/metrics")

    def _dir(self, version: int) -> str:
        return f"{self.root}/v={version}"
