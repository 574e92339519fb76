"""Training of the demand forest, version by version."""

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..errors import EmptyInput
from ..functions.keys import KEYS
from ..operators.features import feature_stages, unseen_categories
from ..operators.metrics import squared_error
from ..operators.sampling import label_split
from ..sinks.runlog import logged_run
from ..sources.models import METRICS_SCHEMA, ModelStore
from ..sources.tables import literal_rows


@dataclass(frozen=True)
class ForestSettings:
    # Fixed values of the demand model.
    num_trees: int = 50
    max_depth: int = 5
    test_share: float = 0.1
    seed: int = 42
    # Fail on unseen categories and drop the rarest category's slot.
    strict: bool = False
    # Bagging draws per partition, so the row layout is part of the model's definition.
    rows_per_partition: int = 100_000


def forest(settings: ForestSettings) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features",
        labelCol="items",
        predictionCol="prediction",
        numTrees=settings.num_trees,
        maxDepth=settings.max_depth,
        seed=settings.seed,
    )


def fixed_layout(rows: DataFrame, partitions: int) -> DataFrame:
    """The same rows in the same partitions and order on every run."""
    return rows.repartition(partitions, *KEYS).sortWithinPartitions(*KEYS, "items")


def fit_forest(
    train: DataFrame, settings: ForestSettings = ForestSettings(), rows: int | None = None
) -> PipelineModel:
    """Index, one-hot, assemble and forest as one fitted pipeline.

    The layout follows from the number of rows; it is kept while the stages pass over it.
    """
    rows = train.count() if rows is None else rows
    stages = [*feature_stages(settings.strict), forest(settings)]
    laid_out = fixed_layout(train, max(1, -(-rows // settings.rows_per_partition))).persist()
    try:
        return Pipeline(stages=stages).fit(laid_out)
    finally:
        laid_out.unpersist()


def fingerprint(totals: DataFrame) -> str:
    """A checksum of an aggregate table, whatever the order of its rows."""
    digest = F.xxhash64(*totals.columns).cast("decimal(38,0)")
    return "/".join(str(v) for v in totals.agg(F.count(F.lit(1)), F.sum(digest)).first())


def train_model(
    spark: SparkSession,
    totals: DataFrame,
    store: ModelStore,
    settings: ForestSettings = ForestSettings(),
    run_log: str | None = None,
) -> int:
    """Split, fit, evaluate, save and publish; returns the new model version.

    The split is written once and both halves are read back from it, so the aggregate
    is computed a single time and the test set stays with its model.
    """
    with logged_run(spark, run_log, "train", output=store.root) as log:
        version = store.claim_version()
        labelled = label_split(totals, settings.test_share, seed=settings.seed)
        store.save_split(version, labelled)
        try:
            train, test = store.split(version, "train"), store.split(version, "test")
        except EmptyInput:
            log("no input", batch_id=version)
            raise
        n_train = train.count()
        model = fit_forest(train, settings, n_train)
        store.save_model(version, model)
        quality = (
            squared_error(model.transform(test))
            .agg(F.count(F.lit(1)).alias("n_test"), F.avg("squared_error").alias("mse"))
            .first()
        )
        row = (version, n_train, quality["n_test"], unseen_categories(test, train).count(), quality["mse"])
        both = train.unionByName(test).select(*totals.columns)
        store.save_input(version, fingerprint(both))
        store.publish(version, literal_rows(spark, [row], METRICS_SCHEMA))
        log("done", batch_id=version)
    return version


def train_if_changed(
    spark: SparkSession,
    totals: DataFrame,
    store: ModelStore,
    settings: ForestSettings = ForestSettings(),
    run_log: str | None = None,
    state: str | None = None,
) -> int | None:
    """``train_model``, unless the newest version was trained on just these totals.

    ``state`` is the version of the kept state that ``totals`` come from (``AggregationState.version``,
    asked for before them); if the newest model was found to agree with it before, nothing is read.
    """
    versions = store.versions()
    known = bool(versions and state) and store.state(versions[-1]) == state
    if known or (versions and store.input(versions[-1]) == fingerprint(totals.select(*KEYS, "items"))):
        with logged_run(spark, run_log, "train") as log:
            log("idle")
        if state and not known:
            store.save_state(versions[-1], state)
        return None
    version = train_model(spark, totals.select(*KEYS, "items"), store, settings, run_log)
    if state:
        store.save_state(version, state)
    return version
