"""A fitted forest as a table of nodes, evaluated by joins, a level of the trees at a time.

For callers who want scores where the model cannot be loaded, such as a SQL warehouse, and to
hold the model's own scores against.
"""

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import KEYS
from .features import NUMERIC_FEATURES


def forest_nodes(saved: DataFrame) -> DataFrame:
    """``(tree, node, feature, categorical, bounds, left, right, value)`` of a forest's saved node data.

    A leaf has ``feature`` -1. ``bounds`` holds a threshold, or the categories that go left.
    """
    node, split = F.col("nodeData"), F.col("nodeData.split")
    return saved.select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        split["featureIndex"].alias("feature"),
        (split["numCategories"] >= 0).alias("categorical"),
        split["leftCategoriesOrThreshold"].alias("bounds"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["prediction"].alias("value"),
    )


def _feature(number: Column) -> Column:
    """The value of a feature by its number: the numeric ones, then a slot per category."""
    value = (F.col("cat_idx") == number - len(NUMERIC_FEATURES)).cast("double")
    for i, name in enumerate(NUMERIC_FEATURES):
        value = F.when(number == i, F.col(name).cast("double")).otherwise(value)
    return value


def forest_scores(rows: DataFrame, model: PipelineModel, nodes: DataFrame) -> DataFrame:
    """``rows`` with the forest's ``prediction``, not rounded, from the node table.

    Each different key goes down each tree once: a row per key and tree, which every level's join
    moves on to a child. The node table grows with the model alone, and Spark broadcasts it while it
    is small. Values are added up in the order of the trees, so the sum is the model's own to the
    last bit. A key without weekday or hour gets NULL, where the model would fail.
    """
    indexer, trees = model.stages[0], model.stages[-1].trees
    keys = rows.select(*KEYS).distinct().dropna(subset=list(NUMERIC_FEATURES))
    at = indexer.transform(keys).select(
        *KEYS, "cat_idx", F.explode(F.sequence(F.lit(0), F.lit(len(trees) - 1))).alias("tree"), F.lit(0).alias("node")
    )
    feature, bounds = F.col("feature"), F.col("bounds")
    goes_left = F.when(F.col("categorical"), F.array_contains(bounds, _feature(feature))).otherwise(
        _feature(feature) <= F.get(bounds, F.lit(0))
    )
    child = F.when(feature < 0, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
    for _ in range(max(tree.depth for tree in trees)):
        at = at.join(nodes, ["tree", "node"]).select(*KEYS, "cat_idx", "tree", child.alias("node"))
    leaves = at.join(nodes, ["tree", "node"]).groupBy(*KEYS).agg(
        F.sort_array(F.collect_list(F.struct("tree", "value"))).alias("values")
    )
    total = F.aggregate("values", F.lit(0.0), lambda sum, x: sum + x["value"])
    scores = leaves.select(*[F.col(k).alias(f"_{k}") for k in KEYS], (total / len(trees)).alias("prediction"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEYS]
    return rows.join(scores, same, "left").drop(*[f"_{k}" for k in KEYS])
