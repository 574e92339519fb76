"""Connected components of a graph given as a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.tables import keep


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is one node per component.

    Each round hooks every node to its smallest neighbour, follows the hooks to their end and
    replaces both ends of each edge by the roots found; edges inside a component vanish. The
    number of rounds grows with the logarithm of the longest path. Every round is a table, so
    neither lineage nor driver memory grows. Minima are summed up before each shuffle, and the
    joins read plain tables on both sides, which lets Spark split a node with many edges.
    """
    edges = keep(_between_roots(edges), "edges")
    labels = None
    while edges.take(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root"))
        hooks = _follow(keep(hooks, "hooks"))
        labels = hooks if labels is None else keep(_relabel(labels, "root", hooks), "labels")
        edges = keep(_between_roots(_relabel(_relabel(edges, "a", hooks), "b", hooks)), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def _between_roots(edges: DataFrame) -> DataFrame:
    return (
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b")
        .distinct()
    )


def _relabel(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """``column`` replaced by its root, where ``hooks`` has one."""
    to = hooks.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    joined = df.join(to, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_root", column)).drop("_node", "_root")


def _follow(hooks: DataFrame) -> DataFrame:
    """Hooks that lead to the end of their chain; each pass halves the way."""
    while True:
        jumped = keep(_relabel(hooks.withColumn("was", F.col("root")), "root", hooks), "hooks")
        changed = jumped.where("root <> was").take(1)
        hooks = jumped.drop("was")
        if not changed:
            return hooks
