"""The fitted forest as a table, and rows scored by it in DataFrame expressions.

The table is read from the saved model (its nodes lie there as parquet): one row
per node, at most trees x 2^(depth + 1) of them, whatever the data.  Scoring
walks every tree by array look-ups, in one projection: no shuffle, no UDF.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAF = -1


def save_forest(spark: SparkSession, forest: RandomForestClassificationModel, path: str) -> DataFrame:
    """Save the forest to ``path`` and return its table."""
    forest.write().overwrite().save(path)
    return forest_table(spark, path)


def forest_table(spark: SparkSession, path: str) -> DataFrame:
    """(tree, node, feature, threshold, categories, left, right, n, impurity, gain, counts, shares) of a saved forest.

    Nodes are numbered from the root, 0.  A leaf has the feature -1.  A split sends values up to ``threshold`` to the
    left or, of a category, those in ``categories``.  ``shares`` are the classes' shares of the (bootstrapped) rows.
    """
    n = F.col("nodeData")
    inner = n["split"]["featureIndex"] >= 0
    ordered = n["split"]["numCategories"] == -1
    values, counts = n["split"]["leftCategoriesOrThreshold"], n["impurityStats"]
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return spark.read.parquet(f"{path.rstrip('/')}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"), n["split"]["featureIndex"].alias("feature"),
        F.when(inner & ordered, values[0]).alias("threshold"), F.when(inner & ~ordered, values).alias("categories"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["rawCount"].alias("n"), n["impurity"].alias("impurity"),
        n["gain"].alias("gain"), counts.alias("counts"), F.transform(counts, lambda x: x / total).alias("shares"))


def _leaf(x: Column, nodes: list, depth: int) -> Column:
    """Number of the leaf that the array ``x`` of features reaches."""
    feature, left, right = (F.lit([r[c] for r in nodes]) for c in ("feature", "left", "right"))
    threshold = F.lit([0.0 if r.threshold is None else r.threshold for r in nodes])
    listed = F.lit([r.categories is not None for r in nodes])
    categories = F.array(*[F.lit(list(r.categories or [LEAF * 1.0])) for r in nodes])

    def step(at: Column, _: Column) -> Column:
        value = F.get(x, F.get(feature, at))
        to_left = F.when(F.get(listed, at), F.array_contains(F.get(categories, at), value)).otherwise(value <= F.get(threshold, at))
        return F.when(F.get(feature, at) == LEAF, at).when(to_left, F.get(left, at)).otherwise(F.get(right, at))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step)


def _depth(nodes: list) -> int:
    deep = {0: 0}
    for r in nodes:  # a parent comes before its children
        if r.feature != LEAF:
            deep[r.left] = deep[r.right] = deep[r.node] + 1
    return max(deep.values())


def score(rows: DataFrame, table: DataFrame, features_col: str = "features", prediction_col: str = "prediction") -> DataFrame:
    """``rows`` with the votes of each class, ``votes``, and the class with the most, the first of equals.

    ``features_col`` is a vector or an array of doubles; a row without one has no votes and no prediction.
    """
    trees: dict[int, list] = {}
    for r in table.orderBy("tree", "node").collect():  # bounded by trees and depth
        trees.setdefault(r.tree, []).append(r)
    kind = rows.schema[features_col].dataType.typeName()
    x = F.col(features_col) if kind == "array" else vector_to_array(features_col)
    leaves = {f"__leaf{t}": _leaf(x, nodes, _depth(nodes)) for t, nodes in trees.items()}
    found = rows.withColumns(leaves)
    votes = []
    for c in range(len(trees[0][0].shares)):
        vote = F.lit(0.0)
        for t, nodes in trees.items():
            vote = vote + F.get(F.lit([r.shares[c] for r in nodes]), F.col(f"__leaf{t}"))
        votes.append(vote)
    found = found.withColumn("votes", F.when(F.col(features_col).isNotNull(), F.array(*votes))).drop(*leaves)
    best = (F.array_position("votes", F.array_max("votes")) - 1).cast("double")
    return found.withColumn(prediction_col, best)
