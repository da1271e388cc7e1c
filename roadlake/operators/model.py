"""Severity classifier: random forest over the feature frame.

Fixed values: 80/20 split with seed 42; 20 trees, ``maxBins`` 200, other
forest parameters at their defaults (depth 5, gini, bootstrap).

A row's part is decided by a hash of its ``ID`` and the seed, so it is the same
at any partitioning.  The category indexers are fitted on all rows (before the
split) and the forest on the training part; the saved artefact is one
``PipelineModel`` (calendar columns, casts, indexers, assembler, forest) that
scores joined Silver rows as they are, Severity not needed; rows with a NULL or
unknown feature are skipped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlake import schema as S
from roadlake.functions.columns import c
from roadlake.operators.features import assembler, label_indexer, preparation, prepare_features

# --- fixed values -----------------------------------------------------------
SPLIT_WEIGHTS = (0.8, 0.2)
SEED = 42
NUM_TREES = 20
MAX_BINS = 200
# ---------------------------------------------------------------------------


@dataclass
class Trained:
    pipeline: PipelineModel
    data: DataFrame
    forest: RandomForestClassificationModel
    train: DataFrame
    test: DataFrame
    predictions: DataFrame
    features: list[str]


def labelled(joined: DataFrame):
    """Feature frame with ``label`` and assembled ``features``; plus its pieces."""
    df, features, cat_models = prepare_features(joined)
    lab = label_indexer().fit(df)
    vec = assembler(features)
    out = vec.transform(lab.transform(df))
    return out, features, cat_models, lab, vec


def split(df: DataFrame, weights=SPLIT_WEIGHTS, seed: int = SEED, key: str = S.KEY):
    """(train, test): the first 32 bits of the MD5 of ``<key>-<seed>``, as a share of all, against the weights."""
    bits = F.conv(F.substring(F.md5(F.concat(c(key).cast("string"), F.lit(f"-{seed}"))), 1, 8), 16, 10)
    training = bits.cast("double") < weights[0] / sum(weights) * 2**32
    return df.filter(training), df.filter(~training)


def forest() -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=NUM_TREES,
                                  maxBins=MAX_BINS, seed=SEED)


def train_model(joined: DataFrame) -> Trained:
    """Fit on the joined Silver frame.  Raises ``ValueError`` when nothing is left to learn from."""
    data, features, cat_models, lab, vec = labelled(joined)
    data = data.select(S.KEY, "label", "features")
    if data.isEmpty():
        raise ValueError("no training rows left after NULL filtering")
    train, test = split(data)
    rf = forest().fit(train)
    pipeline = PipelineModel(stages=[*preparation(joined), *cat_models, assembler(features, skip=True), rf])
    return Trained(pipeline, data, rf, train, test, rf.transform(test), features)


def accuracy(predictions: DataFrame) -> DataFrame:
    """One row: accuracy and test size (same value as the multiclass evaluator)."""
    return predictions.agg(
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n_test"))


def accuracy_value(predictions: DataFrame) -> float:
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="accuracy")
    return ev.evaluate(predictions)


def per_label(predictions: DataFrame) -> DataFrame:
    """Per true label: test rows and correctly predicted rows."""
    return predictions.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("prediction") == F.col("label")).cast("long")).alias("correct"))


def save_pipeline(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path
