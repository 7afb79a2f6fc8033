"""Supervised forest and feature elimination with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42
#: Spark ML grows no deeper trees; a configuration may name a smaller depth.
DEPTH = 30

# The configurations tried and the thresholds of each. "depth" may be added to any of them.
FOREST_CONFIGS = [
    {"name": "300/plain", "trees": 300, "balanced": False, "thresholds": [0.4, 0.45, 0.5, 0.55, 0.6]},
    {"name": "300/balanced", "trees": 300, "balanced": True, "thresholds": [0.2, 0.25, 0.3, 0.35, 0.4]},
    {"name": "500/balanced", "trees": 500, "balanced": True, "thresholds": [0.2, 0.25, 0.3, 0.35]},
]
HOLDOUT_THRESHOLDS = [0.4, 0.45, 0.5, 0.55, 0.6]


def assembled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the vector column ``features``."""
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep").transform(df)


def balanced_weights(df: DataFrame) -> DataFrame:
    """Add ``weight`` = rows / (2 x rows of the class), so both classes weigh the same."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p")).first()
    total, positive = counts["n"], counts["p"] or 0
    up, down = total / (2 * max(positive, 1)), total / (2 * max(total - positive, 1))
    return df.withColumn("weight", F.when(F.col("label") == 1, up).otherwise(down))


def fit_forest(
    train: DataFrame, columns: Sequence[str], trees: int = 300, balanced: bool = True, depth: int = DEPTH, seed: int = SEED
) -> RandomForestClassificationModel:
    """``train`` holds label and the feature columns (or already the vector ``features``)."""
    rows = train if "features" in train.columns else assembled(train, columns)
    learner = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt"
    )
    if balanced:
        rows, learner = balanced_weights(rows), learner.setWeightCol("weight")
    return learner.fit(rows)


def forest_scores(df: DataFrame, model: RandomForestClassificationModel, columns: Sequence[str]) -> DataFrame:
    """Add ``score``: the probability of class 1."""
    rows = df if "features" in df.columns else assembled(df, columns)
    scored = model.transform(rows)
    probability = F.get(vector_to_array("probability"), F.lit(1))
    return scored.withColumn("score", F.coalesce(probability, F.lit(0.0))).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def eliminate_features(
    df: DataFrame, columns: Sequence[str], keep: int = 20, trees: int = 100, depth: int = DEPTH
) -> list[tuple[str, int]]:
    """Recursive elimination: drop the least important feature of a balanced forest until ``keep`` remain.

    Returns (feature, rank): rank 1 for kept features, then 2 for the last one dropped, and so on.
    """
    left, dropped = list(columns), []
    rows = balanced_weights(df.select("label", *columns)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while len(left) > min(keep, len(columns)):
            model = fit_forest(rows.select("label", *left), left, trees, True, depth)
            importances = model.featureImportances.toArray()
            dropped.append(left.pop(min(range(len(left)), key=lambda i: (importances[i], i))))
    finally:
        rows.unpersist()
    return [(c, 1) for c in left] + [(c, i + 2) for i, c in enumerate(reversed(dropped))]
