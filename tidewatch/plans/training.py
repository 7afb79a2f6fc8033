"""Model search, evaluation, promotion and storing, over a training data set.

``data`` holds log_id, timestamp, label, protocol_split and the feature columns. Configurations are
a short list on the driver; every fit, scoring and evaluation is a Spark job over the whole rows,
and scores are written to the shared folder so that no fit is repeated by a later question.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import classifier as K
from tidewatch.operators import dataset as D
from tidewatch.operators import evaluation as V
from tidewatch.operators import forest as I
from tidewatch.session import written

_SCORED = ["config", "fold", "split", "log_id", "label", "score"]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _named(scored: DataFrame, config: str, fold: str) -> DataFrame:
    return scored.withColumns({"config": F.lit(config), "fold": F.lit(fold)}).select(*_SCORED)


def isolation_fold_scores(data: DataFrame, folds: Sequence[D.FoldPart], columns: Sequence[str], configs: Sequence[I.IsolationConfig]) -> DataFrame:
    """Validation and test scores of every configuration in every fold, fitted on the fold's normal rows.

    ``data`` is stored by time (``dataset.by_time``). All models are fitted in one job, and each fold's judged rows are read once for all of them.
    """
    names = sorted({p.fold for p in folds})
    normal = data.filter(F.col("label") == 0)
    parts = [D.fold_rows(normal, folds, name, ["train"]).withColumn("fold", F.lit(name)) for name in names]
    models = I.fit_isolation_grid(_union(parts), columns, configs, by="fold")
    frames = []
    for name in names:
        judged = D.fold_rows(data, folds, name, ["validation", "test"]).select("split", "log_id", "label", *columns)
        frames.append(I.isolation_grid_scores(judged, models[name]).withColumn("fold", F.lit(name)).select(*_SCORED))
    return written(_union(frames), "isolation-scores")


def forest_fold_scores(data: DataFrame, folds: Sequence[D.FoldPart], columns: Sequence[str], configs: Sequence[dict]) -> DataFrame:
    parts = []
    for name in sorted({p.fold for p in folds}):
        train, judged = D.fold_rows(data, folds, name, ["train"]), D.fold_rows(data, folds, name, ["validation", "test"])
        for config in configs:
            model = K.fit_forest(train, columns, config["trees"], config["balanced"], config.get("depth", K.DEPTH))
            parts.append(_named(K.forest_scores(judged, model, columns), config["name"], name))
    return written(_union(parts), "forest-scores")


def select_forest(scores: DataFrame, configs: Sequence[dict]) -> DataFrame:
    """The best configuration; each one is judged with its own thresholds."""
    results = [
        V.fold_results(scores.filter(F.col("config") == c["name"]), V.fixed_thresholds(c["thresholds"])) for c in configs
    ]
    return V.best_config(_union(results), V.FOREST_ORDER)


def novelty_scores(data: DataFrame, columns: Sequence[str], configs: Sequence[I.IsolationConfig]) -> DataFrame:
    """Scores of the novelty protocol: fitted on its normal training part, one fold."""
    parts = D.novelty_split(data)
    normal = parts["baseline_train"].filter(F.col("label") == 0)
    models = I.fit_isolation_grid(normal.withColumn("fold", F.lit("protocol")), columns, configs, by="fold")["protocol"]
    frames = []
    for part, split in (("threshold_validation", "validation"), ("novelty_test", "test")):
        judged = parts[part].select("log_id", "label", *columns)
        frames.append(I.isolation_grid_scores(judged, models).withColumns({"split": F.lit(split), "fold": F.lit("protocol")}).select(*_SCORED))
    return written(_union(frames), "novelty-scores")


@dataclass
class Experiment:
    """What a run found: chosen configurations and metric tables, all small."""

    isolation: dict
    novelty: dict
    forest: dict
    ensemble: dict
    metrics: DataFrame
    budgets: DataFrame
    isolation_only: DataFrame
    promotion: DataFrame


def run_experiment(
    data: DataFrame,
    columns: Sequence[str],
    isolation_configs: Sequence[I.IsolationConfig] | None = None,
    forest_configs: Sequence[dict] = tuple(K.FOREST_CONFIGS),
    store: str | None = None,
) -> Experiment:
    """Search on walk-forward folds, judge on the holdout, refit and store the models."""
    isolation_configs = list(isolation_configs or I.candidate_configs(columns))
    by_name = {c.name: c for c in isolation_configs}
    forest_by_name = {c["name"]: c for c in forest_configs}
    data = D.by_time(data, "training-data")
    folds = D.fold_ranges(data)

    isolation_scores = isolation_fold_scores(data, folds, columns, isolation_configs)
    best_isolation = V.best_config(V.fold_results(isolation_scores), V.ISOLATION_ORDER).first().asDict()
    novelty = novelty_scores(data, columns, isolation_configs)
    best_novelty = V.best_config(V.fold_results(novelty), V.NOVELTY_ORDER).first().asDict()
    forest_scores = forest_fold_scores(data, folds, columns, forest_configs)
    best_forest = select_forest(forest_scores, forest_configs).first().asDict()
    best_ensemble = V.select_ensemble(
        forest_scores.filter(F.col("config") == best_forest["config"]).drop("config"),
        isolation_scores.filter(F.col("config") == best_isolation["config"]).drop("config"),
    ).first().asDict()
    alpha = float(best_ensemble["config"].split("_")[1])

    isolation_config = by_name[best_isolation["config"]]
    forest_config = forest_by_name[best_forest["config"]]
    parts = D.holdout_split(data)
    train, judged = parts.filter(F.col("split") == "train"), parts.filter(F.col("split") != "train")
    isolation_model = I.fit_isolation(train.filter(F.col("label") == 0), columns, isolation_config)
    forest_model = K.fit_forest(train, columns, forest_config["trees"], forest_config["balanced"], forest_config.get("depth", K.DEPTH))
    keys = ["split", "log_id", "label"]
    isolation = I.isolation_scores(judged, isolation_model).select(*keys, "score")
    forest = K.forest_scores(judged, forest_model, columns).select(*keys, "score")
    scaled = V.normalise_scores(isolation, ["split"]).select("split", "log_id", F.col("score").alias("_isolation"))
    ensemble = forest.join(scaled, ["split", "log_id"]).withColumn(
        "score", alpha * F.col("score") + (1 - alpha) * F.col("_isolation")).select(*keys, "score")
    holdout = written(
        _union([f.withColumn("model", F.lit(n)) for n, f in (("isolation", isolation), ("forest", forest), ("ensemble", ensemble))]),
        "holdout-scores",
    )

    def of(model: str, split: str) -> DataFrame:
        return holdout.filter((F.col("model") == model) & (F.col("split") == split))

    raw = of("isolation", "validation")
    limits = {
        "isolation": V.best_threshold(raw, V.threshold_candidates(raw)).first()["threshold"],
        "forest": V.best_threshold(of("forest", "validation"), V.fixed_thresholds(K.HOLDOUT_THRESHOLDS)).first()["threshold"],
        "ensemble": V.best_threshold(of("ensemble", "validation"), V.fixed_thresholds(V.ENSEMBLE_THRESHOLDS)).first()["threshold"],
    }
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("model")]
    metrics = V.evaluate(holdout, limit, ["model", "split"])
    budgets = _union([
        V.review_budget(of("isolation", split)).withColumn("split", F.lit(split)) for split in ("validation", "test")
    ])
    predictions = (
        of("isolation", "test").select("log_id", "label", (F.col("score") >= limits["isolation"]).cast("int").alias("isolation_pred"))
        .join(of("forest", "test").select("log_id", (F.col("score") >= limits["forest"]).cast("int").alias("forest_pred")), "log_id")
    )
    found = Experiment(
        best_isolation, best_novelty, best_forest, best_ensemble, metrics, budgets,
        V.isolation_only(predictions), V.promotion(parts.filter(F.col("split") == "test")),
    )
    if store is not None:
        spark = data.sparkSession
        known = parts.filter(F.col("split") != "test")
        final = I.fit_isolation(known.filter(F.col("label") == 0), columns, isolation_config)
        I.save_isolation(final, spark, f"{store}/isolation_forest", limits["isolation"])
        deployed = K.fit_forest(known, columns, forest_config["trees"], forest_config["balanced"], forest_config.get("depth", K.DEPTH))
        deployed.write().overwrite().save(f"{store}/random_forest")
        details = {"model_family": "hybrid_ensemble", "alpha_rf": alpha, "thresholds": limits, "features": list(columns)}
        spark.createDataFrame([(json.dumps(details),)], "value string").coalesce(1).write.mode("overwrite").text(f"{store}/metadata")
    return found
