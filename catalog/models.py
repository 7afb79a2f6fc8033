"""Real models: fitted and judged on the whole tables, with small configurations; what SQL can state about them is checked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalog.common import shown, stored_logs, with_ctes
from catalog.training import ATTACK_CTE, attack_members
from tidewatch.operators import classifier as K
from tidewatch.operators import dataset as D
from tidewatch.operators import evaluation as V
from tidewatch.operators import features as E
from tidewatch.operators import forest as I
from tidewatch.operators import scoring as S
from tidewatch.plans import training as T
from tidewatch.schemas import FEATURES
from tidewatch.session import shared_folder, written

ISOLATION = I.IsolationConfig(n_estimators=100)
FOREST = {"name": "10/balanced", "trees": 10, "balanced": True, "depth": 10, "thresholds": [0.3, 0.4, 0.5, 0.6]}
COLUMNS = FEATURES


def dataset(spark, folder, rows=None):
    """The training data set of the folder's tables as they are now (or of stored logs), written since fitting reads it many times."""
    rows = stored_logs(spark, folder) if rows is None else rows
    labelled = D.label_logs(E.extract_features(rows), attack_members(rows))
    return written(D.with_protocol(D.with_scenario(labelled)), "model-data")


def _fit_score(spark, folder):
    data = dataset(spark, folder)
    model = I.fit_isolation(data.filter("label = 0"), FEATURES, ISOLATION)
    return shown(I.isolation_decision(data, model).select("log_id", "label", "decision"))


def _nodes(spark, folder):
    data = dataset(spark, folder)
    model = I.fit_isolation(data.filter("label = 0"), FEATURES, ISOLATION)
    return spark.createDataFrame(model.nodes).groupBy("tree").agg(F.count(F.lit(1)).alias("nodes"), F.max("path").alias("longest"))


def _forest(spark, folder):
    parts = D.holdout_split(dataset(spark, folder))
    model = K.fit_forest(parts.filter("split = 'train'"), COLUMNS, FOREST["trees"], depth=FOREST["depth"])
    return shown(K.forest_scores(parts.filter("split <> 'train'"), model, COLUMNS).select("log_id", "split", "label", "score"))


def _elimination(spark, folder):
    ranks = K.eliminate_features(dataset(spark, folder), COLUMNS, keep=len(COLUMNS) - 3, trees=10, depth=5)
    return spark.createDataFrame(ranks, "feature string, rank int")


def _experiment(spark, folder):
    """Search, holdout and storing with one small configuration per model."""
    store = shared_folder(spark, "models")
    small = I.IsolationConfig(feature_set="endpoint_temporal", n_estimators=50)
    found = T.run_experiment(dataset(spark, folder), COLUMNS, [small], [FOREST], store)
    return shown(found.metrics)


def _grid(spark, folder):
    """All isolation configurations in all walk-forward folds, fitted in one job: the trees of each."""
    data = D.by_time(dataset(spark, folder))
    folds = D.fold_ranges(data)
    normal = data.filter("label = 0")
    parts = [D.fold_rows(normal, folds, n, ["train"]).withColumn("part", F.lit(n)) for n in sorted({p.fold for p in folds})]
    grid = I.isolation_grid(reduce(lambda a, b: a.unionByName(b), parts), FEATURES, I.candidate_configs(FEATURES))
    models = [(n, c.name, part, 2 * grid.samples(part, n) - 1) for part in grid.totals for n, c in enumerate(grid.configs)]
    named = spark.createDataFrame(models, "config int, name string, part string, most int")
    sizes = grid.nodes.groupBy("part", "config", "tree").agg(F.count(F.lit(1)).alias("nodes"))
    return sizes.join(F.broadcast(named), ["part", "config"]).groupBy(F.col("name").alias("config"), F.col("part").alias("fold")).agg(
        F.count(F.lit(1)).alias("trees"), F.count_if(F.col("nodes").between(3, F.col("most"))).alias("sized"))


def _novelty(spark, folder):
    data = dataset(spark, folder)
    scores = T.novelty_scores(data, FEATURES, [ISOLATION])
    return shown(V.best_config(V.fold_results(scores), V.NOVELTY_ORDER))


def _stored(spark, folder):
    """Save, load and score with the loaded model; blended with the rules as in production."""
    rows = stored_logs(spark, folder)
    data = dataset(spark, folder, rows)
    path = shared_folder(spark, "isolation")
    I.save_isolation(I.fit_isolation(data.filter("label = 0"), FEATURES, ISOLATION), spark, path)
    decided = I.isolation_decision(data, I.load_isolation(spark, path), missing="zero")
    return shown(S.score_summary(S.hybrid_scores(decided, attack_members(rows))))


def _decision_ranges(spark, folder):
    found = _fit_score(spark, folder)
    return found.agg(
        F.count(F.lit(1)).alias("logs"), F.count_distinct("log_id").alias("ids"), F.count_if(F.col("decision").between(-0.5, 0.5)).alias("in_range"),
        (F.avg(F.when(F.col("label") == 1, F.col("decision"))) < F.avg(F.when(F.col("label") == 0, F.col("decision")))).alias("attacks_lower"))


def _tree_sizes(spark, folder):
    found = _nodes(spark, folder)
    return found.agg(F.count(F.lit(1)).alias("trees"), F.count_if(F.col("nodes").between(3, 2 * ISOLATION.samples - 1)).alias("sized"))


def _forest_ranges(spark, folder):
    return _forest(spark, folder).groupBy("split").agg(
        F.count(F.lit(1)).alias("logs"), F.sum("label").alias("anomalies"), F.count_if(F.col("score").between(0, 1)).alias("in_range"))


def _ranks(spark, folder):
    return _elimination(spark, folder).groupBy("rank").agg(F.count(F.lit(1)).alias("features"), F.count_distinct("feature").alias("different"))


def _stored_counts(spark, folder):
    return _stored(spark, folder).agg(F.sum("logs").alias("logs"), F.max("total").alias("total"), F.round(F.sum("percent"), 4).alias("percent"))


QUERIES = {
    "model_isolation_decision_ranges": _decision_ranges,
    "model_isolation_tree_sizes": _tree_sizes,
    "model_forest_score_ranges": _forest_ranges,
    "model_feature_ranks": _ranks,
    "model_hybrid_stored_counts": _stored_counts,
    "model_isolation_decision": _fit_score,
    "model_isolation_trees": _nodes,
    "model_forest_scores": _forest,
    "model_feature_elimination": _elimination,
    "model_grid": _grid,
    "model_novelty_protocol": _novelty,
    "model_experiment": _experiment,
    "model_hybrid_stored": _stored,
}

# What SQL can state about a fitted model: row counts, ranges, sizes and ranks.
ORACLE = {
    "model_isolation_decision_ranges": with_ctes("SELECT count(*) AS logs, count(*) AS ids, count(*) AS in_range, true AS attacks_lower FROM logs"),
    "model_isolation_tree_sizes": f"SELECT CAST({ISOLATION.n_estimators} AS BIGINT) AS trees, CAST({ISOLATION.n_estimators} AS BIGINT) AS sized",
    "model_grid": with_ctes(
        """, ends AS (SELECT fold, floor(total * f::DOUBLE) + floor(total * 0.2::DOUBLE) AS b,
 floor(total * f::DOUBLE) AS a, floor(total * f::DOUBLE) + floor(total * 0.2::DOUBLE) + floor(total * 0.1::DOUBLE) AS c, total
 FROM (SELECT DISTINCT total FROM dataset), (VALUES ('fold_1', 0.4), ('fold_2', 0.5), ('fold_3', 0.6)) v(fold, f)),
judged AS (SELECT fold, sum(CASE WHEN pos >= a AND pos < b THEN label ELSE 0 END) AS v, sum(CASE WHEN pos >= b THEN label ELSE 0 END) AS t
 FROM dataset d, ends e WHERE pos < c AND c <= e.total GROUP BY fold)
SELECT config, fold, CAST(n AS BIGINT) AS trees, CAST(n AS BIGINT) AS sized FROM judged, (VALUES """
        + ", ".join(f"('{c.name}', {c.n_estimators})" for c in I.candidate_configs(FEATURES)) + """) g(config, n) WHERE v > 0 AND t > 0""", ATTACK_CTE),
    "model_forest_score_ranges": with_ctes(
        """SELECT split, count(*) AS logs, CAST(sum(label) AS BIGINT) AS anomalies, count(*) AS in_range FROM (SELECT label, CASE WHEN pos < floor(total * 0.6::DOUBLE) THEN 'train'
 WHEN pos < floor(total * 0.8::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM dataset) WHERE split <> 'train' GROUP BY split""", ATTACK_CTE),
    "model_feature_ranks": f"""SELECT CAST(rank AS INT) AS rank, CAST(n AS BIGINT) AS features, CAST(n AS BIGINT) AS different
 FROM (VALUES (1, {len(COLUMNS) - 3}), (2, 1), (3, 1), (4, 1)) v(rank, n)""",
    "model_hybrid_stored_counts": with_ctes("SELECT count(*) AS logs, count(*) AS total, 100.0::DOUBLE AS percent FROM logs"),
}
