"""Scores and their evaluation.

The checks need a model that SQL can follow, so these queries use two plain formulas over request
features in its place; catalog.models runs the real ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import WINDOW, logs, shown, with_ctes
from catalog.detection import ALERTS_CTE
from catalog.featuring import FILLED_CTE
from catalog.training import ATTACK_RULES, attack_labels
from tidewatch.functions.columns import clip
from tidewatch.operators import checks as C
from tidewatch.operators import dataset as D
from tidewatch.operators import evaluation as V
from tidewatch.operators import features as E
from tidewatch.operators import rules as R
from tidewatch.operators import scoring as S
from tidewatch.session import shared_folder, written
from tidewatch.sources import tables as T


def formula_decision():
    bad = F.when(F.col("status_code") >= 400, 0.15).otherwise(0.0)
    return F.round(0.25 - F.col("endpoint_length") / 100 - F.col("response_time_log") / 20 - bad, 6)


def formula_forest():
    bad = F.when(F.col("status_code") >= 400, 0.4).otherwise(0.0)
    return F.round(clip(0.2 + bad + F.col("endpoint_length") / 100, 0, 1), 6)


def decide(features):
    return features.select("log_id", formula_decision().alias("decision"))


def own_features(rows):
    """Features that need no other rows but the median."""
    times = rows.select("response_time_ms")
    median = E.quantiles(times, "response_time_ms", [0.5]).first()["quantile"]
    filled = E.filled_logs(rows, median)
    derived = E.request_features()
    return filled.select(F.col("id").alias("log_id"), "timestamp", *[c.alias(n) for n, c in derived.items()])


def decisions(rows):
    return decide(own_features(rows))


def members(rows):
    return R.alert_logs(rows, R.run_rules(rows, WINDOW), WINDOW)


def hybrid(spark, folder):
    rows = logs(spark, folder)
    return S.hybrid_scores(decisions(rows), members(rows))


def model_rows(spark, folder):
    """log_id, timestamp, label and both formula scores."""
    rows = logs(spark, folder)
    scored = own_features(rows).select(
        "log_id", (F.lit(0.0) - formula_decision()).alias("isolation"), formula_forest().alias("forest")
    )
    return attack_labels(rows).join(scored, "log_id")


def _scores(spark, folder, name="isolation"):
    return model_rows(spark, folder).select("log_id", "label", F.col(name).alias("score"))


def _folds(spark, folder):
    """Scored validation and test rows of all folds, stored once as a training run would."""
    folds = D.backtest_folds(model_rows(spark, folder))
    return written(folds.filter(F.col("split") != "train"), "folds")


FORMULA_CTE = (
    FILLED_CTE
    + """,
formula AS (SELECT id AS log_id, timestamp,
 round(0.25::DOUBLE - CAST(length(endpoint) AS DOUBLE) / 100 - ln(1 + response_time_ms) / 20 - CASE WHEN status >= 400 THEN 0.15::DOUBLE ELSE 0.0 END, 6) AS decision,
 round(greatest(0.0, least(1.0, 0.2::DOUBLE + CASE WHEN status >= 400 THEN 0.4::DOUBLE ELSE 0.0 END + CAST(length(endpoint) AS DOUBLE) / 100)), 6) AS forest
 FROM filled)"""
)

SCORES_CTE = (
    FORMULA_CTE
    + ",\n"
    + ALERTS_CTE
    + """,
rule_score AS (SELECT log_id, max(CASE severity WHEN 'CRITICAL' THEN 1.0::DOUBLE WHEN 'HIGH' THEN 0.75::DOUBLE WHEN 'MEDIUM' THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END) AS rule_score,
 string_agg(alert_type, ',' ORDER BY severity DESC, alert_type) AS triggered_rules FROM members GROUP BY log_id),
blended AS (SELECT f.log_id, coalesce(r.rule_score, 0) AS rule_score, coalesce(r.triggered_rules, '') AS triggered_rules,
 1.0::DOUBLE - (greatest(-0.5::DOUBLE, least(0.5::DOUBLE, f.decision)) + 0.5::DOUBLE) AS ml_score FROM formula f LEFT JOIN rule_score r ON f.log_id = r.log_id),
finals AS (SELECT *, round(CASE WHEN rule_score >= 1 THEN greatest(0.55::DOUBLE * rule_score + 0.45::DOUBLE * ml_score, 0.75::DOUBLE)
 ELSE 0.55::DOUBLE * rule_score + 0.45::DOUBLE * ml_score END, 4) AS final_score FROM blended),
scores AS (SELECT *, CASE WHEN final_score >= 0.8 THEN 'CRITICAL' WHEN final_score >= 0.6 THEN 'HIGH' WHEN final_score >= 0.4 THEN 'MEDIUM'
 ELSE 'NORMAL' END AS severity, abs(ml_score - 0.5) * 2 AS ml_confidence, final_score >= 0.4 AS is_anomaly FROM finals)"""
)

MODEL_CTE = (
    FORMULA_CTE
    + ",\n"
    + ALERTS_CTE.replace("INTERVAL 7 DAY", "INTERVAL 30 DAY")
    + """,
model AS (SELECT f.log_id, f.timestamp, 0.0 - f.decision AS isolation, f.forest, CASE WHEN m.log_id IS NULL THEN 0 ELSE 1 END AS label,
 row_number() OVER (ORDER BY f.timestamp, f.log_id) - 1 AS pos, count(*) OVER () AS total
 FROM formula f LEFT JOIN (SELECT DISTINCT log_id FROM members WHERE alert_type IN ("""
    + ", ".join(f"'{r}'" for r in ATTACK_RULES)
    + """)) m ON f.log_id = m.log_id),
ends AS (SELECT fold, floor(total * f::DOUBLE) AS a, floor(total * f::DOUBLE) + floor(total * 0.2::DOUBLE) AS b,
 floor(total * f::DOUBLE) + floor(total * 0.2::DOUBLE) + floor(total * 0.1::DOUBLE) AS c, total
 FROM (SELECT DISTINCT total FROM model), (VALUES ('fold_1', 0.4), ('fold_2', 0.5), ('fold_3', 0.6)) v(fold, f)),
folds AS (SELECT m.*, fold, CASE WHEN pos < b THEN 'validation' ELSE 'test' END AS split FROM model m, ends e WHERE pos >= a AND pos < c AND c <= e.total)"""
)


def _grid_sql(source: str, score: str, by: str = "") -> str:
    """Candidate thresholds of a score, per group."""
    qs = ", ".join(f"{q}" for q in V.THRESHOLD_QUANTILES)
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {keys}unnest(list_concat(quantile_cont({score}, [{qs}]),
 list_transform(range(25), lambda i: CASE WHEN i = 24 THEN max({score}) ELSE min({score}) + i * ((max({score}) - min({score})) / 24) END))) AS threshold
FROM {source} {group}"""


def _metrics_sql(source: str, score: str, grid: str, by: str = "") -> str:
    keys = f"s.{by}, " if by else ""
    match = f"WHERE s.{by} = g.{by}" if by else ""
    return f"""SELECT {keys}g.threshold, count(*) FILTER ({score} >= g.threshold) AS predicted,
 CAST(coalesce(sum(label) FILTER ({score} >= g.threshold), 0) AS BIGINT) AS hits, sum(label) AS positives
FROM {source} s, (SELECT DISTINCT * FROM ({grid})) g {match} GROUP BY {keys}g.threshold"""


_RATES = """coalesce(hits / nullif(predicted, 0), 0) AS precision, coalesce(hits / nullif(positives, 0), 0) AS recall,
 coalesce(2 * hits / nullif(predicted + positives, 0), 0) AS f1_score"""


def _threshold_metrics(spark, folder):
    scores = _scores(spark, folder)
    return shown(V.threshold_metrics(scores, V.threshold_candidates(scores)).dropDuplicates(["threshold"]))


def _best(spark, folder):
    scores = _scores(spark, folder)
    return shown(V.best_threshold(scores, V.threshold_candidates(scores)))


def _candidates(spark, folder):
    grid = V.threshold_candidates(_scores(spark, folder))
    return shown(grid.select(F.posexplode("thresholds").alias("position", "threshold")))


def _evaluate(spark, folder):
    parts = D.holdout_split(model_rows(spark, folder).withColumnRenamed("isolation", "score"))
    return shown(V.evaluate(parts, F.lit(0.2), ["split"]))


def _auc(spark, folder):
    """Labels of documents against a coarse score with many ties: the text length in hundreds."""
    rows = spark.read.parquet(f"{folder}/labels.parquet").join(
        spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "n_chars"), "doc_id")
    scored = rows.select(
        F.col("quality").cast("int").alias("label"), (F.floor(F.col("n_chars") / 100) / 100).alias("score"))
    return shown(V.roc_auc(scored))


def _normalise(spark, folder):
    return shown(V.normalise_scores(_scores(spark, folder)))


def _fold_results(spark, folder):
    folds = _folds(spark, folder)
    both = folds.select("fold", "split", "label", F.inline(F.array(
        F.struct(F.lit("isolation").alias("config"), F.col("isolation").alias("score")),
        F.struct(F.lit("forest").alias("config"), F.col("forest").alias("score")),
    )))
    return V.fold_results(both)


def _folds_shown(spark, folder):
    return shown(_fold_results(spark, folder))


def _config(spark, folder):
    return shown(V.best_config(_fold_results(spark, folder), V.ISOLATION_ORDER))


def _ensemble_frames(spark, folder):
    folds = _folds(spark, folder)
    keys = ["fold", "split", "log_id", "label"]
    return folds.select(*keys, F.col("forest").alias("score")), folds.select(*keys, F.col("isolation").alias("score"))


def _ensemble(spark, folder):
    forest, isolation = _ensemble_frames(spark, folder)
    results = V.fold_results(V.ensemble_scores(forest, isolation), V.fixed_thresholds(V.ENSEMBLE_THRESHOLDS))
    return shown(V.config_averages(results))


def _ensemble_choice(spark, folder):
    return shown(V.select_ensemble(*_ensemble_frames(spark, folder)))


def _budget(spark, folder):
    return shown(V.review_budget(_scores(spark, folder), (0.001, 0.005, *V.REVIEW_BUDGETS)))


def _only(spark, folder):
    rows = model_rows(spark, folder).select(
        "label",
        (F.col("isolation") >= 0.15).cast("int").alias("isolation_pred"),
        (F.col("forest") >= 0.7).cast("int").alias("forest_pred"),
    )
    return shown(V.isolation_only(rows))


def _promotion(spark, folder):
    parts = D.holdout_split(model_rows(spark, folder))
    return V.promotion(parts.filter(F.col("split") == "test"))


def _rule_scores(spark, folder):
    return shown(S.rule_scores(members(logs(spark, folder))))


def _ml(spark, folder):
    """Some decisions are missing, not a number or out of range."""
    decision = (
        F.when(F.col("log_id") % 7 == 0, F.lit(None).cast("double"))
        .when(F.col("log_id") % 7 == 1, float("nan"))
        .when(F.col("log_id") % 7 == 2, F.col("decision") * 5)
        .otherwise(F.col("decision"))
    )
    score = S.ml_score(S.clean_feature(decision))
    return shown(decisions(logs(spark, folder)).select(
        "log_id", score.alias("ml_score"), S.ml_confidence(score).alias("ml_confidence")))


def _blend(spark, folder):
    rows = decisions(logs(spark, folder)).withColumn(
        "rule_score", F.element_at(F.array(*[F.lit(v) for v in (0.0, 0.25, 0.5, 0.75, 1.0)]), (F.col("log_id") % 5 + 1).cast("int")))
    final = S.blend(F.col("rule_score"), S.ml_score(F.col("decision")))
    return rows.select("log_id", "rule_score", final.alias("final_score"), S.severity(final).alias("severity"))


def _hybrid(spark, folder):
    return shown(hybrid(spark, folder))


def _recent(spark, folder):
    rows = logs(spark, folder)
    scores = S.evaluate_batch(rows, members(rows), decide, 7)
    return shown(scores.select("log_id", "final_score", "severity"))


def _first_wins(spark, folder):
    """Two overlapping batches, the second with other scores; stored scores must not change."""
    path = shared_folder(spark, "scores")
    scores = hybrid(spark, folder)
    T.append_first_scores(scores.filter(F.col("log_id") % 3 > 0), path)
    T.append_first_scores(scores.withColumn("final_score", F.lit(0.0)), path)
    return shown(spark.read.parquet(path).select("log_id", "final_score"))


def _summary(spark, folder):
    return shown(S.score_summary(hybrid(spark, folder)))


def _top(spark, folder):
    return shown(S.top_anomalies(hybrid(spark, folder)).select(
        "log_id", "rule_score", "ml_score", "final_score", "severity", "triggered_rules"))


def _constraints(spark, folder):
    return C.violations(hybrid(spark, folder), C.score_constraints())


def _alert_constraints(spark, folder):
    found = R.run_rules(logs(spark, folder), WINDOW).withColumn(
        "source", F.when(F.col("alert_type") == "port_scanning", "guess").otherwise(F.col("source")))
    return C.violations(found, C.alert_constraints())


def _every_score_constraint(spark, folder):
    """Rows that break each constraint in turn."""
    turn = F.col("log_id") % 31
    rows = hybrid(spark, folder).withColumns({
        "rule_score": F.when(turn == 0, 1.5).otherwise(F.col("rule_score")),
        "ml_score": F.when(turn != 1, F.col("ml_score")),
        "final_score": F.when(turn == 2, -0.1).otherwise(F.col("final_score")),
        "severity": F.when(turn == 3, "SEVERE").otherwise(F.col("severity")),
        "ml_confidence": F.when(turn == 4, 2.0).otherwise(F.col("ml_confidence")),
        "is_anomaly": F.when(turn != 5, F.col("is_anomaly")),
    })
    return C.violations(rows, C.score_constraints())


def _every_alert_constraint(spark, folder):
    """Each rule's alerts break another constraint."""
    found, kind = R.run_rules(logs(spark, folder), WINDOW).withColumn("kind", F.col("alert_type")), F.col("kind")
    found = found.withColumns({
        "alert_type": F.when(kind != "brute_force", kind),
        "severity": F.when(kind == "sql_injection", "SEVERE").otherwise(F.col("severity")),
        "source": F.when(kind == "port_scanning", "guess").otherwise(F.col("source")),
        "confidence": F.when(kind == "path_traversal", 1.5).otherwise(F.col("confidence")),
        "timestamp": F.when(kind != "suspicious_user_agent", F.col("timestamp")),
    })
    return C.violations(found, C.alert_constraints())


QUERIES = {
    "eval_normalise_scores": _normalise,
    "eval_threshold_candidates": _candidates,
    "eval_threshold_metrics": _threshold_metrics,
    "eval_best_threshold": _best,
    "eval_metrics_by_split": _evaluate,
    "eval_roc_auc_ties": _auc,
    "eval_fold_results": _folds_shown,
    "eval_best_config": _config,
    "eval_ensemble_grid": _ensemble,
    "eval_ensemble_choice": _ensemble_choice,
    "eval_review_budget": _budget,
    "eval_isolation_only": _only,
    "eval_promotion": _promotion,
    "score_rule": _rule_scores,
    "score_ml": _ml,
    "score_blend_severity": _blend,
    "score_hybrid": _hybrid,
    "score_recent_batch": _recent,
    "score_first_wins_sink": _first_wins,
    "score_summary": _summary,
    "score_top_anomalies": _top,
    "check_score_constraints": _constraints,
    "check_alert_constraints": _alert_constraints,
    "check_every_score_constraint": _every_score_constraint,
    "check_every_alert_constraint": _every_alert_constraint,
}

_FOLD_CTE = MODEL_CTE + f""",
long AS (SELECT 'isolation|' || fold AS k, split, label, isolation AS score FROM folds UNION ALL SELECT 'forest|' || fold, split, label, forest FROM folds),
valid AS (SELECT * FROM long WHERE split = 'validation'),
grid AS ({_grid_sql('valid', 'score', 'k')}),
tried AS (SELECT *, {_RATES} FROM ({_metrics_sql('valid', 'score', 'SELECT * FROM grid', 'k')})),
chosen AS (SELECT k, max_by(threshold, (f1_score, precision, recall, -threshold)) AS threshold FROM tried GROUP BY k),
judged AS (SELECT k, threshold, split, {_RATES} FROM (SELECT l.k, c.threshold, split, sum(label) AS positives,
 count(*) FILTER (score >= threshold) AS predicted, coalesce(sum(label) FILTER (score >= threshold), 0) AS hits
 FROM long l JOIN chosen c ON l.k = c.k GROUP BY l.k, c.threshold, split)),
results AS (SELECT split_part(k, '|', 1) AS config, split_part(k, '|', 2) AS fold, threshold,
 max(f1_score) FILTER (split = 'validation') AS validation_f1, max(precision) FILTER (split = 'validation') AS validation_precision,
 max(recall) FILTER (split = 'validation') AS validation_recall, max(f1_score) FILTER (split = 'test') AS test_f1,
 max(precision) FILTER (split = 'test') AS test_precision, max(recall) FILTER (split = 'test') AS test_recall FROM judged GROUP BY k, threshold)"""

_ENSEMBLE_CTE = MODEL_CTE + f""",
scaled AS (SELECT fold, split, log_id, label, forest, (isolation - min(isolation) OVER w) / (max(isolation) OVER w - min(isolation) OVER w + 1e-9::DOUBLE) AS iso
 FROM folds WINDOW w AS (PARTITION BY fold, split)),
long AS (SELECT a || '|' || fold AS k, split, label, CAST(a AS DOUBLE) * forest + (1 - CAST(a AS DOUBLE)) * iso AS score FROM scaled,
 (VALUES ('0.60'), ('0.70'), ('0.80'), ('0.90')) v(a)),
valid AS (SELECT * FROM long WHERE split = 'validation'),
grid AS (SELECT k, CAST(unnest([{', '.join(str(t) for t in V.ENSEMBLE_THRESHOLDS)}]) AS DOUBLE) AS threshold FROM (SELECT DISTINCT k FROM long)),
tried AS (SELECT *, {_RATES} FROM ({_metrics_sql('valid', 'score', 'SELECT * FROM grid', 'k')})),
chosen AS (SELECT k, max_by(threshold, (f1_score, precision, recall, -threshold)) AS threshold FROM tried GROUP BY k),
judged AS (SELECT k, threshold, split, {_RATES} FROM (SELECT l.k, c.threshold, split, sum(label) AS positives,
 count(*) FILTER (score >= threshold) AS predicted, coalesce(sum(label) FILTER (score >= threshold), 0) AS hits
 FROM long l JOIN chosen c ON l.k = c.k GROUP BY l.k, c.threshold, split)),
results AS (SELECT 'alpha_' || split_part(k, '|', 1) AS config, split_part(k, '|', 2) AS fold, threshold,
 max(f1_score) FILTER (split = 'validation') AS validation_f1, max(precision) FILTER (split = 'validation') AS validation_precision,
 max(recall) FILTER (split = 'validation') AS validation_recall, max(f1_score) FILTER (split = 'test') AS test_f1,
 max(precision) FILTER (split = 'test') AS test_precision, max(recall) FILTER (split = 'test') AS test_recall FROM judged GROUP BY k, threshold)"""

_RESULT_METRICS = ["threshold", "validation_f1", "validation_precision", "validation_recall", "test_f1", "test_precision", "test_recall"]
_AVERAGES = "SELECT config, " + ", ".join(f"round(avg({m}), 6) AS {m}" for m in _RESULT_METRICS) + " FROM results GROUP BY config"


def _choice(order) -> str:
    keys = ", ".join(f"round(avg({m}), 12) DESC" for m in order)
    return _AVERAGES + f" ORDER BY {keys}, config LIMIT 1"


ORACLE = {
    "eval_normalise_scores": with_ctes(
        """SELECT log_id, label, round((isolation - min(isolation) OVER ()) / (max(isolation) OVER () - min(isolation) OVER () + 1e-9::DOUBLE), 6) AS score
FROM model""", MODEL_CTE),
    "eval_threshold_candidates": with_ctes(
        f"SELECT CAST(row_number() OVER (ORDER BY threshold) - 1 AS INT) AS position, round(threshold, 6) AS threshold FROM ({_grid_sql('model', 'isolation')})",
        MODEL_CTE),
    "eval_threshold_metrics": with_ctes(
        f"""SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
 predicted, hits FROM (SELECT *, {_RATES} FROM ({_metrics_sql('model', 'isolation', _grid_sql('model', 'isolation'))}))""", MODEL_CTE),
    "eval_best_threshold": with_ctes(
        f"""SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score
FROM (SELECT *, {_RATES} FROM ({_metrics_sql('model', 'isolation', _grid_sql('model', 'isolation'))}))
ORDER BY f1_score DESC, precision DESC, recall DESC, threshold LIMIT 1""", MODEL_CTE),
    "eval_metrics_by_split": with_ctes(
        """, parts AS (SELECT *, CASE WHEN pos < floor(total * 0.6::DOUBLE) THEN 'train' WHEN pos < floor(total * 0.8::DOUBLE) THEN 'validation'
 ELSE 'test' END AS split FROM model),
ranked AS (SELECT *, (rank() OVER (PARTITION BY split ORDER BY isolation) + (count(*) OVER (PARTITION BY split, isolation) - 1) / 2.0) AS r FROM parts),
g AS (SELECT split, count(*) AS n, sum(label) AS p, count(*) FILTER (isolation >= 0.2) AS pred, sum(label) FILTER (isolation >= 0.2) AS tp,
 sum(r) FILTER (label = 1) AS rs FROM ranked GROUP BY split)
SELECT split, round(tp / pred, 6) AS precision, round(tp / p, 6) AS recall, round(2 * tp / (pred + p), 6) AS f1_score,
 round((rs - p * (p + 1) / 2.0) / (p * (n - p)), 6) AS roc_auc, round((n - p - pred + 2 * tp) / n, 6) AS accuracy,
 CAST(p AS BIGINT) AS positives, CAST(pred AS BIGINT) AS predicted_positives, CAST(n - p - pred + tp AS BIGINT) AS tn,
 CAST(pred - tp AS BIGINT) AS fp, CAST(p - tp AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp FROM g""", MODEL_CTE),
    "eval_roc_auc_ties": """WITH s AS (SELECT quality AS label, CAST(floor(n_chars / 100) AS BIGINT) AS score FROM labels JOIN documents USING (doc_id)),
r AS (SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM s)
SELECT round((sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))), 6) AS roc_auc FROM r""",
    "eval_fold_results": with_ctes(
        "SELECT config, fold, " + ", ".join(f"round({m}, 6) AS {m}" for m in _RESULT_METRICS) + " FROM results", _FOLD_CTE),
    "eval_best_config": with_ctes(_choice(V.ISOLATION_ORDER), _FOLD_CTE),
    "eval_ensemble_grid": with_ctes(_AVERAGES, _ENSEMBLE_CTE),
    "eval_ensemble_choice": with_ctes(_choice(V.ENSEMBLE_ORDER), _ENSEMBLE_CTE),
    "eval_review_budget": with_ctes(
        """, ordered AS (SELECT *, row_number() OVER (ORDER BY isolation DESC, log_id) AS r, count(*) OVER () AS n FROM model),
b AS (SELECT name, budget, greatest(1, CAST(floor(n * budget) AS BIGINT)) AS top_k FROM (SELECT DISTINCT n FROM ordered),
 (VALUES ('top_0.1pct', 0.001::DOUBLE), ('top_0.5pct', 0.005::DOUBLE), ('top_1pct', 0.01::DOUBLE), ('top_2pct', 0.02::DOUBLE), ('top_5pct', 0.05::DOUBLE), ('top_10pct', 0.1::DOUBLE)) v(name, budget))
SELECT name, budget, top_k, CAST(sum(label) FILTER (r <= top_k) AS BIGINT) AS hits, round(sum(label) FILTER (r <= top_k) / top_k, 6) AS precision_at_k,
 round(sum(label) FILTER (r <= top_k) / sum(label), 6) AS recall_at_k FROM ordered, b GROUP BY name, budget, top_k""", MODEL_CTE),
    "eval_isolation_only": with_ctes(
        """SELECT count(*) FILTER (a) AS reviewed, CAST(coalesce(sum(label) FILTER (a), 0) AS BIGINT) AS hits,
 round(coalesce(sum(label) FILTER (a) / nullif(count(*) FILTER (a), 0), 0), 6) AS precision,
 round(coalesce(sum(label) FILTER (a), 0) / sum(label), 6) AS anomaly_coverage FROM (SELECT *, isolation >= 0.15 AND forest < 0.7 AS a FROM model)""",
        MODEL_CTE),
    "eval_promotion": with_ctes(
        """SELECT CAST(sum(label) AS BIGINT) AS test_positives, sum(label) >= 20 AS promoted FROM model WHERE pos >= floor(total * 0.8::DOUBLE)""",
        MODEL_CTE),
    "score_rule": with_ctes("SELECT log_id, rule_score, triggered_rules FROM rule_score", SCORES_CTE),
    "score_ml": with_ctes(
        """SELECT log_id, round(ml, 6) AS ml_score, round(abs(ml - 0.5) * 2, 6) AS ml_confidence FROM (SELECT log_id,
 1.0::DOUBLE - (greatest(-0.5::DOUBLE, least(0.5::DOUBLE, CASE WHEN log_id % 7 < 2 THEN 0 WHEN log_id % 7 = 2 THEN decision * 5 ELSE decision END)) + 0.5) AS ml FROM formula)""",
        FORMULA_CTE),
    "score_blend_severity": with_ctes(
        """SELECT log_id, rule_score, final_score, CASE WHEN final_score >= 0.8 THEN 'CRITICAL' WHEN final_score >= 0.6 THEN 'HIGH'
 WHEN final_score >= 0.4 THEN 'MEDIUM' ELSE 'NORMAL' END AS severity FROM (SELECT log_id, rule_score,
 round(CASE WHEN rule_score >= 1 THEN greatest(t, 0.75) ELSE t END, 4) AS final_score FROM (SELECT *, rule_score * 0.55::DOUBLE + ml * 0.45::DOUBLE AS t
 FROM (SELECT log_id, (log_id % 5) * 0.25::DOUBLE AS rule_score, 1.0::DOUBLE - (greatest(-0.5::DOUBLE, least(0.5::DOUBLE, decision)) + 0.5) AS ml FROM formula)))""",
        FORMULA_CTE),
    "score_hybrid": with_ctes(
        """SELECT log_id, rule_score, round(ml_score, 6) AS ml_score, final_score, severity, triggered_rules, round(ml_confidence, 6) AS ml_confidence,
 is_anomaly FROM scores""", SCORES_CTE),
    "score_recent_batch": with_ctes(
        "SELECT log_id, final_score, severity FROM scores WHERE log_id IN (SELECT id FROM recent)", SCORES_CTE),
    "score_first_wins_sink": with_ctes(
        "SELECT log_id, CASE WHEN log_id % 3 > 0 THEN final_score ELSE 0.0 END AS final_score FROM scores", SCORES_CTE),
    "score_summary": with_ctes(
        """SELECT v.severity, count(s.log_id) AS logs, any_value(t.total) AS total, any_value(t.anomalies) AS anomalies,
 round(any_value(t.f), 6) AS mean_final, round(any_value(t.r), 6) AS mean_rule, round(any_value(t.m), 6) AS mean_ml,
 round(100.0 * count(s.log_id) / any_value(t.total), 6) AS percent, round(any_value(t.anomalies) / any_value(t.total), 6) AS anomaly_rate
FROM (VALUES ('NORMAL'), ('MEDIUM'), ('HIGH'), ('CRITICAL')) v(severity) LEFT JOIN scores s ON s.severity = v.severity,
 (SELECT count(*) AS total, count(*) FILTER (is_anomaly) AS anomalies, avg(final_score) AS f, avg(rule_score) AS r, avg(ml_score) AS m FROM scores) t
GROUP BY v.severity""", SCORES_CTE),
    "score_top_anomalies": with_ctes(
        """SELECT log_id, rule_score, round(ml_score, 6) AS ml_score, final_score, severity, triggered_rules FROM scores WHERE is_anomaly
ORDER BY final_score DESC, log_id LIMIT 10""", SCORES_CTE),
    "check_score_constraints": with_ctes(
        """SELECT u.* FROM (SELECT count(*) AS n FROM scores), (VALUES ('rule_score_range', 0::BIGINT), ('ml_score_range', 0), ('final_score_range', 0),
 ('severity_domain', 0), ('ml_confidence_range', 0), ('is_anomaly_present', 0)) u("constraint", violations)""", SCORES_CTE),
    "check_every_score_constraint": with_ctes(
        """SELECT name AS constraint, count(*) AS violations FROM scores JOIN (VALUES (0, 'rule_score_range'), (1, 'ml_score_range'), (2, 'final_score_range'),
 (3, 'severity_domain'), (4, 'ml_confidence_range'), (5, 'is_anomaly_present')) v(turn, name) ON log_id % 31 = turn GROUP BY name""", SCORES_CTE),
    "check_every_alert_constraint": with_ctes(
        """SELECT name AS constraint, count(alert_id) AS violations FROM (VALUES ('brute_force', 'alert_type_present'), ('sql_injection', 'severity_domain'),
 ('port_scanning', 'source_domain'), ('path_traversal', 'confidence_range'), ('suspicious_user_agent', 'timestamp_present')) v(kind, name)
 LEFT JOIN alerts ON alert_type = kind GROUP BY name""", ALERTS_CTE),
    "check_alert_constraints": with_ctes(
        """SELECT u.* FROM (SELECT count(*) FILTER (alert_type = 'port_scanning') AS n FROM alerts),
 LATERAL (VALUES ('alert_type_present', 0::BIGINT), ('severity_domain', 0), ('source_domain', n), ('confidence_range', 0), ('timestamp_present', 0))
 u("constraint", violations)""", ALERTS_CTE),
}
