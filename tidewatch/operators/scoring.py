"""Blending rule and model evidence into one score and severity per log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import clip, ratio
from tidewatch.operators.features import extract_features
from tidewatch.schemas import SCORE_SEVERITIES
from tidewatch.sources.tables import lookback

# Weights of the blend, evidence per alert severity, severity limits of the final score.
RULE_WEIGHT = 0.55
ML_WEIGHT = 0.45
SEVERITY_SCORES = {"CRITICAL": 1.00, "HIGH": 0.75, "MEDIUM": 0.50, "LOW": 0.25}
SEVERITY_LIMITS = {"CRITICAL": 0.80, "HIGH": 0.60, "MEDIUM": 0.40}
CERTAIN_RULE_FLOOR = 0.75


def severity_score(severity: Column) -> Column:
    score = F.lit(SEVERITY_SCORES["LOW"])
    for name, value in SEVERITY_SCORES.items():
        score = F.when(severity == name, value).otherwise(score)
    return score


def rule_scores(members: DataFrame) -> DataFrame:
    """(log_id, rule_score, triggered_rules): the strongest alert naming the log, and all of them.

    Rules are listed by severity name descending, then by rule name. A log is named once per rule
    and run, so the list stays short however many logs an alert has.
    """
    def by_severity(a: Column, b: Column) -> Column:
        return (
            F.when(a["severity"] > b["severity"], -1)
            .when(a["severity"] < b["severity"], 1)
            .when(a["alert_type"] < b["alert_type"], -1)
            .when(a["alert_type"] > b["alert_type"], 1)
            .otherwise(0)
        )

    return members.groupBy("log_id").agg(
        F.max(severity_score(F.col("severity"))).alias("rule_score"),
        F.transform(
            F.array_sort(F.collect_list(F.struct("severity", "alert_type")), by_severity), lambda r: r["alert_type"]
        ).alias("triggered_rules"),
    )


def ml_score(decision: Column) -> Column:
    """Model decision (high = normal) as a score in 0..1 (high = anomalous)."""
    return 1.0 - (clip(decision, -0.5, 0.5) + 0.5)


def ml_confidence(score: Column) -> Column:
    return F.abs(score - 0.5) * 2.0


def clean_feature(column: Column) -> Column:
    """Missing, not-a-number and infinite feature values count as 0."""
    number = column.try_cast("double")
    return F.when(number.isNull() | F.isnan(number) | (F.abs(number) == float("inf")), 0.0).otherwise(number)


def check_weights(rule_weight: float, ml_weight: float) -> None:
    if abs(rule_weight + ml_weight - 1.0) >= 1e-6:
        raise ValueError("the weights of rule and model score must sum to 1")


def blend(rule: Column, ml: Column, rule_weight: float = RULE_WEIGHT, ml_weight: float = ML_WEIGHT) -> Column:
    """Weighted sum, not below the floor once a rule is certain; 4 decimals."""
    check_weights(rule_weight, ml_weight)
    total = rule * rule_weight + ml * ml_weight
    return F.round(F.when(rule >= 1.0, F.greatest(total, F.lit(CERTAIN_RULE_FLOOR))).otherwise(total), 4)


def severity(score: Column) -> Column:
    name = F.lit("NORMAL")
    for level, limit in sorted(SEVERITY_LIMITS.items(), key=lambda item: item[1]):
        name = F.when(score >= limit, level).otherwise(name)
    return name


def hybrid_scores(
    decisions: DataFrame, members: DataFrame, rule_weight: float = RULE_WEIGHT, ml_weight: float = ML_WEIGHT
) -> DataFrame:
    """One score row per row of ``decisions`` (log_id, decision)."""
    scored = (
        decisions.select("log_id", "decision")
        .join(rule_scores(members), "log_id", "left")
        .withColumns({
            "rule_score": F.coalesce("rule_score", F.lit(0.0)),
            "triggered_rules": F.coalesce("triggered_rules", F.array().cast("array<string>")),
            "ml_score": ml_score(F.col("decision")),
        })
        .withColumn("final_score", blend(F.col("rule_score"), F.col("ml_score"), rule_weight, ml_weight))
        .withColumn("severity", severity(F.col("final_score")))
    )
    return scored.select(
        "log_id",
        "rule_score",
        "ml_score",
        "final_score",
        "severity",
        "triggered_rules",
        ml_confidence(F.col("ml_score")).alias("ml_confidence"),
        (F.col("severity") != "NORMAL").alias("is_anomaly"),
    )


def recent_features(
    features: DataFrame, logs: DataFrame, days: int = 7, as_of: Column | None = None, all_if_none: bool = False
) -> DataFrame:
    """Features of the logs of the last days. With ``all_if_none``, all features when no log is that young."""
    young = lookback(logs, days, as_of)
    if all_if_none and young.isEmpty():
        return features
    return features.join(young.select(F.col("id").alias("log_id")), "log_id", "left_semi")


def evaluate_batch(
    logs: DataFrame, members: DataFrame, decide, days: int = 7, as_of: Column | None = None, all_if_none: bool = False
) -> DataFrame:
    """Scores of the logs of the last days; ``decide`` maps a feature frame to (log_id, decision)."""
    return hybrid_scores(decide(recent_features(extract_features(logs), logs, days, as_of, all_if_none)), members)


def score_summary(scores: DataFrame) -> DataFrame:
    """Count and share of every severity, beside the overall anomaly rate and mean scores."""
    counts = [F.count_if(F.col("severity") == s).alias(s) for s in SCORE_SEVERITIES]
    rows = F.array(*[F.struct(F.lit(s).alias("severity"), F.col(s).alias("logs")) for s in SCORE_SEVERITIES])
    return (
        scores.agg(
            *counts,
            F.count(F.lit(1)).alias("total"),
            F.count_if("is_anomaly").alias("anomalies"),
            F.avg("final_score").alias("mean_final"),
            F.avg("rule_score").alias("mean_rule"),
            F.avg("ml_score").alias("mean_ml"),
        )
        .select("total", "anomalies", "mean_final", "mean_rule", "mean_ml", F.inline(rows))
        .withColumn("percent", 100 * ratio(F.col("logs"), F.col("total")))
        .withColumn("anomaly_rate", ratio(F.col("anomalies"), F.col("total")))
    )


def top_anomalies(scores: DataFrame, limit: int = 10) -> DataFrame:
    return scores.filter("is_anomaly").orderBy(F.desc("final_score"), "log_id").limit(limit)
