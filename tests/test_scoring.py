from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.operators import checks as C
from tidewatch.operators import scoring as S
from tidewatch.schemas import SCORE_SEVERITIES
from tidewatch.sources import tables as T

UNIT = st.floats(min_value=0.0, max_value=1.0, allow_nan=False)


def test_severity_limits(spark):
    cases = [(0.95, "CRITICAL"), (0.80, "CRITICAL"), (0.79, "HIGH"), (0.60, "HIGH"), (0.59, "MEDIUM"), (0.40, "MEDIUM"), (0.39, "NORMAL")]
    df = spark.createDataFrame(cases, "score double, expected string")
    assert df.filter(S.severity(F.col("score")) != F.col("expected")).count() == 0


def test_blend(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.75, 0.5), (0.0, 0.0), (1.0, 1.0)], "r double, m double")
    assert [r[0] for r in df.select(S.blend(F.col("r"), F.col("m"))).collect()] == [0.75, 0.6375, 0.0, 1.0]


def test_weights_must_sum_to_one():
    with pytest.raises(ValueError):
        S.check_weights(0.6, 0.6)
    S.check_weights(0.3, 0.7)


def test_ml_score_and_cleaning(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.2,), (9.0,), (None,), (float("nan"),), (float("inf"),)], "d double")
    rows = df.select(S.ml_score(S.clean_feature(F.col("d"))).alias("s")).select("s", S.ml_confidence(F.col("s"))).collect()
    assert [round(r[0], 6) for r in rows] == [1.0, 0.5, 0.3, 0.0, 0.5, 0.5, 0.5]
    assert [round(r[1], 6) for r in rows] == [1.0, 0.0, 0.4, 1.0, 0.0, 0.0, 0.0]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(UNIT, UNIT), min_size=1, max_size=50))
def test_score_properties(spark, pairs):
    df = spark.createDataFrame(pairs, "r double, m double").withColumn("f", S.blend(F.col("r"), F.col("m")))
    rows = df.withColumn("s", S.severity(F.col("f"))).collect()
    order = {name: i for i, name in enumerate(SCORE_SEVERITIES)}
    assert all(0 <= r["f"] <= 1 and r["s"] in order for r in rows)
    ranks = [order[r["s"]] for r in sorted(rows, key=lambda r: r["f"])]
    assert ranks == sorted(ranks)


def members(spark):
    rows = [("a1", "port_scanning", "MEDIUM", 1), ("a2", "sql_injection", "CRITICAL", 1), ("a3", "port_scanning", "MEDIUM", 1),
            ("a4", "time_anomaly", "LOW", 2), ("a5", "brute_force", "HIGH", 2)]
    return spark.createDataFrame(rows, "alert_id string, alert_type string, severity string, log_id long")


def test_rule_scores(spark):
    got = {r["log_id"]: (r["rule_score"], r["triggered_rules"]) for r in S.rule_scores(members(spark)).collect()}
    assert got == {1: (1.0, ["port_scanning", "port_scanning", "sql_injection"]), 2: (0.75, ["time_anomaly", "brute_force"])}


def test_hybrid_summary_and_top(spark):
    decisions = spark.createDataFrame([(1, 0.5), (2, -0.5), (3, 0.4), (4, -0.5)], "log_id long, decision double")
    scores = S.hybrid_scores(decisions, members(spark))
    got = {r["log_id"]: (r["final_score"], r["severity"], r["is_anomaly"], r["triggered_rules"]) for r in scores.collect()}
    assert got[1][:3] == (0.75, "HIGH", True)
    assert got[2][:3] == (0.8625, "CRITICAL", True)
    assert got[3] == (0.045, "NORMAL", False, []) and got[4][:2] == (0.45, "MEDIUM")
    assert [r["log_id"] for r in S.top_anomalies(scores, 2).collect()] == [2, 1]
    summary = {r["severity"]: (r["logs"], r["percent"], r["anomaly_rate"]) for r in S.score_summary(scores).collect()}
    assert summary["CRITICAL"] == (1, 25.0, 0.75) and summary["NORMAL"] == (1, 25.0, 0.75)
    assert all(r["violations"] == 0 for r in C.violations(scores, C.score_constraints()).collect())


def test_first_score_wins(spark, tmp_path):
    path = str(tmp_path / "scores")
    first = S.hybrid_scores(spark.createDataFrame([(1, 0.5), (2, 0.0)], "log_id long, decision double"), members(spark))
    T.append_first_scores(first, path)
    T.append_first_scores(first.withColumn("final_score", F.lit(0.1)).unionByName(
        first.withColumn("log_id", F.lit(9).cast("long")).limit(1)), path)
    T.append_first_scores(first.limit(0), path)
    stored = {r["log_id"]: r["final_score"] for r in spark.read.parquet(path).collect()}
    assert sorted(stored) == [1, 2, 9] and stored[1] == 0.75


def test_nothing_recent(spark):
    features = spark.createDataFrame([(1,), (2,)], "log_id long")
    logs = spark.sql("select 7L id, timestamp'2024-01-01' timestamp")
    assert S.recent_features(features, logs).count() == 0
    old = F.lit("2030-01-01").cast("timestamp")
    assert S.recent_features(features, logs, as_of=old).count() == 0
    assert S.recent_features(features, logs, as_of=old, all_if_none=True).count() == 2
    logs = spark.sql("select 2L id, timestamp'2024-01-01' timestamp")
    assert [r[0] for r in S.recent_features(features, logs).collect()] == [2]


def test_constraints_split(spark):
    df = spark.createDataFrame([("HIGH", 0.5), ("ODD", 2.0), (None, None)], "severity string, confidence double")
    rules = {"severity": F.col("severity").isin("HIGH"), "confidence": F.col("confidence") <= 1}
    good, bad = C.split_valid(df, rules)
    assert good.count() == 2  # as in SQL, null passes a check
    assert bad.first()["broken"] == ["severity", "confidence"]
