"""Order statistics, splits and evaluation against numpy."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import checks as C
from tidewatch.operators import dataset as D
from tidewatch.operators import evaluation as V
from tidewatch.operators.order_stats import magnitude_cell, quantiles, rank_cuts

START = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quantiles_by_group(spark, seed):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({"g": rng.integers(0, 3, 300), "x": np.round(rng.normal(0, 50, 300), rng.integers(0, 3))})
    probs = [0.0, 0.1, 0.5, 0.95, 1.0]
    found = quantiles(spark.createDataFrame(frame), "x", probs, by=["g"]).collect()
    assert len(found) == 15
    for r in found:
        assert r["quantile"] == pytest.approx(frame[frame["g"] == r["g"]]["x"].quantile(r["prob"]), abs=1e-9)


def test_quantiles_weighted_hot_value_and_empty(spark):
    frame = spark.createDataFrame([(1.0, 10), (2.0, 1), (None, 5)], "x double, w long")
    assert quantiles(frame, "x", [0.5], weight="w").first()["quantile"] == 1.0
    assert quantiles(frame.filter("x > 5"), "x", [0.5]).count() in (0, 1)


def test_magnitude_cell_is_monotone(spark):
    values = sorted([-1e9, -5.0, -0.3, 0.0, 0.2, 1.0, 1.0001, 7e5, 1e12])
    cells = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(magnitude_cell(F.col("v"))).collect()]
    assert cells == sorted(cells)


def test_rank_cuts_with_ties(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"t": rng.integers(0, 4, 90), "id": rng.permutation(90)})
    ranks = {f"r{k}": F.lit(k) for k in (0, 17, 44, 89, 90)}
    cuts = {r["cut"]: (r["major"], r["minor"]) for r in rank_cuts(
        spark.createDataFrame(frame), F.col("t"), F.col("id"), ranks, major_cell=lambda c: c).collect()}
    order = frame.sort_values(["t", "id"]).to_records(index=False)
    assert cuts == {f"r{k}": (order[k].t, order[k].id) for k in (0, 17, 44, 89)}


def timed(spark, n, tie=7):
    rows = [(i, START + dt.timedelta(seconds=i // tie), int(i % 5 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "log_id long, timestamp timestamp, label int")


def test_holdout_counts(spark):
    counts = {r["split"]: r["count"] for r in D.holdout_split(timed(spark, 103)).groupBy("split").count().collect()}
    assert counts == {"train": int(103 * 0.6), "validation": int(103 * 0.8) - int(103 * 0.6), "test": 103 - int(103 * 0.8)}


def test_backtest_folds(spark):
    folds = D.backtest_folds(timed(spark, 101))
    counts = {(r["fold"], r["split"]): r["count"] for r in folds.groupBy("fold", "split").count().collect()}
    assert counts == {(f"fold_{i}", s): n for i, f in enumerate((0.4, 0.5, 0.6), 1)
                      for s, n in (("train", int(101 * f)), ("validation", 20), ("test", 10))}
    assert D.require_folds(folds) == ["fold_1", "fold_2", "fold_3"]
    none = D.backtest_folds(timed(spark, 101).withColumn("label", F.lit(0)))
    with pytest.raises(ValueError):
        D.require_folds(none)


def test_label_checks(spark):
    with pytest.raises(ValueError):
        D.check_labels(timed(spark, 10).withColumn("label", F.lit(0)))
    with pytest.warns(UserWarning):
        D.check_labels(timed(spark, 500).withColumn("label", (F.col("log_id") == 3).cast("int")))


def test_protocol_needs_all_parts(spark):
    rows = timed(spark, 40).withColumn("data", F.lit('{"scenario": "normal"}'))
    parts = D.novelty_split(D.with_protocol(rows))
    assert sum(p.count() for p in parts.values()) == 40
    with pytest.raises(ValueError):
        D.novelty_split(D.with_protocol(rows.withColumn("data", F.lit("{}"))))


def test_correlations_and_scaling(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=200)
    frame = pd.DataFrame({"a": a, "b": 2 * a + 1000, "c": rng.normal(size=200), "d": 3.0})
    df = spark.createDataFrame(frame)
    names = list("abcd")
    got = {(r["left"], r["right"]): r["r"] for r in D.correlations(df, names).collect()}
    assert got["a", "b"] == pytest.approx(1) and got["a", "c"] == pytest.approx(frame["a"].corr(frame["c"])) and got["a", "d"] is None
    assert D.drop_correlated(df, names)[1] == ["a", "c", "d"]
    scaled = D.standardise(df, D.scale_parameters(df, names)).toPandas()
    assert scaled["a"].std(ddof=0) == pytest.approx(1) and (scaled["d"] == 0).all()


def test_quality_flags(spark):
    df = spark.createDataFrame([(1.0, float("inf"), 5.0), (None, 1.0, 5.0)], "a double, b double, c double")
    got = {r["column"]: (r["nulls"], r["infinite"], r["constant"]) for r in C.quality(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (1, 0, True), "b": (0, 1, False), "c": (0, 0, True)}


def judged(seed=3, n=250):
    rng = np.random.default_rng(seed)
    score = np.round(rng.random(n), 2)
    return pd.DataFrame({"log_id": rng.permutation(n), "score": score, "label": (rng.random(n) < score * 0.5).astype(int)})


def test_auc_and_metrics(spark):
    frame = judged()
    pos, neg = frame[frame.label == 1].score.to_numpy(), frame[frame.label == 0].score.to_numpy()
    pairs = pos[:, None] - neg[None, :]
    row = V.evaluate(spark.createDataFrame(frame), F.lit(0.6)).first()
    assert row["roc_auc"] == pytest.approx(((pairs > 0).sum() + 0.5 * (pairs == 0).sum()) / pairs.size)
    hit = frame.score >= 0.6
    tp = int((hit & (frame.label == 1)).sum())
    assert (row["tp"], row["fp"]) == (tp, int(hit.sum()) - tp)
    assert row["precision"] == pytest.approx(tp / hit.sum()) and row["recall"] == pytest.approx(tp / len(pos))
    one_class = spark.createDataFrame(frame.assign(label=0))
    assert V.roc_auc(one_class).first()["roc_auc"] == 0.5
    assert V.evaluate(one_class, F.lit(2.0)).first()["f1_score"] == 0.0


def test_best_threshold(spark):
    frame = judged()
    grid = sorted([0.1, 0.35, 0.5, 0.51, 0.7, 0.99])

    def key(t):
        hit = frame.score >= t
        tp = (hit & (frame.label == 1)).sum()
        p = tp / hit.sum() if hit.sum() else 0.0
        r = tp / (frame.label == 1).sum()
        return (2 * p * r / (p + r) if p + r else 0.0, p, r, -t)

    best = V.best_threshold(spark.createDataFrame(frame), V.fixed_thresholds(grid)).first()
    assert best["threshold"] == max(grid, key=key)
    candidates = V.threshold_candidates(spark.createDataFrame(frame)).first()["thresholds"]
    wanted = [frame.score.quantile(q) for q in V.THRESHOLD_QUANTILES] + list(np.linspace(frame.score.min(), frame.score.max(), 25))
    np.testing.assert_allclose(candidates, sorted(wanted))


def test_review_budget_with_hot_tie(spark):
    frame = judged()
    frame.loc[frame.index[:120], "score"] = 0.9
    ordered = frame.sort_values(["score", "log_id"], ascending=[False, True])
    for r in V.review_budget(spark.createDataFrame(frame)).collect():
        k = max(1, int(len(frame) * r["budget"]))
        assert (r["top_k"], r["hits"]) == (k, int(ordered.label.iloc[:k].sum()))
        assert r["recall_at_k"] == pytest.approx(r["hits"] / frame.label.sum())


def test_isolation_only_and_promotion(spark):
    df = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (1, 1, 1), (0, 0, 1)], "isolation_pred int, forest_pred int, label int")
    row = V.isolation_only(df).first()
    assert (row["reviewed"], row["hits"], row["precision"]) == (2, 1, 0.5) and row["anomaly_coverage"] == pytest.approx(1 / 3)
    assert V.promotion(df).first()["promoted"] is False and V.promotion(df, 3).first()["promoted"] is True


def test_misaligned_counts_repeated_rows_once_per_side(spark):
    """Repeated and null rows as exceptAll counts them, with one grouping for both directions."""
    rows = [(1, "a"), (1, "a"), (1, "a"), (2, None), (None, None), (3, "c")]
    left = spark.createDataFrame(rows, "x int, y string")
    right = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "c"), (4, "d")], "x int, y string")
    found = D.misaligned(left, right, ["x", "y"])
    want = left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.count() == 5
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_protocol_and_correlations_run_their_input_once(spark):
    """What makes the rows runs for the rows only, not again for each statistic over them."""
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    times = spark.range(40).selectExpr("id log_id", "timestamp_seconds(id * 60) timestamp", "CAST(id % 7 AS double) a", "CAST(id % 5 AS double) b", "'{\"scenario\":\"normal\"}' data")
    rows = times.mapInArrow(seen, times.schema)
    assert D.with_protocol(rows).count() == 40 and runs.value == 40
    assert set(D.with_protocol(D.with_scenario(times)).columns) == set(D.with_protocol(times).columns) - {"data"}
    before = runs.value
    assert D.correlations(rows, ["a", "b"]).count() == 1 and runs.value - before == 40
