from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import classifier as K
from tidewatch.operators import evaluation as V
from tidewatch.operators import forest as I
from tidewatch.plans import training as T

COLUMNS = ["status_code", "hour_of_day", "endpoint_length", "endpoint_entropy", "query_param_count"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n = 600
    values = rng.normal(size=(n, len(COLUMNS)))
    label = (rng.random(n) < 0.1).astype(int)
    values[label == 1] += 6
    frame = pd.DataFrame(values, columns=COLUMNS)
    frame["label"] = label
    frame["log_id"] = np.arange(n)
    frame["timestamp"] = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=int(i)) for i in range(n)]
    third = np.arange(n) % 3
    frame["protocol_split"] = np.where(label == 1, np.where(third == 0, "threshold_validation", "novelty_test"),
                                       np.array(["baseline_train", "threshold_validation", "novelty_test"])[third])
    return spark.createDataFrame(frame).cache()


def small(**kw):
    return I.IsolationConfig(**{"n_estimators": 30, "max_samples": 64, **kw})


def test_outliers_stand_out(data):
    model = I.fit_isolation(data.filter("label = 0"), COLUMNS, small())
    scored = I.isolation_scores(data, model)
    ends = scored.agg(F.min("score"), F.max("score")).first()
    assert -0.5 <= ends[0] and ends[1] <= 0.5
    assert V.roc_auc(scored).first()["roc_auc"] > 0.97


@pytest.mark.parametrize("options", [{}, {"bootstrap": True, "max_features": 0.6}])
def test_same_seed_same_trees(data, options):
    one = I.fit_isolation(data.filter("label = 0"), COLUMNS, small(**options))
    two = I.fit_isolation(data.filter("label = 0").repartition(7), COLUMNS, small(**options))
    pd.testing.assert_frame_equal(one.nodes, two.nodes)
    assert one.nodes["tree"].nunique() == 30
    assert one.nodes.groupby("tree").size().max() <= 2 * 64 - 1


def test_sampling(spark):
    """One rule for few and many rows: every tree gets its full sample, and no row twice."""
    for n, trees, samples in ((50, 20, 32), (900, 20, 64), (30000, 10, 32)):
        config = I.IsolationConfig(n_estimators=trees, max_samples=samples)
        drawn = I.tree_samples(spark.range(n).withColumnRenamed("id", "log_id"), n, config)
        sizes = drawn.groupBy("tree").agg(F.count("log_id").alias("n"), F.count_distinct("log_id").alias("d")).collect()
        assert len(sizes) == trees and all(r["n"] == r["d"] == min(samples, n) for r in sizes), (n, trees)


def test_holes_take_the_median(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("inf")), (4, 3.0), (5, float("nan"))], "log_id long, a double")
    assert [r["a"] for r in I.filled_inputs(df, ["a"]).orderBy("log_id").collect()] == [1.0, 2.0, 2.0, 3.0, 2.0]
    rows, total, scale = I.prepared_inputs(df, ["a"])
    assert total == 5 and scale["a"][0] == 2.0 and rows.filter("a is null").count() == 0
    empty = I.filled_inputs(df.withColumn("a", F.lit(None).cast("double")), ["a"])
    assert empty.first()["a"] == 0.0


def test_path_length():
    assert [I.average_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert I.average_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_candidates():
    assert len(I.candidate_configs(I.FEATURES)) == 20
    assert {c.feature_set for c in I.candidate_configs(["status_code", "hour_of_day", "is_night", "x"])} == {"all_features"}


def test_save_and_load(spark, data, tmp_path):
    model = I.fit_isolation(data.filter("label = 0"), COLUMNS, small())
    I.save_isolation(model, spark, str(tmp_path / "m"), 0.1)
    again = I.load_isolation(spark, str(tmp_path / "m"))
    a = I.isolation_decision(data, model).orderBy("log_id").toPandas()["decision"]
    b = I.isolation_decision(data, again).orderBy("log_id").toPandas()["decision"]
    np.testing.assert_allclose(a, b)


def test_forest_and_elimination(data):
    noisy = data.withColumn("hour_of_day", F.rand(1))
    model = K.fit_forest(noisy, COLUMNS, trees=10)
    assert V.roc_auc(K.forest_scores(noisy, model, COLUMNS)).first()["roc_auc"] > 0.97
    ranks = K.eliminate_features(noisy, COLUMNS, keep=3, trees=10, depth=4)
    assert sorted(r for _, r in ranks) == [1, 1, 1, 2, 3] and ("hour_of_day", 1) not in ranks


def test_experiment(spark, data, tmp_path):
    forest = [{"name": "10", "trees": 10, "balanced": True, "thresholds": [0.3, 0.5]}]
    found = T.run_experiment(data, COLUMNS, [small(), small(bootstrap=True)], forest, str(tmp_path / "store"))
    metrics = {(r["model"], r["split"]): r["f1_score"] for r in found.metrics.collect()}
    assert len(metrics) == 6 and metrics["ensemble", "test"] > 0.8
    assert found.promotion.first()["test_positives"] == data.filter("log_id >= 480").agg(F.sum("label")).first()[0]
    assert found.budgets.count() == 8 and found.novelty["test_f1"] > 0.5
    assert I.load_isolation(spark, str(tmp_path / "store" / "isolation_forest")).columns == COLUMNS
