"""Steps that queries share are done once, in parallel and compiled, with the results of the plain rule."""

from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from catalog import common, models, streams
from tidewatch.operators import forest as I

FOLDER = "/root/testdata/sf0.001"


def test_each_batch_of_the_scored_stream_has_the_files_of_many_tasks(spark, monkeypatch):
    raw = common.logs(spark, FOLDER).repartition(4)
    made, batches = {}, []
    known = streams.shared_folder

    def shared_folder(session, name):
        made[name] = known(session, name)
        return made[name]

    def score_closed(stream, *rest):
        batches.append(len(spark.read.schema(stream.schema).parquet(made["steps"]).inputFiles()))
        return SimpleNamespace(awaitTermination=lambda: None)

    monkeypatch.setattr(streams, "logs", lambda *a: raw)
    monkeypatch.setattr(streams, "stored_logs", lambda *a: raw, raising=False)
    monkeypatch.setattr(streams, "shared_folder", shared_folder)
    monkeypatch.setattr(streams.E, "store_profiles", lambda *a: None)
    monkeypatch.setattr(streams.E, "load_profiles", lambda *a: None)
    monkeypatch.setattr(streams.J, "score_closed", score_closed)
    streams._scored_in_steps(spark, FOLDER)
    assert len(batches) == 5 and batches[0] >= 4 and batches[-1] >= 20
    assert spark.read.parquet(made["steps"]).count() == raw.count()


def test_logs_are_taken_apart_once_for_all_steps_of_a_stored_model(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(common, "logs", lambda *a, known=common.logs: calls.append(a) or known(*a))
    monkeypatch.setattr(models, "logs", common.logs, raising=False)
    assert models._stored_counts(spark, FOLDER).first()["percent"] == 100.0
    assert len(calls) == 1


def test_trees_draw_rows_by_their_hashes_without_an_interpreted_filter(spark):
    config = I.IsolationConfig(n_estimators=7, max_samples=20)
    rows = spark.range(900).select(F.col("id").alias("log_id"))
    drawn = I.tree_samples(rows, 900, config)
    assert "lambda" not in drawn._jdf.queryExecution().optimizedPlan().toString()
    share = int(I._HASH_RANGE * (20 + 10 * np.sqrt(20) + 50) / 900)
    want = set()
    for tree in range(7):
        hashed = rows.select("log_id", F.pmod(F.xxhash64("log_id", F.lit(tree), F.lit(I.SEED)), F.lit(I._HASH_RANGE)).alias("h"), F.xxhash64("log_id", F.lit(tree), F.lit(I.SEED + 1)).alias("draw")).collect()
        want |= {(tree, r["log_id"]) for r in sorted((r for r in hashed if r["h"] < share), key=lambda r: (r["draw"], r["log_id"]))[:20]}
    assert {(r["tree"], r["log_id"]) for r in drawn.collect()} == want


def test_trees_are_walked_as_node_by_node():
    rng = np.random.default_rng(3)
    values = rng.normal(size=(700, 5))
    config = I.IsolationConfig(n_estimators=9, max_samples=64)
    nodes = pd.concat([I._tree(values[rng.integers(0, 700, 64)], t, config, 1) for t in range(9)])
    model = I.IsolationModel(list("abcde"), {c: (0.2, 1.5) for c in "abcde"}, 64, config, nodes)
    values[4, 2] = np.nan
    trees = {t: g.set_index("node") for t, g in nodes.groupby("tree")}
    want = []
    for row in (values - 0.2) / 1.5:
        paths = []
        for tree in trees.values():
            at = 0
            while tree["left"][at] != at:
                at = tree["left"][at] if row[tree["feature"][at]] <= tree["threshold"][at] else tree["right"][at]
            paths.append(tree["path"][at])
        want.append(0.5 - 2.0 ** (-np.mean(paths) / I.average_path(64)))
    assert np.allclose(I._decisions(I._flat(model), I._walk(model), values), want, atol=1e-12)
