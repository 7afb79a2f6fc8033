"""Many isolation forests in one job against single fits; folds as ranges against folds as rows; the commit log of appends."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import dataset as D
from tidewatch.operators import forest as I
from tidewatch.plans import training as T
from tidewatch.sources import tables
from tidewatch.sources.commits import CommitLog

COLUMNS = ["status_code", "hour_of_day", "endpoint_length", "endpoint_entropy", "query_param_count", "response_time_ms"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    n = 500
    frame = pd.DataFrame(rng.normal(size=(n, len(COLUMNS))), columns=COLUMNS)
    frame["label"] = (rng.random(n) < 0.15).astype(int)
    frame.loc[frame["label"] == 1, COLUMNS] += 5
    frame["log_id"] = rng.permutation(n)
    frame["timestamp"] = [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=int(i) // 3) for i in range(n)]  # ties in time
    return spark.createDataFrame(frame.sample(frac=1, random_state=1)).cache()


def configs(**more):
    base = [{"n_estimators": 6, "max_samples": 32}, {"n_estimators": 9, "max_samples": 32, "max_features": 0.6}, {"n_estimators": 5, "max_samples": 64, "bootstrap": True}]
    return [I.IsolationConfig(feature_set=s, **b, **more) for s in ("all_features", "endpoint_temporal") for b in base]


@pytest.mark.parametrize("holes", [False, True])
def test_grid_equals_single_fits(data, holes):
    rows = data.withColumn("part", F.when(F.col("log_id") % 3 == 0, "a").otherwise("b"))
    if holes:
        rows = rows.withColumn("endpoint_entropy", F.when(F.col("log_id") % 7 > 0, F.col("endpoint_entropy")))
        rows = rows.withColumn("hour_of_day", F.when(F.col("part") == "a", F.lit(None)).otherwise(F.lit(float("inf"))).cast("double"))
    found = I.fit_isolation_grid(rows, COLUMNS, configs())
    assert sorted(found) == ["a", "b"]
    for part, models in found.items():
        own = rows.filter(F.col("part") == part)
        singles = [I.fit_isolation(own, COLUMNS, c) for c in configs()]
        for one, many in zip(singles, models):
            pd.testing.assert_frame_equal(one.nodes, many.nodes, check_dtype=False)
            assert (one.columns, one.samples, one.config) == (many.columns, many.samples, many.config)
            assert all(np.allclose(one.scale[c], many.scale[c]) for c in one.columns)
        scored = {(r.config, r.log_id): r.score for r in I.isolation_grid_scores(own, models).collect()}
        assert len(scored) == own.count() * len(models)
        for one in singles:
            for r in I.isolation_scores(own, one).collect():
                assert scored[one.config.name, r.log_id] == pytest.approx(r.score, abs=1e-12)


def test_the_driver_reads_single_models(data, monkeypatch):
    """Fitting collects no nodes; scoring holds one run of models at a time and gives the scores of all at once."""
    rows = data.withColumn("part", F.lit("a"))
    read, plain = [], I.IsolationGrid.model
    monkeypatch.setattr(I.IsolationGrid, "model", lambda grid, part, number: read.append(number) or plain(grid, part, number))
    models = I.fit_isolation_grid(rows, COLUMNS, configs())["a"]
    assert not read and len(models) == 6 and models[-1].config == configs()[-1] and read == [5]
    once = {(r.config, r.log_id): r.score for r in I.isolation_grid_scores(rows, models).collect()}
    monkeypatch.setattr(I, "NODES_A_PASS", 300)
    assert len(list(I._passes(models))) > 2
    assert {(r.config, r.log_id): r.score for r in I.isolation_grid_scores(rows, models).collect()} == once and len(once) == 3000


def test_fold_ranges_hold_the_rows_of_the_folds(data):
    stored = D.by_time(data)
    want = {(r.fold, r.split, r.log_id) for r in D.backtest_folds(data).collect()}
    parts = D.fold_ranges(stored)
    names = sorted({p.fold for p in parts})
    got = [(n, r.split, r.log_id) for n in names for r in D.fold_rows(stored, parts, n, ["train", "validation", "test"]).collect()]
    assert set(got) == want and len(got) == len(want) and names == ["fold_1", "fold_2", "fold_3"]
    late = [p for p in parts if p.split == "test"][-1]
    length = "spark.sql.maxMetadataStringLength"
    stored.sparkSession.conf.set(length, 10_000)
    plan = stored.filter(late.holds())._jdf.queryExecution().executedPlan().toString()
    stored.sparkSession.conf.unset(length)
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThanOrEqual(timestamp" in plan  # reaches the scan
    with pytest.raises(ValueError, match="anomalies"):
        D.fold_ranges(stored.withColumn("label", F.lit(0)))


def test_no_rows_have_no_folds(data):
    with pytest.raises(ValueError, match="anomalies"):
        D.fold_ranges(data.limit(0))


def test_search_over_folds(data):
    stored = D.by_time(data)
    scores = T.isolation_fold_scores(stored, D.fold_ranges(stored), COLUMNS, configs()[:2])
    assert scores.groupBy("config", "fold", "split").count().count() == 2 * 3 * 2


# The commit log


def logs(spark, n, day=1):
    return spark.range(n).select(F.lit(dt.datetime(2024, 1, day)).alias("timestamp"), F.concat(F.lit("x"), "id").alias("ip"))


def test_appends_read_no_data(spark, tmp_path, monkeypatch):
    """Ids go on from the log: not even a broken data file is noticed."""
    path = str(tmp_path / "raw")
    tables.append_logs(logs(spark, 5), path)
    monkeypatch.setattr(tables, "last_id", lambda *a: pytest.fail("scanned"))
    for day in (1, 2):
        tables.append_logs(logs(spark, 4, day), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(1, 14))
    (tmp_path / "raw" / "date=2024-01-01" / "part-broken.parquet").write_bytes(b"no parquet")
    tables.append_logs(logs(spark, 2, 3), path)
    newest = CommitLog(spark, path).newest()
    assert (newest.number, newest.first_id, newest.last_id, newest.rows, newest.days, newest.appends, newest.total_rows) == (4, 14, 15, 2, ["2024-01-03"], 4, 15)


def test_tables_without_a_log_are_scanned_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    logs(spark, 3).withColumn("id", F.lit(40).cast("long")).withColumn("date", F.to_date("timestamp")).write.partitionBy("date").parquet(path)
    tables.append_logs(logs(spark, 2), path)
    assert tables.last_id(spark, path) == 42 and tables.last_id(spark, str(tmp_path / "none")) == 0


def test_rows_with_ids_of_their_own(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.append_logs(logs(spark, 2), path)
    for first in (100, 50):
        tables.append_logs(logs(spark, 5).withColumn("id", F.monotonically_increasing_id() % 2 + first), path)
    assert tables.last_id(spark, path) == 101 and not CommitLog(spark, path).newest().known
    tables.append_logs(logs(spark, 2), path)
    assert tables.last_id(spark, path) == 103 and CommitLog(spark, path).newest().appends == 2


def test_failed_appends_are_counted_and_keep_their_ids(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "raw"))
    assert log.newest() is None and log.failed() == 0

    def broken(before):
        raise RuntimeError("disk")

    log.append(3, [], lambda before: None, lambda: 10)
    with pytest.raises(RuntimeError, match="disk"):
        log.append(5, [], broken, lambda: 0)
    assert log.failed() == 1
    seen = []
    assert log.append(2, [], seen.append, lambda: 0).last_id == 20 and seen == [18]
    assert log.failed() == 1


def test_two_writers_never_share_ids(spark, tmp_path):
    """A claim made between reading the log and claiming is noticed."""
    log, other, rng = CommitLog(spark, str(tmp_path / "raw")), CommitLog(spark, str(tmp_path / "raw")), random.Random(1)
    seen, plain = [], log._create

    def raced(name, text):
        if name.endswith(".begun") and rng.random() < 0.6:
            seen.append(other.append(2, [], lambda before: None, lambda: 0))
        return plain(name, text)

    log._create = raced
    seen += [log.append(3, [], lambda before: None, lambda: 0) for _ in range(4)]
    ids = [i for e in seen for i in range(e.first_id, e.last_id + 1)]
    assert len(ids) == len(set(ids)) == max(ids) and len(seen) > 4


def test_old_entries_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidewatch.sources.commits.KEPT", 3)
    log = CommitLog(spark, str(tmp_path / "raw"))
    for _ in range(6):
        log.append(1, [], lambda before: None, lambda: 0)
    assert len(log.names()) == 6 and log.newest().total_rows == 6
