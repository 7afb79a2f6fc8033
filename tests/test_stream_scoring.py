"""Scores of closed spans: whatever the batches, bursts over several of them, late logs, failures; state by key; panes."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import features as E
from tidewatch.operators import forest as I
from tidewatch.operators import rules as R
from tidewatch.operators import scoring as S
from tidewatch.schemas import FEATURES
from tidewatch.session import folders
from tidewatch.streaming import jobs as J
from tidewatch.streaming.state import KeyedState

COLUMNS = "id long, timestamp timestamp, ip string, method string, endpoint string, status int, response_time_ms double, user_agent string, data string"
START = dt.datetime(2024, 1, 1, 12)


def traffic():
    """Two hours of requests; a burst of failed logins at 12:18-12:22 and a scan over 10 endpoints."""
    rng = random.Random(5)
    rows = []
    for n in range(400):
        rows.append((rng.uniform(0, 7200), f"10.0.0.{rng.randint(1, 9)}", "GET", f"/p/{rng.randint(0, 6)}?a={n % 3}", rng.choice([200, 200, 404]), rng.uniform(1, 90)))
    rows += [(1080 + 15 * n, "6.6.6.6", "POST", "/login", 401, 5.0) for n in range(16)]
    rows += [(3000 + 2 * n, None, "GET", f"/scan/{n}", 404, None) for n in range(12)]
    rows.sort(key=lambda r: r[0])
    return [(n, START + dt.timedelta(seconds=r[0]), *r[1:], "x", "{}") for n, r in enumerate(rows)]


@pytest.fixture(scope="module")
def whole(spark):
    return spark.createDataFrame(traffic(), COLUMNS).cache()


@pytest.fixture(scope="module")
def profiles(spark, whole, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("profiles"))
    assert E.store_profiles(whole, folder) == E.load_profiles(spark, folder).base
    return E.load_profiles(spark, folder)


def decide(features):
    return features.select("log_id", (0.4 - F.col("requests_per_ip_5min") / 100 - F.col("endpoint_rarity") / 4 - F.col("requests_per_minute") / 400
                                      - F.least(F.col("time_since_last_request"), F.lit(900.0)) / 9000).alias("decision"))


def scored(spark, parts, place, profiles, decided=decide, **settings):
    source = f"{place}/in"
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(source)
    J.score_closed(stream, f"{place}/store", f"{place}/cp", decided, profiles, **settings).awaitTermination()
    return {r.log_id: (round(r.final_score, 4), r.rule_score, tuple(r.triggered_rules)) for r in spark.read.parquet(f"{place}/store/scores").collect()}


def batch_scores(whole, decided=decide, window="5 minutes"):
    members = J.windowed_alert_logs(whole, J.window_alerts(whole, window), window)
    found = S.hybrid_scores(decided(E.extract_features(whole)), members)
    return {r.log_id: (round(r.final_score, 4), r.rule_score, tuple(r.triggered_rules)) for r in found.collect()}


@pytest.mark.parametrize("cuts", [[1], [0.16, 0.2, 0.41, 0.55, 1]])
def test_any_cut_gives_the_scores_of_one_batch(spark, whole, profiles, tmp_path, cuts):
    ends = [0, *[int(7200 * c) for c in cuts]]
    second = F.unix_seconds("timestamp") - int(START.replace(tzinfo=dt.timezone.utc).timestamp())
    parts = [whole.filter((second >= a) & (second < b)) for a, b in zip(ends, ends[1:])]
    ours = scored(spark, parts, tmp_path, profiles, whole_every=2)
    newest = max(r[1] for r in traffic()) - dt.timedelta(minutes=10)
    closed = newest.replace(minute=newest.minute - newest.minute % 5, second=0, microsecond=0)
    want = {i: s for i, s in batch_scores(whole).items() if traffic()[i][1] < closed}
    assert ours == want and len(ours) > 350
    assert {r.related_logs for r in spark.read.parquet(f"{tmp_path}/store/alerts").filter("alert_type = 'brute_force'").collect()} == {8}
    assert len(folders(spark, f"{tmp_path}/store/waiting")) <= 2


def test_late_logs_are_scored_once(spark, whole, profiles, tmp_path):
    late = whole.filter("id = 3")
    ours = scored(spark, [whole.filter("id <> 3"), late, late], tmp_path, profiles)
    assert 3 in ours and spark.read.parquet(f"{tmp_path}/store/scores").filter("log_id = 3").count() == 1


def test_a_failed_batch_is_repeated(spark, whole, profiles, tmp_path):
    failed = []

    def once(features):
        if len(failed) < 1:
            failed.append(1)
            raise RuntimeError("lost")
        return decide(features)

    parts = [whole.filter("id < 150"), whole.filter("id >= 150")]
    with pytest.raises(Exception, match="lost"):
        scored(spark, parts, tmp_path, profiles, once)
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    J.score_closed(stream, f"{tmp_path}/store", f"{tmp_path}/cp", once, profiles).awaitTermination()
    ours = {r.log_id: round(r.final_score, 4) for r in spark.read.parquet(f"{tmp_path}/store/scores").collect()}
    want = batch_scores(whole)
    assert len(ours) > 350 and all(want[i][0] == s for i, s in ours.items())


def test_stored_model(spark, whole, profiles, tmp_path):
    model = I.fit_isolation(E.extract_features(whole), FEATURES, I.IsolationConfig(n_estimators=20))
    I.save_isolation(model, spark, f"{tmp_path}/model")
    decided = J.model_decisions(spark, f"{tmp_path}/model")
    ours = scored(spark, [whole.filter("id < 200"), whole.filter("id >= 200")], tmp_path, profiles, decided)
    want = batch_scores(whole, decided)
    assert len(ours) > 350 and all(abs(want[i][0] - s[0]) < 0.00011 and want[i][1:] == s[1:] for i, s in ours.items())


def test_later_features_of_the_unknown(spark, whole, profiles):
    row = [(900, START + dt.timedelta(days=1), "9.9.9.9", "PUT", "/never?seen=1", 200, 7.0, "x", "{}")]
    found = E.extract_later_features(spark.createDataFrame(row, COLUMNS), profiles).first()
    assert found.endpoint_rarity == found.method_endpoint_rarity == 1.0 and found.response_time_zscore_endpoint == 0.0
    assert found.requests_vs_ip_baseline_ratio == 1.0 and found.endpoint_entropy > 2 and found.requests_per_minute == 1.0


def test_keyed_state(spark, tmp_path):
    """Values of the newest change, whatever whole copies lie between; a repeated batch changes nothing; old parts go."""
    state, want = KeyedState(spark, str(tmp_path / "s"), ["k"], whole_every=3), {}
    assert state.before(0) is None
    for number in range(0, 24, 2):  # batch numbers may have gaps
        changed = {k: number for k in (None, f"k{number % 5}", "always")}
        for _ in range(2):
            frame = spark.createDataFrame(list(changed.items()), "k string, v int").coalesce(1)
            state.write(number, frame)
        before = state.before(number)
        assert ({r.k: r.v for r in before.collect()} if before is not None else {}) == want
        want |= changed
    assert {r.k: r.v for r in state.before(99).collect()} == want
    assert len(folders(spark, f"{tmp_path}/s/whole")) <= 2 and len(folders(spark, f"{tmp_path}/s/changes")) <= 7


def test_panes_equal_sliding_windows(spark, whole, tmp_path):
    """The same alerts from fewer rows of state: a row is kept for its pane, not for each of six windows."""
    source, found, kept = str(tmp_path / "in"), {}, {}
    whole.coalesce(1).write.parquet(source)
    last = spark.createDataFrame([(9999, START + dt.timedelta(hours=9), *traffic()[0][2:])], COLUMNS)
    for name, make in (("windows", J.windowed_alerts), ("panes", J.pane_alerts)):
        part = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(source)
        for step in range(2):
            if step and name == "windows":
                last.coalesce(1).write.mode("append").parquet(source)
            query = J.store_alerts(make(part, "60 seconds", "10 seconds", "10 seconds"), str(tmp_path / name), str(tmp_path / f"{name}-cp"))
            query.awaitTermination()
            if not step:
                kept[name] = sum(o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"][-1:])
        rows = spark.read.parquet(str(tmp_path / name))
        columns = [F.round(c, 6).alias(c) if c == "average_response_ms" else F.col(c) for c in rows.columns]
        found[name] = {tuple(map(str, r)) for r in rows.select(sorted(columns, key=str)).collect()}
    assert found["panes"] == found["windows"] and len(found["panes"]) > 3
    assert 3 * kept["panes"] < kept["windows"]
    with pytest.raises(ValueError, match="multiple"):
        J.pane_alerts(whole, "60 seconds", "25 seconds")


def test_rules_see_whole_windows(whole):
    """The burst is one alert per window however it is cut; its logs carry the evidence."""
    alerts = J.window_alerts(whole, "5 minutes", [R.rule("brute_force")])
    assert sorted(r.related_logs for r in alerts.collect()) == [8, 8]
