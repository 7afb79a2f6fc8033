from __future__ import annotations

import datetime as dt
import importlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tidewatch.operators.dataset import summary
from tidewatch.plans import queries as Q
from tidewatch.plans import slo as L
from tidewatch.sources import tables as T

START = dt.datetime(2024, 1, 1)
TESTDATA = Path("/root/testdata/sf0.001")


def test_histogram_quantile(spark):
    rows = [(float(ms),) for ms in [2] * 50 + [30] * 40 + [70] * 10]
    logs = spark.createDataFrame(rows, "response_time_ms double")
    histogram = L.duration_histogram(logs)
    counts = [r["observations"] for r in histogram.orderBy("position").collect()]
    assert counts == [0, 50, 50, 90, 100, 100, 100, 100, 100]
    assert L.histogram_quantile(histogram).first()["seconds"] == pytest.approx(0.05 + 0.05 * (95 - 90) / 10)
    slow = L.duration_histogram(spark.createDataFrame([(9000.0,)], "response_time_ms double"))
    assert L.histogram_quantile(slow).first()["seconds"] == 2.5


def test_alarm_hold_times(spark):
    """Logs for 5 minutes, silence for 30, then logs again: no-logs fires 15 + 10 minutes in."""
    minutes = [*range(5), *range(35, 40)]
    logs = spark.createDataFrame([(START + dt.timedelta(minutes=m),) for m in minutes], "timestamp timestamp")
    alerts = spark.createDataFrame([(START,)] * 30, "timestamp timestamp")
    quality = spark.createDataFrame([(START, 0.9), (START + dt.timedelta(minutes=30), 0.5)], "timestamp timestamp, value double")
    base = int(START.replace(tzinfo=dt.timezone.utc).timestamp())
    got = {
        r["alarm"]: tuple((r[c] - base) // 60 for c in ("pending_since", "firing_since", "last_active"))
        for r in L.alarms(logs, alerts, quality).collect()
    }
    assert got == {
        "high_alert_rate": (0, 5, 9), "no_logs_processed": (19, 29, 34), "model_f1_low": (30, 35, 39),
        "data_freshness_high": (9, 19, 34)}


def test_snapshot_of_nothing(spark):
    logs = spark.createDataFrame([], "timestamp timestamp")
    row = L.snapshot(logs, F.lit(START).cast("timestamp")).first()
    assert (row["logs_processed"], row["freshness_seconds"]) == (0, 0.0)


def test_series_payload(spark):
    text = '{"data": {"result": [{"metric": {"job": "", "model": "m"}, "value": [1700000000, "0.7"], "values": [[1700000000, "0.7"], [1700000300.5, "0.8"]]}]}}'
    payloads = spark.createDataFrame([(text,), ('{"data": {"result": []}}',)], "payload string")
    rows = Q.series_rows(payloads).orderBy("timestamp").collect()
    assert [(r["value"], r["series"]) for r in rows] == [(0.7, "m"), (0.8, "m")]
    assert rows[0]["timestamp"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert [r["value"] for r in Q.first_value(payloads).collect()] == [0.7, None]


def test_playbooks(spark):
    alerts = spark.createDataFrame([("brute_force",), ("unheard_of",)], "alert_type string")
    got = {r["alert_type"]: (r["title"], len(r["steps"])) for r in Q.with_playbook(alerts).collect()}
    assert got == {"brute_force": ("Brute Force Response", 4), "unheard_of": ("Generic Investigation", 3)}


def test_search_filters(spark):
    rows = [(i, START + dt.timedelta(hours=i), f"10.0.0.{i}", "GET" if i % 2 else "POST", f"/A{i}", 200, 1.0, "ua", '{"k": "Needle"}' if i == 3 else "{}")
            for i in range(10)]
    logs = spark.createDataFrame(rows, "id long, timestamp timestamp, ip string, method string, endpoint string, status int, response_time_ms double, user_agent string, data string")
    assert [r["id"] for r in Q.search_logs(logs, hours=5).collect()] == [9, 8, 7, 6, 5]
    assert [r["id"] for r in Q.search_logs(logs, hours=24, text="needle").collect()] == [3]
    assert [r["id"] for r in Q.search_logs(logs, hours=24, endpoint="a4").collect()] == [4]
    assert [r["id"] for r in Q.search_logs(logs, hours=24, method="GET", limit=2).collect()] == [9, 7]
    assert Q.search_logs(logs, hours=24, status=404).count() == 0


def test_dataset_files(spark, tmp_path):
    df = spark.createDataFrame([(1, START, 0.5, 1), (2, START, 0.7, 0)], "log_id long, timestamp timestamp, a double, label int")
    T.write_dataset(df, str(tmp_path / "d"), ["a"], summary(df, ["a"]))
    assert spark.read.option("header", True).csv(str(tmp_path / "d" / "dataset.csv")).count() == 2
    assert spark.read.json(str(tmp_path / "d" / "summary.json")).first()["anomalies"] == 1
    assert spark.read.text(str(tmp_path / "d" / "features.txt")).first()["value"] == "a"


def test_registry_is_consistent():
    queries, checks = registry.queries(), registry.oracle_sql()
    assert set(checks) <= set(queries)
    own = {name for area in registry._AREAS for name in importlib.import_module(f"catalog.{area}").QUERIES}
    assert {n for n in own if n not in checks} == {n for n in queries if n.startswith("model_") and n not in checks}


@pytest.mark.skipif(not TESTDATA.exists(), reason="needs the generated tables")
def test_entry(spark):
    found = registry.entry(spark)
    assert found.count() > 0 and "alert_type" in found.columns


def test_day_folders_are_pruned(spark, tmp_path):
    """With and without a given present moment, older days are not read."""
    from tidewatch.functions.columns import recent
    from tidewatch.operators import rules as R
    from tidewatch.plans import queries as Q
    from tidewatch.sources import tables as T

    path = str(tmp_path / "raw")
    rows = spark.range(40).select(
        (F.lit("2024-01-01").cast("timestamp") + F.expr("make_interval(0,0,0,cast(id as int))")).alias("timestamp"), F.lit("web").alias("log_type"),
        F.lit("1.1.1.1").alias("ip"), F.lit("GET").alias("method"), F.lit("/x").alias("endpoint"), F.lit(200).alias("status"),
        F.lit(1.0).alias("response_time_ms"), F.lit("curl").alias("user_agent"), F.lit("{}").alias("data"))
    T.append_logs(rows, path)
    logs = spark.read.parquet(path)
    now = F.lit("2024-02-09 12:00:00").cast("timestamp")
    for frame in (R.run_rules(logs, "7 days", as_of=now), Q.search_logs(logs, 24, as_of=now), Q.recent_load(logs, now), recent(logs, "3 days")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        # Finding the newest day reads partition values only: no column of any file.
        scans = [x for x in plan.split("FileScan")[1:] if "ReadSchema: struct<>" not in x.split("\n")[0]]
        assert scans and all("date" in x.split("PartitionFilters: ")[1].split("PushedFilters")[0] for x in scans), plan
    assert recent(logs, "3 days").count() == 3 and Q.search_logs(logs, 48).count() == 2


def test_clip_keeps_null(spark):
    from tidewatch.functions.columns import clip
    from tidewatch.operators.scoring import ml_score

    row = spark.range(1).select(clip(F.lit(None).cast("double"), -10, 10).alias("z"), ml_score(F.lit(None).cast("double")).alias("s"), clip(F.lit(99.0), -10, 10).alias("c")).first()
    assert row.z is None and row.s is None and row.c == 10.0
