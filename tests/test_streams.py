from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.operators import features as E
from tidewatch.operators import rules as R
from tidewatch.operators import scoring as S
from tidewatch.streaming import jobs as J

COLUMNS = "id long, timestamp timestamp, ip string, method string, endpoint string, status int, response_time_ms double, user_agent string"
START = dt.datetime(2024, 1, 1, 12)
LINE = '10.0.0.{} - - [01/Jan/2024:12:00:0{} +0000] "GET /a HTTP/1.1" 200 5'


def logs(spark, seconds, first=0, ip="a"):
    rows = [(first + i, START + dt.timedelta(seconds=s), ip, "POST", "/login", 401, 1.0, "x") for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, COLUMNS)


def test_only_new_lines_are_ingested(spark, tmp_path):
    source, table, mark = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for part, lines in enumerate((["bad", LINE.format(1, 1)], [LINE.format(2, 2), LINE.format(3, 3)])):
        spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.mode("append").text(source)
        J.ingest(J.stream_lines(spark, source), table, mark, "apache_combined").awaitTermination()
        stored = spark.read.parquet(table)
        assert stored.count() == (1, 3)[part]
    assert stored.select("id").distinct().count() == 3
    assert [r["ip"] for r in stored.orderBy("id").collect()][0] == "10.0.0.1"


def test_window_alerts_equal_batch(spark, tmp_path):
    """6 failures in one minute, 3 in the next; a late-running row closes both windows."""
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    logs(spark, [1, 2, 3, 4, 5, 59, 61, 62, 63, 4000]).write.parquet(source)
    stream = spark.readStream.schema(COLUMNS).parquet(source)
    rules = [R.rule("brute_force")]
    J.store_alerts(J.windowed_alerts(stream, rules=rules), table, str(tmp_path / "cp")).awaitTermination()
    found = spark.read.parquet(table)
    row = found.first()
    assert found.count() == 1 and row["related_logs"] == 6 and row["window_start"] == START
    named = J.windowed_alert_logs(spark.read.parquet(source), found, rules=rules)
    assert sorted(r["log_id"] for r in named.collect()) == [0, 1, 2, 3, 4, 5]


def test_sliding_windows_find_the_same_burst_twice(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    logs(spark, [31, 32, 33, 34, 35, 4000]).write.parquet(source)
    stream = spark.readStream.schema(COLUMNS).parquet(source)
    alerts = J.windowed_alerts(stream, "60 seconds", "30 seconds", rules=[R.rule("brute_force")])
    J.store_alerts(alerts, table, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(table).count() == 2


def test_duplicates_and_restart(spark, tmp_path):
    source, table, mark = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for _ in range(2):
        logs(spark, [1, 2, 3]).write.mode("append").parquet(source)
        J.store_alerts(J.deduplicated(spark.readStream.schema(COLUMNS).parquet(source)), table, mark).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(table).collect()) == [0, 1, 2]


def test_scores_do_not_depend_on_batches(spark, tmp_path):
    """Two batches with stored context give the features, and so the scores, of one batch."""
    whole = logs(spark, range(0, 400, 10)).withColumn("data", F.lit("{}"))
    base = E.baselines(whole)

    def decide(features):
        return features.select("log_id", (0.3 - F.col("requests_per_ip_5min") / 100 - F.col("endpoint_rarity")).alias("decision"))

    def members(batch):
        return R.alert_logs(whole, R.run_rules(whole), "7 days")

    source, table = str(tmp_path / "in"), str(tmp_path / "scores")
    for part in (0, 1):
        whole.filter(F.col("id") % 2 == part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(source)
    J.score(stream, table, str(tmp_path / "cp"), decide, members, base, lambda: whole).awaitTermination()
    ours = {r["log_id"]: r["final_score"] for r in spark.read.parquet(table).collect()}
    batch = S.hybrid_scores(decide(E.extract_features(whole, base)), members(whole))
    assert len(ours) == 40 and ours == {r["log_id"]: r["final_score"] for r in batch.collect()}


def test_metrics_are_rewritten(spark, tmp_path):
    source, table, mark = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for n in (3, 6):
        logs(spark, [1, 2, 3]).write.mode("append").parquet(source)
        stream = spark.readStream.schema(COLUMNS).parquet(source)
        J.publish_metrics(J.status_metrics(stream), table, mark, None).awaitTermination()
        row = spark.read.parquet(table).first()
        assert row["requests"] == n


def test_late_batch_numbers_and_failed_lines(spark, tmp_path):
    """Ids go on from the newest stored batch, whatever its number; lines that fail are kept and counted."""
    good = '{"timestamp": "2024-01-01T00:00:00", "ip": "1.1.1.1", "method": "GET", "endpoint": "/", "status": 200}'
    lines = spark.createDataFrame([(good,), ("not-json",), (good,)], "value string").repartition(3)
    table = str(tmp_path / "raw")
    for number in (0, 131_072, 131_073, 131_073):  # the last one is repeated after a failure
        J.store_lines(lines, number, table)
    ids = sorted(r.id for r in spark.read.parquet(table).collect())
    assert ids == [1, 2, 3, 4, 5, 6]
    assert [r._line for r in spark.read.parquet(f"{table}_failed").collect()] == ["not-json"] * 3
    assert {(r.total, r.ingested, r.failed) for r in spark.read.parquet(f"{table}_report").collect()} == {(3, 2, 1)}
