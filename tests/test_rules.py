from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from tidewatch.operators import rules as R
from tidewatch.sources import lines as L

START = dt.datetime(2026, 6, 27, 15, 0)
COLUMNS = "id long, timestamp timestamp, ip string, method string, endpoint string, status int, response_time_ms double, user_agent string"


def frame(spark, rows):
    """rows: (ip, method, endpoint, status, agent), one second apart."""
    data = [
        (i, START + dt.timedelta(seconds=i), ip, method, endpoint, status, float(i), agent)
        for i, (ip, method, endpoint, status, agent) in enumerate(rows)
    ]
    return spark.createDataFrame(data, COLUMNS)


def attack_rows():
    rows = [("203.0.113.184", "POST", "/login", 401 if i < 5 else 429, "python-requests/2.31.0") for i in range(6)]
    rows += [("203.0.113.184", "GET", "/search?q=%27%20OR%201%3D1%20--", 200, "sqlmap/1.7")] * 3
    rows += [("203.0.113.184", "GET", e, 404, "sqlmap/1.7") for e in ("/../../etc/passwd", "/../../var/log/auth.log")]
    return rows + [("203.0.113.184", "GET", f"/probe-{i}", 404, "masscan/1.3") for i in range(1, 11)]


def test_real_access_log_run(spark):
    """8 harmless lines give no alert, 21 hostile ones give 8."""
    paths = ["/", "/api/data?page=1&per_page=5", "/api/users", "/search?q=normal"] * 2
    benign = [("198.51.100.184", "GET", p, 200, "Mozilla/5.0 Chrome/126.0") for p in paths]
    assert R.run_rules(frame(spark, benign), "1 day").count() == 0
    found = R.run_rules(frame(spark, attack_rows()), "1 day").collect()
    assert Counter((a["alert_type"], a["severity"]) for a in found) == {
        ("suspicious_user_agent", "MEDIUM"): 3, ("path_traversal", "CRITICAL"): 2, ("brute_force", "HIGH"): 1,
        ("port_scanning", "MEDIUM"): 1, ("sql_injection", "CRITICAL"): 1}
    brute = next(a for a in found if a["alert_type"] == "brute_force")
    assert brute["description"] == "Detected 6 failed login attempts from IP 203.0.113.184"
    assert brute["timestamp"] == START + dt.timedelta(seconds=5) and brute["related_logs"] == 6


def test_anomalous_fixture(spark):
    rows = [("10.0.0.99", "POST", "/login", 401, "python-requests/2.31.0")] * 6
    rows.append(("10.0.0.88", "GET", "/api/users?id=1 OR 1=1 --", 400, "sqlmap/1.0"))
    kinds = Counter(a["alert_type"] for a in R.run_rules(frame(spark, rows)).collect())
    assert kinds["brute_force"] == 1 and kinds["sql_injection"] == 1


def test_window_is_strict_and_thresholds_hold(spark):
    logs = frame(spark, [("a", "POST", "/login", 401, "x")] * 5)
    now = F.lit(START + dt.timedelta(seconds=4)).cast("timestamp")
    assert R.run_rules(logs, "4 seconds", [R.rule("brute_force")], now).count() == 0
    assert R.run_rules(logs, "5 seconds", [R.rule("brute_force")], now).count() == 1


def test_null_address_is_a_group(spark):
    logs = frame(spark, [(None, "POST", "/login", 401, "x")] * 5 + [("a", "POST", "/login", 401, "x")] * 4)
    found = R.run_rules(logs, "1 day", [R.rule("brute_force")])
    row = found.first()
    assert found.count() == 1 and row["ip"] is None and row["description"] is None
    assert R.alert_logs(logs, found, "1 day", [R.rule("brute_force")]).count() == 5


def test_path_labels(spark):
    logs = frame(spark, [("a", "GET", e, 404, "x") for e in ("/../etc/passwd", "/ETC/passwd", "/etc/shadow", "/proc/1", "/var/log/x")])
    found = R.run_rules(logs, "1 day", [R.rule("path_traversal")])
    labels = {a["key_endpoint"]: a["p"] for a in found.withColumn("p", F.get_json_object("metadata", "$.pattern")).collect()}
    assert labels == {
        "/../etc/passwd": "directory traversal", "/ETC/passwd": "passwd file access", "/etc/shadow": "shadow file access",
        "/proc/1": "proc filesystem access", "/var/log/x": "other"}


def test_off_hours_rule(spark):
    late = frame(spark, [("a", "GET", f"/{i % 3}", 200, "x") for i in range(20)]).withColumn(
        "timestamp", F.col("timestamp") + F.expr("INTERVAL 8 HOURS"))
    row = R.run_rules(late, "1 day", [R.rule("time_anomaly")]).first()
    assert row["hours_active"] == [23] and row["unique_endpoints"] == 3
    assert row["description"] == "Off-hours activity: 20 requests from IP a between 22h-6h"


def test_failing_rule_counts_zero(spark):
    broken = R.Rule("broken", "LOW", 0.1, lambda: F.col("nope") > 0, lambda: F.lit("x"), lambda w: [])
    rules = [*R.RULES, broken]
    good, bad = R.usable_rules(frame(spark, attack_rows()), rules)
    assert [r.name for r in bad] == ["broken"] and len(good) == 6
    report = {r["alert_type"]: r["alerts"] for r in R.rule_report(R.run_rules(frame(spark, attack_rows()), "1 day", rules), rules).collect()}
    assert report["broken"] == 0 and sum(report.values()) == 8


def test_agent_from_json_record(spark):
    logs = frame(spark, attack_rows()).withColumn("data", F.to_json(F.struct("user_agent"))).drop("user_agent")
    assert R.run_rules(logs, "1 day", [R.rule("suspicious_user_agent")]).count() == 3


def test_log_ids_in_time_order_and_chunks(spark):
    logs = frame(spark, attack_rows()).withColumn("id", F.col("id") * -1)
    found = R.run_rules(logs, "1 day")
    members = R.alert_logs(logs, found, "1 day")
    assert members.count() == found.agg(F.sum("related_logs")).first()[0]
    kinds = {a["alert_id"]: a["alert_type"] for a in found.collect()}
    by_alert = {}
    for row in R.log_id_chunks(members, 4).orderBy("alert_id", "chunk").collect():
        assert row["chunk"] == len(by_alert.setdefault(row["alert_id"], []))
        by_alert[row["alert_id"]].append(row["log_ids"])
    lists = {kinds[alert]: chunks for alert, chunks in by_alert.items()}
    assert lists["brute_force"] == [[0, -1, -2, -3], [-4, -5]]
    assert [len(x) for x in lists["port_scanning"]] == [4, 4, 4, 4, 4, 1]  # 21 logs, all of them


def test_large_alert_keeps_all_ids(spark):
    members = spark.range(20000).select(F.lit("a").alias("alert_id"), F.lit(START).cast("timestamp").alias("timestamp"), F.col("id").alias("log_id"))
    chunks = R.log_id_chunks(members).orderBy("chunk").collect()
    assert [c["chunk"] for c in chunks] == [0, 1] and [i for c in chunks for i in c["log_ids"]] == list(range(20000))


def test_alert_ids_tell_windows_and_nulls_apart(spark):
    rows = frame(spark, attack_rows())
    week, day = (R.run_rules(rows, w, [R.rule("brute_force")]).first()["alert_id"] for w in ("7 days", "1 day"))
    nameless = R.run_rules(rows.withColumn("ip", F.lit(None).cast("string")), "1 day", [R.rule("brute_force")]).first()["alert_id"]
    empty = R.run_rules(rows.withColumn("ip", F.lit("")), "1 day", [R.rule("brute_force")]).first()["alert_id"]
    assert len({week, day, nameless, empty}) == 4


def test_hot_address_keeps_every_log(spark):
    """One address with most of the rows: counts and members stay whole."""
    logs = spark.range(3000).select(
        "id", (F.lit(START).cast("timestamp") + F.expr("make_interval(0,0,0,0,0,0, id % 50)")).alias("timestamp"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("ip"),
        F.lit("GET").alias("method"), F.concat(F.lit("/p"), (F.col("id") % 40).cast("string")).alias("endpoint"),
        F.lit(200).alias("status"), F.lit(1.0).alias("response_time_ms"), F.lit("x").alias("user_agent"))
    rules = [R.rule("port_scanning")]
    found = R.run_rules(logs, "1 day", rules)
    row = found.first()
    assert found.count() == 1 and (row["related_logs"], row["unique_endpoints"]) == (2000, 40)
    assert R.alert_logs(logs, found, "1 day", rules).select("log_id").distinct().count() == 2000
    assert R.alert_endpoints(logs, found, "1 day", rules).count() == 40


def test_rate_limit(spark):
    rows = [("a", "POST", "/login", 401, "x")] * 6 + [("b", "POST", "/login", 401, "x")] * 5 + [("a", "GET", "/search?q=1", 200, "x")] * 6
    found = R.rate_breaches(frame(spark, rows)).collect()
    assert [(r["ip"], r["route"], r["requests"]) for r in found] == [("a", "/login", 6)]


def test_lines_to_alerts(spark):
    line = '203.0.113.184 - - [27/Jun/2026:15:00:{:02d} +0000] "{} {} HTTP/1.1" {} 10 "-" "{}" 0.004'
    text = [line.format(i, m, e, s, a) for i, (_, m, e, s, a) in enumerate(attack_rows())]
    logs = L.with_ids(L.normalised(L.parse_lines(spark.createDataFrame([(t,) for t in text], "value string"), "apache_combined")))
    assert R.run_rules(logs, "1 day").count() == 8
