"""Operator-facing questions and service levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import WINDOW, logs, shown, sql_time, with_ctes
from catalog.detection import ALERTS_CTE
from catalog.scoring import SCORES_CTE, hybrid
from tidewatch.functions.text import age_text
from tidewatch.operators import rules as R
from tidewatch.plans import playbooks as P
from tidewatch.plans import queries as Q
from tidewatch.plans import slo as L


def alerts(spark, folder):
    return R.run_rules(logs(spark, folder), WINDOW)


def scores(spark, folder):
    """Scores dated by their log."""
    times = logs(spark, folder).select(F.col("id").alias("log_id"), F.col("timestamp").alias("created_at"))
    return hybrid(spark, folder).join(times, "log_id")


def newest(spark, folder):
    return logs(spark, folder).agg(F.max("timestamp")).scalar()


def _some_alert(spark, folder):
    """The largest alert, as an operator would pick it from the list."""
    row = alerts(spark, folder).orderBy(F.desc("related_logs"), "alert_id").select("alert_id").first()
    return row["alert_id"]


def _some_log(spark, folder):
    rows = logs(spark, folder)
    members = R.alert_logs(rows, R.run_rules(rows, WINDOW), WINDOW)
    named = members.groupBy("log_id").agg(F.count(F.lit(1)).alias("n"))
    return rows, members, named.orderBy(F.desc("n"), "log_id").first()["log_id"]


def _alert_logs(spark, folder):
    rows = logs(spark, folder)
    members = R.alert_logs(rows, R.run_rules(rows, WINDOW), WINDOW)
    return shown(Q.alert_log_rows(rows, members, _some_alert(spark, folder), 10).drop("data", "user_agent"))


def _log_alerts(spark, folder):
    rows, members, log_id = _some_log(spark, folder)
    return shown(Q.log_alerts(R.run_rules(rows, WINDOW), members, log_id).drop("metadata", "confidence"))


def _log_score(spark, folder):
    _, _, log_id = _some_log(spark, folder)
    return shown(Q.log_score(scores(spark, folder), log_id).drop("ml_confidence"))


def _search_alerts(spark, folder):
    found = Q.search_alerts(
        alerts(spark, folder), severity="CRITICAL", source="rule", ip="0.0.1", hours=96, limit=15, as_of=newest(spark, folder))
    return shown(found.drop("metadata"))


def _search_logs(spark, folder):
    found = Q.search_logs(logs(spark, folder), hours=120, ip="10.0", endpoint="SEARCH", method="GET", text="Union", limit=20)
    return shown(found.drop("data", "user_agent"))


def _search_text(spark, folder):
    """The text is only in the JSON record (its scenario), not in the endpoint."""
    found = Q.search_logs(logs(spark, folder), hours=48, status=401, text="Brute_Force", limit=30)
    return found.select("id", "status", "endpoint")


def payloads(spark, folder):
    """Nested JSON per method and day with the longest response time of every hour."""
    hourly = logs(spark, folder).groupBy("method", F.date_trunc("hour", "timestamp").alias("hour")).agg(
        F.max("response_time_ms").alias("v"))
    point = F.array(F.unix_timestamp("hour").cast("string"), F.col("v").cast("string"))
    daily = hourly.filter("v is not null").groupBy("method", F.to_date("hour").alias("day")).agg(
        F.collect_list(point).alias("values"), F.max_by(point, "hour").alias("value"))
    metric = F.struct(
        F.when(F.col("method") == "GET", "").otherwise("web").alias("job"),
        F.when(F.dayofmonth("day") % 2 == 0, F.lit("daily")).alias("model"),
    )
    item = F.array(F.struct(metric.alias("metric"), "value", "values"))
    return daily.select(
        "method", F.col("day").cast("string").alias("day"),
        F.to_json(F.struct(F.lit("success").alias("status"), F.struct(item.alias("result")).alias("data"))).alias("payload"))


def _ages(spark, folder):
    rows = logs(spark, folder)
    seconds = F.when(F.col("id") % 50 > 0, F.floor(F.unix_micros(F.lit("2024-01-31 00:00:00").cast("timestamp")) / 1000000
                                                   - F.unix_micros(F.col("timestamp").cast("timestamp")) / 1000000) % (F.col("id") * 40 + 1))
    return rows.select("id", age_text(seconds).alias("age"))


def quality(spark, folder):
    """A model-quality series: the share of successful requests per six hours."""
    return logs(spark, folder).groupBy(F.floor(F.unix_timestamp(F.col("timestamp").cast("timestamp")) / 21600).alias("q")).agg(
        F.min("timestamp").alias("timestamp"), F.avg(F.when(F.col("status") < 400, 1.0).otherwise(0.0)).alias("value")).drop("q")


def _alarms(spark, folder):
    return L.alarms(logs(spark, folder), alerts(spark, folder), quality(spark, folder), alert_limit=2)


QUERIES = {
    "ops_overview": lambda s, d: shown(Q.overview(alerts(s, d), logs(s, d))),
    "ops_active_alerts": lambda s, d: Q.active_alerts(alerts(s, d), newest(s, d)),
    "ops_anomaly_trend": lambda s, d: shown(Q.anomaly_trend(scores(s, d))),
    "ops_alert_trend": lambda s, d: shown(Q.hourly_trend(alerts(s, d), newest(s, d), 72)),
    "ops_filter_options": lambda s, d: Q.filter_options(alerts(s, d)),
    "ops_search_alerts": _search_alerts,
    "ops_alert_detail": lambda s, d: shown(Q.alert_detail(alerts(s, d), _some_alert(s, d)).drop("metadata")),
    "ops_alert_logs": _alert_logs,
    "ops_search_logs": _search_logs,
    "ops_search_log_text": _search_text,
    "ops_log_score": _log_score,
    "ops_log_alerts": _log_alerts,
    "ops_prediction_split": lambda s, d: Q.prediction_split(scores(s, d)),
    "ops_series_rows": lambda s, d: shown(Q.series_rows(payloads(s, d))),
    "ops_first_value": lambda s, d: shown(Q.first_value(payloads(s, d))),
    "ops_playbooks": lambda s, d: shown(Q.with_playbook(
        alerts(s, d).withColumn("alert_type", F.when(F.col("alert_type") == "port_scanning", "other").otherwise(F.col("alert_type"))))
        .select("alert_id", "title", F.size("steps").alias("steps"))),
    "ops_alerts_by_type": lambda s, d: Q.alerts_by_type(alerts(s, d)),
    "ops_phase_scores": lambda s, d: Q.phase_scores(scores(s, d), Q.phase_logs(logs(s, d), 500, 900000000, "web")),
    "ops_status_counts": lambda s, d: Q.status_counts(Q.phase_logs(logs(s, d), 500, 900000000, "web")),
    "ops_top_addresses": lambda s, d: Q.top_addresses(logs(s, d)),
    "ops_recent_load": lambda s, d: shown(Q.recent_load(logs(s, d), hours=3)),
    "ops_age_text": _ages,
    "slo_snapshot": lambda s, d: shown(L.snapshot(logs(s, d), F.lit("2024-02-01 00:00:00"))),
    "slo_request_rate": lambda s, d: shown(L.request_rate(logs(s, d)), 8),
    "slo_error_rate": lambda s, d: shown(L.error_rate(logs(s, d)), 8),
    "slo_latency_p95": lambda s, d: shown(L.latency_quantile(logs(s, d), seconds=L.HOUR)),
    "slo_duration_histogram": lambda s, d: shown(L.duration_histogram(logs(s, d), ["method"]).drop("bound")),
    "slo_histogram_p95": lambda s, d: shown(L.histogram_quantile(L.duration_histogram(logs(s, d), ["method"]), by=["method"])),
    "slo_anomaly_share": lambda s, d: shown(L.anomaly_share(scores(s, d))),
    "slo_alert_velocity": lambda s, d: shown(L.alert_velocity(alerts(s, d)), 8),
    "slo_alerts_per_hour": lambda s, d: shown(L.alert_velocity(alerts(s, d), "severity", L.HOUR), 8),
    "slo_alerts_per_day": lambda s, d: shown(L.alert_velocity(alerts(s, d), "severity", L.DAY), 8),
    "slo_trailing_increase_hour": lambda s, d: shown(L.trailing_increase(alerts(s, d), "alert_type", L.HOUR)),
    "slo_trailing_increase_day": lambda s, d: shown(L.trailing_increase(alerts(s, d), "severity", L.DAY)),
    "slo_availability": lambda s, d: shown(L.availability(logs(s, d))),
    "slo_alarms": _alarms,
}

_NOW = "(SELECT max(timestamp) FROM logs)"
_EPOCH = "CAST(floor(epoch_us(timestamp) / 1000000) AS BIGINT)"
_SCORED_CTE = SCORES_CTE + ",\nscored AS (SELECT s.*, l.timestamp AS created_at FROM scores s JOIN logs l ON s.log_id = l.id)"
_PAYLOAD_CTE = """points AS (SELECT method, date_trunc('hour', timestamp) AS hour, max(response_time_ms) AS v FROM logs GROUP BY 1, 2
 HAVING v IS NOT NULL)"""
_SERIES_SQL = """CASE WHEN method <> 'GET' THEN 'web' WHEN day(hour) % 2 = 0 THEN 'daily' ELSE 'series' END"""
_BOUNDS = [str(b) for b in L.DURATION_BOUNDS]
_ALERT_SHOWN = f"alert_id, alert_type, severity, source, confidence, description, ip, {sql_time('timestamp')}, related_logs"
_TITLES = " ".join(f"WHEN '{p[0]}' THEN '{p[1]}'" for p in P.PLAYBOOKS if p[0] != "port_scanning")
_STEPS = " ".join(f"WHEN '{p[0]}' THEN {len(p[3])}" for p in P.PLAYBOOKS if p[0] != "port_scanning")


def _velocity(by, seconds):
    return with_ctes(
        f"""SELECT w AS window_start, {by}, count(*) AS increase, round(count(*) / {seconds}.0, 8) AS per_second
FROM (SELECT {_EPOCH} - {_EPOCH} % {seconds} AS w, {by} FROM alerts) GROUP BY 1, 2""", ALERTS_CTE)


_HISTOGRAM = "SELECT method, position, CAST(n AS BIGINT) AS observations FROM (SELECT method, " + ", ".join(
    f"count(*) FILTER (response_time_ms / 1000 <= {b}::DOUBLE) AS b{i}" for i, b in enumerate(_BOUNDS)
) + f", count(response_time_ms) AS b{len(_BOUNDS)} FROM logs GROUP BY method) h, LATERAL (VALUES " + ", ".join(
    f"({i}, b{i})" for i in range(len(_BOUNDS) + 1)) + ") v(position, n)"

def _trailing(by: str, seconds: int) -> str:
    """Every step from the first alert on, with the alerts of the time before it."""
    return with_ctes(
        f"""SELECT step AS "at", {by}, count(*) AS increase FROM (SELECT unnest(range(a, b, 300)) AS step FROM (
 SELECT min(epoch_us(timestamp)) // 300000000 * 300 AS a, max(epoch_us(timestamp)) // 300000000 * 300 + 600 + {seconds} AS b FROM alerts)) JOIN alerts
 ON epoch_us(timestamp) <= step * 1000000 AND epoch_us(timestamp) > (step - {seconds}) * 1000000 GROUP BY step, {by}""", ALERTS_CTE)


ORACLE = {
    "ops_overview": with_ctes(
        f"SELECT (SELECT count(*) FROM alerts) AS total_alerts, strftime({_NOW}, '%Y-%m-%d %H:%M:%S.%f') AS latest_log", ALERTS_CTE),
    "ops_active_alerts": with_ctes(
        f"SELECT severity, count(*) AS alerts FROM alerts WHERE timestamp > {_NOW} - INTERVAL 24 HOUR GROUP BY severity", ALERTS_CTE),
    "ops_anomaly_trend": with_ctes(
        """SELECT strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M:%S.%f') AS bucket, count(*) AS rows FROM scored WHERE is_anomaly
 AND created_at > (SELECT max(created_at) FROM scored) - INTERVAL 24 HOUR GROUP BY 1""", _SCORED_CTE),
    "ops_alert_trend": with_ctes(
        f"""SELECT strftime(date_trunc('hour', timestamp), '%Y-%m-%d %H:%M:%S.%f') AS bucket, count(*) AS rows FROM alerts
WHERE timestamp > {_NOW} - INTERVAL 72 HOUR GROUP BY 1""", ALERTS_CTE),
    "ops_filter_options": with_ctes(
        """SELECT DISTINCT 'alert_type' AS field, alert_type AS value FROM alerts UNION SELECT 'source', source FROM alerts
UNION SELECT 'severity', severity FROM alerts""", ALERTS_CTE),
    "ops_search_alerts": with_ctes(
        f"""SELECT {_ALERT_SHOWN} FROM (SELECT * FROM alerts WHERE severity = 'CRITICAL' AND source = 'rule' AND ip ILIKE '%0.0.1%'
 AND timestamp > {_NOW} - INTERVAL 96 HOUR ORDER BY timestamp DESC, alert_id LIMIT 15)""", ALERTS_CTE),
    "ops_alert_detail": with_ctes(
        f"SELECT {_ALERT_SHOWN} FROM (SELECT * FROM alerts ORDER BY related_logs DESC, alert_id LIMIT 1)", ALERTS_CTE),
    "ops_alert_logs": with_ctes(
        f"""SELECT id, {sql_time('timestamp')}, ip, method, endpoint, status, round(response_time_ms, 6) AS response_time_ms FROM (
 SELECT * FROM logs WHERE id IN (SELECT log_id FROM members WHERE alert_id = (SELECT alert_id FROM alerts ORDER BY related_logs DESC, alert_id LIMIT 1))
 ORDER BY timestamp DESC, id LIMIT 10)""", ALERTS_CTE),
    "ops_search_logs": with_ctes(
        f"""SELECT id, {sql_time('timestamp')}, ip, method, endpoint, status, round(response_time_ms, 6) AS response_time_ms FROM (
 SELECT * FROM logs WHERE timestamp > {_NOW} - INTERVAL 120 HOUR AND ip ILIKE '%10.0%' AND endpoint ILIKE '%SEARCH%' AND method = 'GET'
 AND endpoint ILIKE '%union%' ORDER BY timestamp DESC, id LIMIT 20)"""),
    "ops_search_log_text": with_ctes(
        f"""SELECT id, status, endpoint FROM logs WHERE timestamp > {_NOW} - INTERVAL 48 HOUR AND status = 401 AND scenario = 'brute_force'
ORDER BY timestamp DESC, id LIMIT 30"""),
    "ops_log_score": with_ctes(
        f"""SELECT log_id, rule_score, round(ml_score, 6) AS ml_score, final_score, severity, triggered_rules, is_anomaly, {sql_time('created_at')}
FROM scored WHERE log_id = (SELECT log_id FROM members GROUP BY log_id ORDER BY count(*) DESC, log_id LIMIT 1)""", _SCORED_CTE),
    "ops_log_alerts": with_ctes(
        f"""SELECT {_ALERT_SHOWN.replace(' confidence,', '')} FROM alerts WHERE alert_id IN (SELECT alert_id FROM members WHERE log_id =
 (SELECT log_id FROM members GROUP BY log_id ORDER BY count(*) DESC, log_id LIMIT 1))""", ALERTS_CTE),
    "ops_prediction_split": with_ctes(
        "SELECT CASE WHEN is_anomaly THEN 'anomaly' ELSE 'normal' END AS prediction, count(*) AS logs FROM scores GROUP BY 1", SCORES_CTE),
    "ops_series_rows": with_ctes(
        f"SELECT strftime(hour, '%Y-%m-%d %H:%M:%S.%f') AS timestamp, v AS value, {_SERIES_SQL} AS series FROM points", _PAYLOAD_CTE),
    "ops_first_value": with_ctes(
        "SELECT method, strftime(hour, '%Y-%m-%d') AS day, max_by(v, hour) AS value FROM points GROUP BY 1, 2", _PAYLOAD_CTE),
    "ops_playbooks": with_ctes(
        f"""SELECT alert_id, CASE alert_type {_TITLES} ELSE '{P.DEFAULT_PLAYBOOK[0]}' END AS title,
 CAST(CASE alert_type {_STEPS} ELSE {len(P.DEFAULT_PLAYBOOK[2])} END AS INT) AS steps FROM alerts""", ALERTS_CTE),
    "ops_alerts_by_type": with_ctes("SELECT alert_type, severity, count(*) AS alerts FROM alerts GROUP BY 1, 2", ALERTS_CTE),
    "ops_phase_scores": with_ctes(
        """SELECT count(*) AS scored_logs, count(*) FILTER (is_anomaly) AS anomalies, round(avg(final_score), 4) AS avg_final_score
FROM scores WHERE log_id > 500""", SCORES_CTE),
    "ops_status_counts": with_ctes("SELECT status, count(*) AS logs FROM logs WHERE id > 500 GROUP BY status"),
    "ops_top_addresses": with_ctes("SELECT ip, count(*) AS requests FROM logs GROUP BY ip ORDER BY requests DESC, ip LIMIT 20"),
    "ops_recent_load": with_ctes(
        f"SELECT count(*) AS requests, round(avg(response_time_ms), 6) AS avg_response_ms FROM logs WHERE timestamp > {_NOW} - INTERVAL 3 HOUR"),
    "ops_age_text": with_ctes(
        """SELECT id, CASE WHEN id % 50 = 0 THEN '-' WHEN s < 60 THEN format('{:.0f}s', s) WHEN s < 3600 THEN printf('%.1fm', s / 60.0::DOUBLE)
 WHEN s < 86400 THEN printf('%.1fh', s / 3600.0::DOUBLE) ELSE printf('%.1fd', s / 86400.0::DOUBLE) END AS age FROM (
 SELECT id, CAST(CAST(floor(epoch_us(TIMESTAMP '2024-01-31 00:00:00') / 1000000 - epoch_us(timestamp) / 1000000) AS BIGINT) % (id * 40 + 1) AS DOUBLE) AS s FROM logs)"""),
    "slo_snapshot": with_ctes(
        """SELECT count(*) AS logs_processed, round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - max(epoch_us(timestamp))) / 1000000.0::DOUBLE, 6) AS freshness_seconds FROM logs"""),
    "slo_request_rate": with_ctes(
        f"""SELECT w AS window_start, method, status, round(count(*) / 300.0::DOUBLE, 8) AS per_second
FROM (SELECT *, {_EPOCH} - {_EPOCH} % 300 AS w FROM logs) GROUP BY 1, 2, 3"""),
    "slo_error_rate": with_ctes(
        f"""SELECT w AS window_start, round(count(*) FILTER (status BETWEEN 400 AND 499) / 300.0::DOUBLE, 8) AS rate_4xx,
 round(count(*) FILTER (status BETWEEN 500 AND 599) / 300.0::DOUBLE, 8) AS rate_5xx FROM (SELECT *, {_EPOCH} - {_EPOCH} % 300 AS w FROM logs) GROUP BY 1"""),
    "slo_latency_p95": with_ctes(
        f"""SELECT w AS window_start, round(quantile_cont(response_time_ms, 0.95), 6) AS latency_ms
FROM (SELECT *, {_EPOCH} - {_EPOCH} % 3600 AS w FROM logs WHERE response_time_ms IS NOT NULL) GROUP BY 1"""),
    "slo_duration_histogram": with_ctes(_HISTOGRAM),
    "slo_histogram_p95": with_ctes(
        f""", hist AS ({_HISTOGRAM}), bound AS (SELECT * FROM (VALUES {', '.join(f'({i}, {b}::DOUBLE)' for i, b in enumerate(_BOUNDS))}, ({len(_BOUNDS)}, NULL)) v(position, le)),
steps AS (SELECT method, position, le, observations, 0.95::DOUBLE * max(observations) OVER (PARTITION BY method) AS r,
 coalesce(lag(le) OVER w, 0) AS lo, coalesce(lag(observations) OVER w, 0) AS below FROM hist JOIN bound USING (position)
 WINDOW w AS (PARTITION BY method ORDER BY position))
SELECT method, round(arg_min(CASE WHEN le IS NULL THEN lo ELSE lo + (le - lo) * coalesce((r - below) / nullif(observations - below, 0), 0) END, position), 6) AS seconds
FROM steps WHERE observations >= r GROUP BY method"""),
    "slo_anomaly_share": with_ctes("SELECT round(count(*) FILTER (is_anomaly) / greatest(count(*), 1), 6) AS anomaly_share FROM scores", SCORES_CTE),
    "slo_alert_velocity": _velocity("alert_type", 300),
    "slo_alerts_per_hour": _velocity("severity", 3600),
    "slo_alerts_per_day": _velocity("severity", 86400),
    "slo_trailing_increase_hour": _trailing("alert_type", 3600),
    "slo_trailing_increase_day": _trailing("severity", 86400),
    "slo_availability": with_ctes(
        f"""SELECT w AS window_start, round(avg(CASE WHEN status >= 500 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END), 6) AS availability,
 avg(CASE WHEN status >= 500 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) >= 0.995 AS target_met FROM (SELECT *, {_EPOCH} - {_EPOCH} % 3600 AS w FROM logs) GROUP BY 1"""),
    "slo_alarms": with_ctes(
        f""", quality AS (SELECT min(timestamp) AS timestamp, avg(CASE WHEN status < 400 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS value FROM logs
 GROUP BY {_EPOCH} // 21600),
span AS (SELECT min({_EPOCH}) // 60 * 60 AS a, max({_EPOCH}) // 60 * 60 AS b FROM logs),
grid0 AS (SELECT unnest(range(a, b + 60, 60)) AS minute FROM span),
pl AS (SELECT {_EPOCH} // 60 * 60 AS minute, count(*) AS n, max(epoch_us(timestamp)) AS newest FROM logs GROUP BY 1),
pa AS (SELECT {_EPOCH} // 60 * 60 AS minute, count(*) AS n FROM alerts GROUP BY 1),
pq AS (SELECT {_EPOCH} // 60 * 60 AS minute, max_by(value, timestamp) AS f1 FROM quality GROUP BY 1),
grid AS (SELECT g.minute, coalesce(pl.n, 0) AS logs, coalesce(pa.n, 0) AS alerts, max(newest) OVER (ORDER BY g.minute) AS newest,
 last_value(f1 IGNORE NULLS) OVER (ORDER BY g.minute) AS f1 FROM grid0 g LEFT JOIN pl ON g.minute = pl.minute
 LEFT JOIN pa ON g.minute = pa.minute LEFT JOIN pq ON g.minute = pq.minute),
cond AS (SELECT minute, sum(alerts) OVER (ORDER BY minute ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) > 2 AS c1,
 sum(logs) OVER (ORDER BY minute ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) = 0 AS c2, coalesce(f1 > 0 AND f1 < 0.75, false) AS c3,
 (minute + 60) * 1000000 - newest > 300000000 AS c4 FROM grid),
states AS (SELECT minute, 'high_alert_rate' AS alarm, c1 AS active, 300 AS hold FROM cond UNION ALL SELECT minute, 'no_logs_processed', c2, 600 FROM cond
 UNION ALL SELECT minute, 'model_f1_low', c3, 300 FROM cond UNION ALL SELECT minute, 'data_freshness_high', c4, 600 FROM cond),
runs AS (SELECT *, sum(CASE WHEN active THEN 0 ELSE 1 END) OVER (PARTITION BY alarm ORDER BY minute) AS run FROM states)
SELECT alarm, min(minute) AS pending_since, min(minute) + hold AS firing_since, max(minute) AS last_active FROM runs WHERE active
GROUP BY alarm, run, hold HAVING max(minute) >= min(minute) + hold""", ALERTS_CTE),
}
