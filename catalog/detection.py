"""Rules: alerts, their logs, the rule report and rate limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.common import WINDOW, logs, shown, sql_time, with_ctes
from tidewatch.operators import rules as R

_SQL_INJECTION = " OR ".join(f"endpoint ILIKE '{p}'" for p in R.SQL_PATTERNS)
_TRAVERSAL = " OR ".join(f"endpoint ILIKE '{p}'" for p in R.PATH_PATTERNS)
_AGENT = " OR ".join(f"user_agent ILIKE '{p}'" for p in R.AGENT_PATTERNS)
_NIGHT = "(hour(timestamp) >= 22 OR hour(timestamp) < 6)"

RECENT_CTE = "recent AS (SELECT * FROM logs WHERE timestamp > (SELECT max(timestamp) FROM logs) - INTERVAL 7 DAY)"


def _rule_sql(name, where, severity, confidence, description, having, keys=()):
    """(rule, group) rows of one rule with every measure the alert needs."""
    key = {k: (k if k in keys else "CAST(NULL AS VARCHAR)") for k in ("endpoint", "method", "user_agent")}
    grouped = ", ".join(["ip", *keys])
    return f"""SELECT '{name}' AS alert_type, ip, {key['endpoint']} AS key_endpoint, {key['method']} AS key_method,
 {key['user_agent']} AS key_user_agent, '{severity}' AS severity, 'rule' AS source, CAST({confidence} AS DOUBLE) AS confidence,
 {description} AS description, max(timestamp) AS timestamp, count(*) AS related_logs,
 count(DISTINCT endpoint) AS unique_endpoints, min(timestamp) AS first_seen, avg(response_time_ms) AS average_response_ms,
 list_sort(list(DISTINCT hour(timestamp))) AS hours_active
FROM recent WHERE {where} GROUP BY {grouped} HAVING {having}"""


RULE_SQL = {
    "brute_force": _rule_sql(
        "brute_force", "endpoint = '/login' AND status IN (401, 429)", "HIGH", 1.0,
        "'Detected ' || count(*) || ' failed login attempts from IP ' || ip", "count(*) >= 5"),
    "sql_injection": _rule_sql(
        "sql_injection", f"({_SQL_INJECTION})", "CRITICAL", 1.0,
        "'SQL injection attempt from IP ' || ip || ' on ' || endpoint", "count(*) >= 1", ("endpoint", "method")),
    "port_scanning": _rule_sql(
        "port_scanning", "true", "MEDIUM", 0.9,
        "'Scanning: ' || count(DISTINCT endpoint) || ' endpoints from IP ' || ip", "count(DISTINCT endpoint) >= 10"),
    "path_traversal": _rule_sql(
        "path_traversal", f"({_TRAVERSAL})", "CRITICAL", 1.0,
        "'Path traversal attempt from IP ' || ip || ' on ' || endpoint", "count(*) >= 1", ("endpoint", "method")),
    "suspicious_user_agent": _rule_sql(
        "suspicious_user_agent", f"({_AGENT})", "MEDIUM", 0.85,
        "'Suspicious tool detected from IP ' || ip", "count(*) >= 3", ("user_agent",)),
    "time_anomaly": _rule_sql(
        "time_anomaly", _NIGHT, "LOW", 0.7,
        "'Off-hours activity: ' || count(*) || ' requests from IP ' || ip || ' between 22h-6h'", "count(*) >= 20"),
}

_RULE_WHERE = {
    "brute_force": ("endpoint = '/login' AND status IN (401, 429)", ()),
    "sql_injection": (f"({_SQL_INJECTION})", ("endpoint", "method")),
    "port_scanning": ("true", ()),
    "path_traversal": (f"({_TRAVERSAL})", ("endpoint", "method")),
    "suspicious_user_agent": (f"({_AGENT})", ("user_agent",)),
    "time_anomaly": (_NIGHT, ()),
}

ALERTS_CTE = (
    RECENT_CTE
    + ",\nalert_rows AS ("
    + "\nUNION ALL\n".join(f"({sql})" for sql in RULE_SQL.values())
    + """),
alerts AS (SELECT md5(concat_ws(',', """
    + ", ".join(
        f"coalesce(length({part}) || ':' || {part}, '-')"
        for part in ("alert_type", "ip", "key_endpoint", "key_method", "key_user_agent", "CAST(epoch_us(timestamp) AS VARCHAR)", "'7 days'")
    )
    + """, '-')) AS alert_id, * FROM alert_rows),
tagged AS ("""
    + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS alert_type, ip, "
        + ", ".join(
            (k if k in keys else "CAST(NULL AS VARCHAR)") + f" AS key_{k}" for k in ("endpoint", "method", "user_agent")
        )
        + f", id AS log_id, timestamp, endpoint FROM recent WHERE {where}"
        for name, (where, keys) in _RULE_WHERE.items()
    )
    + """),
members AS (SELECT a.alert_id, a.alert_type, a.severity, t.log_id, t.timestamp, t.endpoint FROM tagged t JOIN alerts a
  ON t.alert_type = a.alert_type AND t.ip IS NOT DISTINCT FROM a.ip AND t.key_endpoint IS NOT DISTINCT FROM a.key_endpoint
  AND t.key_method IS NOT DISTINCT FROM a.key_method AND t.key_user_agent IS NOT DISTINCT FROM a.key_user_agent)"""
)

_MONTH_CTE = ALERTS_CTE.replace("INTERVAL 7 DAY", "INTERVAL 30 DAY").replace("'7 days'", "'30 days'")

_ALERT_COLUMNS = f"""alert_id, alert_type, ip, key_endpoint, key_method, key_user_agent, severity, source, confidence, description,
 {sql_time('timestamp')}, related_logs, unique_endpoints, {sql_time('first_seen')},
 round(average_response_ms, 6) AS average_response_ms, array_to_string(hours_active, ',') AS hours_active"""


def alerts(spark, folder) -> DataFrame:
    return R.run_rules(logs(spark, folder), WINDOW)


def members(spark, folder) -> DataFrame:
    rows = logs(spark, folder)
    return R.alert_logs(rows, R.run_rules(rows, WINDOW), WINDOW)


def _one_rule(name):
    # Night traffic is thin: that rule needs the whole month to find anyone.
    window = "30 days" if name == "time_anomaly" else WINDOW

    def run(spark, folder):
        return shown(R.run_rules(logs(spark, folder), window, [R.rule(name)]).drop("metadata"))

    return run


def _all_rules(spark, folder):
    return shown(alerts(spark, folder).drop("metadata"))


def _long_history(spark, folder):
    found = R.run_rules(logs(spark, folder), "30 days")
    return R.rule_report(found)


def _report(spark, folder):
    """A rule over a column the logs lack must count 0 and leave the others alone."""
    broken = R.Rule(
        "broken_rule", "LOW", 0.1,
        matches=lambda: F.col("no_such_column") > 0,
        description=lambda: F.lit("never"),
        metadata=lambda window: [],
    )
    rules = [*R.RULES, broken]
    return R.rule_report(R.run_rules(logs(spark, folder), WINDOW, rules), rules)


def _metadata(spark, folder):
    """The JSON detail of the alerts, read back field by field."""
    def get(name):
        return F.get_json_object("metadata", f"$.{name}")

    return alerts(spark, folder).select(
        "alert_id",
        "alert_type",
        get("failed_attempts").alias("failed_attempts"),
        get("attempts").alias("attempts"),
        get("pattern").alias("pattern"),
        get("user_agent").alias("user_agent"),
        get("total_requests").alias("total_requests"),
        get("requests").alias("requests"),
        get("hours_active").alias("hours_active"),
        get("endpoints_targeted").alias("endpoints_targeted"),
        get("time_window").alias("time_window"),
        get("endpoint").alias("endpoint"),
        get("method").alias("method"),
        get("unique_endpoints").alias("unique_endpoints"),
        F.round(get("average_response_ms").cast("double"), 6).alias("average_response_ms"),
        F.date_format(get("first_attempt").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS").alias("first_attempt"),
        F.date_format(get("last_attempt").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS").alias("last_attempt"),
    )


def _alert_logs(spark, folder):
    return members(spark, folder).select("alert_id", "alert_type", "severity", "log_id")


def _log_lists(spark, folder):
    rows = logs(spark, folder)
    found = R.run_rules(rows, WINDOW)
    chunks = R.log_id_chunks(R.alert_logs(rows, found, WINDOW), 5)
    return shown(found.select("alert_id", "related_logs").join(chunks, "alert_id", "left"))


def _alert_endpoints(spark, folder):
    rows = logs(spark, folder)
    return R.alert_endpoints(rows, R.run_rules(rows, WINDOW), WINDOW)


def _rate_breaches(spark, folder):
    """Limits tightened so that the thin test traffic breaks some of them."""
    limits = {"/login": (1, 60), "/api/upload": (1, 60), "/search": (2, 3600)}
    return R.rate_breaches(logs(spark, folder), limits, (1, 3600))


QUERIES = {f"rule_{r.name}": _one_rule(r.name) for r in R.RULES} | {
    "rule_set_alerts": _all_rules,
    "rule_set_report": _report,
    "rule_historical_30_days": _long_history,
    "rule_alert_metadata": _metadata,
    "rule_alert_logs": _alert_logs,
    "rule_alert_log_ids": _log_lists,
    "rule_alert_endpoints": _alert_endpoints,
    "rule_rate_limit_breach": _rate_breaches,
}


def _counts_by_rule(extra: str = "") -> str:
    names = ", ".join(f"('{r.name}')" for r in R.RULES)
    return f"""SELECT n.alert_type, count(a.alert_id) AS alerts FROM (VALUES {names}{extra}) n(alert_type)
LEFT JOIN alerts a ON a.alert_type = n.alert_type GROUP BY n.alert_type"""


ORACLE = {
    f"rule_{r.name}": with_ctes(f"SELECT {_ALERT_COLUMNS} FROM alerts WHERE alert_type = '{r.name}'", ALERTS_CTE)
    for r in R.RULES
} | {
    "rule_time_anomaly": with_ctes(
        f"SELECT {_ALERT_COLUMNS} FROM alerts WHERE alert_type = 'time_anomaly'",
        _MONTH_CTE),
    "rule_set_alerts": with_ctes(f"SELECT {_ALERT_COLUMNS} FROM alerts", ALERTS_CTE),
    "rule_set_report": with_ctes(_counts_by_rule(", ('broken_rule')"), ALERTS_CTE),
    "rule_historical_30_days": with_ctes(_counts_by_rule(), _MONTH_CTE),
    "rule_alert_metadata": with_ctes(
        """SELECT alert_id, alert_type,
 CASE WHEN alert_type = 'brute_force' THEN CAST(related_logs AS VARCHAR) END AS failed_attempts,
 CASE WHEN alert_type IN ('sql_injection', 'path_traversal') THEN CAST(related_logs AS VARCHAR) END AS attempts,
 CASE WHEN alert_type = 'path_traversal' THEN CASE WHEN key_endpoint ILIKE '%../%' THEN 'directory traversal'
  WHEN key_endpoint ILIKE '%/etc/passwd%' THEN 'passwd file access' WHEN key_endpoint ILIKE '%/etc/shadow%' THEN 'shadow file access'
  WHEN key_endpoint ILIKE '%/proc/%' THEN 'proc filesystem access' ELSE 'other' END END AS pattern,
 key_user_agent AS user_agent,
 CASE WHEN alert_type = 'port_scanning' THEN CAST(related_logs AS VARCHAR) END AS total_requests,
 CASE WHEN alert_type IN ('suspicious_user_agent', 'time_anomaly') THEN CAST(related_logs AS VARCHAR) END AS requests,
 CASE WHEN alert_type = 'time_anomaly' THEN '[' || array_to_string(hours_active, ',') || ']' END AS hours_active,
 CASE WHEN alert_type = 'brute_force' THEN '["/login"]' END AS endpoints_targeted,
 CASE WHEN alert_type IN ('brute_force', 'port_scanning', 'time_anomaly') THEN '7 days' END AS time_window,
 CASE WHEN alert_type IN ('sql_injection', 'path_traversal') THEN key_endpoint END AS endpoint,
 CASE WHEN alert_type IN ('sql_injection', 'path_traversal') THEN key_method END AS method,
 CASE WHEN alert_type IN ('port_scanning', 'time_anomaly') THEN CAST(unique_endpoints AS VARCHAR) END AS unique_endpoints,
 CASE WHEN alert_type = 'port_scanning' THEN round(average_response_ms, 6) END AS average_response_ms,
 CASE WHEN alert_type = 'brute_force' THEN left(strftime(first_seen, '%Y-%m-%d %H:%M:%S.%f'), 23) END AS first_attempt,
 CASE WHEN alert_type = 'brute_force' THEN left(strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f'), 23) END AS last_attempt
FROM alerts""", ALERTS_CTE),
    "rule_alert_logs": with_ctes("SELECT alert_id, alert_type, severity, log_id FROM members", ALERTS_CTE),
    "rule_alert_log_ids": with_ctes(
        """SELECT a.alert_id, a.related_logs, m.chunk, m.log_ids FROM alerts a LEFT JOIN
 (SELECT alert_id, chunk, string_agg(CAST(log_id AS VARCHAR), ',' ORDER BY timestamp, log_id) AS log_ids FROM
  (SELECT *, CAST((row_number() OVER (PARTITION BY alert_id ORDER BY timestamp, log_id) - 1) // 5 AS BIGINT) AS chunk FROM members)
  GROUP BY alert_id, chunk) m ON a.alert_id = m.alert_id""", ALERTS_CTE),
    "rule_alert_endpoints": with_ctes(
        "SELECT alert_id, endpoint, count(*) AS requests FROM members WHERE endpoint IS NOT NULL GROUP BY alert_id, endpoint",
        ALERTS_CTE),
    "rule_rate_limit_breach": with_ctes(
        """SELECT ip, route, allowed, window_start, count(*) AS requests FROM (
 SELECT ip, route, allowed, second - second % seconds AS window_start FROM (
  SELECT *, CASE route WHEN '/login' THEN 1 WHEN '/api/upload' THEN 1 WHEN '/search' THEN 2 ELSE 1 END AS allowed,
   CASE route WHEN '/login' THEN 60 WHEN '/api/upload' THEN 60 WHEN '/search' THEN 3600 ELSE 3600 END AS seconds FROM (
   SELECT ip, split_part(endpoint, '?', 1) AS route, CAST(floor(epoch_us(timestamp) / 1000000) AS BIGINT) AS second FROM logs)))
GROUP BY ip, route, allowed, window_start HAVING count(*) > allowed"""),
}
