"""Behavioural features of every request."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import logs, shown, with_ctes
from tidewatch.functions.text import entropy
from tidewatch.operators import features as E
from tidewatch.schemas import FEATURES

FILLED_CTE = """filled AS (SELECT id, timestamp, coalesce(ip, '0.0.0.0') AS ip, coalesce(method, 'UNKNOWN') AS method,
 coalesce(endpoint, '/unknown') AS endpoint, coalesce(user_agent, 'unknown') AS user_agent, coalesce(status, 0) AS status,
 coalesce(response_time_ms, (SELECT median(response_time_ms) FROM logs)) AS response_time_ms, scenario,
 time_bucket(INTERVAL 5 MINUTE, timestamp) AS bucket FROM logs)"""

CHARS = """SELECT endpoint, -sum(p * log2(p)) AS h FROM (SELECT endpoint, c, count(*) / length(endpoint) AS p
 FROM (SELECT endpoint, unnest(string_split(endpoint, '')) AS c FROM (SELECT DISTINCT endpoint FROM filled)) GROUP BY endpoint, c) GROUP BY endpoint"""

FEATURES_CTE = FILLED_CTE + f""",
bucketed AS (SELECT ip, bucket, count(*) AS n, count(DISTINCT endpoint) AS u, avg(CASE WHEN status >= 400 THEN 1.0 ELSE 0.0 END) AS bad,
 avg(response_time_ms) AS a, max(response_time_ms) AS m FROM filled GROUP BY ip, bucket),
gapped AS (SELECT *, epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (PARTITION BY ip ORDER BY timestamp, id) AS gap,
 row_number() OVER (PARTITION BY ip ORDER BY timestamp, id) AS pos FROM filled),
entropies AS ({CHARS}),
per_endpoint AS (SELECT endpoint, avg(response_time_ms) AS em, stddev_samp(response_time_ms) AS es, count(*) AS en,
 median(hour(timestamp)) AS eh FROM filled GROUP BY endpoint),
per_pair AS (SELECT method, endpoint, count(*) AS pn FROM filled GROUP BY method, endpoint),
per_ip AS (SELECT f.ip, median(b.n) AS im FROM filled f JOIN bucketed b ON f.ip = b.ip AND f.bucket = b.bucket GROUP BY f.ip),
overall AS (SELECT count(*) AS n, avg(response_time_ms) AS m, stddev_samp(response_time_ms) AS s FROM filled),
features AS (SELECT g.id AS log_id, g.timestamp, g.scenario,
 CAST(g.status AS DOUBLE) AS status_code, g.response_time_ms, CAST(b.n AS DOUBLE) AS requests_per_ip_5min,
 CAST(b.u AS DOUBLE) AS unique_endpoints_5min, CAST(b.bad AS DOUBLE) AS failed_requests_ratio_5min, b.a AS avg_response_time_5min,
 b.m AS max_response_time_5min, b.n / 300.0 AS request_rate_5min, CAST(hour(g.timestamp) AS DOUBLE) AS hour_of_day,
 CAST(isodow(g.timestamp) - 1 AS DOUBLE) AS day_of_week,
 CASE WHEN hour(g.timestamp) >= 22 OR hour(g.timestamp) < 6 THEN 1.0 ELSE 0.0 END AS is_night,
 CAST(length(g.endpoint) AS DOUBLE) AS endpoint_length, CASE WHEN g.endpoint LIKE '%?%' THEN 1.0 ELSE 0.0 END AS has_query_params,
 CAST(length(g.endpoint) - length(replace(g.endpoint, '&', '')) + CASE WHEN g.endpoint LIKE '%?%' THEN 1 ELSE 0 END AS DOUBLE) AS query_param_count,
 h.h AS endpoint_entropy,
 coalesce(g.gap, (SELECT median(gap) FROM gapped), 999999000000) / 1000000.0 AS time_since_last_request,
 CAST(least(g.pos, 60) AS DOUBLE) AS requests_per_minute, ln(1 + g.response_time_ms) AS response_time_log,
 greatest(-10, least(10, (g.response_time_ms - o.m) / CASE WHEN o.s = 0 THEN 1 ELSE o.s END)) AS response_time_zscore_global,
 greatest(-10, least(10, (g.response_time_ms - p.em) / coalesce(nullif(p.es, 0), o.s))) AS response_time_zscore_endpoint,
 greatest(0, least(50, b.n / CASE WHEN i.im = 0 THEN 1 ELSE i.im END)) AS requests_vs_ip_baseline_ratio,
 1.0 - CAST(p.en AS DOUBLE) / o.n AS endpoint_rarity, 1.0 - CAST(q.pn AS DOUBLE) / o.n AS method_endpoint_rarity,
 greatest(0, least(1000, CAST(b.bad AS DOUBLE) * b.n)) AS error_burst_score,
 least(12, abs(hour(g.timestamp) - p.eh)) AS hour_deviation_from_endpoint_pattern
FROM gapped g JOIN bucketed b ON g.ip = b.ip AND g.bucket = b.bucket JOIN entropies h ON g.endpoint = h.endpoint
JOIN per_endpoint p ON g.endpoint = p.endpoint JOIN per_pair q ON g.method = q.method AND g.endpoint = q.endpoint
JOIN per_ip i ON g.ip = i.ip CROSS JOIN overall o)"""


def features(spark, folder):
    return E.extract_features(logs(spark, folder))


def _rows(spark, folder):
    rows = logs(spark, folder)
    base = E.baselines(rows)
    return base, E.keyed(E.filled_logs(rows, base.median_ms))


def _filled(spark, folder):
    """One log column is dropped first, so that an absent column is filled as well."""
    rows = logs(spark, folder)
    base = E.baselines(rows)
    filled = E.filled_logs(rows.drop("method"), base.median_ms)
    return shown(filled.select("id", "ip", "method", "endpoint", "status", "user_agent", "response_time_ms"))


def _baselines(spark, folder):
    """The whole-input statistics as one row, computed without leaving the cluster."""
    rows = logs(spark, folder)
    base = E.baselines(rows)
    one = rows.agg(F.count(F.lit(1)).alias("rows"))
    return shown(one.select(
        "rows",
        F.lit(base.median_ms).alias("median_ms"),
        F.lit(base.mean_ms).alias("mean_ms"),
        F.lit(base.std_ms).alias("std_ms"),
        F.lit(base.median_gap).alias("median_gap"),
    ))


def _columns(names, frame, derived):
    return shown(frame.select(F.col("id").alias("log_id"), *[derived[n].alias(n) for n in names]))


def _own(names):
    def run(spark, folder):
        _, rows = _rows(spark, folder)
        return _columns(names, rows, E.request_features())

    return run


def _address(names):
    def run(spark, folder):
        base, rows = _rows(spark, folder)
        return _columns(names, rows.join(E.ip_moments(rows), ["ip", "bucket", "at"]), E.address_features(base))

    return run


def _endpoint(names):
    def run(spark, folder):
        base, rows = _rows(spark, folder)
        return _columns(names, rows.join(E.endpoint_profiles(rows), ["method", "endpoint"]), E.endpoint_features(base))

    return run


def _entropy(spark, folder):
    """Over the page addresses, which are longer and more varied than the log endpoints."""
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return shown(pages.select("page_id", entropy(F.col("url")).alias("entropy")))


def _all(spark, folder):
    return shown(features(spark, folder).drop("data", "timestamp"))


def _isolation(spark, folder):
    frame = features(spark, folder).drop("status_code", "data", "timestamp")
    names = E.isolation_features(frame.columns)
    return shown(frame.agg(*[F.avg(F.abs(n)).alias(n) for n in names]), 4)


_GROUPS = {
    "feat_status_and_time": (_own, ["status_code", "response_time_ms"]),
    "feat_ip_5min": (_address, [
        "requests_per_ip_5min", "unique_endpoints_5min", "failed_requests_ratio_5min", "avg_response_time_5min",
        "max_response_time_5min", "request_rate_5min"]),
    "feat_clock": (_own, ["hour_of_day", "day_of_week", "is_night"]),
    "feat_url": (_own, ["endpoint_length", "has_query_params", "query_param_count"]),
    "feat_entropy": (_endpoint, ["endpoint_entropy"]),
    "feat_request_gap": (_address, ["time_since_last_request"]),
    "feat_rows_so_far": (_address, ["requests_per_minute"]),
    "feat_response_log": (_own, ["response_time_log"]),
    "feat_zscore_global": (_endpoint, ["response_time_zscore_global"]),
    "feat_zscore_endpoint": (_endpoint, ["response_time_zscore_endpoint"]),
    "feat_ip_baseline_ratio": (_address, ["requests_vs_ip_baseline_ratio"]),
    "feat_rarity": (_endpoint, ["endpoint_rarity", "method_endpoint_rarity"]),
    "feat_error_burst": (_address, ["error_burst_score"]),
    "feat_hour_deviation": (_endpoint, ["hour_deviation_from_endpoint_pattern"]),
}

QUERIES = {
    "feat_fill_missing": _filled,
    "feat_baselines": _baselines,
    **{name: make(names) for name, (make, names) in _GROUPS.items()},
    "feat_url_entropy_pages": _entropy,
    "feat_all": _all,
    "feat_isolation_columns": _isolation,
}


def _sql(names) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


ORACLE = {
    "feat_fill_missing": with_ctes(
        """SELECT id, ip, 'UNKNOWN' AS method, endpoint, status, user_agent, round(response_time_ms, 6) AS response_time_ms FROM filled""",
        FILLED_CTE),
    "feat_baselines": with_ctes(
        """SELECT o.n AS rows, round((SELECT median(response_time_ms) FROM logs), 6) AS median_ms, round(o.m, 6) AS mean_ms,
 round(o.s, 6) AS std_ms, round((SELECT median(gap) FROM gapped) / 1000000.0, 6) AS median_gap FROM overall o""", FEATURES_CTE),
    **{
        name: with_ctes(f"SELECT log_id, {_sql(names)} FROM features", FEATURES_CTE) for name, (_, names) in _GROUPS.items()
    },
    "feat_url_entropy_pages": """SELECT page_id, round(-sum(p * log2(p)), 6) AS entropy FROM (
 SELECT page_id, c, count(*) / any_value(length(url)) AS p FROM (SELECT page_id, url, unnest(string_split(url, '')) AS c FROM pages)
 GROUP BY page_id, c) GROUP BY page_id""",
    "feat_all": with_ctes(f"SELECT log_id, {_sql(FEATURES)} FROM features", FEATURES_CTE),
    "feat_isolation_columns": with_ctes(
        "SELECT " + ", ".join(f"round(avg(abs({n})), 4) AS {n}" for n in FEATURES if n != "status_code") + " FROM features", FEATURES_CTE),
}
