"""Value domains and the names of the feature columns."""

from __future__ import annotations

# Fixed values.
ALERT_SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
ALERT_SOURCES = ["rule", "ml", "hybrid"]
SCORE_SEVERITIES = ["NORMAL", "MEDIUM", "HIGH", "CRITICAL"]

# The order in which the feature columns are reported.
FEATURES = [
    "status_code",
    "response_time_ms",
    "requests_per_ip_5min",
    "unique_endpoints_5min",
    "failed_requests_ratio_5min",
    "avg_response_time_5min",
    "max_response_time_5min",
    "request_rate_5min",
    "hour_of_day",
    "day_of_week",
    "is_night",
    "endpoint_length",
    "has_query_params",
    "query_param_count",
    "endpoint_entropy",
    "time_since_last_request",
    "requests_per_minute",
    "response_time_log",
    "response_time_zscore_global",
    "response_time_zscore_endpoint",
    "requests_vs_ip_baseline_ratio",
    "endpoint_rarity",
    "method_endpoint_rarity",
    "error_burst_score",
    "hour_deviation_from_endpoint_pattern",
]
