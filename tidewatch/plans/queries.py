"""What an operator asks of the log, alert and score tables.

Tables: ``logs`` (raw_logs), ``alerts`` and its log rows ``members`` (operators.rules), ``scores``
(hybrid_scores with created_at). ``as_of`` stands for the present moment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import contains_text, latest, recent
from tidewatch.plans.playbooks import DEFAULT_PLAYBOOK, PLAYBOOKS

ALERT_COLUMNS = [
    "alert_id", "alert_type", "severity", "source", "confidence", "description", "ip", "timestamp", "metadata", "related_logs",
]
LOG_COLUMNS = ["id", "timestamp", "ip", "method", "endpoint", "status", "response_time_ms", "user_agent", "data"]


def _rows() -> Column:
    return F.count(F.lit(1))


def _newest(df: DataFrame, limit: int, tie: str) -> DataFrame:
    """The newest rows; Spark keeps only ``limit`` rows per task on the way."""
    return df.orderBy(F.desc("timestamp"), tie).limit(limit)


def overview(alerts: DataFrame, logs: DataFrame) -> DataFrame:
    """Total alerts and the newest log, in one row."""
    newest = logs.agg(F.max("timestamp")).scalar()
    return alerts.agg(_rows().alias("total_alerts")).withColumn("latest_log", newest)


def active_alerts(alerts: DataFrame, as_of: Column | None = None, hours: int = 24) -> DataFrame:
    """Alerts per severity in the last hours, most frequent first."""
    young = recent(alerts, f"{hours} hours", as_of)
    return young.groupBy("severity").agg(_rows().alias("alerts")).orderBy(F.desc("alerts"), "severity")


def hourly_trend(df: DataFrame, as_of: Column | None = None, hours: int = 24, name: str = "timestamp") -> DataFrame:
    """Rows per hour in the last hours, in order."""
    young = recent(df, f"{hours} hours", as_of, name)
    return young.groupBy(F.date_trunc("hour", name).alias("bucket")).agg(_rows().alias("rows")).orderBy("bucket")


def anomaly_trend(scores: DataFrame, as_of: Column | None = None, hours: int = 24) -> DataFrame:
    """Anomalies per hour; the last hours end at the newest score, anomalous or not."""
    now = latest(scores, "created_at") if as_of is None else as_of
    return hourly_trend(scores.filter("is_anomaly"), now, hours, "created_at")


def filter_options(alerts: DataFrame) -> DataFrame:
    """(field, value): the distinct alert types, sources and severities, sorted."""
    values = F.inline(F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(name).alias("value")) for name in ("alert_type", "source", "severity")
    ]))
    return alerts.select(values).distinct().orderBy("field", "value")


def search_alerts(
    alerts: DataFrame,
    severity: str = "ALL",
    alert_type: str = "ALL",
    source: str = "ALL",
    ip: str = "",
    hours: int = 24,
    limit: int = 200,
    as_of: Column | None = None,
) -> DataFrame:
    found = recent(alerts, f"{hours} hours", as_of)
    for name, value in (("severity", severity), ("alert_type", alert_type), ("source", source)):
        if value != "ALL":
            found = found.filter(F.col(name) == value)
    if ip:
        found = found.filter(contains_text(F.col("ip"), ip))
    return _newest(found.select(*ALERT_COLUMNS), limit, "alert_id")


def alert_detail(alerts: DataFrame, alert_id: str) -> DataFrame:
    return alerts.filter(F.col("alert_id") == alert_id).select(*ALERT_COLUMNS)


def alert_log_rows(logs: DataFrame, members: DataFrame, alert_id: str, limit: int = 50) -> DataFrame:
    """The newest logs of one alert."""
    ids = members.filter(F.col("alert_id") == alert_id).select(F.col("log_id").alias("id"))
    return _newest(logs.join(ids, "id", "left_semi").select(*LOG_COLUMNS), limit, "id")


def search_logs(
    logs: DataFrame,
    hours: int = 24,
    ip: str = "",
    endpoint: str = "",
    method: str = "ALL",
    status: int | None = None,
    text: str = "",
    limit: int = 250,
    as_of: Column | None = None,
) -> DataFrame:
    """Filtered logs, newest first; ``text`` is looked for in the endpoint and the whole record."""
    found = recent(logs, f"{hours} hours", as_of)
    if ip:
        found = found.filter(contains_text(F.col("ip"), ip))
    if endpoint:
        found = found.filter(contains_text(F.col("endpoint"), endpoint))
    if method != "ALL":
        found = found.filter(F.col("method") == method)
    if status is not None:
        found = found.filter(F.col("status") == status)
    if text:
        found = found.filter(contains_text(F.col("endpoint"), text) | contains_text(F.col("data"), text))
    return _newest(found.select(*LOG_COLUMNS), limit, "id")


def log_score(scores: DataFrame, log_id: int) -> DataFrame:
    return scores.filter(F.col("log_id") == log_id)


def log_alerts(alerts: DataFrame, members: DataFrame, log_id: int, limit: int = 25) -> DataFrame:
    """The newest alerts that name the log."""
    ids = members.filter(F.col("log_id") == log_id).select("alert_id")
    return _newest(alerts.join(ids, "alert_id", "left_semi").select(*ALERT_COLUMNS), limit, "alert_id")


def prediction_split(scores: DataFrame) -> DataFrame:
    kind = F.when(F.col("is_anomaly"), "anomaly").otherwise("normal")
    return scores.groupBy(kind.alias("prediction")).agg(_rows().alias("logs")).orderBy("prediction")


_SERIES = (
    "struct<data: struct<result: array<struct<metric: struct<job: string, model: string, prediction: string>,"
    " value: array<string>, values: array<array<string>>>>>>"
)


def series_rows(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """(timestamp, value, series) from nested JSON range results."""
    result = F.explode(F.from_json(column, _SERIES)["data"]["result"]).alias("item")
    metric = [F.nullif(F.col(f"item.metric.{name}"), F.lit("")) for name in ("job", "model", "prediction")]
    points = payloads.select(result).select(
        F.coalesce(*metric, F.lit("series")).alias("series"), F.explode("item.values").alias("point")
    )
    return points.select(
        F.timestamp_micros((F.col("point")[0].cast("double") * 1_000_000).cast("bigint")).alias("timestamp"),
        F.col("point")[1].cast("double").alias("value"),
        "series",
    )


def first_value(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """The value of the first result of nested JSON point results, null when there is none."""
    result = F.from_json(column, _SERIES)["data"]["result"]
    value = F.get(F.get(result, F.lit(0))["value"], F.lit(1)).cast("double")
    return payloads.select(*[c for c in payloads.columns if c != column], value.alias("value"))


def playbook_table(spark: SparkSession) -> DataFrame:
    """One row per alert type with a response plan."""
    rows = [(name, title, summary, steps) for name, title, summary, steps in PLAYBOOKS]
    return spark.createDataFrame(rows, "alert_type string, title string, summary string, steps array<string>")


def with_playbook(alerts: DataFrame) -> DataFrame:
    """Add title, summary and steps; unknown types get the general plan. The table has a row per rule."""
    plans = F.broadcast(playbook_table(alerts.sparkSession))
    title, summary, steps = DEFAULT_PLAYBOOK
    return alerts.join(plans, "alert_type", "left").withColumns({
        "title": F.coalesce("title", F.lit(title)),
        "summary": F.coalesce("summary", F.lit(summary)),
        "steps": F.coalesce("steps", F.array(*[F.lit(s) for s in steps])),
    })


def alerts_by_type(alerts: DataFrame, ip: str | None = None) -> DataFrame:
    found = alerts if ip is None else alerts.filter(F.col("ip") == ip)
    return (
        found.groupBy("alert_type", "severity").agg(_rows().alias("alerts")).orderBy(F.desc("alerts"), "alert_type", "severity")
    )


def phase_logs(logs: DataFrame, after_id: int, up_to_id: int, log_type: str) -> DataFrame:
    """Logs of one type in an id range."""
    return logs.filter((F.col("id") > after_id) & (F.col("id") <= up_to_id) & (F.col("log_type") == log_type))


def phase_scores(scores: DataFrame, phase: DataFrame) -> DataFrame:
    """Scored logs, anomalies and mean final score of a phase."""
    ids = phase.select(F.col("id").alias("log_id"))
    return scores.join(ids, "log_id", "left_semi").agg(
        _rows().alias("scored_logs"),
        F.count_if("is_anomaly").alias("anomalies"),
        F.round(F.avg("final_score"), 4).alias("avg_final_score"),
    )


def status_counts(logs: DataFrame) -> DataFrame:
    return logs.groupBy("status").agg(_rows().alias("logs")).orderBy(F.desc("logs"), "status")


def top_addresses(logs: DataFrame, limit: int = 20) -> DataFrame:
    return logs.groupBy("ip").agg(_rows().alias("requests")).orderBy(F.desc("requests"), "ip").limit(limit)


def recent_load(logs: DataFrame, as_of: Column | None = None, hours: int = 1) -> DataFrame:
    """Requests and average response time of the last hours."""
    return recent(logs, f"{hours} hours", as_of).agg(
        _rows().alias("requests"), F.avg("response_time_ms").alias("avg_response_ms")
    )
