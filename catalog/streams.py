"""Streaming jobs, run over what is there and compared with the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import LOG_BLOCK, logs, shown, stored_logs, with_ctes
from catalog.detection import ALERTS_CTE, RECENT_CTE
from catalog.ingestion import COMBINED_CTE, combined_lines
from catalog.models import ISOLATION, dataset
from catalog.scoring import SCORES_CTE, decide, members
from tidewatch.operators import rules as R
from tidewatch.operators import features as E
from tidewatch.operators import forest as I
from tidewatch.operators import scoring as S
from tidewatch.schemas import FEATURES
from tidewatch.session import prepare, shared_folder
from tidewatch.sources.adapter import requests, with_data
from tidewatch.sources.tail import tail_lines
from tidewatch.streaming import jobs as J


def log_stream(spark, folder):
    """The events file as a stream of log rows, in event time."""
    prepare(spark)
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    return with_data(requests(events)).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _ingest(spark, folder):
    """Lines written as several files, taken in two files at a time."""
    source, table = shared_folder(spark, "lines"), shared_folder(spark, "raw-logs")
    combined_lines(spark, folder).select("value").repartition(5).write.text(source)
    J.ingest(J.stream_lines(spark, source, 2), table, shared_folder(spark, "cp"), "apache_combined").awaitTermination()
    stored = spark.read.parquet(table)
    return stored.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("logs"), F.count_distinct("id").alias("ids"), F.count("method").alias("with_method"))


class _Appender:
    """Appends the lines of each partition to a log file of its own, as that many web servers would."""

    def __init__(self, folder: str, step: int):
        self.folder, self.step = folder.removeprefix("file:"), step

    def __call__(self, rows) -> None:
        from pathlib import Path

        from pyspark import TaskContext

        file = Path(self.folder) / f"app-{TaskContext.get().partitionId()}.log"
        file.parent.mkdir(parents=True, exist_ok=True)
        done = file.with_name(f".{file.name}-{self.step}")  # a repeated task appends nothing
        if not done.exists():
            with file.open("a", encoding="utf-8") as out:
                out.writelines(f"{row.value}\n" for row in rows)
            done.touch()


def _tail(spark, folder):
    """Files that grow in three steps; after each the stream is started again and takes what is new."""
    source, table, progress = (shared_folder(spark, n) for n in ("growing", "raw-logs", "cp"))
    lines = combined_lines(spark, folder).select("value", F.pmod(F.xxhash64("value"), F.lit(3)).alias("step"))
    for step in range(3):
        lines.filter(F.col("step") == step).repartition(3).foreachPartition(_Appender(source, step))
        growing = tail_lines(spark, source, "app-*.log", bytes_per_task=100_000)
        J.ingest(growing, table, progress, "apache_combined").awaitTermination()
    stored = spark.read.parquet(table)
    return stored.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("logs"), F.count_distinct("id").alias("ids"), F.count("method").alias("with_method"))


def _failed(spark, folder):
    """Lines that a stream could not parse, kept in full."""
    source, table = shared_folder(spark, "lines"), shared_folder(spark, "raw-logs")
    combined_lines(spark, folder).select("value").repartition(4).write.text(source)
    J.ingest(J.stream_lines(spark, source, 1), table, shared_folder(spark, "cp"), "apache_combined").awaitTermination()
    return spark.read.parquet(f"{table}_failed").groupBy(F.col("_line").alias("line")).agg(F.count(F.lit(1)).alias("lines"))


def _alert_ids(spark, folder):
    """Overlapping windows: no two alerts share an id."""
    table = shared_folder(spark, "alerts")
    found = J.windowed_alerts(log_stream(spark, folder), "2 days", "1 day", "2 hours")
    J.store_alerts(found, table, shared_folder(spark, "cp")).awaitTermination()
    return spark.read.parquet(table).agg(F.count(F.lit(1)).alias("alerts"), F.count_distinct("alert_id").alias("ids"))


_ALERT_COLUMNS = [
    "window_start", "window_end", "alert_type", "severity", "ip", "key_endpoint", "key_user_agent", "related_logs",
    "unique_endpoints", "average_response_ms", "hours_active", "description",
]


def _windowed(window, slide):
    def run(spark, folder):
        table = shared_folder(spark, "alerts")
        found = J.windowed_alerts(log_stream(spark, folder), window, slide, "2 hours")
        J.store_alerts(found, table, shared_folder(spark, "cp")).awaitTermination()
        return shown(spark.read.parquet(table).select(_ALERT_COLUMNS))

    return run


def _window_logs(spark, folder):
    table = shared_folder(spark, "alerts")
    rules = [R.rule("brute_force"), R.rule("suspicious_user_agent")]
    found = J.windowed_alerts(log_stream(spark, folder), "1 day", None, "2 hours", rules)
    J.store_alerts(found, table, shared_folder(spark, "cp")).awaitTermination()
    rows = logs(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    named = J.windowed_alert_logs(rows, spark.read.parquet(table), "1 day", None, rules)
    return named.select("alert_type", "log_id")


def _window_logs_all(spark, folder):
    """The logs behind the windowed alerts of all rules."""
    table = shared_folder(spark, "alerts")
    J.store_alerts(J.windowed_alerts(log_stream(spark, folder), "1 day", None, "2 hours"), table, shared_folder(spark, "cp")).awaitTermination()
    rows = logs(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return J.windowed_alert_logs(rows, spark.read.parquet(table), "1 day").select("alert_type", "log_id")


def _dedup(spark, folder):
    """Every third row arrives twice."""
    source, table = shared_folder(spark, "twice"), shared_folder(spark, "once")
    rows = logs(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows.unionByName(rows.filter("id % 3 = 0")).write.parquet(source)
    stream = J.deduplicated(spark.readStream.schema(rows.schema).parquet(source), "2 hours")
    J.store_alerts(stream, table, shared_folder(spark, "cp")).awaitTermination()
    return spark.read.parquet(table).select("id", "ip", "endpoint")


def _score(spark, folder):
    rows = logs(spark, folder)
    table = shared_folder(spark, "scores")
    J.score(
        log_stream(spark, folder), table, shared_folder(spark, "cp"), decide, members, E.baselines(rows)
    ).awaitTermination()
    return shown(spark.read.parquet(table).select("log_id", "rule_score", "final_score", "severity", "triggered_rules"))


def _steps(rows, count=5):
    """The logs cut at any second into so many parts of equal time."""
    low, high = rows.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    edges = [low + (high + 1 - low) * number // count for number in range(count + 1)] if low is not None else []
    times = [F.timestamp_micros(F.lit(edge)) for edge in edges]
    return [rows.filter((F.col("timestamp") >= first) & (F.col("timestamp") < last)) for first, last in zip(times, times[1:])]


def _scored_in_steps(spark, folder, decided=None, raw=None):
    """Scores of five batches, with profiles stored by a batch: (all logs, profiles, store).

    The stream is run again for each part of the logs, which is written by as many tasks as read it: a run takes what is new as one batch.
    """
    raw = stored_logs(spark, folder) if raw is None else raw
    rows = raw.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    source, store, checkpoint, profiles = (shared_folder(spark, name) for name in ("steps", "scored", "cp", "profiles"))
    E.store_profiles(rows, profiles)
    known = E.load_profiles(spark, profiles)
    for part in _steps(rows):
        part.write.mode("append").option("parquet.block.size", LOG_BLOCK).parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        J.score_closed(stream, store, checkpoint, decided or decide, known, "1 day", "2 hours").awaitTermination()
    return rows, known, store


def _score_batches(spark, folder):
    _, _, store = _scored_in_steps(spark, folder)
    return shown(spark.read.parquet(f"{store}/scores").select("log_id", "rule_score", "final_score", "severity", "triggered_rules"))


def _score_model(spark, folder):
    """A stored isolation forest over five batches against the same forest over all logs at once."""
    path = shared_folder(spark, "isolation")
    raw = stored_logs(spark, folder)
    data = dataset(spark, folder, raw)
    I.save_isolation(I.fit_isolation(data.filter("label = 0"), FEATURES, ISOLATION), spark, path)
    decided = J.model_decisions(spark, path)
    rows, _, store = _scored_in_steps(spark, folder, decided, raw)
    found = spark.read.parquet(f"{store}/scores").select("log_id", F.struct("rule_score", "final_score", "severity", "triggered_rules").alias("stream"))
    alerts = J.window_alerts(rows, "1 day")
    # The data set holds the features of all logs at once.
    batch = S.hybrid_scores(decided(data), J.windowed_alert_logs(rows, alerts, "1 day"))
    both = found.join(batch.select("log_id", F.struct("rule_score", "final_score", "severity", "triggered_rules").alias("batch")), "log_id")
    near = F.abs(F.col("stream.final_score") - F.col("batch.final_score")) < 0.00011
    return both.agg(
        F.count(F.lit(1)).alias("logs"), F.count_if(near).alias("same_score"), F.count_if(F.col("stream.rule_score") == F.col("batch.rule_score")).alias("same_rule_score"),
        F.count_if(F.col("stream.triggered_rules") == F.col("batch.triggered_rules")).alias("same_rules"))


def _panes(spark, folder):
    table = shared_folder(spark, "alerts")
    found = J.pane_alerts(log_stream(spark, folder), "2 days", "1 day", "2 hours")
    J.store_alerts(found, table, shared_folder(spark, "cp")).awaitTermination()
    return shown(spark.read.parquet(table).select(_ALERT_COLUMNS))


def _metrics(spark, folder):
    table = shared_folder(spark, "metrics")
    J.publish_metrics(J.status_metrics(log_stream(spark, folder)), table, shared_folder(spark, "cp"), None).awaitTermination()
    return shown(spark.read.parquet(table))


QUERIES = {
    "stream_ingest_lines": _ingest,
    "stream_tail_growing_file": _tail,
    "stream_alerts_tumbling": _windowed("1 day", None),
    "stream_alerts_sliding": _windowed("2 days", "1 day"),
    "stream_sliding_alert_ids": _alert_ids,
    "stream_failed_lines": _failed,
    "stream_alert_logs": _window_logs,
    "stream_alert_logs_all": _window_logs_all,
    "stream_deduplicate": _dedup,
    "stream_scores": _score,
    "stream_scores_batches": _score_batches,
    "stream_scores_model": _score_model,
    "stream_alerts_panes": _panes,
    "stream_metrics": _metrics,
}


def _windowed_sql(days: int, slide: int) -> str:
    """Every rule per window; only windows that the watermark has passed."""
    starts = ", ".join(str(i) for i in range(days // slide))
    cte = ALERTS_CTE.split("alert_rows AS")[0].replace(
        "recent AS (SELECT * FROM logs WHERE timestamp > (SELECT max(timestamp) FROM logs) - INTERVAL 7 DAY)",
        f"""recent AS (SELECT l.*, date_trunc('day', timestamp) - to_days(CAST(s * {slide} AS INTEGER)) AS ws FROM logs l, (SELECT unnest([{starts}]) AS s))""")
    alert_part = ALERTS_CTE.split("alert_rows AS")[1].split("),\nalerts AS")[0]
    alert_part = alert_part.replace("SELECT '", "SELECT ws, '").replace("GROUP BY ip", "GROUP BY ws, ip")
    body = f"""SELECT strftime(ws, '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime(ws + INTERVAL {days} DAY, '%Y-%m-%d %H:%M:%S.%f') AS window_end,
 alert_type, severity, ip, key_endpoint, key_user_agent, related_logs, unique_endpoints, round(average_response_ms, 6) AS average_response_ms,
 array_to_string(hours_active, ',') AS hours_active, description FROM alert_rows
WHERE ws + INTERVAL {days} DAY <= (SELECT max(timestamp) FROM logs) - INTERVAL 2 HOUR"""
    return with_ctes(body, cte + "alert_rows AS" + alert_part + ")")


# Scores with the alerts of whole days; logs of days that the newest log is two hours beyond.
_DAILY_ALERTS_CTE = (
    ALERTS_CTE.replace(RECENT_CTE, "recent AS (SELECT *, date_trunc('day', timestamp) AS ws FROM logs)")
    .replace("SELECT '", "SELECT ws, '").replace("GROUP BY ip", "GROUP BY ws, ip").replace("ON t.alert_type", "ON t.ws = a.ws AND t.alert_type")
)
_DAILY_SCORES_CTE = SCORES_CTE.replace(ALERTS_CTE, _DAILY_ALERTS_CTE)
_CLOSED = "timestamp < date_trunc('day', (SELECT max(timestamp) FROM logs) - INTERVAL 2 HOUR)"

_INGESTED = with_ctes(
    """SELECT strftime(timestamp, '%Y-%m-%d') AS date, count(*) AS logs, count(*) AS ids, count(method) AS with_method
FROM apache WHERE parsed GROUP BY 1""", COMBINED_CTE)

ORACLE = {
    "stream_ingest_lines": _INGESTED,
    "stream_tail_growing_file": _INGESTED,
    "stream_alerts_tumbling": _windowed_sql(1, 1),
    "stream_alerts_sliding": _windowed_sql(2, 1),
    "stream_sliding_alert_ids": "SELECT count(*) AS alerts, count(*) AS ids FROM (" + _windowed_sql(2, 1) + ")",
    "stream_failed_lines": with_ctes("SELECT value AS line, count(*) AS lines FROM apache WHERE NOT parsed GROUP BY value", COMBINED_CTE),
    "stream_alert_logs": with_ctes(
        """SELECT alert_type, log_id FROM (SELECT 'brute_force' AS alert_type, id AS log_id, timestamp, count(*) OVER (PARTITION BY ip, date_trunc('day', timestamp)) AS n, 5 AS m
 FROM logs WHERE endpoint = '/login' AND status IN (401, 429) UNION ALL
 SELECT 'suspicious_user_agent', id, timestamp, count(*) OVER (PARTITION BY ip, user_agent, date_trunc('day', timestamp)), 3
 FROM logs WHERE user_agent ILIKE '%sqlmap%' OR user_agent ILIKE '%python-requests%')
WHERE n >= m AND date_trunc('day', timestamp) + INTERVAL 1 DAY <= (SELECT max(timestamp) FROM logs) - INTERVAL 2 HOUR"""),
    "stream_alert_logs_all": with_ctes(f"SELECT alert_type, log_id FROM members JOIN logs ON id = log_id WHERE logs.{_CLOSED}", _DAILY_ALERTS_CTE),
    "stream_deduplicate": with_ctes("SELECT id, ip, endpoint FROM logs"),
    "stream_scores": with_ctes("SELECT log_id, rule_score, final_score, severity, triggered_rules FROM scores", SCORES_CTE),
    "stream_scores_batches": with_ctes(
        f"SELECT log_id, rule_score, final_score, severity, triggered_rules FROM scores JOIN logs ON id = log_id WHERE {_CLOSED}", _DAILY_SCORES_CTE),
    "stream_scores_model": with_ctes(
        f"SELECT count(*) AS logs, count(*) AS same_score, count(*) AS same_rule_score, count(*) AS same_rules FROM logs WHERE {_CLOSED}"),
    "stream_alerts_panes": _windowed_sql(2, 1),
    "stream_metrics": with_ctes(
        "SELECT method, status, count(*) AS requests, strftime(max(timestamp), '%Y-%m-%d %H:%M:%S.%f') AS latest FROM logs GROUP BY 1, 2"),
}
