"""Streaming jobs: ingestion, duplicate removal, windowed rules, incremental scoring, metrics.

All jobs take their checkpoint folder from the caller, which keeps it on shared storage; progress
lives there, so a restarted job goes on where it stopped. ``every`` is a processing interval such as
"15 seconds"; without it a job handles what is there and ends.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewatch.functions.columns import micros
from tidewatch.operators import rules as R
from tidewatch.operators import scoring as S
from tidewatch.operators.features import FIVE_MINUTES, Baselines, Profiles, address_state, extract_features, extract_later_features, filled_logs
from tidewatch.operators.forest import isolation_decision, load_isolation
from tidewatch.session import discard, scratch, written
from tidewatch.sources import lines as L
from tidewatch.sources import tables as T
from tidewatch.streaming.state import KeyedState, batches, newest_before

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """New text files of a folder, line by line; for files that grow see ``sources.tail.tail_lines``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def _id_before(spark: SparkSession, table: str, number: int) -> int:
    """The largest id of the batches before this one; ids rise with batches, so only the newest is read."""
    if not T.exists(spark, table):
        return 0
    before = spark.read.parquet(table).filter(F.col("batch") < number)
    newest = before.agg(F.max("batch")).first()[0]
    return 0 if newest is None else before.filter(F.col("batch") == newest).agg(F.max("id")).first()[0]


def store_lines(batch: DataFrame, number: int, table: str, log_format: str = "json") -> None:
    """One batch of lines: log rows to ``table``, lines that could not be parsed to ``table``_failed, and counts to ``table``_report.

    Each goes to the batch's own folder and replaces it when the batch is repeated after a failure, so no line is stored twice.
    """
    spark = batch.sparkSession
    with scratch(spark):
        parsed = written(L.parse_lines(batch, log_format), "batch")
        rows = L.with_ids(L.normalised(parsed), _id_before(spark, table, number)).withColumn("date", F.to_date("timestamp"))
        rows.write.mode("overwrite").partitionBy("date").parquet(f"{table}/batch={number}")
        L.failed_lines(parsed).write.mode("overwrite").parquet(f"{table}_failed/batch={number}")
        L.ingestion_report(parsed).write.mode("overwrite").parquet(f"{table}_report/batch={number}")


def ingest(
    lines: DataFrame, table: str, checkpoint: str, log_format: str = "json", every: str | None = None
) -> StreamingQuery:
    """Parse lines and store them as log rows with ids that rise from batch to batch; failed lines are kept and counted."""
    def store(batch: DataFrame, number: int) -> None:
        store_lines(batch, number, table, log_format)

    return _start(lines.writeStream.foreachBatch(store), checkpoint, every)


def deduplicated(logs: DataFrame, delay: str = "10 minutes", name: str = "timestamp") -> DataFrame:
    """Each id once, as long as its copies are not further apart than ``delay``; state stays bounded."""
    return logs.withWatermark(name, delay).dropDuplicatesWithinWatermark(["id"])


def windowed_alerts(
    logs: DataFrame,
    window: str = "60 seconds",
    slide: str | None = None,
    delay: str = "10 seconds",
    rules: Sequence[R.Rule] = tuple(R.RULES),
) -> DataFrame:
    """Alerts per sliding window of a log stream, once the watermark has passed the window.

    Distinct endpoints are counted by two aggregations in a row: per endpoint, then per group; the
    state holds one small row per (window, group, endpoint), never a list.
    """
    rows = R.tagged(logs.withWatermark("timestamp", delay), rules)
    span = F.window("timestamp", window, slide or window)
    per_endpoint = rows.groupBy(span.alias("window"), *R.GROUP, "endpoint").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.sum("response_time_ms").alias("total_ms"),
        F.count("response_time_ms").alias("timed"),
        F.expr("bit_or(shiftleft(1, hour(timestamp)))").alias("hour_mask"),
    )
    return _endpoints_to_alerts(per_endpoint, window, rules)


def pane_alerts(
    logs: DataFrame, window: str = "60 seconds", slide: str = "30 seconds", delay: str = "10 seconds", rules: Sequence[R.Rule] = tuple(R.RULES)
) -> DataFrame:
    """The alerts of ``windowed_alerts`` for overlapping windows, each row being aggregated once and not once per window.

    Rows are first combined in panes, as long as the slide; a window, which must be a multiple of it, is the sum of its panes. A
    row of a pane's table stands for all its requests of one group and endpoint, and only those rows are copied to the windows.
    """
    size, step = (int(n) * _UNIT_SECONDS[u.rstrip("s")] for n, _, u in (x.partition(" ") for x in (window, slide)))
    if size % step:
        raise ValueError(f"a window of {window} is not a multiple of a slide of {slide}")
    rows = R.tagged(logs.withWatermark("timestamp", delay), rules)
    panes = rows.groupBy(F.window("timestamp", slide).alias("pane"), *R.GROUP, "endpoint").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
        F.sum("response_time_ms").alias("total_ms"),
        F.count("response_time_ms").alias("timed"),
        F.expr("bit_or(shiftleft(1, hour(timestamp)))").alias("hour_mask"),
    )
    per_endpoint = panes.groupBy(F.window(F.window_time("pane"), window, slide).alias("window"), *R.GROUP, "endpoint").agg(
        F.sum("n").alias("n"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("total_ms").alias("total_ms"),
        F.sum("timed").alias("timed"),
        F.bit_or("hour_mask").alias("hour_mask"),
    )
    return _endpoints_to_alerts(per_endpoint, window, rules)


def _endpoints_to_alerts(per_endpoint: DataFrame, window: str, rules: Sequence[R.Rule]) -> DataFrame:
    groups = per_endpoint.groupBy("window", *R.GROUP).agg(
        F.sum("n").alias("requests"),
        F.count("endpoint").alias("unique_endpoints"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("timestamp"),
        F.try_divide(F.sum("total_ms"), F.sum("timed")).alias("average_response_ms"),
        F.bit_or("hour_mask").alias("hour_mask"),
    )
    return R.to_alerts(groups, window, rules, ["window"]).withColumns({
        "window_start": F.col("window.start"), "window_end": F.col("window.end")
    }).drop("window")


def windowed_alert_logs(
    logs: DataFrame, alerts: DataFrame, window: str = "60 seconds", slide: str | None = None,
    rules: Sequence[R.Rule] = tuple(R.RULES),
) -> DataFrame:
    """The stored logs behind windowed alerts: (alert_id, alert_type, severity, log_id, timestamp)."""
    span = F.window("timestamp", window, slide or window)
    rows = R.tagged(logs, rules).select(
        *R.GROUP, F.col("id").alias("log_id"), F.col("timestamp"), span.getField("start").alias("window_start"))
    heads = alerts.select("alert_id", "severity", *[F.col(c).alias(f"_{c}") for c in ["window_start", *R.GROUP]])
    same = (rows["alert_type"] == heads["_alert_type"]) & (rows["window_start"] == heads["_window_start"])
    for key in R.GROUP[1:]:
        same = same & rows[key].eqNullSafe(heads[f"_{key}"])
    return rows.join(heads, same).select("alert_id", "alert_type", "severity", "log_id", "timestamp")


def store_alerts(alerts: DataFrame, table: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append finished windows to a file table, exactly once."""
    return _start(alerts.writeStream.format("parquet").outputMode("append").option("path", table), checkpoint, every)


def score(
    logs: DataFrame,
    table: str,
    checkpoint: str,
    decide: Callable[[DataFrame], DataFrame],
    members: Callable[[DataFrame], DataFrame],
    base: Baselines,
    context: Callable[[], DataFrame] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Score new logs as they come; a log keeps the first score it got.

    Features are taken over the batch and the stored look-back of ``context``, with the stored
    whole-history numbers of ``base``, so they do not depend on how the stream is cut into batches.
    Rule evidence does depend on it: ``members`` sees one batch only.
    """
    def handle(batch: DataFrame, number: int) -> None:
        seen = context() if context is not None else None
        features = extract_features(batch, base, context=seen)
        T.append_first_scores(S.hybrid_scores(decide(features), members(batch)), table)

    return _start(logs.writeStream.foreachBatch(handle), checkpoint, every)


def _closing_unit(window: str) -> int:
    """Seconds of the spans in which a log gets its score: whole feature buckets and whole rule windows."""
    count, _, unit = window.partition(" ")
    return math.lcm(FIVE_MINUTES, int(count) * _UNIT_SECONDS[unit.rstrip("s")])


def window_alerts(logs: DataFrame, window: str, rules: Sequence[R.Rule] = tuple(R.RULES)) -> DataFrame:
    """The alerts of ``windowed_alerts`` in tumbling windows, for logs that are there."""
    rows = R.tagged(logs, rules).withColumn("window", F.window("timestamp", window))
    return R.to_alerts(R.alert_groups(rows, ["window"]), window, rules, ["window"]).withColumns({
        "window_start": F.col("window.start"), "window_end": F.col("window.end")
    }).drop("window")


def _advance(spark: SparkSession, store: str, number: int, batch: DataFrame, delay: int, unit: int) -> tuple[DataFrame, int | None]:
    """All logs without a score before this batch, and the time up to which it closes (none without any log)."""
    last = newest_before(spark, f"{store}/progress", number)
    waiting, newest, closed = batch, None, None
    if last is not None:
        waiting = batch.unionByName(spark.read.schema(batch.schema).parquet(f"{store}/waiting/batch={last}"))
        newest, closed = spark.read.parquet(f"{store}/progress/batch={last}").first()
    rows = written(waiting, "waiting")
    now = rows.agg(F.max(micros("timestamp"))).first()[0]
    newest = max((x for x in (newest, now) if x is not None), default=None)
    if newest is not None:
        reached = newest - delay * 1_000_000
        closed = max(closed if closed is not None else reached - reached % unit, reached - reached % unit)
    kept = rows if closed is None else rows.filter(micros("timestamp") >= closed)  # a log without a time never waits
    kept.write.mode("overwrite").parquet(f"{store}/waiting/batch={number}")
    spark.createDataFrame([(newest, closed)], "newest long, closed long").coalesce(1).write.mode("overwrite").parquet(f"{store}/progress/batch={number}")
    for name in ("waiting", "progress"):
        for old in [n for n in batches(spark, f"{store}/{name}") if n < number][:-1]:
            discard(spark, f"{store}/{name}/batch={old}")
    return rows, closed


def score_closed(
    logs: DataFrame,
    store: str,
    checkpoint: str,
    decide: Callable[[DataFrame], DataFrame],
    profiles: Profiles,
    window: str = "5 minutes",
    delay: str = "10 minutes",
    rules: Sequence[R.Rule] = tuple(R.RULES),
    every: str | None = None,
    whole_every: int = 16,
) -> StreamingQuery:
    """Score the logs of a stream as soon as their 5-minute bucket and rule window have closed, whatever batches they came in.

    A log waits until the newest time seen is ``delay`` beyond the span that holds it; the logs of open spans are all that is kept of
    the stream, besides one small row per address. So features and rule evidence are those of the whole bucket and the whole window, bursts over
    several batches included, and no look-back is read again. A log that comes later than that is scored with what comes with it. The
    first score of a log stays. ``store`` gets the tables scores and alerts; ``decide`` maps features to (log_id, decision), see ``model_decisions``.
    """
    spark, unit = logs.sparkSession, _closing_unit(window) * 1_000_000
    count, _, name = delay.partition(" ")
    seconds = int(count) * _UNIT_SECONDS[name.rstrip("s")]
    addresses = KeyedState(spark, f"{store}/addresses", ["ip"], whole_every)

    def handle(batch: DataFrame, number: int) -> None:
        with scratch(spark):
            rows, closed = _advance(spark, store, number, batch, seconds, unit)
            if closed is None or (ready := rows.filter(F.coalesce(micros("timestamp") < closed, F.lit(True)))).isEmpty():
                return
            before = addresses.before(number)
            features = extract_later_features(ready, profiles, before)
            alerts = written(window_alerts(ready, window, rules), "window-alerts")
            alerts.write.mode("overwrite").parquet(f"{store}/alerts/batch={number}")
            members = windowed_alert_logs(ready, alerts, window, None, rules)
            T.append_first_scores(S.hybrid_scores(decide(features), members), f"{store}/scores")
            filled = filled_logs(ready, profiles.base.median_ms)
            addresses.write(number, address_state(filled, before))

    return _start(logs.writeStream.foreachBatch(handle), checkpoint, every)


def model_decisions(spark: SparkSession, folder: str) -> Callable[[DataFrame], DataFrame]:
    """Decisions of a stored isolation forest; missing features count as 0, as in production."""
    model = load_isolation(spark, folder)
    return lambda features: isolation_decision(features, model, missing="zero").select("log_id", "decision")


def status_metrics(logs: DataFrame) -> DataFrame:
    """Running request counts by method and status: a handful of rows of state."""
    return logs.groupBy("method", "status").agg(
        F.count(F.lit(1)).alias("requests"), F.max("timestamp").alias("latest")
    )


def publish_metrics(metrics: DataFrame, table: str, checkpoint: str, every: str | None = "15 seconds") -> StreamingQuery:
    """Rewrite the small metrics table with every refresh."""
    def publish(batch: DataFrame, number: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(table)

    return _start(metrics.writeStream.outputMode("complete").foreachBatch(publish), checkpoint, every)
