"""Service levels computed from the log, alert and score tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.columns import floor_to, micros
from tidewatch.operators.order_stats import quantiles
from tidewatch.operators.ordered import previous, running_sum
from tidewatch.session import written

FIVE_MINUTES = 300
HOUR = 3600
DAY = 86400

# Duration bounds in seconds, availability target, alarm limits and hold times.
DURATION_BOUNDS = [0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 2.5]
AVAILABILITY_TARGET = 0.995
ALERT_LIMIT = 25
F1_TARGET = 0.75
FRESHNESS_LIMIT = 300
HOLD_MINUTES = {"high_alert_rate": 5, "no_logs_processed": 10, "model_f1_low": 5, "data_freshness_high": 10}


def window_start(seconds: int, name: str = "timestamp") -> Column:
    """Start of the tumbling window as epoch seconds."""
    return floor_to(F.floor(micros(name) / 1_000_000).cast("bigint"), seconds)


def snapshot(logs: DataFrame, as_of: Column) -> DataFrame:
    """Processed logs and data freshness in seconds (0 without logs)."""
    age = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))
    return logs.agg(F.count(F.lit(1)).alias("logs_processed"), F.max("timestamp").alias("newest")).select(
        "logs_processed", F.coalesce(age / 1_000_000, F.lit(0.0)).alias("freshness_seconds")
    )


def request_rate(logs: DataFrame, seconds: int = FIVE_MINUTES) -> DataFrame:
    """Requests per second by method and status, per window."""
    return logs.groupBy(window_start(seconds).alias("window_start"), "method", "status").agg(
        (F.count(F.lit(1)) / seconds).alias("per_second")
    )


def error_rate(logs: DataFrame, seconds: int = FIVE_MINUTES) -> DataFrame:
    """4xx and 5xx responses per second, per window with requests."""
    status = F.col("status")
    return logs.groupBy(window_start(seconds).alias("window_start")).agg(
        (F.count_if((status >= 400) & (status < 500)) / seconds).alias("rate_4xx"),
        (F.count_if((status >= 500) & (status < 600)) / seconds).alias("rate_5xx"),
    )


def latency_quantile(logs: DataFrame, prob: float = 0.95, seconds: int = FIVE_MINUTES) -> DataFrame:
    """Exact response-time quantile per window."""
    rows = logs.select(window_start(seconds).alias("window_start"), "response_time_ms")
    return quantiles(rows, "response_time_ms", [prob], by=["window_start"]).select(
        "window_start", F.col("quantile").alias("latency_ms")
    )


def duration_histogram(logs: DataFrame, by: Sequence[str] = (), bounds: Sequence[float] = tuple(DURATION_BOUNDS)) -> DataFrame:
    """(by..., position, bound, observations): cumulative counts up to each bound, last one unbounded (null)."""
    seconds = F.col("response_time_ms") / 1000
    counts = [F.count_if(seconds <= b).alias(f"b{i}") for i, b in enumerate(bounds)]
    last = len(bounds)
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            (F.lit(float(bounds[i])) if i < last else F.lit(None).cast("double")).alias("bound"),
            F.col(f"b{i}").alias("observations"),
        )
        for i in range(last + 1)
    ])
    return logs.groupBy(*by).agg(*counts, F.count("response_time_ms").alias(f"b{last}")).select(*by, F.inline(rows))


def histogram_quantile(histogram: DataFrame, prob: float = 0.95, by: Sequence[str] = ()) -> DataFrame:
    """Quantile read from cumulative bounds, linear inside the bound it falls into.

    A rank past the last finite bound gives that bound.
    """
    in_order = W.partitionBy(*by).orderBy("position")
    rank = F.lit(float(prob)) * F.max("observations").over(W.partitionBy(*by))
    steps = histogram.withColumns({
        "rank": rank,
        "lower": F.coalesce(F.lag("bound").over(in_order), F.lit(0.0)),
        "below": F.coalesce(F.lag("observations").over(in_order), F.lit(0)),
    }).filter(F.col("observations") >= F.col("rank"))
    inside = F.col("lower") + (F.col("bound") - F.col("lower")) * F.coalesce(
        F.try_divide(F.col("rank") - F.col("below"), (F.col("observations") - F.col("below")).cast("double")), F.lit(0.0)
    )
    value = F.when(F.col("bound").isNull(), F.col("lower")).otherwise(inside)
    return steps.groupBy(*by).agg(F.min_by(value, "position").alias("seconds"))


def anomaly_share(scores: DataFrame) -> DataFrame:
    anomalies, total = F.count_if("is_anomaly"), F.count(F.lit(1))
    return scores.agg((anomalies / F.greatest(total, F.lit(1))).alias("anomaly_share"))


def alert_velocity(alerts: DataFrame, by: str = "alert_type", seconds: int = FIVE_MINUTES) -> DataFrame:
    """Alerts and alerts per second by type or severity, per window."""
    count = F.count(F.lit(1))
    return alerts.groupBy(window_start(seconds).alias("window_start"), by).agg(
        count.alias("increase"), (count / seconds).alias("per_second")
    )


def availability(logs: DataFrame, target: float = AVAILABILITY_TARGET, seconds: int = HOUR) -> DataFrame:
    """Share of requests not answered by a server error, per hour with requests."""
    good = F.avg(F.when(F.col("status") >= 500, 0.0).otherwise(1.0))
    return (
        logs.groupBy(window_start(seconds).alias("window_start")).agg(good.alias("availability"))
        .withColumn("target_met", F.col("availability") >= target)
    )


def trailing_increase(alerts: DataFrame, by: str = "alert_type", seconds: int = HOUR, step: int = FIVE_MINUTES) -> DataFrame:
    """(at, by, increase): at every step, the alerts of the ``seconds`` up to it; steps without any are left out.

    An alert counts from the first step at or after it until its age passes ``seconds``: the increase is a running sum of
    arrivals and departures, so it changes at these times alone and nothing is counted once per step.
    """
    if seconds % step:
        raise ValueError(f"a span of {seconds} seconds is not a multiple of a step of {step}")
    second = F.ceil(micros("timestamp") / (step * 1_000_000)).cast("bigint") * step
    arrived = written(alerts.groupBy(second.alias("at"), by).agg(F.count(F.lit(1)).alias("n")), "arrivals")
    left = arrived.select((F.col("at") + seconds).alias("at"), by, (-F.col("n")).alias("n"))
    changes = arrived.unionByName(left).groupBy("at", by).agg(F.sum("n").alias("n"))
    sums = written(running_sum(changes, "at", "n", "increase", [by]), "increases")
    spans = previous(sums, "at", ["at", "increase"], [by])
    steps = F.sequence(F.col("before.at"), F.col("at") - step, F.lit(step).cast("bigint"))
    return spans.filter("before.increase > 0").select(F.explode(steps).alias("at"), by, F.col("before.increase").alias("increase"))


def _runs(changes: DataFrame, start: Column, end: Column) -> DataFrame:
    """(pending_since, last_active) in minutes from the minutes at which a condition may change: (minute, active).

    Only changes of the state are kept, so each end follows its start; a run that is still open ends with ``end``.
    """
    inside = changes.filter((F.col("minute") >= start) & (F.col("minute") <= end))
    closing = inside.limit(1).select((end + 60).alias("minute"), F.lit(False).alias("active"))
    states = previous(inside.unionByName(closing), "minute", ["active"])
    switched = written(states.filter(F.col("active") != F.coalesce("before.active", F.lit(False))).drop("before"), "switches")
    paired = previous(switched, "minute", ["minute"])
    return paired.filter(~F.col("active")).select(F.col("before.minute").alias("pending_since"), (F.col("minute") - 60).alias("last_active"))


def alarms(logs: DataFrame, alerts: DataFrame, quality: DataFrame, alert_limit: int = ALERT_LIMIT) -> DataFrame:
    """Alarm episodes: a condition, judged at the end of every minute from the first log to the last, that stayed true for its hold time.

    (alarm, pending_since, firing_since, last_active) in epoch seconds of the minutes. ``quality`` holds (timestamp, value). A condition
    changes only where a log, an alert or a value arrives or grows old, so what is looked at is as long as these minutes, not
    as the time between them: one log from 1970 adds one row.
    """
    minute = window_start(60).alias("minute")
    # Tables of minutes are read several times, so they are written once; logs, alerts and values are read once each.
    per_log = written(logs.groupBy(minute).agg(F.max(micros("timestamp")).alias("newest")), "minutes-with-logs")
    ends = per_log.agg(F.min("minute").alias("a"), F.max("minute").alias("b"))
    start, end = ends.select("a").scalar(), ends.select("b").scalar()

    # Between two minutes with logs: silent from the 15th minute on, stale from the limit on.
    gaps = previous(per_log, "minute", ["minute", "newest"]).filter("before is not null")
    stale = (F.floor((F.col("before.newest") + (FRESHNESS_LIMIT - 60) * 1_000_000) / 60_000_000) * 60 + 60).cast("bigint")
    last = (F.col("minute") - 60).alias("last_active")
    silent = gaps.select((F.col("before.minute") + 15 * 60).alias("pending_since"), last)
    stale = gaps.select(F.greatest("before.minute", stale).alias("pending_since"), last)

    arrived = written(alerts.groupBy(minute).agg(F.count(F.lit(1)).alias("n")), "minutes-with-alerts")
    arrived = arrived.filter((F.col("minute") >= start) & (F.col("minute") <= end))
    gone = arrived.select((F.col("minute") + 600).alias("minute"), (-F.col("n")).alias("n"))
    counts = written(running_sum(arrived.unionByName(gone).groupBy("minute").agg(F.sum("n").alias("n")), "minute", "n", "alerts"), "alert-counts")
    many = _runs(counts.select("minute", (F.col("alerts") > alert_limit).alias("active")), start, end)

    value = F.max_by("value", "timestamp")  # the last one of a minute
    values = written(quality.groupBy(minute).agg(value.alias("f1")).filter("f1 is not null"), "minutes-with-values")
    low = _runs(values.select("minute", ((F.col("f1") > 0) & (F.col("f1") < F1_TARGET)).alias("active")), start, end)

    runs = {"high_alert_rate": many, "no_logs_processed": silent, "model_f1_low": low, "data_freshness_high": stale}
    named = [df.withColumns({"alarm": F.lit(name), "hold": F.lit(HOLD_MINUTES[name] * 60)}) for name, df in runs.items()]
    return (
        reduce(DataFrame.unionByName, named)
        .withColumn("firing_since", F.col("pending_since") + F.col("hold"))
        .filter(F.col("last_active") >= F.col("firing_since"))
        .select("alarm", "pending_since", "firing_since", "last_active")
    )
