"""Per-request behavioural features.

Rows are shuffled twice, whatever the number of features: once to meet the table of address
moments (ip, time) and once to meet the table of endpoints (method, endpoint), and the second join
is broadcast by Spark when that table is small. Both tables are built by aggregation, so an address
or endpoint that holds a large part of all rows is combined on the map side and, being joined by
(ip, time), is spread over its moments. No window ever runs over the raw rows of one address.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from time import time_ns

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.columns import clip, floor_to, micros, off_hours
from tidewatch.functions.text import entropy
from tidewatch.operators.order_stats import quantiles
from tidewatch.schemas import FEATURES
from tidewatch.session import written

FIVE_MINUTES = 300
_BUCKET = FIVE_MINUTES * 1_000_000
_SECOND = 1_000_000
_KEPT = 59  # the row counter stops at 60
_MOMENT = ["ip", "bucket", "at"]


def filled_logs(logs: DataFrame, median_ms: float | None, as_of: Column | None = None) -> DataFrame:
    """Absent columns and nulls replaced by neutral values; response times by ``median_ms`` (0 if none)."""
    defaults = {
        "timestamp": F.current_timestamp() if as_of is None else as_of,
        "ip": F.lit("0.0.0.0"),
        "method": F.lit("UNKNOWN"),
        "endpoint": F.lit("/unknown"),
        "user_agent": F.lit("unknown"),
        "status": F.lit(0),
        "data": F.lit("{}"),
        "response_time_ms": F.lit(0.0 if median_ms is None else float(median_ms)),
    }
    columns = {}
    for name, value in defaults.items():
        present = F.col(name) if name in logs.columns else F.lit(None)
        if name == "status":
            present = present.try_cast("double").try_cast("int")
        elif name == "response_time_ms":
            present = F.nanvl(present.try_cast("double"), F.lit(None).cast("double"))
        elif name == "data":
            present = F.when(F.ltrim(present.cast("string")).startswith("{"), present.cast("string"))
        elif name != "timestamp":
            present = present.cast("string")
        columns[name] = F.coalesce(present, value)
    return logs.withColumns(columns)


def keyed(logs: DataFrame) -> DataFrame:
    """Add the microsecond ``at`` and the 5-minute ``bucket`` it falls into."""
    return logs.withColumn("at", micros("timestamp")).withColumn("bucket", floor_to(F.col("at"), _BUCKET))


def _before_bucket(buckets: DataFrame) -> DataFrame:
    """Add the address's last request time before each bucket."""
    in_order = W.partitionBy("ip").orderBy("bucket")
    return buckets.withColumn("_before_at", F.lag("_last_at").over(in_order)).drop("_last_at")


def ip_buckets(logs: DataFrame) -> DataFrame:
    """One row per (ip, 5 minutes): the bucket's own measures, the address's median request count per
    row, and the last request time before the bucket."""
    buckets = logs.groupBy("ip", "bucket").agg(
        F.count(F.lit(1)).alias("requests_per_ip_5min"),
        F.count_distinct("endpoint").alias("unique_endpoints_5min"),
        F.avg(F.when(F.col("status") >= 400, 1.0).otherwise(0.0)).alias("failed_requests_ratio_5min"),
        F.avg("response_time_ms").alias("avg_response_time_5min"),
        F.max("response_time_ms").alias("max_response_time_5min"),
        F.max("at").alias("_last_at"),
    )
    # A bucket with n requests stands for n rows of value n in the per-row median.
    median = F.expr("percentile(requests_per_ip_5min, 0.5D, requests_per_ip_5min) over (partition by ip)")
    return _before_bucket(buckets).withColumn("_ip_median", median)


def request_gaps(logs: DataFrame, buckets: DataFrame | None = None) -> DataFrame:
    """One row per (ip, time) with the seconds since the address's previous request (``_gap``).

    Requests of one address at the same microsecond are combined first and looked at second by second,
    so no window holds more than a million rows however busy an address is. The step from one second
    to the next comes from a table of the seconds' ends (at most 300 in a bucket), the step from one
    bucket to the next from the bucket table.
    """
    moments = logs.groupBy(*_MOMENT).agg(F.min("id").alias("_first_id"), F.count(F.lit(1)).alias("_rows"))
    moments = moments.withColumn("_second", floor_to(F.col("at"), _SECOND))
    ends = moments.groupBy("ip", "bucket", "_second").agg(F.max("at").alias("_end"))
    in_bucket = W.partitionBy("ip", "bucket").orderBy("_second")
    ends = ends.withColumn("_end_before", F.lag("_end").over(in_bucket)).drop("_end")
    if buckets is None:
        buckets = _before_bucket(logs.groupBy("ip", "bucket").agg(F.max("at").alias("_last_at")))
    previous = F.lag("at").over(W.partitionBy("ip", "bucket", "_second").orderBy("at"))
    return (
        moments.withColumn("_previous_at", previous)
        .join(ends, ["ip", "bucket", "_second"])
        .join(buckets, ["ip", "bucket"])
        .withColumn("_gap", (F.col("at") - F.coalesce("_previous_at", "_end_before", "_before_at")) / 1_000_000)
        .drop("_previous_at", "_end_before", "_before_at", "_second")
    )


def weighted_gaps(moments: DataFrame) -> DataFrame:
    """(gap, weight): the gaps of all rows; rows tied with an earlier one have gap 0."""
    both = F.array(
        F.struct(F.col("_gap").alias("gap"), F.lit(1).cast("bigint").alias("weight")),
        F.struct(F.lit(0.0).alias("gap"), (F.col("_rows") - 1).alias("weight")),
    )
    return moments.select(F.inline(both)).filter("gap is not null and weight > 0")


def first_rows(logs: DataFrame) -> DataFrame:
    """The first 59 rows of each address, listed per moment: (ip, bucket, at, _first_ids, _first_rank).

    Spark cuts to 59 rows per address on the map side, before the shuffle.
    """
    order = W.partitionBy("ip").orderBy("at", "id")
    return (
        logs.select(*_MOMENT, "id", F.row_number().over(order).alias("rank"))
        .filter(F.col("rank") <= _KEPT)
        .groupBy(*_MOMENT)
        .agg(F.sort_array(F.collect_list("id")).alias("_first_ids"), F.min("rank").alias("_first_rank"))
    )


def rows_so_far() -> Column:
    """Rows of the address up to this one, at most 60, from the columns of ``first_rows``."""
    tied = F.array_position("_first_ids", F.col("id"))
    return F.when(tied > 0, F.col("_first_rank") + tied - 1).otherwise(60).cast("double")


def ip_moments(logs: DataFrame, gaps: DataFrame | None = None) -> DataFrame:
    """Everything the features take from a row's address and time, one row per (ip, time); ``gaps`` are those of ``request_gaps``, if known."""
    buckets = ip_buckets(logs)
    if gaps is None:
        gaps = request_gaps(logs, buckets)
    else:
        gaps = gaps.join(buckets.drop("_before_at"), ["ip", "bucket"])
    return gaps.join(first_rows(logs), _MOMENT, "left")


def endpoint_profiles(logs: DataFrame) -> DataFrame:
    """One row per (method, endpoint): response-time mean and deviation, usual hour, counts, entropy.

    Counts and the usual hour come from one table of at most 24 rows per (method, endpoint).
    """
    times = logs.groupBy("endpoint").agg(
        F.avg("response_time_ms").alias("_endpoint_mean"),
        F.stddev_samp("response_time_ms").alias("_endpoint_std"),
    )
    hourly = logs.groupBy("endpoint", "method", F.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    pairs = hourly.groupBy("endpoint", "method").agg(F.sum("n").alias("_pair_rows"))
    whole = hourly.groupBy("endpoint").agg(
        F.sum("n").alias("_endpoint_rows"), F.expr("percentile(hour, 0.5D, n)").alias("_endpoint_hour")
    )
    per_endpoint = times.join(whole, "endpoint").withColumn("endpoint_entropy", entropy(F.col("endpoint")))
    return pairs.join(per_endpoint, "endpoint")


@dataclass(frozen=True)
class Baselines:
    """The five numbers taken over all rows. A batch computes and keeps them; a stream reuses them."""

    rows: int
    median_ms: float | None
    mean_ms: float | None
    std_ms: float | None
    median_gap: float | None


def baselines(logs: DataFrame, as_of: Column | None = None) -> Baselines:
    """Compute the whole-input statistics; each is one distributed aggregation to a single row."""
    return _baselines_and_gaps(logs, as_of, keep=False)[0]


def _baselines_and_gaps(logs: DataFrame, as_of: Column | None, keep: bool = True) -> tuple[Baselines, DataFrame]:
    """The whole-input statistics and the table of ``request_gaps``, which is written if it is to be read again."""
    time = F.col("response_time_ms") if "response_time_ms" in logs.columns else F.lit(None)
    times = logs.select(time.try_cast("double").alias("ms")).filter(~F.isnan("ms"))
    median = quantiles(times, "ms", [0.5]).first()
    median_ms = median["quantile"] if median else None
    rows = keyed(filled_logs(logs, median_ms, as_of))
    overall = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("response_time_ms").alias("mean"),
        F.stddev_samp("response_time_ms").alias("std"),
    ).first()
    gaps = request_gaps(rows)
    if keep:
        gaps = written(gaps, "gaps")
    gap = quantiles(weighted_gaps(gaps), "gap", [0.5], weight="weight").first()
    return Baselines(overall["rows"], median_ms, overall["mean"], overall["std"], gap["quantile"] if gap else None), gaps


def request_features() -> dict[str, Column]:
    """Features that need nothing but the row itself."""
    endpoint = F.col("endpoint")
    has_query = F.contains(endpoint, F.lit("?")).cast("double")
    ampersands = (F.length(endpoint) - F.length(F.replace(endpoint, F.lit("&"), F.lit("")))).cast("double")
    hour = F.hour("timestamp")
    return {
        "status_code": F.col("status").cast("double"),
        "response_time_ms": F.col("response_time_ms").cast("double"),
        "hour_of_day": hour.cast("double"),
        "day_of_week": F.weekday("timestamp").cast("double"),
        "is_night": off_hours(hour).cast("double"),
        "endpoint_length": F.length(endpoint).cast("double"),
        "has_query_params": has_query,
        "query_param_count": ampersands + has_query,
        "response_time_log": F.log1p(F.col("response_time_ms").cast("double")),
    }


def address_features(base: Baselines) -> dict[str, Column]:
    """Features over the columns of ``ip_moments``."""
    requests = F.col("requests_per_ip_5min").cast("double")
    median = F.when(F.col("_ip_median") == 0, 1.0).otherwise(F.col("_ip_median"))
    first_gap = F.lit(base.median_gap).cast("double")
    gap = F.when(F.col("id") == F.col("_first_id"), F.coalesce("_gap", first_gap, F.lit(999999.0))).otherwise(0.0)
    return {
        "requests_per_ip_5min": requests,
        "unique_endpoints_5min": F.col("unique_endpoints_5min").cast("double"),
        "failed_requests_ratio_5min": F.col("failed_requests_ratio_5min"),
        "avg_response_time_5min": F.col("avg_response_time_5min"),
        "max_response_time_5min": F.col("max_response_time_5min"),
        "request_rate_5min": requests / FIVE_MINUTES,
        "time_since_last_request": gap,
        "requests_per_minute": rows_so_far(),
        "requests_vs_ip_baseline_ratio": clip(requests / median, 0, 50),
        "error_burst_score": clip(F.col("failed_requests_ratio_5min") * requests, 0, 1000),
    }


def endpoint_features(base: Baselines) -> dict[str, Column]:
    """Features over the columns of ``endpoint_profiles`` and the global response times."""
    overall_std = F.lit(1.0 if base.std_ms == 0 else base.std_ms).cast("double")
    endpoint_std = F.coalesce(F.nullif("_endpoint_std", F.lit(0.0)), overall_std)
    time, total = F.col("response_time_ms"), float(base.rows)
    hours_off = F.abs(F.hour("timestamp") - F.col("_endpoint_hour"))
    return {
        "endpoint_entropy": F.col("endpoint_entropy"),
        "response_time_zscore_global": clip((time - F.lit(base.mean_ms).cast("double")) / overall_std, -10, 10),
        "response_time_zscore_endpoint": clip((time - F.col("_endpoint_mean")) / endpoint_std, -10, 10),
        "endpoint_rarity": 1.0 - F.col("_endpoint_rows") / total,
        "method_endpoint_rarity": 1.0 - F.col("_pair_rows") / total,
        "hour_deviation_from_endpoint_pattern": clip(F.coalesce(hours_off, F.lit(0.0)), 0, 12),
    }


def extract_features(
    logs: DataFrame,
    base: Baselines | None = None,
    as_of: Column | None = None,
    context: DataFrame | None = None,
) -> DataFrame:
    """All features of each log row: log_id, timestamp, data and the columns of FEATURES.

    ``context`` gives further rows that count for the address and endpoint statistics but get no
    features themselves: the stored look-back of a stream.
    """
    names = ["id", "timestamp", "ip", "method", "endpoint", "status", "response_time_ms", "data"]
    if context is not None:
        context = context.join(logs.select("id"), "id", "left_anti").select(*names)
    gaps = None
    if base is None:
        every = logs if context is None else logs.select(*names).unionByName(context)
        if as_of is None:
            # Missing times are filled by one present moment, the same in the written gaps and in the rows that meet them.
            as_of = F.timestamp_micros(F.lit(time_ns() // 1000))
            base, gaps = _baselines_and_gaps(every, as_of)
        else:
            base = baselines(every, as_of)
    rows = keyed(filled_logs(logs, base.median_ms, as_of)).select(*names, "at", "bucket")
    seen = rows
    if context is not None:
        seen = rows.unionByName(keyed(filled_logs(context, base.median_ms, as_of)).select(rows.columns))

    joined = rows.join(ip_moments(seen, gaps), _MOMENT).join(endpoint_profiles(seen), ["method", "endpoint"])
    derived = {**request_features(), **address_features(base), **endpoint_features(base)}
    return joined.select(
        F.col("id").alias("log_id"), "timestamp", "data", *[derived[name].alias(name) for name in FEATURES]
    )


@dataclass(frozen=True)
class Profiles:
    """What a stream needs of the whole history, stored by a batch: its five numbers, and tables of addresses and endpoints.

    addresses: (ip, _ip_median); endpoints and pairs: the columns of ``endpoint_profiles`` by endpoint and by (endpoint, method).
    """

    base: Baselines
    addresses: DataFrame
    endpoints: DataFrame
    pairs: DataFrame


def store_profiles(logs: DataFrame, folder: str, as_of: Column | None = None) -> Baselines:
    """Compute the profiles of all logs and write them below ``folder``, replacing older ones."""
    base = baselines(logs, as_of)
    rows = keyed(filled_logs(logs, base.median_ms, as_of))
    counts = rows.groupBy("ip", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts.groupBy("ip").agg(F.expr("percentile(n, 0.5D, n)").alias("_ip_median")).write.mode("overwrite").parquet(f"{folder}/addresses")
    both = endpoint_profiles(rows)
    both.select("endpoint", "method", "_pair_rows").write.mode("overwrite").parquet(f"{folder}/pairs")
    whole = [c for c in both.columns if c not in ("endpoint", "method", "_pair_rows")]
    both.groupBy("endpoint").agg(*[F.any_value(c).alias(c) for c in whole]).write.mode("overwrite").parquet(f"{folder}/endpoints")
    logs.sparkSession.createDataFrame([(json.dumps(asdict(base)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/numbers")
    return base


def load_profiles(spark: SparkSession, folder: str) -> Profiles:
    base = Baselines(**json.loads(spark.read.text(f"{folder}/numbers").first()["value"]))
    return Profiles(base, *[spark.read.parquet(f"{folder}/{name}") for name in ("addresses", "endpoints", "pairs")])


def address_state(rows: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(ip, last_at, rows): an address's newest request and its requests so far, counted up to 60; of the addresses in ``rows``."""
    now = keyed(rows).groupBy("ip").agg(F.max("at").alias("last_at"), F.count(F.lit(1)).alias("rows"))
    if before is not None:
        known = before.select("ip", F.col("last_at").alias("_last"), F.col("rows").alias("_rows"))
        now = now.join(known, "ip", "left").select("ip", F.greatest("last_at", "_last").alias("last_at"), (F.col("rows") + F.coalesce("_rows", F.lit(0))).alias("rows"))
    return now.withColumn("rows", F.least("rows", F.lit(_KEPT + 1)))


def extract_later_features(logs: DataFrame, profiles: Profiles, state: DataFrame | None = None) -> DataFrame:
    """The features of ``extract_features`` for logs that come after those of ``state`` and fill whole 5-minute buckets.

    No older log is read: an address's newest request and its count come from ``state``, everything else that is older
    from ``profiles``. Addresses and endpoints that the profiles lack are ordinary for themselves and as rare as can be.
    """
    names = ["id", "timestamp", "ip", "method", "endpoint", "status", "response_time_ms", "data"]
    rows = keyed(filled_logs(logs, profiles.base.median_ms)).select(*names, "at", "bucket")
    buckets = ip_buckets(rows).drop("_ip_median").join(profiles.addresses, "ip", "left")
    buckets = buckets.withColumn("_ip_median", F.coalesce("_ip_median", F.col("requests_per_ip_5min").cast("double")))
    if state is None:
        buckets = buckets.withColumn("_rows_before", F.lit(0))
    else:
        known = state.select("ip", "last_at", F.col("rows").alias("_rows_before"))
        buckets = buckets.join(known, "ip", "left").withColumns({
            "_before_at": F.coalesce("_before_at", F.when(F.col("last_at") < F.col("bucket"), F.col("last_at"))), "_rows_before": F.coalesce("_rows_before", F.lit(0)),
        }).drop("last_at")
    moments = request_gaps(rows, buckets).join(first_rows(rows), _MOMENT, "left")
    joined = rows.join(moments, _MOMENT).join(profiles.endpoints, "endpoint", "left").join(profiles.pairs, ["endpoint", "method"], "left")
    joined = joined.withColumns({
        "endpoint_entropy": F.coalesce("endpoint_entropy", entropy(F.col("endpoint"))),
        "_endpoint_mean": F.coalesce("_endpoint_mean", "response_time_ms"),
        "_endpoint_rows": F.coalesce("_endpoint_rows", F.lit(0)), "_pair_rows": F.coalesce("_pair_rows", F.lit(0)),
    })
    derived = {**request_features(), **address_features(profiles.base), **endpoint_features(profiles.base)}
    derived["requests_per_minute"] = F.least(derived["requests_per_minute"] + F.col("_rows_before"), F.lit(_KEPT + 1.0))
    return joined.select(F.col("id").alias("log_id"), "timestamp", "data", *[derived[name].alias(name) for name in FEATURES])


def isolation_features(columns: list[str]) -> list[str]:
    """The feature columns present, in report order."""
    return [name for name in FEATURES if name in columns]
