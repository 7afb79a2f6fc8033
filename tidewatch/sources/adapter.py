"""The ``events`` table seen as web requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def requests(events: DataFrame) -> DataFrame:
    """Access-log columns of event rows. ``k`` is read from the JSON once, in its own projection."""
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).select(*_request_columns())


def _request_columns() -> list[Column]:
    kind, user = F.col("event_type"), F.col("user_id")
    k = F.col("k")
    part = k % 10
    probe = (
        F.when(part == 0, "/search?q=' UNION SELECT * FROM users --")
        .when(part == 1, "/../../etc/passwd")
        .when(part == 2, "/proc/self/environ")
        .when(part == 3, "/api/users?id=1 OR 1=1")
        .when(part == 4, "/var/log/auth.log")
        .otherwise(F.concat(F.lit("/probe-"), k.cast("string")))
    )
    endpoint = (
        F.when(kind == "signup", "/login")
        .when(kind == "purchase", "/api/upload")
        .when(kind == "view", F.concat(F.lit("/api/data?page="), (k % 20).cast("string")))
        .when(kind == "click", F.concat(F.lit("/search?q=item&page="), (k % 5).cast("string")))
        .otherwise(probe)
    )
    status = (
        F.when(kind == "signup", F.when(k < 50, 401).when(k < 60, 429).otherwise(200))
        .when(kind == "error", F.when(k % 3 == 0, 500).otherwise(404))
        .otherwise(200)
    )
    agent = (
        F.when(user % 10 == 0, "sqlmap/1.7")
        .when(user % 10 == 1, "python-requests/2.31.0")
        .when(user % 10 == 2, F.lit(None).cast("string"))
        .otherwise("Mozilla/5.0")
    )
    scenario = (
        F.when((kind == "signup") & (k < 60), "brute_force")
        .when((kind == "error") & part.isin(0, 3), "sql_injection")
        .when((kind == "error") & (part >= 5), "scanning")
        .when((kind == "purchase") & (k >= 95), "rate_abuse")
        .when(kind == "error", "observed")
        .otherwise("normal")
    )
    network = F.floor(user / 250).cast("int").cast("string")
    return [
        F.col("event_id").alias("id"),
        F.lit("web").alias("log_type"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("10.0."), network, F.lit("."), (user % 250).cast("string")).alias("ip"),
        F.when(kind.isin("signup", "purchase"), "POST").otherwise("GET").alias("method"),
        endpoint.alias("endpoint"),
        status.alias("status"),
        F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("response_time_ms"),
        agent.alias("user_agent"),
        scenario.alias("scenario"),
    ]


def with_data(logs: DataFrame) -> DataFrame:
    """Fold the scenario and the request fields into the JSON column ``data``."""
    fields = ["ip", "method", "endpoint", "status", "response_time_ms", "user_agent", "scenario"]
    return logs.withColumn("data", F.to_json(F.struct(*fields))).drop("scenario")


def access_logs(spark: SparkSession, folder: str) -> DataFrame:
    """All events as ``raw_logs`` rows (time without zone, as stored)."""
    return with_data(requests(spark.read.parquet(f"{folder}/events.parquet")))
