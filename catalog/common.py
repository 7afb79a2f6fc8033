"""Shared inputs of the registered queries and of their check SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import prepare, written
from tidewatch.sources.adapter import access_logs

WINDOW = "7 days"

#: Bytes of stored logs that are read by one task, about.
LOG_BLOCK = 4 << 20

# Check SQL: the events table as access logs.
LOGS_CTE = """
e AS (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props,'$.k') AS INT) AS k FROM events),
logs AS (SELECT event_id AS id, 'web' AS log_type, ts AS timestamp,
 CONCAT('10.0.', CAST(CAST(FLOOR(user_id/250) AS INT) AS VARCHAR), '.', CAST(user_id % 250 AS VARCHAR)) AS ip,
 CASE WHEN event_type IN ('signup','purchase') THEN 'POST' ELSE 'GET' END AS method,
 CASE event_type WHEN 'signup' THEN '/login'
  WHEN 'purchase' THEN '/api/upload'
  WHEN 'view' THEN CONCAT('/api/data?page=', CAST(k % 20 AS VARCHAR))
  WHEN 'click' THEN CONCAT('/search?q=item&page=', CAST(k % 5 AS VARCHAR))
  ELSE CASE k % 10 WHEN 0 THEN '/search?q='' UNION SELECT * FROM users --'
   WHEN 1 THEN '/../../etc/passwd' WHEN 2 THEN '/proc/self/environ'
   WHEN 3 THEN '/api/users?id=1 OR 1=1' WHEN 4 THEN '/var/log/auth.log'
   ELSE CONCAT('/probe-', CAST(k AS VARCHAR)) END END AS endpoint,
 CASE event_type WHEN 'signup' THEN CASE WHEN k < 50 THEN 401 WHEN k < 60 THEN 429 ELSE 200 END
  WHEN 'error' THEN CASE WHEN k % 3 = 0 THEN 500 ELSE 404 END ELSE 200 END AS status,
 CASE WHEN k % 17 = 0 THEN NULL ELSE value END AS response_time_ms,
 CASE user_id % 10 WHEN 0 THEN 'sqlmap/1.7' WHEN 1 THEN 'python-requests/2.31.0' WHEN 2 THEN NULL ELSE 'Mozilla/5.0' END AS user_agent,
 CASE WHEN event_type = 'signup' AND k < 60 THEN 'brute_force'
  WHEN event_type = 'error' AND k % 10 IN (0,3) THEN 'sql_injection'
  WHEN event_type = 'error' AND k % 10 >= 5 THEN 'scanning'
  WHEN event_type = 'purchase' AND k >= 95 THEN 'rate_abuse'
  WHEN event_type = 'error' THEN 'observed'
  ELSE 'normal' END AS scenario
FROM e)"""


def with_ctes(body: str, *ctes: str) -> str:
    """A query over the access logs, after further CTEs."""
    return "WITH " + ",\n".join([LOGS_CTE, *ctes]) + "\n" + body


def logs(spark: SparkSession, folder: str) -> DataFrame:
    return access_logs(prepare(spark), folder)


def stored_logs(spark: SparkSession, folder: str) -> DataFrame:
    """The logs as a stored table, for what reads them many times: their JSON is taken apart and put together once."""
    return written(logs(spark, folder), "logs", LOG_BLOCK)


def time_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def sql_time(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def shown(df: DataFrame, places: int = 6, names: Sequence[str] | None = None) -> DataFrame:
    """Columns in a form both engines print alike: times as text, doubles rounded, lists joined."""
    columns = []
    for part in df.schema.fields:
        if names is not None and part.name not in names:
            continue
        if isinstance(part.dataType, (T.TimestampType, T.TimestampNTZType)):
            columns.append(time_text(part.name))
        elif isinstance(part.dataType, (T.DoubleType, T.FloatType)):
            columns.append(F.round(part.name, places).alias(part.name))
        elif isinstance(part.dataType, T.ArrayType):
            columns.append(F.array_join(F.col(part.name).cast("array<string>"), ",").alias(part.name))
        else:
            columns.append(F.col(part.name))
    return df.select(columns)
