"""Parsing log lines, cleaning, checks. The lines are written from the access logs by Spark itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog.common import logs, shown, sql_time, with_ctes
from tidewatch.functions import text as X
from tidewatch.operators import checks as C
from tidewatch.session import shared_folder
from tidewatch.sources import lines as L
from tidewatch.sources import tables as T


def _agent() -> Column:
    return F.coalesce("user_agent", F.lit("-"))


def combined_lines(spark, folder) -> DataFrame:
    """Combined-format lines: short ones, long ones with a request time, and broken ones."""
    time = F.date_format("timestamp", "dd/MMM/yyyy:HH:mm:ss")
    request = (
        F.when(F.col("id") % 13 == 1, "-")
        .when(F.col("id") % 13 == 2, F.col("endpoint"))
        .when(F.col("id") % 13 == 3, F.concat_ws(" ", "method", "endpoint"))
        .otherwise(F.concat(F.col("method"), F.lit(" "), F.col("endpoint"), F.lit(" HTTP/1.1")))
    )
    whole = F.coalesce(F.floor("response_time_ms").cast("bigint"), F.lit(0))
    extra = (
        F.when(F.col("id") % 5 == 0, "")
        .when(F.col("id") % 5 == 1, F.concat(F.lit(" "), (F.col("id") % 400).cast("string"), F.lit(".125 \"x\"")))
        .when(F.col("id") % 5 == 2, F.concat(F.lit(" - \""), (F.col("id") * 1000 + 100000).cast("string"), F.lit("\"")))
        .when(F.col("id") % 5 == 3, F.concat(F.lit(" rt="), F.lit(" "), whole.cast("string")))
        .otherwise(" none")
    )
    line = F.concat(
        F.when(F.col("id") % 17 == 0, "-").otherwise(F.col("ip")),
        F.lit(" - - ["), time, F.when(F.col("id") % 3 == 0, " -0700] \"").otherwise(" +0000] \""),
        request, F.lit("\" "),
        F.when(F.col("id") % 19 == 0, "-").otherwise(F.col("status").cast("string")), F.lit(" "),
        F.when(F.col("id") % 11 == 0, "-").otherwise(F.col("id").cast("string")),
        F.when(F.col("id") % 7 == 0, "").otherwise(F.concat(F.lit(" \"-\" \""), _agent(), F.lit("\""), extra)),
    )
    broken = F.when(F.col("id") % 23 == 0, "bad apache line").when(F.col("id") % 23 == 1, F.regexp_replace(line, r"\[\d", "[x"))
    return logs(spark, folder).select("id", F.coalesce(broken, line).alias("value"))


# The same lines as check SQL.
COMBINED_CTE = """combined AS (SELECT id, CASE WHEN id % 23 = 0 THEN 'bad apache line' WHEN id % 23 = 1 THEN regexp_replace(line, '\\[[0-9]', '[x') ELSE line END AS value FROM (
SELECT *, CASE WHEN id % 17 = 0 THEN '-' ELSE ip END || ' - - [' || strftime(timestamp, '%d/%b/%Y:%H:%M:%S')
 || CASE WHEN id % 3 = 0 THEN ' -0700] "' ELSE ' +0000] "' END
 || CASE id % 13 WHEN 1 THEN '-' WHEN 2 THEN endpoint WHEN 3 THEN method || ' ' || endpoint ELSE method || ' ' || endpoint || ' HTTP/1.1' END
 || '" ' || CASE WHEN id % 19 = 0 THEN '-' ELSE CAST(status AS VARCHAR) END || ' '
 || CASE WHEN id % 11 = 0 THEN '-' ELSE CAST(id AS VARCHAR) END
 || CASE WHEN id % 7 = 0 THEN '' ELSE ' "-" "' || coalesce(user_agent, '-') || '"' ||
  CASE id % 5 WHEN 0 THEN '' WHEN 1 THEN ' ' || CAST(id % 400 AS VARCHAR) || '.125 "x"' WHEN 2 THEN ' - "' || CAST(id * 1000 + 100000 AS VARCHAR) || '"'
  WHEN 3 THEN ' rt= ' || CAST(coalesce(CAST(floor(response_time_ms) AS BIGINT), 0) AS VARCHAR) ELSE ' none' END END AS line FROM logs)),
split AS (SELECT id, value,
 regexp_extract(value, '^(\\S+)\\s+\\S+\\s+\\S+\\s+\\[([^\\]]+)\\]\\s+"([^"]*)"\\s+(\\d{3}|-)\\s+(\\d+|-)((?:\\s+"[^"]*"\\s+"[^"]*")?)(.*)$',
  ['ip', 'time', 'request', 'status', 'bytes', 'quoted', 'extra']) AS p FROM combined),
timed AS (SELECT *, try_strptime(p.time, '%d/%b/%Y:%H:%M:%S %z') AS stamp, string_split_regex(trim(p.request), '\\s+') AS words,
 list_filter(list_transform(string_split_regex(trim(p.extra), '\\s+'), lambda t: trim(t, '"')),
  lambda t: regexp_full_match(t, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)'))[1] AS token FROM split),
apache AS (SELECT id, value, p.ip <> '' AND stamp IS NOT NULL AS parsed, timezone('UTC', stamp) AS timestamp, nullif(p.ip, '-') AS ip,
 CASE WHEN p.request <> '-' AND len(words) >= 2 THEN words[1] END AS method,
 CASE WHEN p.request = '-' THEN NULL WHEN len(words) >= 2 THEN words[2] ELSE p.request END AS endpoint,
 CASE WHEN p.request <> '-' AND len(words) >= 3 THEN words[3] END AS protocol,
 TRY_CAST(nullif(p.status, '-') AS INT) AS status, TRY_CAST(nullif(p.bytes, '-') AS BIGINT) AS bytes_sent,
 CASE WHEN token LIKE '%.%' THEN round(CAST(token AS DOUBLE) * 1000, 3) WHEN CAST(token AS DOUBLE) >= 100000
  THEN round(CAST(token AS DOUBLE) / 1000, 3) ELSE CAST(token AS DOUBLE) END AS response_time_ms,
 nullif(regexp_extract(p.quoted, '"([^"]*)"$', 1), '-') AS agent, p.quoted AS quoted FROM timed)"""


def json_lines(spark, folder) -> DataFrame:
    """JSON lines with plain, missing and unreadable fields, and lines that are no objects."""
    fields = F.struct(
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("log_type")).alias("log_type"),
        F.when(F.col("id") % 11 == 0, "soon")
        .when(F.col("id") % 11 == 1, F.lit(None))
        .when(F.col("id") % 2 == 0, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("timestamp"),
        "ip", "method", "endpoint", "status", "response_time_ms", "user_agent",
    )
    body = F.to_json(fields)
    value = (
        F.when(F.col("id") % 29 == 0, "not-json")
        .when(F.col("id") % 29 == 1, F.concat(F.lit("["), body, F.lit("]")))
        .when(F.col("id") % 29 == 2, F.concat(body, F.lit(" tail")))
        .when(F.col("id") % 29 == 3, "{}")
        .when(F.col("id") % 29 == 4, "   ")
        .otherwise(F.concat(F.lit("  "), body))
    )
    return logs(spark, folder).select("id", value.alias("value"))


JSON_OK = "id % 29 > 4"


def _parse_json(spark, folder):
    parsed = L.parse_lines(json_lines(spark, folder), "json")
    return shown(parsed.select("id", "parsed", "timestamp", "ip", "method", "endpoint", F.col("status").cast("string").alias("status"), "response_time_ms", "user_agent"))


def _parse_combined(spark, folder):
    parsed = L.parse_lines(combined_lines(spark, folder), "apache_combined")
    return shown(parsed.select(
        "id", "parsed", "log_type", "timestamp", "ip", F.col("status").cast("string").alias("status"),
        F.col("bytes_sent").cast("string").alias("bytes_sent"), "user_agent", "source_format"))


def _requests(spark, folder):
    parsed = L.parse_lines(combined_lines(spark, folder), "apache_combined").filter("parsed")
    return parsed.select("id", "request_line", "method", "endpoint", "protocol")


def _request_times(spark, folder):
    parsed = L.parse_lines(combined_lines(spark, folder), "apache_combined").filter("parsed")
    return parsed.select("id", "response_time_ms")


def _auto(spark, folder):
    both = json_lines(spark, folder).filter("id % 2 = 0").unionByName(combined_lines(spark, folder).filter("id % 2 = 1"))
    parsed = L.parse_lines(both, "auto")
    return parsed.select("id", "parsed", "source_format", "method", "endpoint")


def _normalise(spark, folder):
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp")
    parsed = L.parse_lines(json_lines(spark, folder), "json")
    rows = L.normalised(parsed, as_of)
    return shown(rows.select(
        "log_type", "timestamp", "ip", "method", "endpoint", F.get_json_object("data", "$.endpoint").alias("kept_endpoint")))


def _append(spark, folder):
    """Write the parsed lines as a day-partitioned table in two batches and read the table back."""
    path = shared_folder(spark, "raw-logs")
    parsed = L.parse_lines(combined_lines(spark, folder), "apache_combined")
    for part in (0, 1):
        T.append_logs(L.normalised(parsed.filter(F.col("id") % 2 == part)), path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("date").cast("string").alias("date"), "log_type").agg(
        F.count(F.lit(1)).alias("logs"), F.count("method").alias("with_method"))


def _two_appends(spark, folder):
    """The same lines appended twice: ids never repeat."""
    path = shared_folder(spark, "raw-logs")
    parsed = L.parse_lines(combined_lines(spark, folder), "apache_combined")
    for _ in range(2):
        T.append_logs(L.normalised(parsed), path)
    return spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("logs"), F.count_distinct("id").alias("ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def _report(spark, folder):
    return shown(L.ingestion_report(L.parse_lines(combined_lines(spark, folder), "apache_combined")))


def _quarantine(spark, folder):
    failed = L.failed_lines(L.parse_lines(combined_lines(spark, folder), "apache_combined"))
    return failed.groupBy("_line").agg(F.count(F.lit(1)).alias("lines")).withColumnRenamed("_line", "line")


def _every_log_constraint(spark, folder):
    """Rows that break each constraint in turn."""
    rows, turn = logs(spark, folder), F.col("id") % 31
    rows = rows.withColumns({
        "log_type": F.when(turn == 1, F.repeat(F.lit("t"), F.lit(51))).when(turn != 0, F.col("log_type")),
        "timestamp": F.when(turn != 2, F.col("timestamp")),
        "method": F.when(turn == 3, "UNREASONABLE").otherwise(F.col("method")),
        "endpoint": F.when(turn == 4, F.repeat(F.lit("/"), F.lit(501))).otherwise(F.col("endpoint")),
        "data": F.when(turn != 5, F.col("data")),
    })
    return C.violations(rows, C.log_constraints())


def _constraints(spark, folder):
    rows = logs(spark, folder).withColumn("log_type", F.when(F.col("id") % 31 > 0, F.col("log_type")))
    return C.violations(rows, {**C.log_constraints(), "endpoint_short": F.length("endpoint") <= 20})


def _valid_split(spark, folder):
    rules = {"endpoint_short": F.length("endpoint") <= 20, "agent_known": F.col("user_agent") != "sqlmap/1.7"}
    _, bad = C.split_valid(logs(spark, folder), rules)
    return bad.select("id", F.array_join("broken", ",").alias("broken"))


def _missing(spark, folder):
    return C.missing_fields(logs(spark, folder), "web", 100, 900000000)


def _masked(spark, folder):
    body = F.concat(F.lit('{"user":"u'), F.col("id").cast("string"), F.lit('","password": "p\\"'), F.col("ip"), F.lit('"}'))
    return logs(spark, folder).select("id", X.mask_password(body).alias("data"))


def _client_ip(spark, folder):
    forwarded = F.when(F.col("id") % 3 == 0, F.concat(F.lit(" "), F.col("ip"), F.lit(", 10.9.9.9"))).when(F.col("id") % 3 == 1, "")
    real = F.when(F.col("id") % 2 == 0, F.concat(F.lit(" 10.8.8."), (F.col("id") % 200).cast("string")))
    remote = F.when(F.col("id") % 5 > 0, F.col("ip"))
    return logs(spark, folder).select("id", X.client_ip(forwarded, real, remote).alias("client_ip"))


def _levels(spark, folder):
    return logs(spark, folder).groupBy(X.log_level(F.col("status")).alias("level")).agg(F.count(F.lit(1)).alias("logs"))


def _load(spark, folder):
    return shown(T.lookback(logs(spark, folder), 7).select("id", "timestamp", "ip", "endpoint", "status"))


QUERIES = {
    "ingest_json_lines": _parse_json,
    "ingest_combined_lines": _parse_combined,
    "ingest_request_line": _requests,
    "ingest_request_time": _request_times,
    "ingest_auto_format": _auto,
    "ingest_normalise": _normalise,
    "ingest_append_sink": _append,
    "ingest_ids_two_appends": _two_appends,
    "ingest_report": _report,
    "ingest_failed_lines": _quarantine,
    "check_log_constraints": _constraints,
    "check_every_log_constraint": _every_log_constraint,
    "check_constraint_split": _valid_split,
    "profile_missing_fields": _missing,
    "clean_mask_password": _masked,
    "clean_client_ip": _client_ip,
    "clean_log_level": _levels,
    "load_lookback": _load,
}

_J_TIME = """CASE WHEN id % 11 IN (0, 1) THEN NULL ELSE timestamp END"""

ORACLE = {
    "ingest_json_lines": with_ctes(f"""SELECT id, {JSON_OK} AS parsed,
 CASE WHEN {JSON_OK} THEN strftime({_J_TIME}, '%Y-%m-%d %H:%M:%S.%f') END AS timestamp,
 CASE WHEN {JSON_OK} THEN ip END AS ip, CASE WHEN {JSON_OK} THEN method END AS method, CASE WHEN {JSON_OK} THEN endpoint END AS endpoint,
 CASE WHEN {JSON_OK} THEN CAST(status AS VARCHAR) END AS status, CASE WHEN {JSON_OK} THEN round(response_time_ms, 6) END AS response_time_ms,
 CASE WHEN {JSON_OK} THEN user_agent END AS user_agent FROM logs"""),
    "ingest_combined_lines": with_ctes(f"""SELECT id, parsed, CASE WHEN parsed THEN 'apache_access' END AS log_type,
 CASE WHEN parsed THEN strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') END AS timestamp, CASE WHEN parsed THEN ip END AS ip,
 CASE WHEN parsed THEN CAST(status AS VARCHAR) END AS status, CASE WHEN parsed THEN CAST(bytes_sent AS VARCHAR) END AS bytes_sent,
 CASE WHEN parsed AND quoted <> '' THEN agent END AS user_agent, CASE WHEN parsed THEN 'apache_combined' END AS source_format FROM apache""",
        COMBINED_CTE),
    "ingest_request_line": with_ctes(
        "SELECT a.id, t.p.request AS request_line, method, endpoint, protocol FROM apache a JOIN timed t ON a.id = t.id WHERE parsed",
        COMBINED_CTE),
    "ingest_request_time": with_ctes("SELECT id, response_time_ms FROM apache WHERE parsed", COMBINED_CTE),
    "ingest_auto_format": with_ctes(f"""SELECT id, {JSON_OK} AS parsed, CAST(NULL AS VARCHAR) AS source_format,
 CASE WHEN {JSON_OK} THEN method END AS method, CASE WHEN {JSON_OK} THEN endpoint END AS endpoint FROM logs WHERE id % 2 = 0
UNION ALL SELECT id, parsed, CASE WHEN parsed THEN 'apache_combined' END, CASE WHEN parsed THEN method END, CASE WHEN parsed THEN endpoint END
FROM apache WHERE id % 2 = 1""", COMBINED_CTE),
    "ingest_normalise": with_ctes(f"""SELECT 'web' AS log_type,
 strftime(coalesce({_J_TIME}, TIMESTAMP '2024-02-01 00:00:00'), '%Y-%m-%d %H:%M:%S.%f') AS timestamp, ip, method, endpoint,
 endpoint AS kept_endpoint FROM logs WHERE {JSON_OK}"""),
    "ingest_append_sink": with_ctes(
        """SELECT strftime(timestamp, '%Y-%m-%d') AS date, 'apache_access' AS log_type, count(*) AS logs, count(method) AS with_method
FROM apache WHERE parsed GROUP BY 1""", COMBINED_CTE),
    "ingest_ids_two_appends": with_ctes(
        "SELECT 2 * count(*) AS logs, 2 * count(*) AS ids, CAST(1 AS BIGINT) AS first_id, 2 * count(*) AS last_id FROM apache WHERE parsed", COMBINED_CTE),
    "ingest_report": with_ctes(
        """SELECT count(*) AS total, count(*) FILTER (parsed) AS ingested, count(*) FILTER (NOT parsed) AS failed,
 round(count(*) FILTER (parsed) / count(*), 6) AS ingested_share FROM apache""", COMBINED_CTE),
    "ingest_failed_lines": with_ctes("SELECT value AS line, count(*) AS lines FROM apache WHERE NOT parsed GROUP BY value", COMBINED_CTE),
    "check_log_constraints": with_ctes("""SELECT u.name AS constraint, CAST(u.n AS BIGINT) AS violations FROM (
 SELECT count(*) FILTER (id % 31 = 0) AS a, count(*) FILTER (length(endpoint) > 20) AS b FROM logs) c,
 LATERAL (VALUES ('log_type_present', a), ('log_type_length', 0), ('timestamp_present', 0), ('method_length', 0), ('endpoint_length', 0),
  ('data_present', 0), ('endpoint_short', b)) u(name, n)"""),
    "check_every_log_constraint": with_ctes("""SELECT name AS constraint, count(*) AS violations FROM logs JOIN (VALUES (0, 'log_type_present'),
 (1, 'log_type_length'), (2, 'timestamp_present'), (3, 'method_length'), (4, 'endpoint_length'), (5, 'data_present')) v(turn, name) ON id % 31 = turn GROUP BY name"""),
    "check_constraint_split": with_ctes("""SELECT id, concat_ws(',', CASE WHEN length(endpoint) > 20 THEN 'endpoint_short' END,
 CASE WHEN user_agent = 'sqlmap/1.7' THEN 'agent_known' END) AS broken FROM logs WHERE length(endpoint) > 20 OR user_agent = 'sqlmap/1.7'"""),
    "profile_missing_fields": with_ctes("""SELECT count(*) AS total_logs, count(*) FILTER (ip IS NULL) AS missing_ip,
 count(*) FILTER (method IS NULL) AS missing_method, count(*) FILTER (endpoint IS NULL) AS missing_endpoint,
 count(*) FILTER (status IS NULL) AS missing_status, count(*) FILTER (response_time_ms IS NULL) AS missing_response_time
FROM logs WHERE id > 100 AND log_type = 'web'"""),
    "clean_mask_password": with_ctes("""SELECT id, '{"user":"u' || id || '","password": "************"}' AS data FROM logs"""),
    "clean_client_ip": with_ctes("""SELECT id, CASE WHEN id % 3 = 0 THEN ip WHEN id % 2 = 0 THEN '10.8.8.' || (id % 200)
 WHEN id % 5 > 0 THEN ip ELSE 'unknown' END AS client_ip FROM logs"""),
    "clean_log_level": with_ctes("""SELECT CASE WHEN status >= 500 THEN 'error' WHEN status >= 400 THEN 'warning' ELSE 'info' END AS level,
 count(*) AS logs FROM logs GROUP BY 1"""),
    "load_lookback": with_ctes(f"""SELECT id, {sql_time('timestamp')}, ip, endpoint, status FROM logs
WHERE timestamp > (SELECT max(timestamp) FROM logs) - INTERVAL 7 DAY"""),
}
