"""Access-log lines (JSON objects or the combined format) to ``raw_logs`` columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import ratio
from tidewatch.functions.numbering import numbered

FORMATS = ("json", "apache_combined", "auto")

# Fixed value: the combined access-log line. The two quoted groups keep their quotes, so an absent
# field and an empty one stay apart.
COMBINED = (
    r'^(\S+)\s+(\S+)\s+(\S+)\s+\[([^\]]+)\]\s+"([^"]*)"\s+(\d{3}|-)\s+(\d+|-)'
    r'(?:\s+("[^"]*")\s+("[^"]*"))?(.*)$'
)
_PARTS = ["ip", "ident", "authuser", "timestamp", "request", "status", "bytes", "referrer", "user_agent", "extra"]
_WHITESPACE = " \t\r\n\f\x0b"
_NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$"
_JSON_FIELDS = ["log_type", "timestamp", "ip", "method", "endpoint", "status", "response_time_ms", "user_agent"]

FIELDS = [*_JSON_FIELDS, "protocol", "bytes_sent", "referrer", "request_line", "source_format"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row per line, in column ``value``."""
    return spark.read.text(path)


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(_WHITESPACE))


def undash(column: Column) -> Column:
    return F.nullif(column, F.lit("-"))


def json_record(line: Column) -> Column:
    """The fields of a JSON object line as text, or null when the line is not exactly one object.

    The line is parsed once, wrapped in brackets, so text after the object is an error.
    """
    schema = "array<struct<" + ",".join(f"{name}:string" for name in _JSON_FIELDS) + ">>"
    parsed = F.from_json(F.concat(F.lit("["), line, F.lit("]")), schema, {"allowSingleQuotes": "false"})
    one_object = line.startswith("{") & (F.size(parsed) == 1) & ~line.rlike(r"^\{\s*\}$")
    return F.when(one_object, parsed[0])


def request_parts(request: Column) -> Column:
    """(method, endpoint, protocol) of a request line of three, two or one words."""
    words = F.split(strip(request), r"\s+")
    several = F.size(words) >= 2
    empty = request.isNull() | (request == "") | (request == "-")
    return F.struct(
        F.when(~empty & several, words[0]).alias("method"),
        F.when(~empty & several, words[1]).when(~empty, request).alias("endpoint"),
        F.when(~empty & (F.size(words) >= 3), words[2]).alias("protocol"),
    )


def request_time_ms(extra: Column) -> Column:
    """First number after the quoted fields: seconds if it has a point, microseconds if large, else ms."""
    tokens = F.transform(F.split(strip(extra), r"\s+"), lambda t: F.btrim(t, F.lit('"')))
    first = F.get(F.filter(tokens, lambda t: t.rlike(_NUMBER)), F.lit(0))
    number = first.try_cast("double")
    return (
        F.when(first.contains("."), F.round(number * 1000, 3))
        .when(number >= 100000, F.round(number / 1000, 3))
        .otherwise(number)
    )


def combined_time(text: Column) -> Column:
    """'10/Oct/2000:13:55:36 -0700' as a timestamp, null when it is no such time."""
    offset = F.regexp_replace(F.regexp_replace(text, r"([+-]\d{2}):(\d{2})$", "$1$2"), r"Z$", "+0000")
    return F.try_to_timestamp(offset, F.lit("d/MMM/yyyy:H:m:s Z"))


def iso_time(text: Column) -> Column:
    """ISO 8601 text as a timestamp, null when it is not."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def _combined_parts(line: Column) -> Column:
    """All groups of the combined pattern by one regex run; a line can hold no newline itself."""
    joined = F.regexp_replace(line, COMBINED, "\n".join(f"${i + 1}" for i in range(len(_PARTS))))
    return F.split(joined, "\n")


def parse_lines(lines: DataFrame, log_format: str = "json", value: str = "value") -> DataFrame:
    """Add the record fields of FIELDS (with ``timestamp`` parsed) and ``parsed``.

    ``parsed`` is false for blank lines and for lines of no accepted format. 'auto' tries JSON first
    for lines that start with a brace and the combined format first for the others; since a JSON
    object must start with a brace, the order decides nothing else.
    """
    if log_format not in FORMATS:
        raise ValueError(f"unsupported log format {log_format!r}; use one of {', '.join(FORMATS)}")
    null = F.lit(None).cast("string")
    lines = lines.withColumn("_line", strip(F.col(value)))

    if log_format in ("json", "auto"):
        lines = lines.withColumn("_json", json_record(F.col("_line")))
    if log_format in ("apache_combined", "auto"):
        lines = lines.withColumn("_part", _combined_parts(F.col("_line")))
        part = {name: F.get(F.col("_part"), F.lit(i)) for i, name in enumerate(_PARTS)}
        lines = lines.withColumn("_time", combined_time(part["timestamp"])).withColumn(
            "_request", request_parts(part["request"])
        )

    def unquoted(column: Column) -> Column:
        return undash(F.when(column != "", F.btrim(column, F.lit('"'))))

    is_json = F.col("_json").isNotNull() if log_format != "apache_combined" else F.lit(False)
    fields: dict[str, Column] = {}
    if log_format == "json":
        is_combined = F.lit(False)
        fields = {name: null for name in FIELDS}
    else:
        is_combined = (F.size("_part") == len(_PARTS)) & F.col("_time").isNotNull() & ~is_json
        fields = {
            "log_type": F.lit("apache_access"),
            "ip": undash(part["ip"]),
            "method": F.col("_request.method"),
            "endpoint": F.col("_request.endpoint"),
            "protocol": F.col("_request.protocol"),
            "status": undash(part["status"]),
            "response_time_ms": request_time_ms(part["extra"]),
            "user_agent": unquoted(part["user_agent"]),
            "bytes_sent": undash(part["bytes"]),
            "referrer": unquoted(part["referrer"]),
            "request_line": part["request"],
            "source_format": F.lit("apache_combined"),
        }

    def chosen(name: str) -> Column:
        combined = F.when(is_combined, fields[name])
        if name in _JSON_FIELDS and log_format != "apache_combined":
            found = F.col("_json")[name]
            if name == "response_time_ms":
                found = found.try_cast("double")
            return F.when(is_json, found).otherwise(combined)
        return combined

    when = F.when(is_json, iso_time(F.col("_json.timestamp"))) if log_format != "apache_combined" else F.when(F.lit(False), F.lit(None).cast("timestamp"))
    if log_format != "json":
        when = when.when(is_combined, F.col("_time"))
    columns = {name: chosen(name) for name in FIELDS if name != "timestamp"}
    columns["status"] = columns["status"].try_cast("int")
    columns["bytes_sent"] = columns["bytes_sent"].try_cast("bigint")
    columns["response_time_ms"] = columns["response_time_ms"].cast("double")
    return lines.withColumns(
        {"parsed": F.coalesce(is_json | is_combined, F.lit(False)), "timestamp": when, **columns}
    ).drop("_json", "_part", "_time", "_request")


def normalised(parsed: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Parsed lines as ``raw_logs`` columns: defaults filled, the whole record kept as JSON.

    A missing or unreadable timestamp becomes ``as_of`` (default: the time of the query).
    """
    record = F.to_json(F.struct(*[F.col(name) for name in FIELDS]), {"ignoreNullFields": "false"})
    return parsed.filter("parsed").select(
        F.coalesce("log_type", F.lit("web")).alias("log_type"),
        F.coalesce("timestamp", F.current_timestamp() if as_of is None else as_of).alias("timestamp"),
        "ip",
        "method",
        "endpoint",
        "status",
        "response_time_ms",
        "user_agent",
        F.when(F.col("source_format").isNull(), F.col("_line")).otherwise(record).alias("data"),
    )


def failed_lines(parsed: DataFrame) -> DataFrame:
    """The quarantine: lines that could not be parsed, in full."""
    return parsed.filter(~F.col("parsed")).select("_line")


def ingestion_report(parsed: DataFrame) -> DataFrame:
    """Total, ingested and failed lines and the ingested share."""
    return parsed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("parsed").alias("ingested"),
        F.count_if(~F.col("parsed")).alias("failed"),
    ).withColumn("ingested_share", ratio(F.col("ingested"), F.col("total")))


def with_ids(logs: DataFrame, start: Column | int = 0) -> DataFrame:
    """Number new rows upward from ``start``, without gaps; see ``tables.last_id`` for the start of an append."""
    return numbered(logs, name="_row").withColumn("id", F.lit(start).cast("bigint") + F.col("_row") + 1).drop("_row")
