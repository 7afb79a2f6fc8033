"""Detection rules: filter, group, threshold, alert.

All rules of a set are evaluated in one pass: every log row is tagged with the rules it matches,
then one grouped aggregation (rule + the rule's own keys) gives every alert. The aggregates are
fixed-size (counts, extremes, an hour bit mask, a distinct count), so Spark combines them on the map
side and the distinct count spreads a hot address over its endpoints. Lists that grow with the data
(log ids, endpoints) are kept as rows; see ``alert_logs`` and ``alert_endpoints``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import any_ilike, micros, off_hours, recent
from tidewatch.functions.numbering import numbered
from tidewatch.session import written

# The text patterns of the rules.
SQL_PATTERNS = ["%union%select%", "%or%1=1%", "%drop%table%", "%--%"]
PATH_PATTERNS = ["%../%", "%/etc/passwd%", "%/etc/shadow%", "%/proc/%", "%/var/log/%"]
PATH_LABELS = [
    ("%../%", "directory traversal"),
    ("%/etc/passwd%", "passwd file access"),
    ("%/etc/shadow%", "shadow file access"),
    ("%/proc/%", "proc filesystem access"),
]
AGENT_PATTERNS = [
    "%sqlmap%", "%nikto%", "%nmap%", "%masscan%", "%zgrab%", "%python-requests%", "%go-http-client%", "%curl%",
]

# The columns that can take part in a rule's group key besides the address.
_EXTRA_KEYS = ["endpoint", "method", "user_agent"]
GROUP = ["alert_type", "ip", "key_endpoint", "key_method", "key_user_agent"]


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    confidence: float
    matches: Callable[[], Column]
    description: Callable[[], Column]
    metadata: Callable[[str], Sequence[Column]]
    keys: tuple[str, ...] = ()
    minimum: int = 1
    measure: str = "requests"


def _text(*parts) -> Column:
    """SQL '||': null as soon as one part is null."""
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def path_label(endpoint: Column) -> Column:
    label = F.when(endpoint.ilike(PATH_LABELS[0][0]), PATH_LABELS[0][1])
    for pattern, name in PATH_LABELS[1:]:
        label = label.when(endpoint.ilike(pattern), name)
    return label.otherwise("other")


def _requested() -> list[Column]:
    return [F.col("key_endpoint").alias("endpoint"), F.col("key_method").alias("method"), F.col("requests").alias("attempts")]


RULES: list[Rule] = [
    Rule(
        "brute_force", "HIGH", 1.0,
        matches=lambda: (F.col("endpoint") == "/login") & F.col("status").isin(401, 429),
        description=lambda: _text("Detected ", F.col("requests"), " failed login attempts from IP ", F.col("ip")),
        metadata=lambda window: [
            F.col("requests").alias("failed_attempts"),
            F.array(F.lit("/login")).alias("endpoints_targeted"),
            F.lit(window).alias("time_window"),
            F.col("first_seen").alias("first_attempt"),
            F.col("timestamp").alias("last_attempt"),
        ],
        minimum=5,
    ),
    Rule(
        "sql_injection", "CRITICAL", 1.0,
        matches=lambda: any_ilike(F.col("endpoint"), SQL_PATTERNS),
        description=lambda: _text("SQL injection attempt from IP ", F.col("ip"), " on ", F.col("key_endpoint")),
        metadata=lambda window: _requested(),
        keys=("endpoint", "method"),
    ),
    Rule(
        "port_scanning", "MEDIUM", 0.9,
        matches=lambda: F.lit(True),
        description=lambda: _text("Scanning: ", F.col("unique_endpoints"), " endpoints from IP ", F.col("ip")),
        metadata=lambda window: [
            F.col("unique_endpoints"),
            F.col("requests").alias("total_requests"),
            F.lit(window).alias("time_window"),
            F.col("average_response_ms"),
        ],
        minimum=10,
        measure="unique_endpoints",
    ),
    Rule(
        "path_traversal", "CRITICAL", 1.0,
        matches=lambda: any_ilike(F.col("endpoint"), PATH_PATTERNS),
        description=lambda: _text("Path traversal attempt from IP ", F.col("ip"), " on ", F.col("key_endpoint")),
        metadata=lambda window: [*_requested(), path_label(F.col("key_endpoint")).alias("pattern")],
        keys=("endpoint", "method"),
    ),
    Rule(
        "suspicious_user_agent", "MEDIUM", 0.85,
        matches=lambda: any_ilike(F.col("user_agent"), AGENT_PATTERNS),
        description=lambda: _text("Suspicious tool detected from IP ", F.col("ip")),
        metadata=lambda window: [F.col("key_user_agent").alias("user_agent"), F.col("requests")],
        keys=("user_agent",),
        minimum=3,
    ),
    Rule(
        "time_anomaly", "LOW", 0.7,
        matches=lambda: off_hours(F.hour("timestamp")),
        description=lambda: _text(
            "Off-hours activity: ", F.col("requests"), " requests from IP ", F.col("ip"), " between 22h-6h"
        ),
        metadata=lambda window: [
            F.col("requests"),
            F.col("unique_endpoints"),
            F.col("hours_active"),
            F.lit(window).alias("time_window"),
        ],
        minimum=20,
    ),
]


def rule(name: str) -> Rule:
    for candidate in RULES:
        if candidate.name == name:
            return candidate
    raise ValueError(f"unknown rule: {name}")


def with_agent(logs: DataFrame) -> DataFrame:
    """Take the user agent from the JSON record where it has no column of its own.

    Ingestion fills both from the same record; reading the column spares the wide JSON.
    """
    if "user_agent" in logs.columns or "data" not in logs.columns:
        return logs
    return logs.withColumn("user_agent", F.get_json_object("data", "$.user_agent"))


def usable_rules(logs: DataFrame, rules: Sequence[Rule] = RULES) -> tuple[list[Rule], list[Rule]]:
    """Split rules into those whose columns resolve on ``logs`` and those that would fail."""
    logs = with_agent(logs)
    good, bad = [], []
    for candidate in rules:
        try:
            logs.select(candidate.matches(), *candidate.keys)
            good.append(candidate)
        except AnalysisException:
            bad.append(candidate)
    return good, bad


def tagged(logs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per (log, matching rule) with that rule's group key columns filled in."""
    logs = with_agent(logs)
    if len(rules) == 1:
        rows = logs.filter(rules[0].matches()).withColumn("alert_type", F.lit(rules[0].name))
    else:
        names = F.array_compact(F.array(*[F.when(r.matches(), F.lit(r.name)) for r in rules]))
        rows = logs.withColumn("alert_type", F.explode(names))
    for key in _EXTRA_KEYS:
        users = [r.name for r in rules if key in r.keys]
        column = F.when(F.col("alert_type").isin(users), F.col(key)) if users else F.lit(None).cast("string")
        rows = rows.withColumn(f"key_{key}", column)
    return rows


def _by_rule(rules: Sequence[Rule], value: Callable[[Rule], Column]) -> Column:
    chosen = F.when(F.col("alert_type") == rules[0].name, value(rules[0]))
    for candidate in rules[1:]:
        chosen = chosen.when(F.col("alert_type") == candidate.name, value(candidate))
    return chosen


def alert_groups(rows: DataFrame, more_keys: Sequence[str] = ()) -> DataFrame:
    """The measures of every (rule, key) group of tagged rows."""
    return (
        rows.groupBy(*more_keys, *GROUP)
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_distinct("endpoint").alias("unique_endpoints"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("timestamp"),
            F.avg("response_time_ms").alias("average_response_ms"),
            F.expr("bit_or(shiftleft(1, hour(timestamp)))").alias("hour_mask"),
        )
    )


def to_alerts(groups: DataFrame, window: str, rules: Sequence[Rule] = RULES, more_keys: Sequence[str] = ()) -> DataFrame:
    """Keep the groups that reach their rule's threshold and word them as alerts."""
    hours = F.expr("filter(sequence(0, 23), h -> (hour_mask & shiftleft(1, h)) != 0)")
    reached = _by_rule(rules, lambda r: F.col(r.measure) >= r.minimum)

    def told_apart(value: Column) -> Column:
        """Text that no other value has, whatever it contains, null included."""
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    # Sliding windows over one burst share their last time, so the window's start and length belong to the identity.
    start = F.unix_micros(F.col("window.start").cast("timestamp")).cast("string") if "window" in more_keys else F.lit(None).cast("string")
    parts = [*[F.col(c) for c in GROUP], micros("timestamp").cast("string"), F.lit(window), start]
    identity = F.concat_ws(",", *[told_apart(p) for p in parts])
    return (
        groups.filter(reached)
        .withColumn("hours_active", hours)
        .select(
            *more_keys,
            F.md5(identity).alias("alert_id"),
            *GROUP,
            _by_rule(rules, lambda r: F.lit(r.severity)).alias("severity"),
            F.lit("rule").alias("source"),
            _by_rule(rules, lambda r: F.lit(r.confidence)).alias("confidence"),
            _by_rule(rules, lambda r: r.description()).alias("description"),
            "timestamp",
            F.col("requests").alias("related_logs"),
            "unique_endpoints",
            "first_seen",
            "average_response_ms",
            "hours_active",
            _by_rule(rules, lambda r: F.to_json(F.struct(*r.metadata(window)))).alias("metadata"),
        )
    )


def run_rules(
    logs: DataFrame,
    window: str = "7 days",
    rules: Sequence[Rule] = RULES,
    as_of: Column | None = None,
) -> DataFrame:
    """Alerts of all usable rules over the look-back window; rules that cannot run add none."""
    good, _ = usable_rules(logs, rules)
    return to_alerts(alert_groups(tagged(recent(logs, window, as_of), good)), window, good)


def rule_report(alerts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Alerts per rule, 0 for rules that found nothing or could not run."""
    counts = [F.count_if(F.col("alert_type") == r.name).alias(r.name) for r in rules]
    rows = F.array(*[F.struct(F.lit(r.name).alias("alert_type"), F.col(r.name).alias("alerts")) for r in rules])
    return alerts.agg(*counts).select(F.inline(rows))


def alert_logs(
    logs: DataFrame,
    alerts: DataFrame,
    window: str = "7 days",
    rules: Sequence[Rule] = RULES,
    as_of: Column | None = None,
) -> DataFrame:
    """(alert_id, alert_type, severity, log_id, timestamp): every log named by an alert.

    The alert side is unique per key, so a hot address only widens the log side, which adaptive
    execution splits.
    """
    good, _ = usable_rules(logs, rules)
    rows = tagged(recent(logs, window, as_of), good).select(*GROUP, F.col("id").alias("log_id"), "timestamp")
    heads = alerts.select("alert_id", "severity", *[F.col(c).alias(f"_{c}") for c in GROUP])
    same = rows["alert_type"] == heads["_alert_type"]
    for key in GROUP[1:]:
        same = same & rows[key].eqNullSafe(heads[f"_{key}"])
    return rows.join(heads, same).select("alert_id", "alert_type", "severity", "log_id", "timestamp")


def alert_endpoints(
    logs: DataFrame,
    alerts: DataFrame,
    window: str = "7 days",
    rules: Sequence[Rule] = RULES,
    as_of: Column | None = None,
) -> DataFrame:
    """(alert_id, endpoint, requests): the distinct endpoints an alert's logs touched."""
    good, _ = usable_rules(logs, rules)
    touched = (
        tagged(recent(logs, window, as_of), good)
        .filter(F.col("endpoint").isNotNull())
        .groupBy(*GROUP, "endpoint")
        .agg(F.count(F.lit(1)).alias("requests"))
    )
    heads = alerts.select("alert_id", *[F.col(c).alias(f"_{c}") for c in GROUP])
    same = touched["alert_type"] == heads["_alert_type"]
    for key in GROUP[1:]:
        same = same & touched[key].eqNullSafe(heads[f"_{key}"])
    return touched.join(heads, same).select("alert_id", "endpoint", "requests")


def log_id_chunks(members: DataFrame, length: int = 10_000) -> DataFrame:
    """(alert_id, chunk, log_ids): all log ids of every alert in time order, in lists of ``length`` numbered from 0.

    The rows are numbered through the whole table, and the alerts' first numbers are written before they are joined: then the join is one of two
    plain tables, which Spark splits for an alert that owns many rows.
    """
    rows = numbered(members.select("alert_id", "timestamp", "log_id"), ["alert_id", "timestamp", "log_id"])
    first = written(rows.groupBy("alert_id").agg(F.min("n").alias("_first")), "first-numbers")
    chunk = F.floor((F.col("n") - F.col("_first")) / length)
    return (
        rows.join(first, "alert_id")
        .groupBy("alert_id", chunk.alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("n", "log_id"))).alias("_pairs"))
        .select("alert_id", "chunk", F.transform("_pairs", lambda p: p["log_id"]).alias("log_ids"))
    )


# Requests allowed per client and route, and the window in seconds.
RATE_LIMITS = {
    "/login": (5, 60),
    "/admin": (20, 60),
    "/search": (30, 60),
    "/api/upload": (10, 60),
}
DEFAULT_RATE_LIMIT = (200, 3600)


def rate_breaches(
    logs: DataFrame,
    limits: dict[str, tuple[int, int]] = RATE_LIMITS,
    default: tuple[int, int] = DEFAULT_RATE_LIMIT,
) -> DataFrame:
    """Fixed windows in which one client asked one route more often than allowed.

    A route is the endpoint without its query string; unlisted routes have the default limit each.
    """
    route = F.col("route")
    allowed, seconds = F.lit(default[0]), F.lit(default[1])
    for name, (count, width) in limits.items():
        allowed = F.when(route == name, count).otherwise(allowed)
        seconds = F.when(route == name, width).otherwise(seconds)
    second = F.floor(micros("timestamp") / 1_000_000).cast("bigint")
    return (
        logs.select("ip", F.split("endpoint", r"\?")[0].alias("route"), second.alias("second"))
        .select("ip", "route", allowed.alias("allowed"), (F.col("second") - F.pmod("second", seconds)).alias("window_start"))
        .groupBy("ip", "route", "allowed", "window_start")
        .agg(F.count(F.lit(1)).alias("requests"))
        .filter(F.col("requests") > F.col("allowed"))
    )
