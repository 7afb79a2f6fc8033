"""Domain constraints, missing-field profiles and data set quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import schemas as S


def _unit(name: str) -> Column:
    return F.col(name).between(0.0, 1.0)


def log_constraints() -> dict[str, Column]:
    return {
        "log_type_present": F.col("log_type").isNotNull(),
        "log_type_length": F.length("log_type") <= 50,
        "timestamp_present": F.col("timestamp").isNotNull(),
        "method_length": F.length("method") <= 10,
        "endpoint_length": F.length("endpoint") <= 500,
        "data_present": F.col("data").isNotNull(),
    }


def alert_constraints() -> dict[str, Column]:
    return {
        "alert_type_present": F.col("alert_type").isNotNull(),
        "severity_domain": F.col("severity").isin(S.ALERT_SEVERITIES),
        "source_domain": F.col("source").isin(S.ALERT_SOURCES),
        "confidence_range": _unit("confidence"),
        "timestamp_present": F.col("timestamp").isNotNull(),
    }


def score_constraints() -> dict[str, Column]:
    return {
        "rule_score_range": F.col("rule_score").isNotNull() & _unit("rule_score"),
        "ml_score_range": F.col("ml_score").isNotNull() & _unit("ml_score"),
        "final_score_range": F.col("final_score").isNotNull() & _unit("final_score"),
        "severity_domain": F.col("severity").isNotNull() & F.col("severity").isin(S.SCORE_SEVERITIES),
        "ml_confidence_range": _unit("ml_confidence"),
        "is_anomaly_present": F.col("is_anomaly").isNotNull(),
    }


def violations(df: DataFrame, constraints: dict[str, Column]) -> DataFrame:
    """(constraint, violations). As in SQL, a check that is null is not violated."""
    counts = [F.count_if(~rule).alias(name) for name, rule in constraints.items()]
    rows = F.array(*[F.struct(F.lit(n).alias("constraint"), F.col(n).alias("violations")) for n in constraints])
    return df.agg(*counts).select(F.inline(rows))


def split_valid(df: DataFrame, constraints: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all constraints, and the others with the names of the broken ones."""
    broken = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in constraints.items()]))
    marked = df.withColumn("broken", broken)
    return marked.filter(F.size("broken") == 0).drop("broken"), marked.filter(F.size("broken") > 0)


def missing_fields(logs: DataFrame, log_type: str, after_id: int, up_to_id: int) -> DataFrame:
    """Row count and nulls per field of one log type in an id range."""
    fields = {
        "missing_ip": "ip",
        "missing_method": "method",
        "missing_endpoint": "endpoint",
        "missing_status": "status",
        "missing_response_time": "response_time_ms",
    }
    return logs.filter(
        (F.col("id") > after_id) & (F.col("id") <= up_to_id) & (F.col("log_type") == log_type)
    ).agg(F.count(F.lit(1)).alias("total_logs"), *[F.count_if(F.col(c).isNull()).alias(n) for n, c in fields.items()])


def quality(dataset: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: nulls, infinities, whether it is constant. One aggregation over the rows."""
    parts = []
    for i, name in enumerate(columns):
        column = F.col(name).cast("double")
        parts += [
            F.count_if(column.isNull() | F.isnan(column)).alias(f"nulls_{i}"),
            F.count_if(F.abs(column) == float("inf")).alias(f"infinite_{i}"),
            (F.min(column).eqNullSafe(F.max(column)) & (F.count(column) > 0)).alias(f"constant_{i}"),
        ]
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"nulls_{i}").alias("nulls"),
            F.col(f"infinite_{i}").alias("infinite"),
            F.col(f"constant_{i}").alias("constant"),
        )
        for i, name in enumerate(columns)
    ])
    return dataset.agg(*parts).select(F.inline(rows))


def label_balance(dataset: DataFrame) -> DataFrame:
    """Anomaly rate and whether it lies strictly between 1 % and 50 %."""
    return dataset.agg(F.avg("label").alias("anomaly_rate")).withColumn(
        "balanced", (F.col("anomaly_rate") > 0.01) & (F.col("anomaly_rate") < 0.5)
    )
