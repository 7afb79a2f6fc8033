"""The training data as one call: features, labels, selection, scaling, protocol, and both data sets stored side by side."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import classifier as K
from tidewatch.operators import dataset as D
from tidewatch.operators.features import extract_features, isolation_features
from tidewatch.schemas import FEATURES
from tidewatch.session import written
from tidewatch.sources.tables import lookback, write_dataset

#: Columns of both data sets besides their features; both hold the same rows of them.
SHARED = ["log_id", "timestamp", "label", "scenario", "protocol_role", "protocol_split"]


@dataclass(frozen=True)
class DataSets:
    """Both stored data sets, their features, and the scale of each: mean and deviation by feature."""

    forest: DataFrame
    isolation: DataFrame
    selected: list[str]
    isolation_columns: list[str]
    scales: dict[str, dict[str, tuple[float, float]]]
    anomaly_rate: float


def build_datasets(
    logs: DataFrame, members: DataFrame, folder: str, days: int = 90, as_of: Column | None = None, keep: int = 20, trees: int = 100, depth: int = K.DEPTH
) -> DataSets:
    """The data sets of the supervised and the isolation forest from the logs of the last days, written below ``folder``.

    ``members`` names the logs of alerts (alert_id, log_id). Columns that correlate with an earlier one go; the isolation forest takes the rest, the
    supervised forest the ``keep`` columns that recursive elimination leaves. Each is scaled by its own rows. Labels without any anomaly, and data sets that
    do not hold the same rows, are errors. Both are written as parquet and CSV, with their features as text, scales and summary as JSON.
    """
    spark = logs.sparkSession
    features = extract_features(lookback(logs, days, as_of))
    rows = written(D.with_protocol(D.with_scenario(D.label_logs(features, members))).select(*SHARED, *FEATURES), "labelled")
    rate = D.check_labels(rows)
    _, left = D.drop_correlated(rows, FEATURES)
    isolation_columns = isolation_features(left)
    selected = [c for c, rank in K.eliminate_features(rows, left, keep, trees, depth) if rank == 1]
    stored, scales = {}, {}
    for name, columns in (("forest", selected), ("isolation", isolation_columns)):
        scales[name] = D.scale_parameters(rows, columns)
        scaled = D.standardise(rows.select(*SHARED, *columns), scales[name])
        write_dataset(scaled, f"{folder}/{name}", columns, D.summary(scaled, columns))
        stored[name] = spark.read.parquet(f"{folder}/{name}/dataset.parquet")
    D.check_aligned(stored["forest"], stored["isolation"], SHARED)
    counts = {c: {r[c]: r["count"] for r in rows.groupBy(c).count().collect()} for c in ("protocol_role", "protocol_split")}
    details = {"lookback_days": days, "anomaly_rate": rate, "selected_features": selected, "isolation_features": isolation_columns, "scales": scales, **counts}
    spark.createDataFrame([(json.dumps(details),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/details")
    return DataSets(stored["forest"], stored["isolation"], selected, isolation_columns, scales, rate)
