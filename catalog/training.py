"""Labels, protocol, splits, scaling, correlations and summaries of the training data set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from catalog.common import WINDOW, logs, shown, sql_time, stored_logs, with_ctes
from catalog.detection import ALERTS_CTE
from catalog.featuring import FEATURES_CTE
from tidewatch.operators import checks as C
from tidewatch.operators import dataset as D
from tidewatch.operators import features as E
from tidewatch.operators import forest as I
from tidewatch.operators import rules as R
from tidewatch.plans import datasets as B
from tidewatch.schemas import FEATURES
from tidewatch.session import shared_folder, written
from tidewatch.sources import tables as T

DATASET_CTE = (
    FEATURES_CTE
    + ",\n"
    + ALERTS_CTE
    + """,
labelled AS (SELECT f.*, CASE WHEN m.log_id IS NULL THEN 0 ELSE 1 END AS label FROM features f
 LEFT JOIN (SELECT DISTINCT log_id FROM members) m ON f.log_id = m.log_id),
cuts AS (SELECT quantile_cont(epoch_us(timestamp)::DOUBLE, 0.7) AS a, quantile_cont(epoch_us(timestamp)::DOUBLE, 0.85) AS b
 FROM features WHERE scenario = 'normal'),
dataset AS (SELECT l.*, CASE WHEN scenario = 'normal' THEN 'baseline_normal'
  WHEN scenario IN ('brute_force', 'rate_abuse', 'offhours') THEN 'known_attack'
  WHEN scenario IN ('scanning', 'sql_injection') THEN 'unknown_attack' ELSE 'observed' END AS protocol_role,
 CASE WHEN scenario = 'normal' THEN CASE WHEN epoch_us(timestamp) <= a THEN 'baseline_train'
   WHEN epoch_us(timestamp) <= b THEN 'threshold_validation' ELSE 'novelty_test' END
  WHEN scenario IN ('brute_force', 'rate_abuse', 'offhours') THEN 'threshold_validation'
  WHEN scenario IN ('scanning', 'sql_injection') THEN 'novelty_test' ELSE 'observed' END AS protocol_split,
 row_number() OVER (ORDER BY timestamp, log_id) - 1 AS pos, count(*) OVER () AS total FROM labelled l, cuts)"""
)


# Labels from the rules that need no busy address, over the whole month.
ATTACK_RULES = ["brute_force", "sql_injection", "path_traversal"]
ATTACK_CTE = DATASET_CTE.replace("INTERVAL 7 DAY", "INTERVAL 30 DAY").replace(
    "SELECT DISTINCT log_id FROM members",
    "SELECT DISTINCT log_id FROM members WHERE alert_type IN ('brute_force', 'sql_injection', 'path_traversal')",
)


def attack_members(rows):
    rules = [R.rule(name) for name in ATTACK_RULES]
    return R.alert_logs(rows, R.run_rules(rows, "30 days", rules), "30 days", rules)


def attack_labels(rows):
    """(log_id, timestamp, label) with anomalies spread over the whole period."""
    return D.label_logs(rows.select(F.col("id").alias("log_id"), "timestamp"), attack_members(rows))


def _labels(rows):
    """The label of every log, without its features."""
    found = R.run_rules(rows, WINDOW)
    return D.label_logs(
        rows.select(F.col("id").alias("log_id"), "timestamp", "data"), R.alert_logs(rows, found, WINDOW)
    )


def dataset(spark, folder):
    """Features, label and protocol columns of every log."""
    rows = stored_logs(spark, folder)
    found = R.run_rules(rows, WINDOW)
    labelled = D.label_logs(E.extract_features(rows), R.alert_logs(rows, found, WINDOW))
    return D.with_protocol(labelled)


def _label(spark, folder):
    return _labels(logs(spark, folder)).select("log_id", "label")


def _protocol(spark, folder):
    return D.with_protocol(_labels(logs(spark, folder))).select("log_id", "scenario", "protocol_role", "protocol_split")


def _protocol_counts(spark, folder):
    return D.protocol_counts(D.with_protocol(_labels(logs(spark, folder))))


def _holdout(spark, folder):
    return D.holdout_split(_labels(logs(spark, folder))).select("log_id", "split")


def _fold_ranges(spark, folder):
    """The folds as ranges of rows stored once by time."""
    data = D.by_time(attack_labels(logs(spark, folder)))
    parts = D.fold_ranges(data)
    frames = [
        D.fold_rows(data, parts, name, ["train", "validation", "test"]).select("log_id", F.lit(name).alias("fold"), "split")
        for name in sorted({p.fold for p in parts})
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _folds(spark, folder):
    folds = D.backtest_folds(attack_labels(logs(spark, folder)))
    return folds.select("log_id", "fold", "split")


def _novelty(spark, folder):
    parts = D.novelty_split(D.with_protocol(_labels(logs(spark, folder))))
    counted = [
        part.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("logs"), F.sum("label").alias("anomalies"))
        for name, part in parts.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def _aligned(spark, folder):
    """One copy has shifted labels for some rows; exactly these rows are reported, from both sides."""
    one = written(_labels(logs(spark, folder)).select("log_id", "timestamp", "label"), "aligned")
    other = one.withColumn("label", F.when(F.col("log_id") % 500 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    return shown(D.misaligned(one, other, ["log_id", "timestamp", "label"]))


def _correlations(spark, folder):
    return shown(D.correlations(E.extract_features(logs(spark, folder)), FEATURES), 5)


def _drop(spark, folder):
    _, kept = D.drop_correlated(E.extract_features(logs(spark, folder)), FEATURES)
    return spark.createDataFrame([(c,) for c in FEATURES if c not in kept], "dropped string")


def _standardised(spark, folder):
    frame = written(E.extract_features(logs(spark, folder)).select("log_id", *FEATURES), "features")
    return shown(D.standardise(frame, D.scale_parameters(frame, FEATURES)).select("log_id", *FEATURES), 5)


def _quality(spark, folder):
    """Two spoiled columns are added so that every check has something to find."""
    frame = E.extract_features(logs(spark, folder)).select(
        "log_id", "status_code", "endpoint_length",
        F.when(F.col("log_id") % 10 > 0, F.col("response_time_log")).alias("response_time_log"),
        F.when(F.col("log_id") % 9 == 0, float("inf")).otherwise(F.col("is_night")).alias("is_night"),
        F.lit(3.0).alias("hour_of_day"),
    )
    return C.quality(frame, ["status_code", "endpoint_length", "response_time_log", "is_night", "hour_of_day"])


def spoiled(spark, folder):
    """All features; in its turn of 50 rows each column is once missing and once infinite."""
    turn = F.col("log_id") % 50
    return E.extract_features(logs(spark, folder)).select("log_id", *[
        F.when(turn == len(FEATURES) + i, float("inf")).when(turn != i, F.col(c)).alias(c) for i, c in enumerate(FEATURES)
    ])


def _quality_all(spark, folder):
    return C.quality(spoiled(spark, folder), FEATURES)


def _filled(spark, folder):
    """What missing and infinite features of an isolation forest's input are replaced by."""
    rows, turn = I.filled_inputs(written(spoiled(spark, folder), "spoiled"), FEATURES), F.col("log_id") % 50
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), turn.isin(i, len(FEATURES) + i).alias("was"), F.round(c, 6).alias("value")) for i, c in enumerate(FEATURES)
    ])
    return rows.select("log_id", F.inline(cells)).filter("was").drop("was")


def _balance(spark, folder):
    return shown(C.label_balance(_labels(logs(spark, folder))))


def _summary(spark, folder):
    return shown(D.summary(_labels(logs(spark, folder)), FEATURES))


def _describe(spark, folder):
    return shown(D.describe(E.extract_features(logs(spark, folder)), _DESCRIBED), 4)


def _top(spark, folder):
    return shown(D.label_correlations(dataset(spark, folder), FEATURES), 5)


def _sink(spark, folder):
    """Write the data set files and read the CSV back."""
    path = shared_folder(spark, "dataset")
    frame = written(dataset(spark, folder), "dataset-rows")
    T.write_dataset(frame.drop("data"), path, FEATURES, D.summary(frame, FEATURES))
    back = spark.read.option("header", True).csv(f"{path}/dataset.csv")
    return back.groupBy("protocol_split").agg(
        F.count(F.lit(1)).alias("logs"), F.sum(F.col("label").cast("int")).alias("anomalies"))


def _both_sets(spark, folder):
    """The whole data set pipeline, with the reference's number of columns and trees: rows, anomalies and columns of both data sets, and their scaled means."""
    rows = logs(spark, folder)
    found = B.build_datasets(rows, attack_members(rows), shared_folder(spark, "datasets"), days=90)
    frames = []
    for name, data, columns in (("forest", found.forest, found.selected), ("isolation", found.isolation, found.isolation_columns)):
        centred = F.lit(True)
        means = data.agg(F.count(F.lit(1)).alias("logs"), F.sum("label").alias("anomalies"), *[F.avg(c).alias(c) for c in columns])
        for c in columns:
            centred = centred & (F.abs(c) < 1e-6)
        frames.append(means.select(F.lit(name).alias("data_set"), "logs", "anomalies", F.lit(len(columns)).cast("long").alias("columns"), centred.alias("centred")))
    return frames[0].unionByName(frames[1])


_DESCRIBED = FEATURES

QUERIES = {
    "data_labels": _label,
    "data_protocol": _protocol,
    "data_protocol_counts": _protocol_counts,
    "data_holdout_split": _holdout,
    "data_backtest_folds": _folds,
    "data_fold_ranges": _fold_ranges,
    "data_novelty_split": _novelty,
    "data_misaligned_rows": _aligned,
    "data_correlations": _correlations,
    "data_drop_correlated": _drop,
    "data_standardised": _standardised,
    "data_quality": _quality,
    "data_quality_all": _quality_all,
    "model_filled_inputs": _filled,
    "data_label_balance": _balance,
    "data_summary": _summary,
    "data_describe": _describe,
    "data_label_correlations": _top,
    "data_set_files": _sink,
    "data_sets_of_both_models": _both_sets,
}

_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(CASE WHEN stddev_pop({a}) = 0 OR stddev_pop({b}) = 0 THEN NULL"
    f" ELSE covar_pop({a}, {b}) / stddev_pop({a}) / stddev_pop({b}) END, 5) AS r FROM f"
    for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]
)
_F_CTE = FEATURES_CTE + ",\nf AS MATERIALIZED (SELECT * FROM features)"
_SPOILED_CTE = _F_CTE + ",\ns AS MATERIALIZED (SELECT log_id, " + ", ".join(
    f"CASE WHEN log_id % 50 = {len(FEATURES) + i} THEN 'infinity'::DOUBLE WHEN log_id % 50 <> {i} THEN CAST({c} AS DOUBLE) END AS {c}" for i, c in enumerate(FEATURES)
) + " FROM f)"
_LABEL_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS \"column\", CASE WHEN stddev_pop({a}) = 0 THEN NULL ELSE corr({a}, label) END AS r FROM d"
    for a in FEATURES
)

_FOLDS = with_ctes(
    """, ends AS (SELECT fold, floor(total * f::DOUBLE) AS a, floor(total * f::DOUBLE) + floor(total * 0.2::DOUBLE) AS b,
 floor(total * f::DOUBLE) + floor(total * 0.2::DOUBLE) + floor(total * 0.1::DOUBLE) AS c, total
 FROM (SELECT DISTINCT total FROM dataset), (VALUES ('fold_1', 0.4), ('fold_2', 0.5), ('fold_3', 0.6)) v(fold, f)),
placed AS (SELECT log_id, fold, label, CASE WHEN pos < a THEN 'train' WHEN pos < b THEN 'validation' ELSE 'test' END AS split
 FROM dataset d, ends e WHERE pos < c AND c <= e.total)
SELECT log_id, fold, split FROM placed WHERE fold IN (SELECT fold FROM placed GROUP BY fold
 HAVING sum(label) FILTER (split = 'validation') > 0 AND sum(label) FILTER (split = 'test') > 0)""", ATTACK_CTE)

ORACLE = {
    "data_labels": with_ctes("SELECT log_id, label FROM dataset", DATASET_CTE),
    "data_protocol": with_ctes("SELECT log_id, scenario, protocol_role, protocol_split FROM dataset", DATASET_CTE),
    "data_protocol_counts": with_ctes(
        "SELECT protocol_role, protocol_split, count(*) AS logs FROM dataset GROUP BY ALL", DATASET_CTE),
    "data_holdout_split": with_ctes(
        """SELECT log_id, CASE WHEN pos < floor(total * 0.6::DOUBLE) THEN 'train' WHEN pos < floor(total * 0.8::DOUBLE) THEN 'validation'
 ELSE 'test' END AS split FROM dataset""", DATASET_CTE),
    "data_backtest_folds": _FOLDS,
    "data_fold_ranges": _FOLDS,
    "data_novelty_split": with_ctes(
        """SELECT protocol_split AS part, count(*) AS logs, CAST(sum(label) AS BIGINT) AS anomalies FROM dataset
WHERE protocol_split <> 'observed' GROUP BY 1""", DATASET_CTE),
    "data_misaligned_rows": with_ctes(
        f"""SELECT log_id, {sql_time('timestamp')}, label, 'left' AS side FROM dataset WHERE log_id % 500 = 0
UNION ALL SELECT log_id, {sql_time('timestamp')}, 1 - label, 'right' FROM dataset WHERE log_id % 500 = 0""", DATASET_CTE),
    "data_correlations": with_ctes(_PAIRS, _F_CTE),
    "data_drop_correlated": with_ctes(f'SELECT DISTINCT "right" AS dropped FROM ({_PAIRS}) WHERE abs(r) > 0.9', _F_CTE),
    "data_standardised": with_ctes(
        "SELECT log_id, " + ", ".join(
            f"round(({n} - avg({n}) OVER ()) / coalesce(nullif(stddev_pop({n}) OVER (), 0), 1), 5) AS {n}" for n in FEATURES) + " FROM features",
        FEATURES_CTE),
    "data_quality": with_ctes(
        """SELECT u.* FROM (SELECT count(*) FILTER (log_id % 10 = 0) AS a, count(*) FILTER (log_id % 9 = 0) AS b FROM features) c,
 LATERAL (VALUES ('status_code', 0::BIGINT, 0::BIGINT, false), ('endpoint_length', 0, 0, false), ('response_time_log', a, 0, false),
  ('is_night', 0, b, false), ('hour_of_day', 0, 0, true)) u("column", nulls, infinite, constant)""", FEATURES_CTE),
    "data_quality_all": with_ctes(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (s.{c} IS NULL OR isnan(s.{c})) AS nulls, count(*) FILTER (abs(s.{c}) = 'infinity'::DOUBLE) AS infinite,
 coalesce(min(s.{c}) = max(s.{c}), false) AS constant FROM s""" for c in FEATURES), _SPOILED_CTE),
    "model_filled_inputs": with_ctes(" UNION ALL ".join(
        f"""SELECT log_id, '{c}' AS "column", round((SELECT quantile_cont({c}, 0.5) FROM s WHERE abs({c}) <> 'infinity'::DOUBLE), 6) AS value
 FROM s WHERE log_id % 50 IN ({i}, {len(FEATURES) + i})""" for i, c in enumerate(FEATURES)), _SPOILED_CTE),
    "data_label_balance": with_ctes(
        "SELECT round(avg(label), 6) AS anomaly_rate, avg(label) > 0.01 AND avg(label) < 0.5 AS balanced FROM dataset", DATASET_CTE),
    "data_summary": with_ctes(
        f"""SELECT count(*) AS total_logs, {len(FEATURES)} AS total_features, CAST(sum(label) AS BIGINT) AS anomalies,
 round(avg(label), 6) AS anomaly_rate, strftime(min(timestamp), '%Y-%m-%d %H:%M:%S.%f') AS period_start,
 strftime(max(timestamp), '%Y-%m-%d %H:%M:%S.%f') AS period_end FROM dataset""", DATASET_CTE),
    "data_describe": with_ctes(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS rows, round(avg({c}), 4) + 0 AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
 round(max({c}), 4) AS max, round(quantile_cont({c}, 0.25), 4) AS q25, round(median({c}), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q75 FROM f"""
        for c in _DESCRIBED), _F_CTE),
    "data_label_correlations": with_ctes(
        f"""SELECT "column", round(r, 5) AS r FROM (SELECT * FROM ({_LABEL_PAIRS} UNION ALL SELECT 'label', 1.0)
 ORDER BY r DESC NULLS LAST, "column" LIMIT 10)""", DATASET_CTE + ",\nd AS MATERIALIZED (SELECT * FROM dataset)"),
    "data_sets_of_both_models": with_ctes(
        f"""SELECT data_set, logs, anomalies, CASE WHEN data_set = 'forest' THEN least(20, n) ELSE n END AS columns, true AS centred
FROM (SELECT count(*) AS logs, CAST(sum(label) AS BIGINT) AS anomalies FROM dataset),
 (SELECT {len(FEATURES)} - count(DISTINCT "right") AS n FROM ({_PAIRS}) WHERE abs(r) > 0.9), (VALUES ('forest'), ('isolation')) v(data_set)""",
        ATTACK_CTE + ",\nf AS MATERIALIZED (SELECT * FROM features)"),
    "data_set_files": with_ctes(
        "SELECT protocol_split, count(*) AS logs, CAST(sum(label) AS BIGINT) AS anomalies FROM dataset GROUP BY 1", DATASET_CTE),
}
