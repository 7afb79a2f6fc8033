"""From features to a training data set: labels, protocol, splits, scaling, correlations."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import micros
from tidewatch.operators.order_stats import cut_scalar, minute_cell, quantiles, rank_cuts
from tidewatch.session import written

# Scenarios by protocol role.
KNOWN_ATTACKS = ["brute_force", "rate_abuse", "offhours"]
UNKNOWN_ATTACKS = ["scanning", "sql_injection"]


def label_logs(features: DataFrame, members: DataFrame) -> DataFrame:
    """label 1 for logs named by an alert, else 0. ``members`` holds (alert_id, log_id) rows."""
    flagged = members.select("log_id").distinct().withColumn("_flag", F.lit(1))
    return features.join(flagged, "log_id", "left").withColumn("label", F.coalesce("_flag", F.lit(0))).drop("_flag")


def check_labels(labelled: DataFrame) -> float:
    """The anomaly rate; no anomaly at all is an error, less than 1 % a warning."""
    rate = labelled.agg(F.avg("label")).first()[0]
    if not rate:
        raise ValueError("no anomalies among the labels; run the rules over more history first")
    if rate < 0.01:
        warnings.warn(f"only {rate:.2%} of the rows are anomalies", stacklevel=2)
    return rate


def with_scenario(dataset: DataFrame) -> DataFrame:
    """The scenario from the JSON column ``data``, in its place."""
    scenario = F.coalesce(F.get_json_object("data", "$.scenario"), F.lit("observed"))
    return dataset.withColumn("scenario", scenario).drop("data")


def with_protocol(dataset: DataFrame) -> DataFrame:
    """Add protocol_role and protocol_split, and scenario from the JSON column ``data`` if it is not there yet.

    Normal rows are cut by the 70 % and 85 % quantiles of their own times. The rows are written first: they are read for the
    quantiles and again for the result, and what made them would run twice.
    """
    if "scenario" not in dataset.columns:
        dataset = with_scenario(dataset.withColumn("_data", F.col("data"))).withColumnRenamed("_data", "data")
    rows = written(dataset, "protocol-rows").withColumn("_at", micros("timestamp"))
    normal_times = rows.filter(F.col("scenario") == "normal").select("_at")
    cuts = quantiles(normal_times, "_at", [0.70, 0.85], cell=minute_cell)
    cut = cuts.agg(F.map_from_entries(F.collect_list(F.struct("prob", "quantile")))).scalar()
    rows = rows.withColumn("_cuts", cut)
    known, unknown = F.col("scenario").isin(KNOWN_ATTACKS), F.col("scenario").isin(UNKNOWN_ATTACKS)
    normal = F.col("scenario") == "normal"
    role = (
        F.when(normal, "baseline_normal").when(known, "known_attack").when(unknown, "unknown_attack").otherwise("observed")
    )
    split = (
        F.when(normal & (F.col("_at") <= F.col("_cuts")[F.lit(0.70)]), "baseline_train")
        .when(normal & (F.col("_at") <= F.col("_cuts")[F.lit(0.85)]), "threshold_validation")
        .when(normal, "novelty_test")
        .when(known, "threshold_validation")
        .when(unknown, "novelty_test")
        .otherwise("observed")
    )
    return rows.withColumn("protocol_role", role).withColumn("protocol_split", split).drop("_at", "_cuts")


def novelty_split(dataset: DataFrame) -> dict[str, DataFrame]:
    """The three protocol parts; an empty part is an error."""
    names = ["baseline_train", "threshold_validation", "novelty_test"]
    counts = {r["protocol_split"]: r["count"] for r in dataset.groupBy("protocol_split").count().collect()}
    missing = [name for name in names if not counts.get(name)]
    if missing:
        raise ValueError(f"the novelty protocol has no rows in {', '.join(missing)}")
    return {name: dataset.filter(F.col("protocol_split") == name) for name in names}


def _whole(fraction: float) -> Column:
    """int(rows * fraction)"""
    return F.floor(F.col("total") * F.lit(float(fraction)))


def _row_time(dataset: DataFrame) -> DataFrame:
    return dataset.withColumn("_row", F.struct(micros("timestamp").alias("major"), F.col("log_id").cast("bigint").alias("minor")))


def _cuts(dataset: DataFrame, ranks: dict[str, Column]) -> Column:
    return cut_scalar(rank_cuts(dataset, micros("timestamp"), F.col("log_id"), ranks))


def holdout_split(dataset: DataFrame, train: float = 0.6, validation: float = 0.2) -> DataFrame:
    """Add ``split``: the first rows in time order train, the next validate, the rest test.

    The two rows at the cuts are looked up once; every other row only compares itself with them.
    """
    cuts = _cuts(dataset, {"train": _whole(train), "validation": _whole(train + validation)})
    rows = _row_time(dataset).withColumn("_cuts", cuts)

    def before(name: str) -> Column:
        at = F.try_element_at("_cuts", F.lit(name))
        return at.isNull() | (F.col("_row") < at)

    split = F.when(before("train"), "train").when(before("validation"), "validation").otherwise("test")
    return rows.withColumn("split", split).drop("_row", "_cuts")


FOLD_STARTS = [0.4, 0.5, 0.6]


def backtest_folds(
    dataset: DataFrame, validation: float = 0.2, test: float = 0.1, starts: Sequence[float] = tuple(FOLD_STARTS)
) -> DataFrame:
    """One row per (row, fold it takes part in) with ``fold`` and ``split``.

    Folds that would end past the last row, or whose validation or test part has no positive label,
    are left out. Use ``require_folds`` to make "no fold at all" an error.
    """
    ranks, past = {}, {}
    for i, start in enumerate(starts, 1):
        train_end = _whole(start)
        validation_end = train_end + _whole(validation)
        test_end = validation_end + _whole(test)
        # Ranks of the last rows, so that a fold ending at the very last row still has its cut.
        ranks |= {f"{i}_train": train_end - 1, f"{i}_validation": validation_end - 1, f"{i}_test": test_end - 1}
    rows = _row_time(dataset).withColumn("_cuts", _cuts(dataset, ranks))

    def until(name: str) -> Column:
        at = F.try_element_at("_cuts", F.lit(name))
        return at.isNotNull() & (F.col("_row") <= at)

    entries = []
    for i in range(1, len(starts) + 1):
        fits = F.try_element_at("_cuts", F.lit(f"{i}_test")).isNotNull()
        part = F.when(until(f"{i}_train"), "train").when(until(f"{i}_validation"), "validation").when(until(f"{i}_test"), "test")
        entries.append(F.when(fits & part.isNotNull(), F.struct(F.lit(f"fold_{i}").alias("fold"), part.alias("split"))))
    folds = rows.withColumn("_in", F.explode(F.array_compact(F.array(*entries)))).select(
        *dataset.columns, F.col("_in.fold").alias("fold"), F.col("_in.split").alias("split")
    )
    usable = (
        folds.groupBy("fold")
        .agg(
            F.sum(F.when(F.col("split") == "validation", F.col("label")).otherwise(0)).alias("v"),
            F.sum(F.when(F.col("split") == "test", F.col("label")).otherwise(0)).alias("t"),
        )
        .filter((F.col("v") > 0) & (F.col("t") > 0))
        .select("fold")
    )
    return folds.join(usable, "fold", "left_semi")


def require_folds(folds: DataFrame) -> list[str]:
    names = sorted(r["fold"] for r in folds.select("fold").distinct().collect())
    if not names:
        raise ValueError("no walk-forward fold has enough anomalies")
    return names


@dataclass(frozen=True)
class FoldPart:
    """Rows of one fold and split: those after one row, up to another one, both given as (micros, log_id)."""

    fold: str
    split: str
    after: tuple[int, int] | None
    until: tuple[int, int]

    def holds(self, kind: str = "timestamp") -> Column:
        """The range as a filter; its time bounds, of the time column's type, reach the scan of stored rows, which are sorted by time."""
        time, row = F.col("timestamp"), F.struct(micros("timestamp"), F.col("log_id").cast("bigint"))

        def at(micro: int) -> Column:
            return F.timestamp_micros(F.lit(micro)).cast(kind)

        def of(bound: tuple[int, int]) -> Column:
            return F.struct(F.lit(bound[0]).cast("bigint"), F.lit(bound[1]).cast("bigint"))

        inside = (time <= at(self.until[0])) & (row <= of(self.until))
        return inside if self.after is None else inside & (time >= at(self.after[0])) & (row > of(self.after))


def by_time(dataset: DataFrame, name: str = "by-time") -> DataFrame:
    """The rows stored once, sorted by time, so that a range of time reads its own files and row groups. Written."""
    return written(dataset.repartitionByRange("timestamp", "log_id").sortWithinPartitions("timestamp", "log_id"), name)


def fold_ranges(
    dataset: DataFrame, validation: float = 0.2, test: float = 0.1, starts: Sequence[float] = tuple(FOLD_STARTS)
) -> list[FoldPart]:
    """The walk-forward folds of ``backtest_folds`` as ranges of rows: three per fold, whatever the rows; no row is copied.

    Without any fold that has positive labels in both judged parts this is an error.
    """
    ranks: dict[str, Column] = {}
    for i, start in enumerate(starts, 1):
        end = _whole(start)
        for part, more in (("train", None), ("validation", validation), ("test", test)):
            end = end if more is None else end + _whole(more)
            ranks[f"{i}_{part}"] = end - 1
    cuts = {r["cut"]: (r["major"], r["minor"]) for r in rank_cuts(dataset, micros("timestamp"), F.col("log_id"), ranks).collect()}
    parts = []
    for i in range(1, len(starts) + 1):
        names = [f"{i}_{part}" for part in ("train", "validation", "test")]
        if f"{i}_test" in cuts:
            ends = [None, *[cuts.get(n) for n in names]]
            parts += [FoldPart(f"fold_{i}", n[2:], a, b) for n, a, b in zip(names, ends, ends[1:]) if b is not None]
    judged = [p for p in parts if p.split != "train"]
    kind = dataset.schema["timestamp"].dataType.simpleString()
    found = dataset.agg(*[F.count_if(p.holds(kind) & (F.col("label") > 0)).alias(f"{p.fold} {p.split}") for p in judged]).first() if judged else {}
    usable = {p.fold for p in judged} - {p.fold for p in judged if not found[f"{p.fold} {p.split}"]}
    if not usable:
        raise ValueError("no walk-forward fold has enough anomalies")
    return [p for p in parts if p.fold in usable]


def fold_rows(dataset: DataFrame, parts: Sequence[FoldPart], fold: str, splits: Sequence[str]) -> DataFrame:
    """Rows of some splits of a fold, with ``split``."""
    chosen = [p for p in parts if p.fold == fold and p.split in splits]
    kind = dataset.schema["timestamp"].dataType.simpleString()
    split, inside = F.lit(None).cast("string"), F.lit(False)
    for p in chosen:
        split, inside = F.when(p.holds(kind), p.split).otherwise(split), inside | p.holds(kind)
    return dataset.filter(inside).withColumn("split", split)


def misaligned(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of either data set without an equal row in the other, as often as they are more there; none when they are aligned.

    Equal rows are counted once for both directions.
    """
    both = left.select(*columns, F.lit(1).alias("_n")).unionByName(right.select(*columns, F.lit(-1).alias("_n")))
    more = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    side = F.when(F.col("_n") > 0, "left").otherwise("right")
    return more.select(*columns, side.alias("side"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_n"))).alias("_i")).drop("_i")


def check_aligned(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> None:
    if not misaligned(left, right, columns).isEmpty():
        raise ValueError("the two data sets do not hold the same rows")


def scale_parameters(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column (deviation 1 where it is 0): one row to the driver."""
    parts = [e for c in columns for e in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]
    row = df.agg(*parts).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def standardise(df: DataFrame, parameters: dict[str, tuple[float, float]]) -> DataFrame:
    """(value - mean) / deviation for the given columns."""
    return df.withColumns({c: (F.col(c) - F.lit(mean)) / F.lit(std) for c, (mean, std) in parameters.items()})


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(left, right, r) for every pair i < j in column order; null where a column is constant.

    Spark sums one small matrix per task and merges the matrices in a tree, so the cost does not
    depend on the number of pairs. Values are centred first, so large means cost no precision.
    The columns must hold no nulls. They are written first, since they are read several times.
    """
    df = written(df.select(*columns), "correlated")
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    centred = df.select([(F.col(c) - F.lit(means[c] or 0.0)).alias(c) for c in columns])
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(centred)
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    pairs = [
        (columns[i], columns[j], float(matrix[i, j]) if matrix[i, j] == matrix[i, j] else None)
        for i in range(len(columns)) for j in range(i + 1, len(columns))
    ]
    return df.sparkSession.createDataFrame(pairs, "left string, right string, r double")


def correlated_columns(pairs: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> list[str]:
    """Columns strongly correlated with an earlier one (also if that one is dropped itself)."""
    found = {r["right"] for r in pairs.filter(F.abs("r") > threshold).select("right").distinct().collect()}
    return [c for c in columns if c in found]


def drop_correlated(df: DataFrame, columns: Sequence[str], threshold: float = 0.9) -> tuple[DataFrame, list[str]]:
    dropped = correlated_columns(correlations(df, columns), columns, threshold)
    return df.drop(*dropped), [c for c in columns if c not in dropped]


def summary(dataset: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: rows, features, anomalies, rate, period."""
    return dataset.agg(
        F.count(F.lit(1)).alias("total_logs"),
        F.lit(len(features)).alias("total_features"),
        F.sum("label").alias("anomalies"),
        F.avg("label").alias("anomaly_rate"),
        F.min("timestamp").alias("period_start"),
        F.max("timestamp").alias("period_end"),
    )


def protocol_counts(dataset: DataFrame) -> DataFrame:
    return dataset.groupBy("protocol_role", "protocol_split").agg(F.count(F.lit(1)).alias("logs"))


def describe(dataset: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows, mean, std, min, q25, median, q75, max) per column.

    Quartiles are exact; the columns are stacked as (column, value) and counted per value first.
    """
    basics = []
    for i, c in enumerate(columns):
        basics += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                   F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}")]
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("rows"), F.col(f"m{i}").alias("mean"),
                 F.col(f"s{i}").alias("std"), F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max"))
        for i, c in enumerate(columns)
    ])
    stacked = dataset.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])))
    quarter = quantiles(stacked.withColumnRenamed("value", "held"), "held", [0.25, 0.5, 0.75], by=["column"])
    wide = quarter.groupBy("column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for n, p in (("q25", 0.25), ("median", 0.5), ("q75", 0.75))
    ])
    return dataset.agg(*basics).select(F.inline(rows)).join(wide, "column", "left")


def label_correlations(dataset: DataFrame, columns: Sequence[str], top: int = 10) -> DataFrame:
    """The columns most correlated with the label, the label itself first (as r = 1)."""
    pairs = correlations(dataset.withColumn("label", F.col("label").cast("double")), [*columns, "label"])
    own = pairs.filter(F.col("right") == "label").select(F.col("left").alias("column"), "r")
    label = dataset.agg(F.lit("label").alias("column"), F.lit(1.0).alias("r"))
    return own.unionByName(label).orderBy(F.desc_nulls_last("r"), "column").limit(top)
