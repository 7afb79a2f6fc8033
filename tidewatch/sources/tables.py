"""Stored tables: reading, appending, first-score-wins appending and data set files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.functions.columns import recent
from tidewatch.session import discard, scratch, shared_folder, written
from tidewatch.sources.commits import CommitLog
from tidewatch.sources.lines import with_ids


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, kind: str = "parquet", **options) -> DataFrame:
    """A table of files: parquet, orc, json or csv."""
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """A database table, read in parallel ranges of a numeric key."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=parts, **options)
        .load()
    )


def append_logs(logs: DataFrame, path: str, rebalance: bool = True) -> None:
    """Append log rows, laid out by day so that time filters skip whole folders.

    Rows are first rebalanced by day: adaptive execution merges small days into one task and splits a
    day that holds much of the data over several, so files come out neither tiny nor huge. Input that
    is already in day order can skip that shuffle. Rows without ids are numbered on from the largest id given so far, which
    the table's commit log tells without reading the table; see ``commits``.
    """
    def store(rows: DataFrame) -> None:
        rows = rows.withColumn("date", F.to_date("timestamp"))
        (rows.hint("rebalance", "date") if rebalance else rows).write.mode("append").partitionBy("date").parquet(path)

    spark = logs.sparkSession
    log = CommitLog(spark, path)
    if "id" in logs.columns:
        log.forget()
        store(logs)
        return
    with scratch(spark):
        rows = with_ids(logs)
        counts = rows.groupBy(F.to_date("timestamp").cast("string").alias("day")).count().collect()  # one row per day
        days, total = sorted(r["day"] for r in counts if r["day"] is not None), sum(r["count"] for r in counts)
        log.append(total, days, lambda before: store(rows.withColumn("id", F.col("id") + F.lit(before))), lambda: last_id(spark, path))


def last_id(spark: SparkSession, path: str) -> int:
    """The largest id of a stored table, 0 without one: from its commit log, else by a scan of the ids."""
    if (newest := CommitLog(spark, path).newest()) is not None and newest.known:
        return newest.last_id
    if not exists(spark, path) or "id" not in (stored := spark.read.parquet(path)).columns:
        return 0
    return stored.agg(F.max("id")).first()[0] or 0


def load_logs(spark: SparkSession, path: str, days: int = 90, as_of: Column | None = None) -> DataFrame:
    """The last ``days`` days of stored logs; raises when there are none."""
    rows = lookback(spark.read.parquet(path), days, as_of)
    if rows.isEmpty():
        raise ValueError(f"no logs in the last {days} days")
    return rows


def lookback(logs: DataFrame, days: int = 90, as_of: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` days; the day column, where there is one, is pruned too."""
    return recent(logs, f"{days} days", as_of)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def append_first_scores(scores: DataFrame, path: str) -> None:
    """Append scores of logs not scored before; an already stored score stays as it is.

    Of several new scores of one log the largest final score counts (of equal ones the first by severity).
    The new scores are written once to the shared folder, so they are not computed again for the
    comparison, and only stored scores in their id range are compared: ids grow with time, so the
    range skips almost all of a long table.
    """
    spark = scores.sparkSession
    rest = [c for c in scores.columns if c != "log_id"]
    order = [F.col(c) for c in ("final_score", "rule_score", "ml_score") if c in rest]
    best = F.max_by(F.struct(*rest), F.struct(*order, F.xxhash64(*rest)))
    folder = shared_folder(spark, "fresh-scores")
    scores.groupBy("log_id").agg(best.alias("_best")).select("log_id", "_best.*").select(*scores.columns).write.parquet(folder)
    fresh = spark.read.schema(scores.schema).parquet(folder)
    if exists(spark, path):
        low, high = fresh.agg(F.min("log_id"), F.max("log_id")).first()
        if low is None:
            discard(spark, folder)
            return
        stored = spark.read.parquet(path).filter(F.col("log_id").between(low, high))
        fresh = unscored(fresh, stored)
    fresh.write.mode("append").parquet(path)
    discard(spark, folder)


def unscored(scores: DataFrame, stored: DataFrame) -> DataFrame:
    return scores.join(stored.select("log_id"), "log_id", "left_anti")


def write_dataset(dataset: DataFrame, folder: str, features: list[str], summary: DataFrame) -> None:
    """The training data set as parquet and CSV, its feature list as text, its summary as JSON."""
    spark = dataset.sparkSession
    dataset.write.mode("overwrite").parquet(f"{folder}/dataset.parquet")
    dataset.write.mode("overwrite").option("header", True).csv(f"{folder}/dataset.csv")
    spark.createDataFrame([(name,) for name in features], "value string").coalesce(1).write.mode("overwrite").text(
        f"{folder}/features.txt"
    )
    summary.coalesce(1).write.mode("overwrite").json(f"{folder}/summary.json")
