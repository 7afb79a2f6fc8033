"""Headline timings over the access logs of $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

The logs are written as combined-format lines first. Ingestion is timed from these lines to the
stored day-partitioned table; all further queries read that table. Each query runs twice and the
second run counts, so JVM start-up and code generation are left out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import dataset as D
from tidewatch.operators import features as E
from tidewatch.operators import forest as I
from tidewatch.operators import rules as R
from tidewatch.operators import scoring as S
from tidewatch.plans import queries as Q
from tidewatch.plans import slo as L
from tidewatch.schemas import FEATURES
from tidewatch.session import prepare, shared_folder
from tidewatch.sources import lines as N
from tidewatch.sources import tables as T
from tidewatch.sources.adapter import access_logs

WINDOW = "30 days"


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = prepare(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidewatch-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = shared_folder(spark, "bench")

    source = access_logs(spark, folder)
    line = F.concat(
        "ip", F.lit(" - - ["), F.date_format("timestamp", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "'), "method", F.lit(" "),
        F.replace("endpoint", F.lit(" "), F.lit("%20")), F.lit(' HTTP/1.1" '), F.col("status").cast("string"),
        F.lit(' 512 "-" "'), F.coalesce("user_agent", F.lit("-")), F.lit('"'),
        F.coalesce(F.concat(F.lit(" "), F.round(F.col("response_time_ms") / 1000, 6).cast("decimal(12,6)").cast("string")), F.lit("")),
    )
    source.select(line.alias("value")).repartition(int(cpus)).write.text(f"{work}/lines")

    timings: dict[str, float] = {}

    def timed(name: str, job) -> None:
        for run in range(2):
            start = time.perf_counter()
            job(run)
            timings[name] = round(time.perf_counter() - start, 3)

    def done(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def ingest(run: int) -> None:
        rows = N.with_ids(N.normalised(N.parse_lines(N.read_lines(spark, f"{work}/lines"), "apache_combined")))
        T.append_logs(rows, f"{work}/raw_logs_{run}")

    timed("ingest_parse_write", ingest)
    logs = spark.read.parquet(f"{work}/raw_logs_1")
    count = logs.count()
    now = F.lit(logs.agg(F.max("timestamp")).first()[0])

    for rule in R.RULES:
        timed(f"rule_{rule.name}", lambda run, r=rule: done(R.run_rules(logs, WINDOW, [r], now)))
    timed("rule_set_one_pass", lambda run: done(R.run_rules(logs, WINDOW, as_of=now)))

    timed("rule_set_one_day", lambda run: done(R.run_rules(logs, "1 day", as_of=now)))

    rules = [R.rule("brute_force"), R.rule("sql_injection"), R.rule("path_traversal")]
    alerts = R.run_rules(logs, WINDOW, rules, now)
    members = R.alert_logs(logs, alerts, WINDOW, rules, now)
    timed("alert_logs", lambda run: done(members))

    timed("feature_baselines", lambda run: E.baselines(logs))
    base = E.baselines(logs)
    timed("feature_pass", lambda run: E.extract_features(logs, base).write.mode("overwrite").parquet(f"{work}/features_{run}"))
    features = spark.read.parquet(f"{work}/features_1")

    data = D.label_logs(features, members)
    data.write.parquet(f"{work}/data")
    data = spark.read.parquet(f"{work}/data")
    timed("holdout_split", lambda run: done(D.holdout_split(data)))
    timed("correlation_matrix", lambda run: D.correlations(data, FEATURES))
    models = {}

    def fit(run: int) -> None:
        models["isolation"] = I.fit_isolation(data.filter("label = 0"), FEATURES)

    timed("isolation_fit_200_trees", fit)
    timed("isolation_score", lambda run: done(I.isolation_decision(data, models["isolation"])))
    decided = I.isolation_decision(data, models["isolation"]).select("log_id", "decision")
    decided.write.parquet(f"{work}/decided")
    decided = spark.read.parquet(f"{work}/decided")
    timed("hybrid_scores", lambda run: done(S.hybrid_scores(decided, members)))

    timed("stress_count_recent", lambda run: Q.recent_load(logs, now).collect())
    timed("stress_top_addresses", lambda run: Q.top_addresses(logs).collect())
    timed("search_logs", lambda run: Q.search_logs(logs, 720, endpoint="search", text="union", as_of=now).collect())
    timed("latency_p95", lambda run: done(L.latency_quantile(logs)))

    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "log_rows": count,
        "ingest_rows_per_sec": round(count / timings["ingest_parse_write"]),
        "score_rows_per_sec": round(count / timings["isolation_score"]),
        "feature_rows_per_sec": round(count / timings["feature_pass"]),
    }))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
