"""Running sums, previous rows, alarms and trailing increases against plain loops, over days, years and single logs of 1970."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from tidewatch.operators.ordered import previous, running_sum
from tidewatch.plans import slo as L

DAY = 86400


def test_running_sum_and_previous(spark):
    rng = random.Random(1)
    times = sorted({rng.choice([0, 5, 400, 4096, 9000, -3, 30_000]) * DAY + rng.randint(-2, 3) * 40_000 for _ in range(60)})
    rows = [(g, t, rng.randint(-3, 9)) for g in ("a", None, "b") for t in times if rng.random() < 0.7]
    frame = spark.createDataFrame(rows, "g string, at long, n int").repartition(4)
    sums = {(r.g, r.at): r.total for r in running_sum(frame, "at", "n", "total", ["g"]).collect()}
    before = {(r.g, r.at): r.before for r in previous(frame, "at", ["at", "n"], ["g"]).collect()}
    assert len(sums) == len(before) == len(rows)
    for g in ("a", None, "b"):
        total, last = 0, None
        for _, at, n in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            total += n
            assert sums[g, at] == total and (before[g, at] == last if last else before[g, at] is None)
            last = (at, n)


def test_no_window_lacks_a_partition(spark):
    """Windows of both scans have partition keys, also without groups."""
    rows = spark.createDataFrame([(1, 2)], "at long, n long")
    for found in (running_sum(rows, "at", "n", "total"), previous(rows, "at", ["n"])):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert len(windows) >= 3 and all("_day" in w or "_block" in w or "_all" in w for w in windows)


def grid_alarms(logs, alerts, quality, limit):
    """Minute by minute, as the definition has it."""
    minute = lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp()) // 60 * 60
    exact = lambda t: t.replace(tzinfo=dt.timezone.utc).timestamp()
    per_log, per_alert = Counter(map(minute, logs)), Counter(map(minute, alerts))
    first, last = min(per_log), max(per_log)
    values, newest, f1 = {}, 0, None
    for t, v in sorted(quality):
        values[minute(t)] = v
    newest_of = {}
    for t in logs:
        newest_of[minute(t)] = max(newest_of.get(minute(t), 0), exact(t))
    states = {n: [] for n in L.HOLD_MINUTES}
    for m in range(first, last + 60, 60):
        newest, f1 = max(newest, newest_of.get(m, 0)), values.get(m, f1)
        states["high_alert_rate"].append((m, sum(per_alert[x] for x in range(max(first, m - 540), m + 60, 60)) > limit))
        states["no_logs_processed"].append((m, sum(per_log[x] for x in range(m - 840, m + 60, 60)) == 0))
        states["model_f1_low"].append((m, f1 is not None and 0 < f1 < L.F1_TARGET))
        states["data_freshness_high"].append((m, m + 60 - newest > L.FRESHNESS_LIMIT))
    found = set()
    for name, rows in states.items():
        run = []
        for m, active in [*rows, (None, False)]:
            if active:
                run.append(m)
                continue
            hold = L.HOLD_MINUTES[name] * 60
            if run and run[-1] >= run[0] + hold:
                found.add((name, run[0], run[0] + hold, run[-1]))
            run = []
    return found


def test_alarms_equal_the_grid(spark):
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1, 20)
    at = lambda minutes: start + dt.timedelta(minutes=minutes)
    for seed in range(3):
        logs, now = [], 0.0
        while now < 2500:  # over two midnights
            now += rng.choice([0.2, 1, 3, 6, 20, 45, 120])
            logs.append(at(now))
        alerts = [at(rng.gauss(rng.choice([100, 240, 250, 900, 1700]), 12)) for _ in range(220)] + [at(-30), at(4000)]
        quality = [(at(rng.uniform(-50, 2600)), rng.choice([0.0, 0.5, 0.7, 0.76, 0.9])) for _ in range(40)] + [(at(500), None)]
        frames = [spark.createDataFrame([(t,) for t in x], "timestamp timestamp") for x in (logs, alerts)]
        frames.append(spark.createDataFrame(quality, "timestamp timestamp, value double"))
        quality = [(t, v) for t, v in quality if v is not None]
        got = {tuple(r) for r in L.alarms(*frames, alert_limit=8).collect()}
        assert got == grid_alarms(logs, alerts, quality, 8) and {g[0] for g in got} == set(L.HOLD_MINUTES), seed


def test_one_log_from_1970(spark):
    """Half a century of silence is one episode of two alarms."""
    times = [dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 1)]
    logs = spark.createDataFrame([(t,) for t in times], "timestamp timestamp")
    nothing = logs.limit(0)
    got = {r.alarm: (r.pending_since, r.last_active) for r in L.alarms(logs, nothing, nothing.withColumn("value", F.lit(0.5))).collect()}
    end = int(times[1].replace(tzinfo=dt.timezone.utc).timestamp()) - 60
    assert got == {"no_logs_processed": (900, end), "data_freshness_high": (300, end)}
    assert L.alarms(nothing, nothing, nothing.withColumn("value", F.lit(0.5))).collect() == []


def test_trailing_increase(spark):
    rng = random.Random(2)
    base = 1_700_000_000 // 300 * 300
    alerts = [(base + rng.choice([0, 300, 301, 4000, 90_000, rng.uniform(0, 200_000)]), rng.choice(["x", "y", None])) for _ in range(80)]
    frame = spark.createDataFrame([(dt.datetime.fromtimestamp(t, dt.timezone.utc).replace(tzinfo=None), k) for t, k in alerts], "timestamp timestamp, kind string")
    for seconds in (3600, 86400):
        want = {}
        for step in range(base - 300, base + 300_000, 300):
            for kind in ("x", "y", None):
                n = sum(step - seconds < t <= step and k == kind for t, k in alerts)
                if n:
                    want[step, kind] = n
        got = L.trailing_increase(frame, "kind", seconds).collect()
        assert {(r["at"], r.kind): r.increase for r in got} == want and len(got) == len(want)
