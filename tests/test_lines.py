from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import text as X
from tidewatch.sources import lines as L
from tidewatch.sources import tables as T

FULL = (
    '192.168.1.10 - - [10/Oct/2000:13:55:36 -0700] "GET /api/items?id=1 HTTP/1.1" 200 2326 '
    '"https://example.com" "Mozilla/5.0" 0.123'
)


def parse(spark, lines, log_format):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "n int, value string")
    return [r.asDict() for r in L.parse_lines(frame, log_format).orderBy("n").collect()]


def test_combined_line(spark):
    row = parse(spark, [FULL], "apache_combined")[0]
    assert row["parsed"] and row["log_type"] == "apache_access"
    assert row["timestamp"] == dt.datetime(2000, 10, 10, 20, 55, 36)
    assert (row["ip"], row["method"], row["endpoint"], row["protocol"]) == ("192.168.1.10", "GET", "/api/items?id=1", "HTTP/1.1")
    assert (row["status"], row["bytes_sent"], row["response_time_ms"]) == (200, 2326, 123.0)
    assert (row["referrer"], row["user_agent"]) == ("https://example.com", "Mozilla/5.0")


@pytest.mark.parametrize(
    "extra, expected",
    [("", None), (" -", None), (' "-" 0.5', 500.0), (" 250", 250.0), (" 250000", 250.0), (" rt=1 0.25 7", 250.0), (" 1d", None)],
)
def test_request_time(spark, extra, expected):
    line = '1.1.1.1 - - [10/Oct/2000:13:55:36 +0000] "GET / HTTP/1.1" 200 1 "-" "-"' + extra
    row = parse(spark, [line], "apache_combined")[0]
    assert row["response_time_ms"] == expected
    assert row["user_agent"] is None and row["referrer"] is None


def test_request_line_words(spark):
    line = '1.1.1.1 - - [1/Oct/2000:13:55:36 +02:00] "{}" - -'
    rows = parse(spark, [line.format(r) for r in ("GET /a HTTP/1.1 x", "GET /a", "/a", "-", "")], "apache_combined")
    assert [(r["method"], r["endpoint"], r["protocol"]) for r in rows] == [
        ("GET", "/a", "HTTP/1.1"), ("GET", "/a", None), (None, "/a", None), (None, None, None), (None, None, None)]
    assert rows[0]["status"] is None and rows[0]["bytes_sent"] is None
    assert rows[0]["timestamp"] == dt.datetime(2000, 10, 1, 11, 55, 36)


def test_empty_and_absent_agent_differ(spark):
    head = '1.1.1.1 - - [10/Oct/2000:13:55:36 +0000] "GET / HTTP/1.1" 200 1'
    rows = parse(spark, [head, head + ' "" ""'], "apache_combined")
    assert [r["user_agent"] for r in rows] == [None, ""]


def test_bad_lines_fail(spark):
    bad = ["bad apache line", "", "   ", '1.1.1.1 - - [99/Foo/2000:13:55:36 +0000] "GET / HTTP/1.1" 200 1']
    assert not any(r["parsed"] for r in parse(spark, bad, "apache_combined"))


def test_json_lines(spark):
    lines = [
        '{"timestamp": "2024-01-01T00:00:00Z", "ip": "1.1.1.1", "status": 200, "response_time_ms": 1.5, "extra": {"a": [1]}}',
        "not-json", "[1, 2]", '[{"ip": "1.1.1.1"}]', '{"ip": "x"} tail', '{"ip": "x"}, {"ip": "y"}', "{}", "{ }", "5", "",
        "  {\"ip\": \"2.2.2.2\"}  ", "{'ip': 'x'}", '{"ip": "x"',
    ]
    rows = parse(spark, lines, "json")
    assert [r["parsed"] for r in rows] == [True] + [False] * 9 + [True, False, False]
    assert rows[0]["status"] == 200 and rows[0]["response_time_ms"] == 1.5
    assert rows[0]["timestamp"] == dt.datetime(2024, 1, 1)


def test_auto_takes_both(spark):
    rows = parse(spark, ['{"ip": "1.1.1.1"}', FULL, "neither", "{broken"], "auto")
    assert [r["parsed"] for r in rows] == [True, True, False, False]
    assert [r["source_format"] for r in rows] == [None, "apache_combined", None, None]


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        parse(spark, ["x"], "csv")


def test_normalise_defaults_and_report(spark):
    lines = ['{"ip": "1.1.1.1", "timestamp": "soon"}', '{"timestamp": "2024-05-01T10:00:00+02:00", "log_type": "app"}', "x"]
    parsed = L.parse_lines(spark.createDataFrame([(v,) for v in lines], "value string"), "json")
    rows = L.normalised(parsed, F.lit("2024-02-01 00:00:00").cast("timestamp")).orderBy("log_type").collect()
    assert [(r["log_type"], r["timestamp"]) for r in rows] == [
        ("app", dt.datetime(2024, 5, 1, 8)), ("web", dt.datetime(2024, 2, 1))]
    assert rows[1]["data"] == lines[0]
    report = L.ingestion_report(parsed).first()
    assert (report["total"], report["ingested"], report["failed"]) == (3, 2, 1)
    assert [r[0] for r in L.failed_lines(parsed).collect()] == ["x"]


def test_combined_record_is_kept_whole(spark):
    parsed = L.parse_lines(spark.createDataFrame([(FULL,)], "value string"), "apache_combined")
    data = L.normalised(parsed).select(F.get_json_object("data", "$.protocol"), F.get_json_object("data", "$.bytes_sent")).first()
    assert tuple(data) == ("HTTP/1.1", "2326")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(1950, 1, 1), max_value=dt.datetime(2100, 1, 1)), min_size=1, max_size=20))
def test_iso_timestamps_survive(spark, times):
    frame = spark.createDataFrame([(i, t.isoformat() + "+00:00") for i, t in enumerate(times)], "n int, s string")
    micros = [r[0] for r in frame.orderBy("n").select(F.unix_micros(L.iso_time(F.col("s")))).collect()]
    epoch = dt.datetime(1970, 1, 1)
    assert micros == [(t - epoch) // dt.timedelta(microseconds=1) for t in times]


def test_append_and_load(spark, tmp_path):
    parsed = L.parse_lines(spark.createDataFrame([(FULL,), (FULL.replace("10/Oct", "12/Oct"),)], "value string"), "apache_combined")
    path = str(tmp_path / "raw")
    T.append_logs(L.normalised(parsed), path)
    T.append_logs(L.normalised(parsed), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]
    assert T.load_logs(spark, path, 1).count() == 2
    assert T.load_logs(spark, path, 90, F.lit("2000-10-13 00:00:00").cast("timestamp")).count() == 4
    with pytest.raises(ValueError):
        T.load_logs(spark, path, 1, F.lit("2001-01-01 00:00:00").cast("timestamp"))


def test_text_helpers(spark):
    frame = spark.createDataFrame(
        [(30.0, "aab"), (90.0, ""), (5400.0, "abcd"), (129.0, None), (200000.0, "a"), (None, "ab")], "s double, t string")
    rows = frame.select(X.age_text(F.col("s")), F.round(X.entropy(F.col("t")), 6)).collect()
    assert [r[0] for r in rows] == ["30s", "1.5m", "1.5h", "2.1m", "2.3d", "-"]
    assert [r[1] for r in rows] == [0.918296, 0.0, 2.0, 0.0, 0.0, 1.0]
    masked = spark.createDataFrame([('{"user":"a","password": "s\\"e"}',), ('{"user":"a"}',)], "d string")
    assert [r[0] for r in masked.select(X.mask_password(F.col("d"))).collect()] == [
        '{"user":"a","password": "************"}', '{"user":"a"}']
