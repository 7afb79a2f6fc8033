"""Growing files as a stream: half lines, restarts, rotation, cut files, failed batches, splits at any byte."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.session import shared_folder
from tidewatch.sources.tail import TailReader, tail_lines
from tidewatch.streaming import jobs as J


def taken(spark, source, table, progress, **options):
    stream = tail_lines(spark, source, **options)
    writer = stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", progress)
    writer.trigger(availableNow=True).start().awaitTermination()
    return sorted(r.value for r in spark.read.schema(stream.schema).parquet(table).collect())


@pytest.fixture
def places(tmp_path):
    source = tmp_path / "logs"
    source.mkdir()
    return source, str(tmp_path / "out"), str(tmp_path / "cp")


def test_growth_half_lines_and_restarts(spark, places):
    source, table, progress = places
    file = source / "app.log"
    file.write_bytes(b"one\ntwo\nthr")
    assert taken(spark, str(source), table, progress) == ["one", "two"]
    with file.open("ab") as out:
        out.write(b"ee\r\n\nfour \xc3\xa9\n")
    (source / "other.log").write_bytes(b"five\n")
    (source / ".hidden").write_bytes(b"not this\n")
    (source / "_temporary").write_bytes(b"nor this\n")
    want = sorted(["one", "two", "three", "", "four é", "five"])
    assert taken(spark, str(source), table, progress) == want
    assert taken(spark, str(source), table, progress) == want  # nothing new
    with file.open("ab") as out:
        out.write(b"bad \xff byte\nwaits")
    assert taken(spark, str(source), table, progress) == sorted([*want, "bad � byte"])


def test_one_file_and_its_rotation(spark, places):
    source, table, progress = places
    file, options = source / "app.log", {"single": True, "pattern": "app.log*"}
    (source / "else.log").write_bytes(b"no\n")
    file.write_bytes(b"a1\na2\n")
    assert taken(spark, str(file), table, progress, **options) == ["a1", "a2"]
    with file.open("ab") as out:
        out.write(b"a3\n")
    file.rename(source / "app.log.1")
    file.write_bytes(b"b1\n")
    assert taken(spark, str(file), table, progress, **options) == ["a1", "a2", "a3", "b1"]
    (source / "app.log.1").rename(source / "app.log.2")
    file.rename(source / "app.log.1")
    file.write_bytes(b"c1\nc2\nc3\nc4\n")
    assert taken(spark, str(file), table, progress, **options) == ["a1", "a2", "a3", "b1", "c1", "c2", "c3", "c4"]
    file.write_bytes(b"d1\n")  # cut and written anew
    assert taken(spark, str(file), table, progress, **options)[-1] == "d1"


def test_a_missing_folder_is_empty(spark, places):
    source, table, progress = places
    (source / "x").write_bytes(b"")
    assert TailReader(str(source / "none"), "*", 10, True).latestOffset() == {"files": {}}
    assert taken(spark, str(source), table, progress) == []
    (source / "x").write_bytes(b"1\n")
    assert taken(spark, str(source), table, progress) == ["1"]


def test_every_split_gives_every_line_once(tmp_path):
    rng = random.Random(3)
    lines = ["x" * rng.choice([0, 0, 1, 2, 5, 17, 40]) for _ in range(60)]
    (tmp_path / "a.log").write_bytes("".join(f"{x}\n" for x in lines).encode())
    for size in [1, 2, 3, 7, 16, 41, 100, 10_000]:
        reader = TailReader(str(tmp_path), "*", size, True)
        spans = reader.partitions(reader.initialOffset(), reader.latestOffset())
        rows = [r for s in spans for batch in reader.read(s) for r in batch.to_pylist()]
        assert [r["value"] for r in rows] == lines
        assert len({r["position"] for r in rows}) == len(lines)


def test_rotation_between_planning_and_reading(tmp_path):
    file = tmp_path / "app.log"
    file.write_bytes(b"1\n2\n")
    reader = TailReader(str(tmp_path), "app.log*", 100, True)
    end = reader.latestOffset()
    spans = reader.partitions({"files": {}}, end)
    file.rename(tmp_path / "app.log.1")
    file.write_bytes(b"n\n")
    assert [r["value"] for b in reader.read(spans[0]) for r in b.to_pylist()] == ["1", "2"]
    assert [s.end for s in reader.partitions({"files": {}}, end)] == [4]  # a repeated plan finds the rotated file
    (tmp_path / "app.log.1").unlink()
    with pytest.raises(ValueError, match="no longer holds"):
        reader.partitions({"files": {}}, end)
    assert TailReader(str(tmp_path), "app.log*", 100, False).partitions({"files": {}}, end)[0].end == 0


def test_a_failed_batch_is_read_again(spark, places):
    source, table, progress = places
    (source / "app.log").write_bytes(b'{"ip": "1.1.1.1", "method": "GET", "endpoint": "/", "status": 200}\nbad\n')

    def broken(batch, number):
        batch.count()
        raise RuntimeError("lost")

    stream = tail_lines(spark, str(source))
    with pytest.raises(Exception, match="lost"):
        stream.writeStream.foreachBatch(broken).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    with (source / "app.log").open("ab") as out:
        out.write(b"bad too\n")
    for want in (["bad"], ["bad", "bad too"]):  # first the failed batch as it was, then what has come since
        J.ingest(tail_lines(spark, str(source)), table, progress).awaitTermination()
        assert sorted(r._line for r in spark.read.parquet(f"{table}_failed").collect()) == want
    assert spark.read.parquet(table).count() == 1


def test_batches_leave_no_folders_behind(spark, tmp_path):
    """Ten batches of ingestion: the shared folder holds what it held before."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark, "x")).getParent()
    system = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    listed = lambda: {str(f.getPath()) for f in system.listStatus(hadoop)} if system.exists(hadoop) else set()
    before = listed()
    lines = spark.createDataFrame([('{"ip": "1.1.1.1", "status": 200}',), ("bad",)], "value string")
    for number in range(10):
        J.store_lines(lines, number, str(tmp_path / "raw"))
    assert listed() == before
    assert spark.read.parquet(str(tmp_path / "raw")).agg(F.max("id")).first()[0] == 10
