"""Each pipeline stage on its own input, against brute force over the small tables."""

from __future__ import annotations

import corpus_pipeline
from tidewatch.llm import quality
from tidewatch.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns, before = docs.columns, None
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        rows = docs.collect()
        if number < 4:
            assert docs.columns == columns, name
        if number == 0:
            lost = {r.doc_id for r in table(spark, FOLDER, "documents").collect()} - {r.doc_id for r in rows}
            assert all(labels.get(i) != 1 for i in lost) and lost
            assert quality.THRESHOLD == 0.3
        if number == 1:
            low = lambda r: (r.text or "").encode().lower()
            want = {}
            for r in before:
                want[low(r)] = max(want.get(low(r), -1), r.doc_id)
            assert sorted(want.values()) == sorted(r.doc_id for r in rows)
        if number == 2:
            assert {r.doc_id for r in rows} <= {r.doc_id for r in before} and rows
        if number == 3:
            assert {r.doc_id for r in rows} <= {r.doc_id for r in before}
        if number == 4:
            assert len(rows) == len(before) and all(r.decoded and r.n_tokens == len(r.ids) for r in rows)
        before = rows


def test_registered():
    import __spark_entry__

    names = {n for n in __spark_entry__.queries() if n.startswith("op")}
    assert {f"op{n}_" for n in range(1, 11)} <= {n[: n.index("_") + 1] for n in names if n[2].isdigit()}
    assert "pipeline" in __spark_entry__.queries()


def test_what_stages_leave_on_the_driver_is_collected_before_the_next(spark, monkeypatch):
    kept = [("first", lambda spark, docs, folder: docs), ("second", lambda spark, docs, folder: docs)]
    monkeypatch.setattr(corpus_pipeline, "STAGES", kept)
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()

    def whole_collections():
        return sum(b.getCollectionCount() for b in beans if any(name in b.getName() for name in ("Old", "MarkSweep", "Major")))

    before = whole_collections()
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() == 200
    assert whole_collections() > before
