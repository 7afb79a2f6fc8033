"""What the operators of this subpackage share: reading inputs, Arrow batches of a bounded size, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import prepare, written

#: Rows per Arrow batch; texts may be long, so a batch of the default 10,000 rows could fill a worker.
BATCH_ROWS = 400


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    # A plan with literal tables would be kept by the driver as a text of megabytes.
    spark.conf.set("spark.sql.maxPlanStringLength", "20000")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def lowered(texts: list[bytes]) -> list[bytes]:
    """A-Z only: bytes.lower() leaves every byte of a longer UTF-8 sequence alone."""
    return [x.lower() for x in texts]


def arrow(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Map each Arrow batch to the columns that make returns, under the names and types of schema."""
    names = [part.strip().split()[0] for part in _parts(schema)]
    types = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(types)
        for batch in batches:
            columns = make(batch)
            yield pa.RecordBatch.from_arrays([pa.array(columns[n], out.field(n).type) for n in names], schema=out)

    return df.mapInArrow(run, types)


def _parts(schema: str) -> list[str]:
    """Split a DDL string at its top-level commas."""
    parts, depth, start = [], 0, 0
    for at, char in enumerate(schema):
        depth += (char == "<") - (char == ">")
        if char == "," and not depth:
            parts.append(schema[start:at])
            start = at + 1
    return [*parts, schema[start:]]


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (node, root), root the smallest node of the component.

    Alternating large-star and small-star steps; each round is written, and the loop ends when the links stay the same.
    Minima are written before they are joined back: then a join is one of two plain tables, and a node with very many links is
    split like any skewed key.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "large-minima")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = written(large, "large-star")
        low = written(large.groupBy("a").agg(F.min("b").alias("m")), "small-minima")
        small = large.join(low, "a").where("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        edges = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
