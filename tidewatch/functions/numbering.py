"""Consecutive row numbers over a whole table, without bringing its rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.session import written


def numbered(df: DataFrame, order: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in the given order, or in any order without one.

    Rows are sorted by ranges and written, so their places stay; then each partition's count, one row
    per partition, gives the number its first row has.
    """
    if order:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = written(df.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn("_part", F.shiftright("_at", 33))
    ahead = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    bases = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    bases = bases.select("_part", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_base"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(bases), "_part").withColumn(name, F.col("_base") + inside).drop("_at", "_part", "_base")
