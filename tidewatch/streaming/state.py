"""State of a stream by key, as tables of files.

Every batch writes the rows of the keys that it changed; every so many batches the whole state is written instead. The state before
a batch is the newest row of each key in the last whole copy and the changes after it. A batch that is repeated after a failure
finds what it found before and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import discard, folders


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches stored below a folder, ascending."""
    return sorted(int(name.removeprefix("batch=")) for name in folders(spark, path) if name.startswith("batch="))


def newest_before(spark: SparkSession, path: str, number: int) -> int | None:
    return max((n for n in batches(spark, path) if n < number), default=None)


class KeyedState:
    """One row per key. ``whole_every``: changes between whole copies."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], whole_every: int = 16):
        self.spark, self.path, self.keys, self.whole_every = spark, path, list(keys), whole_every

    def _parts(self, number: int) -> tuple[int | None, list[int]]:
        whole = newest_before(self.spark, f"{self.path}/whole", number)
        return whole, [n for n in batches(self.spark, f"{self.path}/changes") if n < number and (whole is None or n > whole)]

    def before(self, number: int) -> DataFrame | None:
        """The state that the batches before this one left; None if there was none."""
        whole, changes = self._parts(number)
        places = [f"{self.path}/changes/batch={n}" for n in changes]
        if whole is not None:
            places.insert(0, f"{self.path}/whole/batch={whole}")
        if not places:
            return None
        rows = self.spark.read.parquet(*places)
        rest = [c for c in rows.columns if c not in (*self.keys, "_batch")]
        newest = F.max_by(F.struct(*rest), "_batch").alias("_newest")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_newest.*")

    def write(self, number: int, changed: DataFrame) -> None:
        """Keep what a batch changed; ``changed`` may read ``before(number)``."""
        whole, changes = self._parts(number)
        if len(changes) < self.whole_every:
            changed.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{self.path}/changes/batch={number}")
            return
        before = self.before(number)
        rest = before.join(changed.select(*[F.col(k).alias(f"_{k}") for k in self.keys]), self._same(), "left_anti")
        rest.unionByName(changed).withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{self.path}/whole/batch={number}")
        # A repetition of this batch reads the copy before and the changes since; older ones are not needed any more.
        for kind in ("whole", "changes"):
            for n in batches(self.spark, f"{self.path}/{kind}"):
                if whole is not None and (n < whole or (kind == "changes" and n == whole)):
                    discard(self.spark, f"{self.path}/{kind}/batch={n}")

    def _same(self):
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        return same
