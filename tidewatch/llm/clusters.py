"""Centroid clustering by Lloyd rounds that are sharded by dimension.

Vectors become rows of whole numbers, floor(scale * x), and are packed into blocks of rows; each block is stored as one slice per
column block. In a round, a task that holds a slice computes the exact partial distances of its rows to the same columns of the
centroids. Partial distances are added per block of rows, which gives each row its nearest centroid (of equals the one with the
smaller number). The labels then go back to the slices, and each column block sums its own columns per centroid and replaces its
own slice of the centroids by floor(sum / count). Sums are exact: 64-bit within a task, decimal between tasks. Only centroids
(clusters x dimensions numbers, both parameters) pass through the driver.

Defined results: vectors that are null, of another length, or that hold null or non-finite components take no part. Repeated rows
are separate vectors; null ids are allowed and are first centroids last. Of equal hashes the smaller vector comes first. With
fewer vectors than clusters there are as many clusters as vectors. A centroid without vectors stays. Components whose squared
distances could exceed 64 bits (beyond some 180,000 times the usual range of -1 to 1, at 64 dimensions and scale 1024) stop the
job with an error, as no right result fits the type. Other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import table
from tidewatch.session import written

CLUSTERS = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
SEED = 3
#: Columns of a slice and rows of a block.
SHARD_DIMENSIONS = 16
BLOCK_ROWS = 1024

_RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def _kept(vectors: DataFrame, dimensions: int) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where((F.size("embedding") == dimensions) & finite)


def _largest(dimensions: int) -> int:
    """Components up to this size have squared distances of at most 63 bits, and fit 32 bits themselves."""
    return min(math.isqrt(((1 << 63) - 1) // dimensions) // 2, (1 << 31) - 1)


def _whole(values: np.ndarray, scale: int, dimensions: int) -> np.ndarray:
    numbers = np.floor(values.reshape(-1, dimensions) * scale)
    if numbers.size and np.abs(numbers).max() > _largest(dimensions):
        raise ValueError(f"components beyond {_largest(dimensions)} / {scale}: squared distances need more than 64 bits")
    return numbers.astype(np.int32)


def slices(kept: DataFrame, dimensions: int, scale: int, shard: int = SHARD_DIMENSIONS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, shard, part, ids): part holds the block's rows in the shard's columns; ids stands in the first shard only. Written."""

    def emit(task: int, number: int, ids: list, rows: np.ndarray) -> pa.RecordBatch:
        starts = range(0, dimensions, shard)
        blocks = [(task << 32) | number] * len(starts)
        parts = [np.ascontiguousarray(rows[:, at : at + shard]).tobytes() for at in starts]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(blocks, pa.int64()), pa.array(range(len(starts)), pa.int32()), pa.array(parts, pa.binary()),
                pa.array([ids] + [None] * (len(starts) - 1), pa.list_(pa.int64())),
            ],
            names=["block", "shard", "part", "ids"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, ids, held = TaskContext.get().partitionId(), 0, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _whole(batch.column("embedding").flatten().to_numpy(zero_copy_only=False), scale, dimensions)
            for at in range(0, len(rows), block_rows):
                ids += batch.column("vec_id")[at : at + block_rows].to_pylist()
                held.append(rows[at : at + block_rows])
                if len(ids) >= block_rows:
                    yield emit(task, number, ids, np.concatenate(held))
                    number, ids, held = number + 1, [], []
        if ids:
            yield emit(task, number, ids, np.concatenate(held))

    return written(kept.mapInArrow(run, "block long, shard int, part binary, ids array<long>"), "slices")


def first_centroids(kept: DataFrame, clusters: int, dimensions: int, scale: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids; at most `clusters` rows come to the driver."""
    ranked = kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "embedding")
    first = ranked.orderBy(F.col("h").asc_nulls_last(), "embedding").limit(clusters).collect()
    return _whole(np.array([r.embedding for r in first], float), scale, dimensions).astype(np.int64)


def _rows_of(part: bytes, width: int) -> np.ndarray:
    return np.frombuffer(part, np.int32).reshape(-1, width).astype(np.int64)


def assigned(parts: DataFrame, centroids: np.ndarray, shard: int = SHARD_DIMENSIONS) -> DataFrame:
    """(block, labels, distances): partial distances of all column blocks, added per block of rows."""
    clusters = len(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for number, part in zip(batch.column("shard").to_pylist(), batch.column("part").to_pylist()):
                own = centroids[:, number * shard : (number + 1) * shard]
                rows = _rows_of(part, own.shape[1])
                distances = np.empty((len(rows), clusters), np.int64)
                for j, one in enumerate(own):
                    step = rows - one
                    distances[:, j] = np.einsum("ij,ij->i", step, step)
                out.append(distances.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(out, pa.binary())], names=["block", "partial"])

    def nearest(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64).reshape(-1, clusters) for x in group.column("partial").to_pylist())
        labels = total.argmin(axis=1)
        return pa.table({
            "block": group.column("block")[:1], "labels": pa.array([labels.astype(np.int32).tobytes()], pa.binary()),
            "distances": pa.array([total[np.arange(len(total)), labels].tobytes()], pa.binary()),
        })

    partials = parts.select("block", "shard", "part").mapInArrow(partial, "block long, partial binary")
    return partials.groupBy("block").applyInArrow(nearest, "block long, labels binary, distances binary")


def moved(parts: DataFrame, labels: DataFrame, centroids: np.ndarray, shard: int = SHARD_DIMENSIONS) -> np.ndarray:
    """The next centroids: each column block sums its own columns; an empty centroid stays."""
    clusters, dimensions = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts = np.zeros((clusters, dimensions), np.int64), np.zeros((clusters, dimensions), np.int64)
        for batch in batches:
            for number, part, label in zip(*(batch.column(n).to_pylist() for n in ("shard", "part", "labels"))):
                columns = slice(number * shard, min((number + 1) * shard, dimensions))
                rows, of = _rows_of(part, columns.stop - columns.start), np.frombuffer(label, np.int32)
                for j in np.unique(of):
                    total[j, columns] += rows[of == j].sum(axis=0)
                    counts[j, columns] += int((of == j).sum())
        cluster, column = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(column, pa.int32()), pa.array(total[cluster, column]), pa.array(counts[cluster, column])],
            names=["cluster", "at", "total", "rows"],
        )

    joined = parts.select("block", "shard", "part").join(labels.select("block", "labels"), "block")
    each = joined.mapInArrow(sums, "cluster int, at int, total long, rows long").groupBy("cluster", "at")
    out = centroids.copy()
    for r in each.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("rows").alias("rows")).collect():
        out[r.cluster, r.at] = int(r.total) // r.rows
    return out


def clustered(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
    shard: int = SHARD_DIMENSIONS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per vector (vec_id, embedding) that takes part: its cluster, squared distance, inertias and its centroid's digest."""
    spark = vectors.sparkSession
    kept = _kept(vectors, dimensions)
    centroids = first_centroids(kept, clusters, dimensions, scale, seed)
    if not len(centroids):
        return spark.createDataFrame([], _RESULT)
    stored = slices(kept, dimensions, scale, shard, block_rows)
    for _ in range(rounds):
        after = moved(stored, assigned(stored, centroids, shard), centroids, shard)
        if (after == centroids).all():
            break  # later rounds would change nothing
        centroids = after
    final = assigned(stored, centroids, shard)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, distances in zip(*(batch.column(n).to_pylist() for n in ("ids", "labels", "distances"))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(np.frombuffer(labels, np.int32)), pa.array(np.frombuffer(distances, np.int64))],
                    names=["vec_id", "cluster", "distance"],
                )

    rows = stored.where("ids is not null").select("block", "ids").join(final, "block")
    rows = written(rows.mapInArrow(expand, "vec_id long, cluster int, distance long"), "clustered")
    digests = [(n, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for n, c in enumerate(centroids.tolist())]
    each = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    each = each.join(rows.agg(F.sum("distance").alias("inertia")), how="cross")  # one row
    each = each.join(spark.createDataFrame(digests, "cluster int, centroid_sha256 string"), "cluster")
    return rows.join(F.broadcast(each), "cluster").select([part.split()[0] for part in _RESULT.split(", ")])  # one row per cluster


def op12_clusters(spark, folder: str) -> DataFrame:
    return clustered(table(spark, folder, "embeddings"))


def _sql(clusters: int = CLUSTERS, rounds: int = ROUNDS) -> str:
    steps = [f"""
vectors AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
numbers AS MATERIALIZED (
  SELECT rid, dim, CAST(floor({SCALE} * CAST(embedding[dim] AS DOUBLE)) AS BIGINT) AS x
  FROM vectors, (SELECT unnest(range(1, {DIMENSIONS} + 1)) AS dim)),
c0 AS MATERIALIZED (
  SELECT place - 1 AS cluster, dim, x FROM numbers JOIN (
    SELECT rid, row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR))) AS place FROM vectors) USING (rid)
  WHERE place <= {clusters})"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT rid, cluster, distance FROM (
    SELECT rid, cluster, distance, row_number() OVER (PARTITION BY rid ORDER BY distance, cluster) AS place FROM (
      SELECT rid, cluster, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance
      FROM numbers v JOIN c{n} c USING (dim) GROUP BY rid, cluster))
  WHERE place = 1)""")
        if n < rounds:
            steps.append(f"""
c{n + 1} AS MATERIALIZED (
  SELECT o.cluster, o.dim, coalesce(m.x, o.x) AS x FROM c{n} o LEFT JOIN (
    SELECT cluster, dim, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
      SELECT cluster, dim, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{n} JOIN numbers USING (rid) GROUP BY cluster, dim)) m
  USING (cluster, dim))""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, cluster_inertia, inertia, centroid_sha256
FROM a{rounds} JOIN vectors USING (rid)
JOIN (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY cluster) USING (cluster)
JOIN (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster) USING (cluster)
CROSS JOIN (SELECT CAST(sum(distance) AS BIGINT) AS inertia FROM a{rounds})
"""


QUERIES = {"op12_clusters": op12_clusters}
ORACLE = {"op12_clusters": _sql()}
