"""Exact top-k search by aggregation without random access.

Components become integers, floor(256 x). Candidates are dealt to blocks of a bounded number of rows, and so are queries; every
pair of blocks meets. Within a block each dimension is a list of the candidates sorted by its component, read from the top for
queries with a positive weight there and from the bottom for negative ones. All lists are read to the same depth, which grows
from step to step. What has been read gives a candidate's lower bound (an unread component counts as the list's last value) and
its upper bound (as the value at the reading depth). As soon as a candidate's upper bound lies below the k-th best lower bound
of its query it is an outsider; when no step leaves fewer, or few are left, the rest get their final scores.

The bounds of all queries of a block and all its candidates are matrix products, as a component read or unread is the larger (or
smaller) of its value and the value at the depth. All sums are integers below 2^53 and so exact in floating point; components
beyond that are refused. The k best of each block are merged on Spark.

Defined results: vectors that are null or hold null or non-finite components take no part. Vectors of another length than a
query's do not meet it. Rows that repeat an id count once, with their smallest vector; the query's own id is never a candidate.
Null ids take no part. Other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import table
from tidewatch.session import written

K = 5
SCALE = 256
QUERY_EVERY = 50
#: Rows of a block, on average.
CANDIDATE_ROWS, QUERY_ROWS = 4096, 1024
#: Share of the lists that the first step reads, and by which each later one reads on.
FIRST_DEPTH, STEP_DEPTH = 0.5, 0.25

_OUT = "query_id long, vec_id long, score long"


def quantized(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): one row per usable id, components as long integers."""
    x = F.col("embedding").cast("array<double>")
    usable = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**40))
    beyond = F.exists(x, lambda c: F.abs(c) >= 2.0**16) & F.forall(x, lambda c: ~F.isnan(c) & (F.abs(c) != float("inf")))
    v = F.transform(x, lambda c: F.when(beyond, F.raise_error(F.lit("components of 65536 and more are not supported")).cast("long")).otherwise(F.floor(c * SCALE)))
    return vectors.where(usable | F.coalesce(beyond, F.lit(False))).select(F.col("vec_id").cast("long"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def bounds(values: np.ndarray, weights: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds (queries x candidates) once all lists are read to a depth."""
    ordered = np.sort(values, axis=0)
    n = len(values)
    up, down = np.maximum(weights, 0), np.minimum(weights, 0)
    high, low = ordered[n - depth], ordered[depth - 1]  # where reading stands, from the top and from the bottom
    read_high, read_low = values >= high, values <= low
    least = up @ np.where(read_high, values, ordered[0]).T + down @ np.where(read_low, values, ordered[-1]).T
    most = up @ np.where(read_high, values, high).T + down @ np.where(read_low, values, low).T
    return least, most


def best_of_block(ids: np.ndarray, values: np.ndarray, query_ids: np.ndarray, weights: np.ndarray, k: int = K, first: float = FIRST_DEPTH):
    """(query, id, score) of the k best candidates of each query; ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order].astype(np.float64)
    weights, n = weights.astype(np.float64), len(ids)
    own = query_ids[:, None] == ids[None, :]
    inside, depth = ~own, max(1, int(n * first))
    while depth < n:
        least, most = bounds(values, weights, depth)
        least[own] = -np.inf
        bar = np.partition(least, n - k, axis=1)[:, n - k] if n > k else np.full(len(weights), -np.inf)
        before, inside = inside.sum(), inside & (most >= bar[:, None])
        if inside.sum() < before / 8 or not before:  # few are left: score them
            break
        depth += max(1, int(n * STEP_DEPTH))
    found = []
    for row in range(len(query_ids)):
        rest = np.flatnonzero(inside[row])
        scores = values[rest] @ weights[row]
        if len(rest) > k:
            bar = np.partition(scores, len(rest) - k)[len(rest) - k]
            keep = np.flatnonzero(scores >= bar)
            rest, scores = rest[keep], scores[keep]
        top = np.argsort(-scores, kind="stable")[:k]
        found.append((np.full(len(top), query_ids[row]), ids[rest[top]], scores[top].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _search(k: int, first: float):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for width in set(queries.v.map(len)) & set(candidates.v.map(len)):
            q, c = queries[queries.v.map(len) == width], candidates[candidates.v.map(len) == width]
            parts.append(best_of_block(c.id.to_numpy(), np.stack(c.v.to_list()), q.id.to_numpy(), np.stack(q.v.to_list()), k, first))
        if not parts:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        return pd.DataFrame({n: np.concatenate(x) for n, x in zip(("query_id", "vec_id", "score"), zip(*parts))})

    return run


def top_k(vectors: DataFrame, is_query, k: int = K, candidate_rows: int = CANDIDATE_ROWS, query_rows: int = QUERY_ROWS, first: float = FIRST_DEPTH) -> DataFrame:
    """The k best candidates of each query (is_query: a condition on vec_id): query_id, rank, vec_id, score."""
    data = written(quantized(vectors), "vectors")
    queries = data.where(is_query)
    across, down = (max(1, -(-x.count() // size)) for x, size in ((data, candidate_rows), (queries, query_rows)))
    place = F.xxhash64("vec_id")

    def dealt(rows: DataFrame, own: int, others: int, names: tuple[str, str]) -> DataFrame:
        """Each row in its own block, once for each block of the other side: the blocks are counted, not the rows."""
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return rows.select(F.col("vec_id").alias("id"), "v", F.pmod(place, F.lit(own)).cast("int").alias(names[0]), every.alias(names[1]))

    left = dealt(queries, down, across, ("q", "c")).groupBy("q", "c")
    right = dealt(data, across, down, ("c", "q")).groupBy("q", "c")
    best = left.cogroup(right).applyInPandas(_search(k, first), _OUT)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


QUERIES = {"op6_topk": op6_topk}

ORACLE = {
    "op6_topk": """
WITH v AS (SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
 FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM p)
SELECT * FROM r WHERE rank <= 5""",
}
