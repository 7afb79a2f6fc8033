"""MinHash near-duplicates with sequential Bayesian verification.

A document's set of word shingles has a signature of minimum hashes, cut into bands; documents that agree in a band are candidates.
A candidate pair's signatures are compared batch by batch: after each batch the similarity has a posterior (Beta, from an even prior), and
a pair whose posterior probability of reaching the threshold is below the chosen miss probability is dropped. Survivors are
verified exactly on their whole sets, so no link is wrong. A pair at the threshold shares no band with probability 6e-7 (36 bands of 5).

Only one document of each distinct set takes part, and pairs within a band are not listed. First each document is compared with
the smallest (then the largest) member of the band that it shares most often, one pair per document, and components are formed.
Bands whose members are all in one component are done. The members of each remaining band are compared within cells of bounded
size, and there only with members of other components, as long as they have not been linked: a cell gives a spanning forest of its links.

Sets are of 64-bit shingle hashes. Defined results: null text counts as empty; an empty set is linked with nothing, not even with
other empty ones. Repeated rows stay separate rows of one component. Null ids never name a component; a component of null ids only has a
null name, and its rows count as kept. Other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import arrow, components, lowered, raw_texts, table
from tidewatch.session import written

SHINGLE_WORDS = 2
#: Least similarity in percent.
PERCENT = 80
BANDS, BAND_ROWS = 36, 5
#: Hashes compared at a time, and the probability at which a true link may be dropped.
BATCH, MISS = 36, 1e-6
#: Members of a band that one cell holds on either side.
CELL_ROWS = 1024

_WORDS_HELD = 1 << 18
_SALTS = np.random.default_rng(11).integers(0, 1 << 32, (2, BANDS * BAND_ROWS), np.uint64).astype(np.uint32)
_FLIPS, _FACTORS = _SALTS[0], _SALTS[1] | np.uint32(1)
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


class Shingles:
    """Hashes of word shingles; hashes of words are kept for a while."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def of(self, text: bytes) -> np.ndarray:
        """Sorted distinct hashes of the shingles of a lower-cased text."""
        words = text.split()
        if not words:
            return np.array([], np.uint64)
        if len(self.known) > _WORDS_HELD:
            self.known.clear()
        known, digest = self.known, xxhash.xxh64_intdigest
        hashes = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = digest(w)
            hashes.append(h)
        hashes, count = np.array(hashes, np.uint64), max(len(words) - self.words + 1, 1)
        mixed = np.full(count, len(words) if len(words) < self.words else self.words, np.uint64)
        for at in range(min(self.words, len(words))):
            mixed = ((mixed << np.uint64(29)) | (mixed >> np.uint64(35))) * _C1 + hashes[at : at + count] * _C2
            mixed = (mixed ^ (mixed >> np.uint64(31))) * _C3
        return np.unique(mixed ^ (mixed >> np.uint64(32)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum hashes of a set that is not empty."""
    low = np.full(len(_FLIPS), 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 1024):
        np.minimum(low, ((short[at : at + 1024, None] ^ _FLIPS) * _FACTORS).min(axis=0), out=low)
    return low


def _bands(low: np.ndarray) -> np.ndarray:
    parts = low.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _C1
    for at in range(BAND_ROWS):
        key = (key ^ parts[:, at]) * _C2
        key ^= key >> np.uint64(29)
    return (key * _C3).view(np.int64)


def sketches(rows: DataFrame, words: int) -> DataFrame:
    """(rid, doc_id, n_shingles, same, prints, bands): same tells sets apart; prints are eight bits of each minimum hash."""

    def make(batch: pa.RecordBatch) -> dict:
        shingles, out = Shingles(words), {n: [] for n in ("n_shingles", "same", "prints", "bands")}
        for text in lowered(raw_texts(batch)):
            members = shingles.of(text)
            row = [len(members), None, None, None]
            if len(members):
                low = signature(members)
                prints = (low * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
                row[1:] = hashlib.blake2b(members.tobytes(), digest_size=16).digest(), prints.tobytes(), _bands(low)
            for name, value in zip(out, row):
                out[name].append(value)
        return {n: batch.column(n) for n in ("rid", "doc_id")} | out

    return arrow(rows.select("rid", "doc_id", "text"), make, "rid long, doc_id long, n_shingles long, same binary, prints binary, bands array<long>")


@cache
def least_matches(percent: int, miss: float, hashes: int = BANDS * BAND_ROWS, batch: int = BATCH) -> tuple[int, ...]:
    """After each batch, the fewest equal hashes at which the similarity still reaches the threshold with probability `miss`.

    With m of n equal the posterior is Beta(m + 1, n - m + 1), whose upper tail at t is P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(batch, hashes + 1, batch):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def likely(left: np.ndarray, right: np.ndarray, percent: int, miss: float) -> np.ndarray:
    """Which rows of prints survive all batches; rows that are dropped are not compared further."""
    alive = np.arange(max(len(left), len(right)))
    equal = np.zeros(len(alive), np.int64)
    wide = lambda x, at: x[:, at : at + BATCH] if len(x) == 1 else x[alive, at : at + BATCH]
    for number, least in enumerate(least_matches(percent, miss)):
        equal = equal + (wide(left, number * BATCH) == wide(right, number * BATCH)).sum(axis=1)
        stays = equal >= least
        alive, equal = alive[stays], equal[stays]
    return alive


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Exact test on the whole sets."""
    small, large = sorted((len(left), len(right)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (small + large - both)


def _prints(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BANDS * BAND_ROWS)


def _tested(pairs: DataFrame, candidates: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that are links. Pairs are written before, so that a member of very many of them is split like any skewed key."""
    for side in "ab":
        pairs = pairs.join(candidates.select(F.col("node").alias(side), F.col("prints").alias(f"prints_{side}"), F.col("members").alias(f"members_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive = likely(_prints(batch.column("prints_a")), _prints(batch.column("prints_b")), percent, miss)
                left, right = batch.column("members_a"), batch.column("members_b")
                fits = [i for i in alive.tolist() if similar(np.frombuffer(left[i].as_py(), np.uint64), np.frombuffer(right[i].as_py(), np.uint64), percent)]
                yield pa.RecordBatch.from_arrays([batch.column(n).take(pa.array(fits, pa.int64())) for n in "ab"], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _forest(nodes, roots, prints, members, sides, percent: int, miss: float) -> list[tuple[int, int]]:
    """Links of a cell that join whatever its links join; rows of one component, or linked already, are not compared.

    sides is None in a cell of one group of members, else only rows of different sides are compared.
    """
    links, label = [], roots.copy()
    for at in range(len(nodes)):
        later = np.arange(at + 1, len(nodes))
        later = later[label[later] != label[at]] if sides is None else later[(label[later] != label[at]) & (sides[later] != sides[at])]
        if not len(later):
            continue
        for other in later[likely(prints[at : at + 1], prints[later], percent, miss)]:
            if label[other] != label[at] and similar(members[at], members[other], percent):
                links.append((int(nodes[at]), int(nodes[other])))
                label[label == label[other]] = label[at]
    return links


def _cells(percent: int, miss: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def finish(rows: pa.Table) -> pa.RecordBatch:
            keys = [rows.column(n).to_numpy() for n in ("bucket", "i", "j")]
            same = np.all([k[1:] == k[:-1] for k in keys], axis=0)
            starts = [*np.flatnonzero(np.concatenate(([True], ~same))).tolist(), rows.num_rows]
            nodes, roots, sides = (rows.column(n).to_numpy() for n in ("node", "root", "chunk"))
            links = []
            for start, end in zip(starts, starts[1:]):
                if end - start > 1 and (roots[start:end] != roots[start]).any():
                    part = rows.slice(start, end - start)
                    sets = [np.frombuffer(x, np.uint64) for x in part.column("members").to_pylist()]
                    side = None if keys[1][start] == keys[2][start] else sides[start:end]
                    links += _forest(nodes[start:end], roots[start:end], _prints(part.column("prints")), sets, side, percent, miss)
            a, b = zip(*links) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b)], names=["a", "b"])

        key = lambda batch, at: tuple(batch.column(n)[at].as_py() for n in ("bucket", "i", "j"))
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            last = key(batch, batch.num_rows - 1)
            if key(held[0], 0) == last:
                continue  # still one cell; cells are bounded
            rows = pa.Table.from_batches(held)
            cut = rows.num_rows
            while key(rows, cut - 1) == last:
                cut -= 1
            held = rows.slice(cut).combine_chunks().to_batches()
            yield finish(rows.slice(0, cut).combine_chunks())
        if held:
            yield finish(pa.Table.from_batches(held))

    return run


def _rooted(live: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return live.withColumn("root", F.col("node"))
    return live.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))


def _open_bands(placed: DataFrame) -> DataFrame:
    """(bucket, rows, low, high): bands with members of several components, with their smallest and largest member. Written."""
    each = placed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.min("node").alias("low"), F.max("node").alias("high"), F.min("root").alias("r0"), F.max("root").alias("r1")
    )
    return written(each.where("r0 <> r1").select("bucket", "rows", "low", "high"), "open-bands")


def _star_pairs(placed: DataFrame, bands: DataFrame, hub: str) -> DataFrame:
    """(a, b): each member with one hub, that of most of its open bands (of equals the smallest)."""
    pairs = placed.join(bands.select("bucket", F.col(hub).alias("hub")), "bucket").where("node <> hub").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("node").agg(F.max(F.struct("n", (-F.col("hub")).alias("hub"))).alias("m")).select(F.col("node").alias("a"), (-F.col("m.hub")).alias("b"))


def links_of(live: DataFrame, candidates: DataFrame, percent: int = PERCENT, miss: float = MISS, cell_rows: int = CELL_ROWS) -> DataFrame | None:
    """(node, root) of all nodes that are linked, from bands' members live (bucket, node) and candidates (node, prints, members)."""
    links, roots = None, None
    for hub in ("low", "high"):
        placed = written(_rooted(live, roots), "placed")
        bands = _open_bands(placed)
        pairs = written(_star_pairs(placed, bands, hub), "star-pairs")
        found = written(_tested(pairs, candidates, percent, miss), "star-links")
        links = found if links is None else links.unionByName(found)
        roots = components(links)
    placed = written(_rooted(live, roots), "placed")
    rows = placed.join(_open_bands(placed).select("bucket", F.ceil(F.col("rows") / cell_rows).alias("chunks")), "bucket")
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), "chunks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    rows = written(rows.select("bucket", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "node", "root"), "cells")
    cells = rows.join(candidates, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    cells = cells.select("bucket", "i", "j", "chunk", "node", "root", "prints", "members")
    return components(links.unionByName(written(cells.mapInArrow(_cells(percent, miss), "a long, b long"), "cell-links")))


def near_groups(
    docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT, miss: float = MISS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = written(rows, "numbered-rows")
    base = written(sketches(rows, words), "sketches")
    nodes = base.where("n_shingles > 0").groupBy("same").agg(F.min("rid").alias("node"), F.min("doc_id").alias("low"))
    nodes = written(nodes, "distinct-sets")
    own = written(base.join(nodes.select("node"), F.col("rid") == F.col("node")).select("node", "prints", "bands"), "set-sketches")
    each = own.select("node", F.explode("bands").alias("bucket"))
    shared = written(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "shared-bands")
    live = written(each.join(shared, "bucket").select("bucket", "node"), "live")
    candidates = written(live.select("node").distinct(), "candidates")
    texts = candidates.join(own.select("node", "prints"), "node").join(rows.select(F.col("rid").alias("node"), "text"), "node")

    def sets(batch: pa.RecordBatch) -> dict:
        shingles = Shingles(words)
        return {n: batch.column(n) for n in ("node", "prints")} | {"members": [shingles.of(x).tobytes() for x in lowered(raw_texts(batch))]}

    candidates = written(arrow(texts, sets, "node long, prints binary, members binary"), "candidate-sets")
    roots = links_of(live, candidates, percent, miss, cell_rows)
    placed = nodes.join(roots, "node", "left").select("same", "low", F.coalesce("root", "node").alias("root"))
    placed = written(placed, "placed-sets")
    named = written(placed.groupBy("root").agg(F.min("low").alias("component_id")), "named")
    named = written(placed.join(named, "root").select("same", "component_id"), "named-sets")
    full = base.where("n_shingles > 0").join(named, "same").select("doc_id", "n_shingles", "component_id")
    empty = base.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_minhash(spark, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"))


QUERIES = {"op11_minhash": op11_minhash}
ORACLE: dict[str, str] = {}
