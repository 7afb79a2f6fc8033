"""SimHash near-duplicates by anchor points.

Fingerprints of 64 bits link at 4 or fewer differing bits. They are cut into three segments of 21, 21 and 22 bits: two linked
fingerprints differ in at most one bit of some segment. On each segment a covering code gives the anchors: the perfect Hamming
code on 15 bits, with the remaining 6 or 7 bits free, has covering radius 1. Each fingerprint goes to every anchor within the
radius plus the segment's threshold, 1 + 1 = 2 bits (about 15 anchors a segment), and is at home at the one within the radius.
Of two linked fingerprints, each meets the other at its home anchor, so comparing each anchor's members loses no link.

Only distinct fingerprints take part. Anchors with very many members are split into cells, home rows by member rows. A cell
gives a spanning forest of its links, not all pairs. Components come from alternating star steps on Spark.

Defined results: null text counts as empty; a text without words has fingerprint zero and is linked like any other. Repeated
rows stay separate rows. Null ids never name a component; a component of null ids only has a null name. Other columns of the
input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import arrow, components, lowered, raw_texts, table
from tidewatch.session import written

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
#: First bit and width of the segments.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
#: Rows of an anchor that one cell holds on either side.
CELL_ROWS = 4096

_CODE_BITS = 15


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a lower-cased text: words parted by ASCII white space, all shingles with repeats."""
    words = text.split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    spans = zip(starts[: len(words) - shingle_words + 1].tolist(), (ends[shingle_words - 1 :] - 1).tolist())
    digest, total, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - shingle_words + 1
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, count)
    for at in range(0, count, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > count, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *carried: str) -> DataFrame:
    """(doc_id, fp) per row of docs, with its whole numbers `carried`; fp is the fingerprint as a signed long."""
    numbers = ("doc_id", *carried)

    def make(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(x) for x in lowered(raw_texts(batch))], np.uint64)
        return {n: batch.column(n) for n in numbers} | {"fp": found.view(np.int64)}

    rows = docs.select(*[F.col(n).cast("long") for n in numbers], F.col("text").cast("string"))
    return arrow(rows, make, ", ".join(f"{n} long" for n in (*numbers, "fp")))


def _syndromes(words: np.ndarray) -> np.ndarray:
    """XOR of the positions (1-15) of the set bits: 0 for code words, else the position whose change gives one."""
    out = np.zeros_like(words)
    for bit in range(_CODE_BITS):
        out ^= np.where((words >> bit) & 1, bit + 1, 0)
    return out


def anchors_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For unsigned fingerprints: (row, anchor, home) for each anchor within two bits in some segment."""
    rows, anchors, homes = [], [], []
    index = np.arange(len(fps))

    def add(where, segment, free, word, home):
        rows.append(index[where])
        anchors.append((((np.int64(segment) << 7) | free[where]) << _CODE_BITS) | word[where])
        homes.append(np.full(int(where.sum()), home))

    for segment, (first, width) in enumerate(SEGMENTS):
        part = ((fps >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
        free, word = part >> _CODE_BITS, part & ((1 << _CODE_BITS) - 1)
        syndrome = _syndromes(word)
        exact = syndrome == 0
        nearest = np.where(exact, word, word ^ (1 << np.maximum(syndrome - 1, 0)))
        everywhere = np.ones(len(fps), bool)
        add(everywhere, segment, free, nearest, True)
        free_bits = [1 << b for b in range(width - _CODE_BITS)]
        for a in free_bits:
            add(everywhere, segment, free ^ a, nearest, False)
        for x, a in enumerate(free_bits):
            for b in free_bits[:x]:
                add(exact, segment, free ^ (a | b), nearest, False)
        for i in range(1, _CODE_BITS + 1):  # the other code words two bits away: change positions i and j, i xor j = syndrome
            j = i ^ syndrome
            fits = ~exact & (i < j) & (j <= _CODE_BITS)
            add(fits, segment, free, word ^ (1 << (i - 1)) ^ (1 << np.maximum(j - 1, 0)), False)
    return np.concatenate(rows), np.concatenate(anchors), np.concatenate(homes)


def _replicate(batch: pa.RecordBatch) -> dict:
    fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    rows, anchors, homes = anchors_of(fps)
    return {"anchor": anchors, "fp": fps.view(np.int64)[rows], "home": homes}


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join the same rows as all links do: each row is compared with those not reached yet."""
    links, waiting = [], fps
    while len(waiting):
        queue, waiting = [waiting[0]], waiting[1:]
        while queue:
            one = queue.pop()
            near = np.bitwise_count(waiting ^ one) <= max_bits
            if near.any():
                reached = waiting[near]
                links += [(one, x) for x in reached]
                queue += list(reached)
                waiting = waiting[~near]
    return links


def _compare(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def finish(cells, fps, homes):
            """Links of whole cells."""
            out_a, out_b = [], []
            starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(cells)])))
            small = (sizes > 1) & (sizes <= 32)
            size_of = np.repeat(np.where(small, sizes, 0), sizes)
            start_of = np.repeat(starts, sizes)
            home_rows = np.flatnonzero(homes & (size_of > 0))
            for at in range(0, len(home_rows), 1 << 16):
                some = home_rows[at : at + (1 << 16)]
                n = size_of[some]
                left = np.repeat(some, n)
                right = np.repeat(start_of[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                a, b = fps[left], fps[right]
                near = (np.bitwise_count(a ^ b) <= max_bits) & (a != b)
                out_a.append(a[near])
                out_b.append(b[near])
            for start, size in zip(starts[sizes > 32], sizes[sizes > 32]):
                for a, b in _forest(np.unique(fps[start : start + size]), max_bits):
                    out_a.append(np.array([a], np.uint64))
                    out_b.append(np.array([b], np.uint64))
            a, b = (np.concatenate(x).view(np.int64) if x else np.array([], np.int64) for x in (out_a, out_b))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            part = (
                batch.column("cell").to_numpy(zero_copy_only=False),
                batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64),
                batch.column("home").to_numpy(zero_copy_only=False),
            )
            if not len(part[0]):
                continue
            held.append(part)
            if part[0][0] == part[0][-1] and held[0][0][0] == part[0][0]:
                continue  # still the same cell; cells are bounded
            cells, fps, homes = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(cells, cells[-1]))
            held = [(cells[cut:], fps[cut:], homes[cut:])]
            if cut:
                yield finish(cells[:cut], fps[:cut], homes[:cut])
        if held:
            yield finish(*(np.concatenate(x) for x in zip(*held)))

    return run


def links_of(fps: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints fps (fp), enough to give all components."""
    rows = arrow(fps.select("fp"), _replicate, "anchor long, fp long, home boolean")
    sizes = rows.groupBy("anchor").agg(F.count("*").alias("members"), F.sum(F.col("home").cast("long")).alias("homes"))
    split = written(sizes.where(F.col("members") > cell_rows), "large-anchors")
    rows = rows.join(split, "anchor", "left")
    # A home row meets all members: it stands in every column of its row of cells, and as a member in every row of its column.
    # Anchors that are not split have the one cell (0, 0), where a home row stands once.
    down, across = (F.greatest(F.ceil(F.coalesce(c, F.lit(0)) / cell_rows), F.lit(1)) for c in ("homes", "members"))
    i, j = F.pmod(F.xxhash64("fp"), down), F.pmod(F.xxhash64("fp", F.lit(1)), across)
    as_home = F.transform(F.sequence(F.lit(0).cast("long"), across - 1), lambda x: F.struct(i.alias("i"), x.alias("j"), F.lit(True).alias("home")))
    as_member = F.transform(F.sequence(F.lit(0).cast("long"), down - 1), lambda x: F.struct(x.alias("i"), j.alias("j"), F.lit(False).alias("home")))
    places = F.when(~F.col("home"), as_member).when(F.col("members").isNull(), as_home).otherwise(F.concat(as_home, as_member))
    cells = rows.select("anchor", "fp", F.explode(places).alias("c"))
    cells = cells.select((F.col("anchor") * (1 << 38) + F.col("c.i") * (1 << 19) + F.col("c.j")).alias("cell"), "fp", "c.home")
    cells = cells.repartition("cell").sortWithinPartitions("cell")
    return cells.mapInArrow(_compare(max_bits), "a long, b long")


def _rooted(fps: DataFrame, **settings) -> DataFrame:
    """fps (distinct fp, and more) with the root of its component."""
    roots = components(links_of(fps, **settings))
    return fps.join(roots, fps.fp == roots.node, "left").select(*fps.columns, F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame, **settings) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, fingerprint (16 hex digits), component_id."""
    base = written(fingerprints(docs), "fingerprints")
    fps = written(base.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    placed = _rooted(fps, **settings)
    named = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = placed.join(named, "root").select("fp", "component_id")
    return base.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs that stay, with all columns: one of each component, with its smallest doc_id; null ids come last.

    Rows are numbered and written with their numbers first, so ids need not tell rows apart.
    """
    rows = written(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct("*").alias("row")), "numbered-rows")
    base = fingerprints(rows.select("rid", "row.doc_id", "row.text"), "rid")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp", "rid")
    fps = written(base.groupBy("fp").agg(F.min(place).alias("first")), "distinct-fingerprints")
    stay = _rooted(fps, **settings).groupBy("root").agg(F.min("first").alias("first")).select("first.rid")
    return rows.join(stay, "rid").select("row.*")


def op10_simhash(spark, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"))


QUERIES = {"op10_simhash": op10_simhash}
ORACLE: dict[str, str] = {}
