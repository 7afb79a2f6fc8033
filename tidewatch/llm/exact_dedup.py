"""Exact duplicates by deterministic block naming.

A text, with A-Z lower-cased, is cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered, so
equal blocks and only they share an integer name. Then the names of adjacent blocks are paired, the distinct pairs sorted and
numbered, and so on until each text has one name. A name stands for its whole content: no hash decides equality.

Blocks travel compressed once, to be made distinct. References to blocks look their names up by a 64-bit key of the content;
where a key has two contents, which is found by counting, these references are looked up by content instead.

Defined results: null text counts as empty; all empty texts are equal. Rows repeated whole are separate rows of one group, of
which exactly one stays. Null ids are smaller than any id. Other columns of the input are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import lowered, raw_texts
from tidewatch.session import written

BLOCK_BYTES = 4096
KEY_BITS = 64

_BLOCKS = "rid long, doc_id long, text_sha256 string, n_blocks int, pos int, key long, block binary"


def _cut(block_bytes: int, key_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for rid, doc_id, text in zip(batch.column("rid").to_pylist(), batch.column("doc_id").to_pylist(), lowered(raw_texts(batch))):
                blocks = [text[at : at + block_bytes] for at in range(0, len(text), block_bytes)] or [b""]
                digest = hashlib.sha256(text).hexdigest()
                for pos, block in enumerate(blocks):
                    key = int.from_bytes(hashlib.blake2b(block, digest_size=8).digest(), "big", signed=True) >> (64 - key_bits)
                    rows.append((rid, doc_id, digest, len(blocks), pos, key, zlib.compress(block, 1)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            names = [part.split()[0] for part in _BLOCKS.split(", ")]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _named(distinct: DataFrame, columns: list[str]) -> DataFrame:
    """Number distinct rows in sorted order within their partition: integers that no two rows share."""
    return distinct.sortWithinPartitions(*columns).withColumn("name", F.monotonically_increasing_id())


def block_names(blocks: DataFrame) -> DataFrame:
    """(rid, pos, n, name) for rows with (rid, pos, n_blocks, key, block)."""
    names = written(_named(blocks.select("key", "block").distinct(), ["block"]).select("key", "name"), "names")
    shared = written(names.groupBy("key").count().where("count > 1").select("key"), "shared-keys")
    references = blocks.select("rid", "pos", F.col("n_blocks").alias("n"), "key")
    plain = references.join(names.join(shared, "key", "left_anti"), "key")
    # A key of several contents: their own numbers, below zero, found by content.
    contents = written(blocks.join(shared, "key").select("rid", "pos", F.col("n_blocks").alias("n"), "block"), "shared-contents")
    own = written(_named(contents.select("block").distinct(), ["block"]).select("block", (-1 - F.col("name")).alias("name")), "own-names")
    return plain.select("rid", "pos", "n", "name").unionByName(contents.join(own, "block").select("rid", "pos", "n", "name"))


def identities(named: DataFrame) -> DataFrame:
    """(rid, level, name): name pairs of adjacent names until one is left; equal only for equal sequences of names."""
    level, done = 0, named.where("n = 1").select("rid", F.lit(0).alias("level"), "name")
    rest = written(named.where("n > 1"), "level")
    while rest.limit(1).count():
        level += 1
        pairs = written(
            rest.groupBy("rid", F.floor(F.col("pos") / 2).cast("int").alias("at")).agg(
                F.max("n").alias("n"),
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("first"),
                F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("second"),
                F.count("*").alias("parts"),
            ).select("rid", F.col("at").alias("pos"), F.ceil(F.col("n") / 2).cast("int").alias("n"), "parts", "first", F.coalesce("second", F.lit(0)).alias("second")),
            "pairs",
        )
        names = written(_named(pairs.select("parts", "first", "second").distinct(), ["first", "second", "parts"]), "pair-names")
        named = pairs.join(names, ["parts", "first", "second"]).select("rid", "pos", "n", "name")
        named = written(named, "level")
        done = done.unionByName(named.where("n = 1").select("rid", F.lit(level).alias("level"), "name"))
        rest = named.where("n > 1")
    return done


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES, key_bits: int = KEY_BITS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Of each group the row with the largest doc_id stays (one of them, if rows repeat).
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    blocks = written(rows.mapInArrow(_cut(block_bytes, key_bits), _BLOCKS), "blocks")
    named = identities(block_names(blocks))
    heads = blocks.where("pos = 0").select("rid", "doc_id", "text_sha256")
    members = written(heads.join(named, "rid"), "members")
    groups = members.groupBy("level", "name").agg(
        F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"),
        F.max(F.struct("doc_id", "rid")).getField("rid").alias("keep_rid"),
    )
    return members.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256"
    )


@F.udf(T.StringType(), useArrow=True)
def _digest(text):
    return hashlib.sha256((text or "").encode().lower()).hexdigest()


def drop_exact(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    stay = written(exact_groups(docs, **settings), "exact-groups")
    repeated = stay.groupBy(F.col("doc_id"), "text_sha256").count().where("count > 1")
    stay = stay.where("kept").select(F.col("doc_id").alias("stay_id"), F.col("text_sha256").alias("stay_sha"))
    rows = docs.select(F.struct("*").alias("row"), _digest(F.col("text").cast("string")).alias("sha"))
    rows = rows.join(stay, (F.col("sha") == F.col("stay_sha")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("stay_id")))
    if repeated.limit(1).count():
        rows = rows.groupBy("stay_id", "stay_sha").agg(F.first("row").alias("row"))
    return rows.select("row.*")


def op5_exact_dedup(spark, folder: str) -> DataFrame:
    from tidewatch.llm.common import table

    return exact_groups(table(spark, folder, "documents"))


QUERIES = {"op5_exact_dedup": op5_exact_dedup}

ORACLE = {
    "op5_exact_dedup": """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256,
 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
 row_number() OVER (PARTITION BY body ORDER BY doc_id DESC) = 1 AS kept, text_sha256 FROM t""",
}
