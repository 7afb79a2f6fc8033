"""Mixing sources to target weights, with DataFrame operations only.

The words of each source, documents in a hashed order, are packed into blocks of a fixed length. A source's target decides how
many slots it fills: whole passes over its blocks, and a part of one more. Each slot draws its output shard, so the counts of a
source over the shards are multinomial, given the source's total. The slots of a shard are mapped to blocks by a keyed
permutation of the source's block numbers, another one for each pass, and joined with the blocks by number.

The permutation is a swap-or-not shuffle on exactly the source's block numbers, so no walk through unused numbers is needed. Positions within a source come from sums over small
buckets of documents and then over the buckets' totals: no task holds a source.

Targets: sources by code point, null last, weigh 1, 2, 3, repeating, and share all words; a target stops at three times its
source's words, and the excess goes to the others by weight until none is above.

Defined results: null text has no words; a document without words is never taken. A null source is a source of its own.
Repeated rows are separate documents. Null ids are allowed. Other columns of the input are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import table
from tidewatch.session import written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 26
MOST_PASSES = 3
ROUNDS = 12
SEED = 20240607

_BUCKET_ROWS = 512
_CHUNK = 1 << 14


def sized(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, source, size); written, so that rid stays what it is."""
    return written(_sized(docs), "sizes")


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), F.col("source").cast("string"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), *more,
    )


def targets(sizes: DataFrame) -> DataFrame:
    """(source, sid, weight, source_size, target): one row per source, numbered from 1."""
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source in one task: the number of sources, not of documents, is what it holds.
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    by_cap = Window.orderBy("ratio", "sid")
    each = each.withColumn("sid", F.row_number().over(by_name)).withColumn("weight", (F.col("sid") - 1) % 3 + 1)
    each = each.withColumn("cap", (MOST_PASSES * F.col("source_size")).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    full = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(everything) - full) / rest
    each = each.withColumn("level", level).withColumn("open", F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "sid", "level")))
    share = F.min("open").over(everything).getField("level")
    return each.select("source", "sid", "weight", "source_size", F.coalesce(F.least("cap", F.col("weight") * share), "cap").alias("target"))


def blocks_of(sizes: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """(sid, block, rid, first, words): which words of which document, counted from 0, stand in which block."""
    buckets = max(1, -(-sizes.count() // _BUCKET_ROWS))
    rows = sizes.where("size > 0").join(sources.select("source", "sid"), sizes.source.eqNullSafe(sources.source))
    order = F.xxhash64("doc_id", F.lit(SEED))
    rows = rows.select("rid", "doc_id", "sid", "size", order.alias("place"), F.pmod(F.xxhash64("doc_id", "size", F.lit(SEED + 1)), F.lit(buckets)).alias("bucket"))
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("sid", "bucket").orderBy("place", "doc_id", "size", "rid").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("offset", F.coalesce(F.sum("size").over(within), F.lit(0))).join(sums, ["sid", "bucket"])
    start = F.col("base") + F.col("offset")
    rows = rows.select("sid", "rid", start.alias("start"), (start + F.col("size")).alias("end"))
    spans = F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("end") - 1) / block_words))
    rows = rows.select("*", F.explode(spans).alias("block"))
    first = F.greatest("start", F.col("block") * block_words)
    last = F.least("end", (F.col("block") + 1) * block_words)
    return rows.select("sid", "block", "rid", (first - F.col("start")).alias("first"), (last - first).cast("int").alias("words"))


def _chunked(rows: DataFrame, count: Column, *keep: str) -> DataFrame:
    """Number 0 .. count-1 for each row, spread over tasks in chunks: (keep..., n)."""
    rows = rows.withColumn("count", count).where("count > 0")
    rows = rows.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1, F.lit(_CHUNK).cast("long"))))
    # A number of partitions that adaptive execution keeps: a few rows become very many.
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keep, "from")
    return rows.select(*keep, F.explode(F.sequence(F.col("from"), F.least(F.col("from") + _CHUNK, "count") - 1)).alias("n"))


def _permuted(index: Column, keys: Column, blocks: Column) -> Column:
    """Swap-or-not: a bijection of 0 .. blocks-1 for each array of round keys."""

    def turn(x: Column, key: Column) -> Column:
        other = F.pmod(key - x, blocks)
        return F.when(F.xxhash64(key, F.greatest(x, other)) % 2 == 0, other).otherwise(x)

    return F.aggregate(keys, index, turn)


def slots(sources: DataFrame, block_words: int, shard_words: int) -> DataFrame:
    """(sid, shard, slot, block): the blocks that each shard takes from each source, in order."""
    blocks = F.ceil(F.col("source_size") / block_words)
    passes = F.floor(F.col("target") / F.col("source_size"))
    rest = F.round((F.col("target") - passes * F.col("source_size")) / block_words)
    plan = sources.where("source_size > 0").select(
        "sid", blocks.cast("long").alias("blocks"), (passes * blocks + F.least(rest, blocks)).cast("long").alias("slots"),
        F.greatest(F.ceil(F.sum("source_size").over(Window.partitionBy()) / shard_words), F.lit(1)).cast("long").alias("shards"),
    )
    draws = _chunked(plan, F.col("slots"), "sid", "shards")
    draws = draws.groupBy("sid", F.pmod(F.xxhash64("sid", "n", F.lit(SEED + 2)), "shards").alias("shard")).agg(F.count("*").alias("drawn"))
    ahead = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranges = draws.withColumn("base", F.coalesce(F.sum("drawn").over(ahead), F.lit(0))).join(plan.select("sid", "blocks"), "sid")
    filled = _chunked(ranges, F.col("drawn"), "sid", "shard", "base", "blocks").withColumn("at", F.col("base") + F.col("n"))
    filled = filled.withColumn("pass", F.floor(F.col("at") / F.col("blocks")))
    keys = F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: F.pmod(F.xxhash64("sid", "pass", r, F.lit(SEED + 3)), "blocks"))
    block = _permuted(F.col("at") - F.col("pass") * F.col("blocks"), F.col("keys"), F.col("blocks"))
    return filled.withColumn("keys", keys).select("sid", "shard", F.col("n").alias("slot"), block.alias("block"))


def mixture(sizes: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and the mix (shard, sid, slot, rid, first, words) over rows from `sized`."""
    sources = written(targets(sizes), "targets")
    # The planner takes the slots for few rows, as they come from few sources; the hint keeps them from being broadcast.
    taken = slots(sources, block_words, shard_words).hint("merge").join(blocks_of(sizes, sources, block_words), ["sid", "block"])
    return sources, taken.select("shard", "sid", "slot", "rid", "first", "words")


def mixed_counts(docs: DataFrame, **settings) -> DataFrame:
    """One row per row of docs (doc_id, text, source): doc_id, size, source_size, target, taken."""
    sizes = sized(docs)
    sources, taken = mixture(sizes, **settings)
    sums = taken.groupBy("rid").agg(F.sum("words").alias("taken"))
    rows = sizes.join(sources.withColumnRenamed("source", "name"), sizes.source.eqNullSafe(F.col("name")))
    return rows.join(sums, "rid", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix as documents, with all columns of docs: the n-th copy of a document holds its words that the mix takes n times or
    more, in order, with the white space before them; a document taken whole keeps its text as it is. n_chars follows the text."""
    tagged = written(_sized(docs, F.struct("*").alias("row")), "tagged")
    _, taken = mixture(tagged.select("rid", "doc_id", "source", "size"), **settings)
    times = taken.groupBy("rid", "first", "words").agg(F.count("*").cast("int").alias("times"))
    copies = times.select("rid", "first", "words", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    # A document has at most its length of blocks; this gathers no more than its text holds.
    copies = copies.groupBy("rid", "copy").agg(F.array_sort(F.collect_list(F.struct("first", "words"))).alias("parts"), F.sum("words").alias("taken"))
    rows = tagged.join(copies, "rid")
    pieces = F.regexp_extract_all(F.col("row.text").cast("string"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.transform("parts", lambda p: F.array_join(F.slice("pieces", (p["first"] + 1).cast("int"), p["words"]), "")), "")
    whole = F.col("taken") == F.col("size")
    rows = rows.withColumn("pieces", F.when(whole, F.array().cast("array<string>")).otherwise(pieces))
    rows = rows.withColumn("mixed", F.when(whole, F.col("row.text").cast("string")).otherwise(cut))
    changes = {"text": F.col("mixed")} | ({"n_chars": F.length("mixed").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    row = F.struct(*[changes.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
    return rows.select(row.alias("row")).select("row.*")


def op3_mixing(spark, folder: str) -> DataFrame:
    return mixed_counts(table(spark, folder, "documents"))


QUERIES = {"op3_mixing": op3_mixing}
ORACLE: dict[str, str] = {}
