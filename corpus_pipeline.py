"""The corpus pipeline: from documents to tokens, in stages that each read what the one before has written.

Stages but the last return the columns of documents. Null texts count as empty, repeated rows are duplicates of one another, and
an empty table passes through as one; see the operators for the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bpe, exact_dedup, mixing, quality, simhash
from tidewatch.llm.common import ready, table
from tidewatch.session import release, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on labels that are not held out, does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    ready(spark)
    return exact_dedup.drop_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    ready(spark)
    return simhash.drop_near(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: documents as often, and as far, as the mix takes them."""
    ready(spark)
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, and decoded: whether the ids give back the text."""
    ready(spark)
    codec = bpe.public_codec()
    # The driver also holds what earlier stages left: a smaller dictionary, which changes the work and not the ids.
    most = bpe.TIER // 8
    text = F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    return bpe.encode_and_decode(docs.select("doc_id", "source", "text"), codec, most).select(
        "row.doc_id", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == text).alias("decoded"),
    )


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("SimHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokens),
]

#: The classifier, the fingerprints and the merges are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = written(docs, f"stage-{number + 1}")
            release(spark)
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
