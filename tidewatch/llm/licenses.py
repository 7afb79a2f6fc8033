"""License scans: phrases, and notices found by an exact set-similarity join.

Templates are the word sets of license notices. Text blocks are windows of WINDOW words at every STEP words, so that each run of
WINDOW - STEP words lies whole in one of them. A block meets a template if it contains at least THRESHOLD of the template's
words, among them those that name the license. The words are ordered by their frequency in the corpus, rare ones first; a block that meets a template of n words, of
which m are needed, has one of the n - m + 1 first of them (prefix filter), has at least m words (length filter), and the matching
word's place leaves at least m words to match (positional filter). Surviving pairs are counted exactly.

Phrases of license names are found as consecutive words; their labels stay whatever the join finds.

Defined results: null text counts as empty: no words, no labels, score 0. Repeated rows give repeated rows. Other columns of the
input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import arrow, lowered, raw_texts, table
from tidewatch.session import written

#: Words of a lower-cased text as bytes: digits, letters a-z and everything beyond ASCII.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW, STEP = 64, 32
THRESHOLD = 0.8

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices as commonly published, and their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
]

#: Words that name a license: a block without them does not meet a template of the label that has them.
NAMING = {
    "mit": {"mit"}, "apache": {"apache"}, "gpl": {"general", "public"}, "mpl": {"mozilla"}, "cc-by-nc": {"cc", "by", "nc"}, "cc-by": {"creative", "commons", "attribution"},
}


def _token_counts(docs: DataFrame, tokens: set[bytes]) -> dict[str, int]:
    """How often each template word stands in the corpus; one row per template word reaches the driver."""

    def make(batch: pa.RecordBatch) -> dict:
        counts = dict.fromkeys(tokens, 0)
        for text in lowered(raw_texts(batch)):
            for word in WORDS.findall(text):
                if word in counts:
                    counts[word] += 1
        return {"word": [w.decode() for w in counts], "n": list(counts.values())}

    rows = arrow(docs.select(F.col("text").cast("string")), make, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {row.word: row.n for row in rows.collect()}


def _places(words: list[bytes], phrase: bytes) -> list[int]:
    """Word numbers at which a phrase starts."""
    parts = phrase.split()
    found, at = [], -1
    while True:
        try:
            at = words.index(parts[0], at + 1)
        except ValueError:
            return found
        if words[at : at + len(parts)] == parts:
            found.append(at)


def scan(docs: DataFrame, ranks: dict[str, int], first: set[str], phrases: dict[str, str], window: int, step: int) -> DataFrame:
    """Per row of docs: phrase places, and the blocks that hold a word of `first`, as (words, ranks of the template words)."""
    order = {w.encode(): r for w, r in ranks.items()}
    starts = {w.encode() for w in first}
    known = [(p.encode(), label) for p, label in phrases.items()]

    def blocks(words: list[bytes]) -> list[dict]:
        hits = sorted({b for at, w in enumerate(words) if w in starts for b in range(max(0, (at - window) // step + 1), at // step + 1)})
        found = []
        for number in hits:
            content = set(words[number * step : number * step + window])
            found.append({"size": len(content), "ranks": sorted(order[w] for w in content if w in order)})
        return found

    def make(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base", "blocks")}
        for text in lowered(raw_texts(batch)):
            words = WORDS.findall(text)
            places, labels = [], set()
            for phrase, label in known:
                # The last word of every phrase must be there; most texts have none.
                if phrase.split()[-1] in text:
                    here = _places(words, phrase)
                    places += here
                    labels |= {label} if here else set()
            out["n_words"].append(len(words))
            out["n_base"].append(len(places))
            out["first_word"].append(min(places, default=None))
            out["last_word"].append(max(places, default=None))
            out["base"].append(sorted(labels))
            out["blocks"].append(blocks(words))
        return out | {"doc_id": batch.column("doc_id")}

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow(
        rows, make,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, blocks array<struct<size:int,ranks:array<int>>>",
    )


def license_scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is the largest containment of a template that meets the threshold, and 1 where a phrase stands.
    """
    spark = docs.sparkSession
    longest = max(len(text.split()) for _, text in templates)
    if longest > window - step:
        raise ValueError(f"a template has {longest} words; windows hold runs of {window - step}")
    counts = _token_counts(docs, {w.encode() for _, text in templates for w in text.split()})
    words = sorted({w for _, text in templates for w in text.split()}, key=lambda w: (counts.get(w, 0), w))
    ranks = {w: r for r, w in enumerate(words)}
    rows, first = [], set()
    for number, (label, text) in enumerate(templates):
        own = sorted({ranks[w] for w in text.split()})
        must = sorted(ranks[w] for w in NAMING.get(label, set()) & set(text.split()))
        need = math.ceil(threshold * len(own) - 1e-9)
        for place in range(len(own) - need + 1):
            rows.append((own[place], place, number, label, len(own), need, own, must))
            first.add(words[own[place]])
    prefixes = spark.createDataFrame(rows, "rank int, place int, template int, label string, length int, need int, own array<int>, must array<int>")
    base = scan(docs, ranks, first, phrases, window, step)
    base = written(base.withColumn("rid", F.monotonically_increasing_id()), "license-blocks")
    blocks = base.select("rid", F.posexplode("blocks").alias("number", "block"))
    tokens = blocks.select("rid", "number", "block", F.explode("block.ranks").alias("rank"))
    # The templates are a parameter: a few rows each.
    pairs = tokens.join(F.broadcast(prefixes), "rank").where((F.col("block.size") >= F.col("need")) & (F.col("length") - F.col("place") >= F.col("need")))
    share = F.size(F.array_intersect("block.ranks", "own")) / F.col("length")
    pairs = pairs.where(F.size(F.array_intersect("block.ranks", "own")) >= F.col("need"))
    pairs = pairs.where(F.size(F.array_except("must", "block.ranks")) == 0)
    found = pairs.groupBy("rid").agg(F.collect_set("label").alias("found"), F.max(share).alias("share"))
    labels = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    return base.join(found, "rid", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def op7_license_scan(spark, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


QUERIES = {"op7_license_scan": op7_license_scan}
ORACLE: dict[str, str] = {}
