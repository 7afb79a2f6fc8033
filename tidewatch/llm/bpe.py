"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

A text is cut into words by the tokenizer's pattern. The parts of a word's byte array that may be tokens, those of a length that tokens
with the same first three bytes have, are looked up by their check sum in a constant rank map; one more constant has the two tokens that
each token is made of. A fold in order of rank then applies these
merges to the word, each at all its places; the word is kept as text in which one character stands for one token. A rank found only
because its token shares a check sum with some part changes nothing: its two tokens never stand side by side. This is the result of
merging the leftmost pair of lowest rank again and again, for a vocabulary in which each token's own bytes encode to it (checked
when the vocabulary is read): then a token arises from one pair only, and a merge never makes a pair of lower rank.

The words of the corpus are counted, and the most frequent ones (at most `dictionary`, whose encodings become constants too) are
folded once for all documents; any other word is folded where it stands, by the same expression, so the dictionary's size changes
the work and not the result. A word is looked up in the tier of the most frequent words first, then in the next.

Where documents are encoded, these constants are one stored row, which a plan names as a scalar subquery: they reach the tasks flat, and the
texts of plans, which the driver keeps for each execution, do not hold them. `fold` and `decoded` alone, without a stored row, name literals. Ids stay text, from the word to the document's digest. Decoding cuts that text into numbers and joins the byte pieces of the ids, as text in which each character stands for one byte.

Letters, digits and blanks are those of the JVM's Unicode version. Defined results: null text counts as empty and has no ids.
Repeated rows give repeated rows. Other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import itertools
import json
import zlib
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import table
from tidewatch.session import release, written

#: Words of a tier of the dictionary, and of all its tiers, at most.
TIER = 1 << 17
DICTIONARY = 2 * TIER

_TOKEN_BUCKETS = 1 << 18
_START_BUCKETS = 1 << 16
#: Bits of a check sum that give a word's place in the dictionary; the other bits give the step by which that place is moved.
_PLACE_BITS = 18
#: Tokens of several bytes are the characters from here on, by rank; single bytes are the characters 0 to 255.
_ABOVE = 0x10000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _constant(value, kind: str) -> Column:
    """A literal of a nested type; folded to a constant when the query is planned."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def merges_of(ranks: dict[bytes, int]) -> dict[bytes, tuple[bytes, bytes]]:
    """The last two parts of each token before it is whole."""
    found = {}
    for token, own in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            rank, at = min((ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1))
            if rank >= own:
                raise ValueError(f"token {own} does not arise from merges of lower rank")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            found[token] = parts[0], parts[1]
    return found


def _placed(common: dict[str, str]) -> tuple[list[int], list[str | None], list[str | None]]:
    """Steps by the upper bits of the check sum, and words (base 64) and their ids by place: the lower bits and the step, so that no two share one.

    Of words with one check sum the first stays.
    """
    groups: dict[int, dict[int, str]] = {}
    for word in common:
        upper, lower = divmod(zlib.crc32(word.encode()), 1 << _PLACE_BITS)
        groups.setdefault(upper, {}).setdefault(lower, word)
    steps, taken = [0] * (1 << (32 - _PLACE_BITS)), {}
    for upper in sorted(groups, key=lambda u: (-len(groups[u]), u)):
        step = next(n for n in itertools.count() if not any(lower + n in taken for lower in groups[upper]))
        steps[upper] = step
        taken.update((lower + step, word) for lower, word in groups[upper].items())
    places = range(max(taken, default=-1) + 1)
    words = [base64.b64encode(taken[at].encode()).decode() if at in taken else None for at in places]
    return steps, words, [common[taken[at]] if at in taken else None for at in places]


class Codec:
    """Expressions for one vocabulary of ranks. All 256 single bytes must have a rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.merges = ranks, merges_of(ranks)
        self.longest = max(map(len, ranks))
        # Blanks as Unicode defines them; the pattern's \\p classes are Unicode's anyway.
        self.pattern = "(?U)" + pattern

    def _char(self, token: bytes) -> str:
        return token.decode("latin-1") if len(token) == 1 else chr(_ABOVE + self.ranks[token])

    @cached_property
    def _rank_map(self) -> list[str | None]:
        """By the end of the check sum: the tokens of several bytes that have it, as characters; null if there are none."""
        buckets: list[str | None] = [None] * _TOKEN_BUCKETS
        for token in self.merges:
            at = zlib.crc32(token) % _TOKEN_BUCKETS
            buckets[at] = (buckets[at] or "") + self._char(token)
        return buckets

    @cached_property
    def _lengths(self) -> list[list[int] | None]:
        """By the end of the check sum of three bytes: the lengths of the tokens that begin with them, always with 2; null for 2 alone."""
        found: dict[int, set[int]] = {}
        for token in self.merges:
            if len(token) > 2:
                found.setdefault(zlib.crc32(token[:3]) % _START_BUCKETS, {2}).add(len(token))
        return [sorted(found[at]) if at in found else None for at in range(_START_BUCKETS)]

    @cached_property
    def _merged(self) -> list[str | None]:
        """By rank: the two tokens that each token is made of, as two characters (null for a single byte)."""
        tokens = sorted(self.ranks, key=self.ranks.get)
        if [self.ranks[t] for t in tokens] != list(range(len(tokens))):
            raise ValueError("ranks must be 0, 1, 2, ... without gaps")
        parts = [self.merges.get(t) for t in tokens]
        return [self._char(p[0]) + self._char(p[1]) if p else None for p in parts]

    @cached_property
    def _byte_ids(self) -> list[int]:
        return [self.ranks[bytes([b])] for b in range(256)]

    @cached_property
    def _pieces(self) -> list[str]:
        pieces = [""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            pieces[rank] = token.decode("latin-1")
        return pieces

    def _literals(self, *names: str) -> dict[str, Column]:
        return {n: _constant(getattr(self, f"_{n}"), _KINDS[n]) for n in names}

    def stored(self, spark: SparkSession) -> DataFrame:
        """One row with all tables of the vocabulary."""
        rows = spark.createDataFrame([tuple(getattr(self, f"_{n}") for n in _KINDS)], ", ".join(f"{n} {kind}" for n, kind in _KINDS.items()))
        return written(rows, "vocabulary")

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def fold(self, word: Column) -> Column:
        """The ids of one word, as text joined by commas."""
        tables = self._literals("rank_map", "lengths", "merged", "byte_ids")
        return F.array_join(F.transform(F.array(word.cast("binary")), lambda raw: self._fold(raw, tables)), "")

    def _fold(self, raw: Column, tables) -> Column:
        """Of the variable of a higher-order function, which may be named often; tables gives columns by name."""

        def look(table: Column, buckets: int, at: Column, n: Column) -> Column:
            return F.get(table, F.crc32(F.substring(raw, at, n)).bitwiseAND(F.lit(buckets - 1).cast("long")))

        def from_place(at: Column) -> Column:
            """What is cut off by the word's end is a shorter part of it, which may be looked up as well."""
            lengths = F.coalesce(look(tables["lengths"], _START_BUCKETS, at, F.lit(3)), F.array(F.lit(2)))
            return F.array_join(F.transform(lengths, lambda n: look(tables["rank_map"], _TOKEN_BUCKETS, at, n)), "")

        # Characters are in order of rank; one found twice gives a merge that does nothing the second time.
        found = F.array_join(F.transform(F.sequence(F.lit(1), F.length(raw) - 1), from_place), "")
        tokens = F.sort_array(F.array_remove(F.split(found, ""), ""))
        text = F.aggregate(tokens, F.decode(raw, "ISO-8859-1"), lambda t, c: F.replace(t, F.get(tables["merged"], F.ascii(c) - _ABOVE), c))
        ids = F.transform(F.split(text, ""), lambda c: F.coalesce(F.get(tables["byte_ids"], F.ascii(c)), F.ascii(c) - _ABOVE))
        return F.array_join(ids, ",")

    def _encoded(self, raws: Column, tables, tiers: int) -> Column:
        """The ids of an array of words, as text joined by commas."""
        if not tiers:
            return F.array_join(F.transform(raws, lambda w: self._fold(w, tables)), ",")

        def place(w: Column, tier: int) -> Column:
            at = F.transform(F.array(F.crc32(w)), lambda s: s.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1).cast("long")) + F.get(tables[f"steps_{tier}"], F.shiftright(s, _PLACE_BITS)))
            return F.get(at, F.lit(0))

        def known(w: Column, at: Column, tier: int) -> Column:
            found = F.when(F.get(tables[f"words_{tier}"], at) == w, F.get(tables[f"ids_{tier}"], at))
            if tier + 1 == tiers:
                return found.otherwise(self._fold(w, tables))
            return found.otherwise(F.get(F.transform(F.array(place(w, tier + 1)), lambda other: known(w, other, tier + 1)), F.lit(0)))

        return F.array_join(F.zip_with(raws, F.transform(raws, lambda w: place(w, 0)), lambda w, at: known(w, at, 0)), ",")

    def decoded(self, ids: Column, tables=None) -> Column:
        """The bytes of an array of ids."""
        pieces = (self._literals("pieces") if tables is None else tables)["pieces"]
        return F.encode(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""), "ISO-8859-1")


#: The tables of a vocabulary.
_KINDS = {"rank_map": "array<string>", "lengths": "array<array<int>>", "merged": "array<string>", "byte_ids": "array<int>", "pieces": "array<string>"}


def _with(docs: DataFrame, name: str, held: Column, tables: DataFrame, make: Callable[[Column, Column], Column]) -> DataFrame:
    """docs and one more column: make of the value held and of the tables, the columns of one stored row.

    A subquery may not be written within a higher-order function, so the stored row is a column first; as it is named once, Spark's
    optimizer puts the subquery in its place, and no row carries the tables. A test holds it to that.
    """
    wide = docs.select("*", held.alias("held"), tables.select(F.struct("*")).scalar().alias("tables"))
    apart = lambda t: F.array(F.struct(t["held"].alias("held"), *[t["tables"][n].alias(n) for n in tables.columns]))
    made = F.transform(F.array(F.struct("held", "tables")), lambda t: F.get(F.transform(apart(t), lambda each: make(each["held"], each)), F.lit(0)))
    return wide.select(*docs.columns, F.get(made, F.lit(0)).alias(name))


def common_words(docs: DataFrame, codec: Codec, tables: DataFrame, most: int = DICTIONARY) -> list[DataFrame]:
    """Encodings of the words that stand in the most documents: all words of more than some number of documents, `most` at most.

    One stored row per tier, of the words' places (see _placed).
    """
    words = docs.select(F.explode(F.array_distinct(codec.words(F.col("text").cast("string")))).alias("word"))
    counts = written(words.groupBy("word").agg(F.count("*").alias("n")), "words")
    steps = counts.groupBy("n").agg(F.count("*").alias("words"))
    least, total = None, 0
    for n, step in steps.orderBy(F.desc("n")).limit(most).collect():  # one row per distinct count
        if total + step > most:
            break
        least, total = n, total + step
    if least is None:
        return []
    chosen = _with(counts.where(F.col("n") >= least), "ids", F.col("word").cast("binary"), tables, codec._fold)
    found = chosen.toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    return [_tier(docs.sparkSession, tier, found.slice(start, TIER)) for tier, start in enumerate(range(0, found.num_rows, TIER))]


def _tier(spark: SparkSession, tier: int, found) -> DataFrame:
    row = _placed(dict(zip(found.column("word").to_pylist(), found.column("ids").to_pylist())))
    row = spark.createDataFrame([row], f"steps_{tier} array<int>, words_{tier} array<string>, ids_{tier} array<string>")
    return written(row.withColumn(f"words_{tier}", F.transform(f"words_{tier}", F.unbase64)), "dictionary")


def encode(docs: DataFrame, codec: Codec, most: int = DICTIONARY, tables: DataFrame | None = None) -> DataFrame:
    """The columns of docs as `row`, `ids`, and `joined`: the ids as text joined by commas. tables: the codec's, if they are stored already."""
    spark = docs.sparkSession
    tables = codec.stored(spark) if tables is None else tables
    tiers = common_words(docs, codec, tables.drop("pieces"), most)
    release(spark)  # what counting, folding and placing the words left
    held = tables.drop("pieces")
    for tier in tiers:
        held = held.crossJoin(tier)
    if tiers:
        held = written(held, "tables")
    rows = docs.select(F.struct("*").alias("row"), codec.words(F.col("text").cast("string")).cast("array<binary>").alias("words"))
    rows = _with(rows, "joined", F.col("words"), held, lambda raws, t: codec._encoded(raws, t, len(tiers))).select("row", "joined")
    return rows.select("row", "joined", F.when(F.col("joined") == "", F.array().cast("array<int>")).otherwise(F.split("joined", ",").cast("array<int>")).alias("ids"))


def encode_and_decode(docs: DataFrame, codec: Codec, most: int = DICTIONARY) -> DataFrame:
    """What encode gives, and `decoded`: the bytes of the ids."""
    tables = codec.stored(docs.sparkSession)
    return _with(encode(docs, codec, most, tables), "decoded", F.col("ids"), tables.select("pieces"), codec.decoded)


def digests(docs: DataFrame, codec: Codec, most: int = DICTIONARY) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    rows = encode_and_decode(docs.select(F.col("doc_id").cast("long"), "text"), codec, most)
    return rows.select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("joined", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def public_codec(name: str = "byte_bpe_multi_50k.tiktoken") -> Codec:
    import public_tokenizers

    return Codec(read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN)


def op1_bpe(spark, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"), public_codec())


QUERIES = {"op1_bpe": op1_bpe}
ORACLE: dict[str, str] = {}
