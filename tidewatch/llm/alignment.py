"""Alignment of two tokenizers over the same texts, by anchors at white space.

Each text is encoded whole by both tokenizers: space and text by a byte-level BPE (A), the text by a piece vocabulary (B), which
adds the space itself. Places where tokens of both end and the next tokens of both begin with a space are anchors; the bytes on
both sides are checked to be the same. They cut a document into windows of token ids. A window's alignment, its groups and its
links, depends on its ids alone, so it is computed once and remembered under the pair of id tuples (in a bounded memory of each worker).
Within a window two positions walk along the bytes, which takes one step per link.

An id pair's count is the number of documents that hold it linked. Counts are added per task and then by id pair. The most
frequent pairs (at most `frequent`, a parameter) are sent to all tasks; places of other pairs, each of which occurs in few
documents, are joined with the table of counts. Both ways give the same numbers.

Defined results: texts that are null, empty, or whose tokens of A or B do not give back the bytes of space and text have no tokens: zeros
and an empty groups_sha256. Strings of special tokens in texts are plain text. Repeated rows are separate documents. Null ids
are allowed. Other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import arrow, table
from tidewatch.session import written

#: Id pairs whose counts are sent to all tasks, at most (16 bytes each).
FREQUENT = 1 << 17
#: Windows that a worker remembers in each of two generations, and their most tokens.
REMEMBERED = 200_000
REMEMBERED_TOKENS = 48

# Fixed value: how byte-level pre-tokenizers cut a text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Bytes of text that are encoded in one call.
_CALL_BYTES = 1 << 20
_SPACE_MARK = "▁"
#: Distinct pairs that a task holds while counting.
_HELD_PAIRS = 1 << 20


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 stands for itself, the rest follows from 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def _piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:-1], 16)]) if is_byte else piece.replace(_SPACE_MARK, " ").encode()


def _ranked(told: dict, entries: list[bytes]):
    """The same encoder as ranks, several times as fast, for a plain byte-level BPE whose ids are in order of its merges; else None."""
    model, before = told["model"], told.get("pre_tokenizer") or {}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    plain = told.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    plain = plain and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    vocabulary, special = model["vocab"], {x["id"] for x in told.get("added_tokens", [])}
    plain = plain and all(vocabulary.get(a + b) == 256 + n for n, (a, b) in enumerate(merges)) and len(merges) + 256 + len(special) == len(entries)
    if not plain or any(n < 256 + len(merges) for n in special):
        return None
    import tiktoken

    ranks = {entries[n]: n for n in range(256 + len(merges))}
    return tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 256 + len(merges) else None


@dataclass
class Aligner:
    """Both tokenizers, the bytes of their tokens, and the windows aligned so far."""

    json_text: str
    model: bytes
    young: dict = field(default_factory=dict)
    old: dict = field(default_factory=dict)

    def __post_init__(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(self.json_text)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            known = all(c in alphabet for c in entry)
            self.bytes_a[number] = bytes(alphabet[c] for c in entry) if known else entry.encode()
        self.bytes_b = [_piece_bytes(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.size_b = len(self.bytes_b)
        self.lengths = [np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b)]
        self.starts = [np.cumsum(x) - x for x in self.lengths]
        self.flat = [np.frombuffer(b"".join(t), np.uint8) for t in (self.bytes_a, self.bytes_b)]
        self.written = [f"{n}{end}" for table, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;")) for n in range(len(table)) for end in ends]
        self.ranked = _ranked(json.loads(self.json_text), self.bytes_a)
        self.marked = [np.array([x.startswith(b" ") for x in t]) for t in (self.bytes_a, self.bytes_b)]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of all texts, by A and by B."""
        if self.ranked is not None:
            left = [self.ranked.encode_to_numpy(" " + x, disallowed_special=()) for x in texts]
        else:
            left = [np.array(x.ids, np.uint32) for x in self.a.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)]
        return left, [np.array(x, np.uint32) for x in self.b.encode(texts, num_threads=1)]

    def told(self, side: int, ids: np.ndarray) -> np.ndarray:
        """The bytes of tokens, joined."""
        return self.flat[side][_spread(self.starts[side][ids], self.lengths[side][ids])]

    def whole(self, texts: list[str], tokens: tuple[list[np.ndarray], list[np.ndarray]]) -> np.ndarray:
        """Which texts have tokens that give back space and text, on both sides."""
        want = [b" " + t.encode() if t else b"" for t in texts]
        sizes = np.array([len(w) for w in want], np.int64)
        good = sizes > 0
        for side in (0, 1):
            good &= np.array([self.lengths[side][x].sum() for x in tokens[side]], np.int64) == sizes
        for side in (0, 1):
            some = np.flatnonzero(good)
            if len(some):
                text = np.frombuffer(b"".join([want[n] for n in some]), np.uint8)
                wrong = self.told(side, np.concatenate([tokens[side][n] for n in some])) != text
                good[some] &= np.add.reduceat(wrong, np.cumsum(sizes[some]) - sizes[some], dtype=np.int64) == 0
        return good

    def align(self, ids: list[np.ndarray], n: list[np.ndarray]) -> list[tuple[int, bytes, str]]:
        """Per window, token sequences of A and B over the same bytes, laid end to end with n tokens each: groups, links and the groups' text.

        Links are pairs of ids (a * size_b + b), packed as 64-bit numbers. Between two neighbouring ends of any tokens lies one link: that of the
        tokens which cover the bytes there.
        """
        ends = [np.cumsum(self.lengths[side][ids[side]]) for side in (0, 1)]
        places = np.union1d(*ends)
        in_a, in_b = (np.searchsorted(e, places) for e in ends)
        pairs = (ids[0][in_a] * self.size_b + ids[1][in_b]).tobytes()
        shared = np.intersect1d(*ends, assume_unique=True)
        of = [np.searchsorted(shared, e) for e in ends]
        last = [shared[g] == e for g, e in zip(of, ends)]
        window = np.repeat(np.arange(len(n[0])), n[0])
        links = (8 * np.cumsum(np.bincount(window[in_a], minlength=len(n[0])))).tolist()
        groups = np.bincount(window[last[0]], minlength=len(n[0])).tolist()
        # The text: of each group the tokens of A, then those of B, each with what follows it.
        order = np.argsort(np.concatenate((2 * of[0], 2 * of[1] + 1)), kind="stable")
        written = np.concatenate((2 * ids[0] + last[0], 2 * (len(self.bytes_a) + ids[1]) + last[1]))[order]
        parts = list(map(self.written.__getitem__, written.tolist()))
        stops = np.cumsum(n[0] + n[1]).tolist()
        return [
            (count, pairs[i:j], "".join(parts[k:m])[:-1])
            for count, i, j, k, m in zip(groups, [0, *links], links, [0, *stops], stops)
        ]

    def windows(self, ids: list[np.ndarray], starts: list[np.ndarray], stops: list[np.ndarray]) -> list[tuple[int, bytes, str]]:
        """The alignments of different windows, remembered by their pairs of id tuples (each packed as numbers, A's length in front)."""
        n = [b - a for a, b in zip(starts, stops)]
        flat = [ids[side][_spread(starts[side], n[side])] for side in (0, 1)]
        ends = np.cumsum(n[0] + n[1] + 1)
        packed = np.empty(int(ends[-1]), np.uint32)
        begins = ends - n[0] - n[1] - 1
        packed[begins] = n[0]
        packed[_spread(begins + 1, n[0])], packed[_spread(begins + 1 + n[0], n[1])] = flat
        told = packed.tobytes()
        keys = [told[i:j] for i, j in zip((4 * begins).tolist(), (4 * ends).tolist())]
        found = list(map(self.young.get, keys))
        missing = [at for at, x in enumerate(found) if x is None]
        for at in missing:
            found[at] = self.old.get(keys[at])
        new = np.array([at for at in missing if found[at] is None], np.int64)
        if len(new):
            some = [ids[side][_spread(starts[side][new], n[side][new])] for side in (0, 1)]
            for at, x in zip(new.tolist(), self.align(some, [n[0][new], n[1][new]])):
                found[at] = x
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        for at in missing:
            if len(self.young) < REMEMBERED and len(keys[at]) <= 4 * REMEMBERED_TOKENS:
                self.young[keys[at]] = found[at]
        return found

    def documents(self, texts: list[str], tokens: tuple[list[np.ndarray], list[np.ndarray]]) -> Documents:
        """Align the token sequences of several texts; those whose tokens do not give back space and text have none."""
        out, at = Documents(len(texts)), np.flatnonzero(self.whole(texts, tokens))
        if not len(at):
            return out
        n = [np.array([len(side[d]) for d in at], np.int64) for side in tokens]
        ids = [np.concatenate([side[d] for d in at]).astype(np.int64) for side in tokens]
        # Both sides of a document have the same bytes, so positions over all documents agree too.
        cuts, ends = [], []
        for side in (0, 1):
            last = np.append(self.marked[side][ids[side][1:]], True)  # before a marked token
            last[np.cumsum(n[side]) - 1] = True  # a document's end
            cuts.append(np.flatnonzero(last) + 1)
            ends.append(np.cumsum(self.lengths[side][ids[side]])[cuts[side] - 1])
        _, *inside = np.intersect1d(*ends, assume_unique=True, return_indices=True)
        stops = [c[i] for c, i in zip(cuts, inside)]
        starts = [np.concatenate(([0], s[:-1])) for s in stops]
        # Equal windows of this call are found by a hash of their ids, so each is looked up once.
        hashes = np.zeros(len(stops[0]), np.uint64)
        for side in (0, 1):
            place = np.arange(len(ids[side])) - np.repeat(starts[side], stops[side] - starts[side])
            hashes += np.add.reduceat(_mixed((ids[side] | (side << 24) | place << 25).astype(np.uint64)), starts[side])
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        known = self.windows(ids, [x[first] for x in starts], [x[first] for x in stops])
        # Counts of windows to counts of documents.
        windows = np.searchsorted(stops[0], np.cumsum(n[0]))  # each document's last window
        of = np.repeat(np.arange(len(at)), np.diff(np.concatenate(([-1], windows))))
        each_links = np.array([len(w[1]) for w in known], np.int64) // 8
        groups, links = np.array([w[0] for w in known], np.int64)[which], each_links[which]
        out.n_a[at], out.n_b[at] = n
        out.n_groups[at], out.n_links[at] = (np.bincount(of, x, len(at)).astype(np.int64) for x in (groups, links))
        each = np.frombuffer(b"".join([w[1] for w in known]), np.int64)
        pairs = each[_spread((np.cumsum(each_links) - each_links)[which], links)]
        limit = len(self.bytes_a) * self.size_b
        found, out.times = np.unique(np.repeat(of, links) * limit + pairs, return_counts=True)
        out.pairs = found % limit
        out.n_pairs[at] = np.bincount(found // limit, minlength=len(at))
        texts_of = list(map([w[2] for w in known].__getitem__, which.tolist()))
        begin = 0
        for doc, end in zip(at.tolist(), (windows + 1).tolist()):
            out.groups[doc] = ";".join(texts_of[begin:end])
            begin = end
        return out


class Documents:
    """Per text: counts, the groups' text (None without tokens); then all texts' distinct linked pairs and how often each occurs."""

    def __init__(self, size: int):
        self.n_a, self.n_b, self.n_groups, self.n_links, self.n_pairs = (np.zeros(size, np.int64) for _ in range(5))
        self.groups: list[str | None] = [None] * size
        self.pairs = self.times = np.array([], np.int64)


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts, starts + 1, ... of each length, laid end to end."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers, one for each number."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(31))


#: Of this process: what a worker has aligned serves its later tasks.
_KNOWN: dict[str, Aligner] = {}


def _aligner(json_text: str, model: bytes) -> Aligner:
    key = hashlib.sha256(json_text.encode() + model).hexdigest()
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Aligner(json_text, model)
    return _KNOWN[key]


def read_tokenizers(path_a: str, path_b: str) -> tuple[str, bytes]:
    """The contents of both files, which travel to the tasks."""
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return json.dumps(json.load(a), ensure_ascii=False), b.read()


def _calls(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for at, text in enumerate(texts):
        held += len(text)
        if held >= _CALL_BYTES:
            yield start, at + 1
            start, held = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def aligned(docs: DataFrame, tokenizers: tuple[str, bytes]) -> DataFrame:
    """Per row of docs (doc_id, text): its counts and groups' digest, and its distinct linked pairs with how often each occurs. Written."""
    json_text, model = tokenizers

    def make(batch: pa.RecordBatch) -> dict:
        aligner = _aligner(json_text, model)
        texts = [x or "" for x in batch.column("text").to_pylist()]
        found = [aligner.documents(some, aligner.encode(some)) for some in (texts[i:j] for i, j in _calls(texts))]
        joined = {n: np.concatenate([getattr(d, n) for d in found]) for n in ("n_a", "n_b", "n_groups", "n_links", "n_pairs", "pairs", "times")} if found else {}
        places = pa.array(np.concatenate(([0], np.cumsum(joined.pop("n_pairs", [])))), pa.int32())
        out = {n: pa.ListArray.from_arrays(places, pa.array(joined.pop(n, []), kind)) for n, kind in (("pairs", pa.int64()), ("times", pa.int32()))}
        out["groups_sha256"] = ["" if g is None else hashlib.sha256(g.encode()).hexdigest() for d in found for g in d.groups]
        return {n: batch.column(n) for n in ("rid", "doc_id")} | {n: joined.get(n, []) for n in ("n_a", "n_b", "n_groups", "n_links")} | out

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    return written(arrow(rows, make, schema), "aligned")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per pair of this task; a document's pairs are distinct."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        pairs, docs = (np.concatenate(x) for x in zip(*held))
        both, place = np.unique(pairs, return_inverse=True)
        return both, np.bincount(place, docs, len(both)).astype(np.int64)

    for batch in batches:
        held.append(np.unique(batch.column("pairs").flatten().to_numpy(zero_copy_only=False), return_counts=True))
        size += len(held[-1][0])
        if size > _HELD_PAIRS:
            held = [merged()]
            size = len(held[0][0])
            if 2 * size > _HELD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], names=["pair", "docs"])
                held, size = [], 0
    if size:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["pair", "docs"])


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, docs, best): documents that hold the pair, and whether no other pair of its A id has more. Written."""
    counts = written(rows.select("pairs").mapInArrow(_count, "pair long, docs long").groupBy("pair").agg(F.sum("docs").alias("docs")), "pair-counts")
    counts = counts.withColumn("id_a", F.expr(f"pair div {size_b}"))
    # One row per id of the vocabulary of A, which bounds what is sent.
    most = counts.groupBy("id_a").agg(F.max("docs").alias("most"))
    return written(counts.join(F.broadcast(most), "id_a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pairs")


def align_tokenizers(docs: DataFrame, tokenizers: tuple[str, bytes], frequent: int = FREQUENT) -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_proto=tokenizers[1]).get_piece_size()
    rows = aligned(docs, tokenizers)
    counts = pair_counts(rows, size_b)
    top = counts.orderBy(F.col("docs").desc(), "pair").limit(frequent).toArrow().sort_by("pair")
    known, docs_of, is_best = (top.column(n).to_numpy() for n in ("pair", "docs", "best"))

    def add(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        pairs = batch.column("pairs").flatten().to_numpy(zero_copy_only=False)
        times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        of = np.repeat(np.arange(n), batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False))
        place = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
        found = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
        weight, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(weight, of[found], docs_of[place[found]] * times[found])
        np.add.at(best, of[found], is_best[place[found]] * times[found])
        split = np.searchsorted(of[~found], np.arange(1, n))
        return {"rid": batch.column("rid"), "count_sum": weight, "n_best": best, "pairs": np.split(pairs[~found], split), "times": np.split(times[~found], split)}

    sums = written(arrow(rows.select("rid", "pairs", "times"), add, "rid long, count_sum long, n_best long, pairs array<long>, times array<long>"), "sums")
    rare = sums.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("rid", "p.pairs", "p.times")
    rare = rare.join(counts, F.col("pairs") == F.col("pair")).select(
        "rid", (F.col("docs") * F.col("times")).alias("count_sum"), F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best")
    )
    total = sums.select("rid", "count_sum", "n_best").unionByName(rare).groupBy("rid").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return rows.join(total, "rid").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_alignment(spark, folder: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align_tokenizers(table(spark, folder, "documents"), read_tokenizers(*paths))


QUERIES = {"op13_alignment": op13_alignment}
ORACLE: dict[str, str] = {}
