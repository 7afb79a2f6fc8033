"""Exact token counts at every prefix of a text, by dynamic programming over a BPE vocabulary of pieces.

For each prefix the last token of its encoding is the one token that ends there and may follow the last token of the prefix
before it; two tokens may follow each other if merging the characters of both gives the two again. The count is one more than
that prefix's. No piece of the vocabulary reaches over a word start (a blank after another character) or over a line end, so a
text is a sequence of units with counts of their own, and equal units are counted once per worker (a bounded memory of units); so
are the prefixes that units begin with.
Budget questions, such as the longest prefix within a limit, are answered from these counts without encoding again.

Blanks become the vocabulary's blank mark, with one more in front of a text that is not empty. Characters that the vocabulary
lacks count as their UTF-8 bytes. A table says which lengths the pieces have that end as a prefix does, so no others are tried. Special strings are ordinary text. Defined results: null text counts as empty: 0 bytes, 0 tokens.
Repeated rows give repeated rows. Other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import arrow, table

LIMIT = 4096
MARK = "▁"
#: Units that a worker remembers, in each of two generations; the longest of them in characters.
REMEMBERED, LONGEST_REMEMBERED = 500_000, 64
#: Characters of the prefixes from which units are counted on.
HEAD = 5
#: Characters at the end of a prefix that decide which lengths of tokens are tried there.
TAIL = 3

_UNITS = re.compile(f"(?<=[^{MARK}])(?={MARK})")


@dataclass
class Vocabulary:
    """Pieces with their scores (higher merges first)."""

    scores: dict[str, float]
    longest: int = 0
    line_end_is_apart: bool = True
    order: dict[str, int] = field(default_factory=dict)
    splits: dict[str, list[str]] = field(default_factory=dict)
    #: By the places of both in order, as one number.
    follows: dict[int, bool] = field(default_factory=dict)
    endings: dict[str, list[int]] = field(default_factory=dict)
    lengths: dict[str, list[int]] = field(default_factory=dict)
    heads: dict[str, tuple[list, list, list]] = field(default_factory=dict)
    young: dict[str, int] = field(default_factory=dict)
    old: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.longest = max(map(len, self.scores))
        self.order = {piece: at for at, piece in enumerate(sorted(self.scores, key=lambda p: -self.scores[p]))}
        endings: dict[str, set[int]] = {}
        for piece in self.scores:
            if len(piece) >= TAIL:
                endings.setdefault(piece[-TAIL:], set()).add(len(piece))
        self.endings = {tail: sorted(found, reverse=True) for tail, found in endings.items()}
        self.line_end_is_apart = not any("\n" in piece for piece in self.scores)
        crossing = [p for p in self.scores if MARK in p[1:] and p.strip(MARK)]
        if crossing:
            raise ValueError(f"pieces reach over word starts: {crossing[:3]}")

    def merged(self, text: str) -> list[str]:
        """Plain BPE: again and again the pair of the best score, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best = None
            for at in range(len(parts) - 1):
                score = self.scores.get(parts[at] + parts[at + 1])
                if score is not None and (best is None or score > best[0]):
                    best = score, at
            if best is None:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts

    def split(self, token: str) -> list[str]:
        """The two tokens whose merge makes this one."""
        parts = self.splits.get(token)
        if parts is None:
            score, parts = self.scores[token], list(token)
            while len(parts) > 2:
                found = [(self.scores.get(parts[i] + parts[i + 1], score), -i) for i in range(len(parts) - 1)]
                at = -max(found)[1]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.splits[token] = parts
        return parts

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether no merge reaches over the border while both tokens form, looked at from the end back to single characters.

        The token that formed later is undone first. Two neighbours at the border merge if that comes before the next merge of
        either one; of equal merges the left one comes first.
        """
        left_next = right_next = len(self.order)
        while True:
            across = self.order.get(left + right)
            if across is not None and across < left_next and across <= right_next:
                return False
            left_born = self.order[left] if len(left) > 1 else -1
            right_born = self.order[right] if len(right) > 1 else -1
            if left_born < 0 and right_born < 0:
                return True
            if left_born > right_born:
                left_next, left = left_born, self.split(left)[1]
            else:
                right_next, right = right_born, self.split(right)[0]

    def may_follow(self, left: str, right: str, key: int) -> bool:
        """Key: the places of both in order, as one number under which the answer is kept."""
        if len(self.follows) > REMEMBERED:
            self.follows.clear()
        # Runs of blanks have one score for several lengths, so their merges have no order of their own.
        runs = left[-2:] == MARK * 2 or right[:2] == MARK * 2 or left[-1:] == right[:1] == MARK
        known = self.follows[key] = self.merged(left + right) == [left, right] if runs else self.stay_apart(left, right)
        return known

    def lengths_at(self, tail: str) -> list[int]:
        """Lengths, longest first, of the pieces that may end where these characters end: TAIL of them, or all there are."""
        if len(self.lengths) > REMEMBERED:
            self.lengths.clear()
        found = self.endings.get(tail, []) if len(tail) == TAIL else []
        known = self.lengths[tail] = found + [n for n in range(min(TAIL - 1, len(tail)), 0, -1) if tail[-n:] in self.scores]
        return known

    def unit_counts(self, unit: str) -> list[int]:
        """Token counts of all prefixes of a unit, from the empty one."""
        if len(unit) <= HEAD:
            return self.counted_on(unit, [0], [-1], [""])[0]
        head = unit[:HEAD]
        known = self.heads.get(head)
        if known is None:
            if len(self.heads) > REMEMBERED // 4:
                self.heads.clear()
            known = self.heads[head] = self.counted_on(head, [0], [-1], [""])
        return self.counted_on(unit, *map(list.copy, known))[0]

    def counted_on(self, unit: str, counts: list[int], places: list[int], last: list[str]) -> tuple[list, list, list]:
        """Extends, to all prefixes of the unit: their counts, the place of their last token in order, and that token."""
        order, lengths, follows, pieces = self.order, self.lengths, self.follows, len(self.order)
        for end in range(len(counts), len(unit) + 1):
            tail = unit[end - TAIL if end > TAIL else 0 : end]
            tried = lengths.get(tail)
            for length in self.lengths_at(tail) if tried is None else tried:
                start = end - length
                if start < 0:
                    continue
                token = unit[start:end]
                place = order.get(token)
                if place is None:
                    continue
                before = places[start]
                if before >= 0:
                    key = before * pieces + place
                    known = follows.get(key)
                    if not (self.may_follow(last[start], token, key) if known is None else known):
                        continue
                counts.append(counts[start] + 1)
                places.append(place)
                last.append(token)
                break
            else:  # a character of its own bytes; nothing merges with it
                counts.append(counts[end - 1] + len(unit[end - 1].encode()))
                places.append(-1)
                last.append("")
        return counts, places, last

    def unit_count(self, unit: str) -> int:
        count = self.young.get(unit)
        if count is None:
            count = self.old.get(unit)
            if count is None:
                count = self.unit_counts(unit)[-1]
                if len(unit) > LONGEST_REMEMBERED:
                    return count
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[unit] = count
        return count

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        text = MARK + text.replace(" ", MARK)
        lines = text.split("\n") if self.line_end_is_apart else [text]
        found: list[str] = []
        for number, line in enumerate(lines):
            if number:
                found.append("\n")
            if MARK * 2 in line:
                found += _UNITS.split(line)
            elif line:
                head, *rest = line.split(MARK)
                if head:
                    found.append(head)
                found += [MARK + x for x in rest]
        return found

    def count(self, text: str) -> int:
        known, get, total = self.young, self.unit_count, 0
        for unit in self.units(text):
            n = known.get(unit)
            if n is None:
                n = get(unit)
                known = self.young
            total += n
        return total

    def prefix_counts(self, text: str) -> list[int]:
        """Counts of the first 0, 1, 2, ... characters of the text."""
        counts, base = [0], 0
        for number, unit in enumerate(self.units(text)):
            own = self.unit_counts(unit)
            counts += [base + n for n in own[1:]]
            base += own[-1]
            if not number:
                del counts[1]  # the mark in front of the text is no character of it
        return counts[: len(text) + 1]

    def fitting(self, text: str, limit: int) -> int:
        """Characters of the longest prefix of at most limit tokens."""
        base, place = 0, -1 if text else 0
        for unit in self.units(text):
            count = self.unit_count(unit)
            if base + count > limit:
                own = self.unit_counts(unit)
                return max(0, place + max(i for i, n in enumerate(own) if base + n <= limit))
            base, place = base + count, place + len(unit)
        return max(0, place)


def read_pieces(path: str) -> dict[str, float]:
    """Ordinary pieces of a sentencepiece BPE model: no control, byte, unknown or unused ones."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
    return {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not any(kind(i) for kind in kinds)}


#: Of this process, by the pieces' hash: what a worker has counted serves its later tasks.
_KNOWN: dict[int, Vocabulary] = {}


def _vocabulary(pieces: dict[str, float]) -> Vocabulary:
    key = hash(tuple(pieces.items()))
    if key not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[key] = Vocabulary(pieces)
    return _KNOWN[key]


def counted(docs: DataFrame, pieces: dict[str, float], limit: int = LIMIT) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_bytes, n_tokens, over_limit, n_chars_within (of the longest prefix within the limit)."""

    def make(batch: pa.RecordBatch) -> dict:
        vocabulary = _vocabulary(pieces)
        texts = [x or "" for x in batch.column("text").to_pylist()]
        counts = [vocabulary.count(x) for x in texts]
        return {
            "doc_id": batch.column("doc_id"), "n_bytes": [len(x.encode()) for x in texts], "n_tokens": counts, "over_limit": [n > limit for n in counts],
            "n_chars_within": [len(x) if n <= limit else vocabulary.fitting(x, limit) for x, n in zip(texts, counts)],
        }

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return arrow(rows, make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chars_within long")


def prefix_table(docs: DataFrame, pieces: dict[str, float]) -> DataFrame:
    """(doc_id, counts): the token counts of the first 0, 1, 2, ... characters, to be stored."""

    def make(batch: pa.RecordBatch) -> dict:
        vocabulary = _vocabulary(pieces)
        return {"doc_id": batch.column("doc_id"), "counts": [vocabulary.prefix_counts(x or "") for x in batch.column("text").to_pylist()]}

    return arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, counts array<int>")


def tokens_of_prefix(counts: Column, characters: Column) -> Column:
    """From a stored table: tokens of the first characters."""
    return F.get(counts, F.least(characters, F.size(counts) - 1))


def longest_within(counts: Column, limit: Column) -> Column:
    """From a stored table: characters of the longest prefix of at most limit tokens."""
    places = F.transform(counts, lambda n, at: F.when(n <= limit, at))
    return F.array_max(places)


def op4_token_counts(spark, folder: str) -> DataFrame:
    import public_tokenizers

    return counted(table(spark, folder, "documents"), read_pieces(public_tokenizers.path("piece_bpe_32k.model")))


QUERIES = {"op4_token_counts": op4_token_counts}
ORACLE: dict[str, str] = {}
