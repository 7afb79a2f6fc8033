"""Main text of web pages by differencing with the page of the nearest URL.

A page becomes lines, one per block element, without scripts, styles, forms and whatever its markup names as menu, header,
footer, side column, notice, advert or comment: by its tag, or by a word of class, id or role that is such a name as a whole or
in all its parts ("cookie-notice", not "with-sidebar"). Elements end where HTML ends them without an end tag. Pages are ordered by host and path; a page's partner is, of the nearest pages of
the same host whose lines differ, one on each side, the one whose path shares the longer prefix. The lines of both are aligned by longest common subsequence, and lines that both
have are deleted. Lines inside an element that marks the page's article are never deleted: articles of one host share whole
paragraphs, which belong to them. Differencing decides about all other lines, whether or not an article is marked.

Pages of one host that stand next to one another and have the very same lines outside articles are copies and say nothing about
their frame: they form a run, and the partner comes from the run before or after. Only such pages count as copies: of pages that
differ in a line, what they share is deleted, however much it is.

Only hashes of lines are sorted and paired, so no host, however large, is gathered anywhere.

Defined results: null html counts as empty, with an empty text; a null URL is a host of its own. Repeated rows are one page when
partners are sought and give repeated rows. Other columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import count
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import arrow, table
from tidewatch.session import written

_BLOCKS = set(
    "address article blockquote body caption dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html legend li main ol p pre section summary table tbody tfoot thead tr ul".split()
)
_SKIPPED = set(
    "head title script style noscript template svg math canvas object iframe audio video nav header footer aside menu form button select option textarea input dialog".split()
)
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: Words in class, id or role that mark what is not the article.
_FRAME = set(
    "ad ads adv advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo related search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget complementary contentinfo".split()
)
_ARTICLE = {"article", "main"}
_IN_HEAD = set("base link meta noscript script style template title".split())
#: Start tags that end an open element, and what they do not look beyond.
_TABLE = {"table", "template", "html"}
_ENDED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "td": ({"td", "th"}, _TABLE | {"tr"}), "th": ({"td", "th"}, _TABLE | {"tr"}), "tr": ({"tr"}, _TABLE),
    "tbody": ({"tbody", "thead", "tfoot", "caption"}, _TABLE), "thead": ({"tbody", "thead", "tfoot", "caption"}, _TABLE), "tfoot": ({"tbody", "thead", "tfoot", "caption"}, _TABLE),
}
#: Elements that hold others as a whole: no end tag from inside ends what is outside.
_SCOPES = set("html table td th caption template object button".split())
_ENDS_P = _BLOCKS - set("caption legend tbody td tfoot th thead tr body html".split()) | set("dialog footer header aside nav menu form".split())
#: Elements that end tags of inline elements do not end.
_SPECIAL = _BLOCKS | _SKIPPED | {"td", "th"}


class _Lines(HTMLParser):
    """Lines of a page, each with whether it stands in an article."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[bool, str]] = []
        self.text: list[str] = []
        #: Open elements: the tag, and whether the element is skipped.
        self.open: list[tuple[str, bool]] = []
        self.counts: Counter[str] = Counter()
        self.inside = self.skipped = 0

    def flush(self) -> None:
        line = " ".join("".join(self.text).split())
        if line:
            self.lines.append((self.inside > 0, line))
        self.text = []

    def leave(self, size: int) -> None:
        """End the open elements after the first `size` ones."""
        while len(self.open) > size:
            tag, frame = self.open.pop()
            self.counts[tag] -= 1
            if not self.skipped and tag in _BLOCKS:
                self.flush()
            self.skipped -= frame
            self.inside -= tag in _ARTICLE and not frame

    def end(self, tags: set[str], beyond: set[str]) -> None:
        """End the innermost element of `tags`, and what is open in it, unless one of `beyond` is nearer."""
        if any(self.counts[tag] > 0 for tag in tags):
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] in tags:
                    return self.leave(at)
                if self.open[at][0] in beyond:
                    return None

    def handle_starttag(self, tag, attrs):
        words = {w for key, value in attrs if key in ("class", "id", "role") and value for w in value.lower().split()}
        named = any(set(w.replace("_", "-").split("-")) <= _FRAME for w in words)
        frame = tag in _SKIPPED or named and tag not in ("html", "body", "main")
        if tag not in _IN_HEAD and tag != "head":
            self.end({"head"}, set())
        if tag in _ENDS_P:
            self.end({"p"}, _SCOPES)
        if tag in _ENDED:
            self.end(*_ENDED[tag])
        if self.skipped and tag in _ARTICLE and not frame and not self.inside and not any(f and t in _ARTICLE for t, f in self.open):
            self.open = [(t, False) for t, _ in self.open]  # what was skipped was never closed
            self.skipped = 0
        if not self.skipped:
            if tag in _BLOCKS or tag in _SKIPPED:
                self.flush()
            elif tag in ("br", "td", "th"):
                self.text.append(" ")
        if tag not in _VOID:
            self.open.append((tag, frame))
            self.counts[tag] += 1
            self.skipped += frame
            self.inside += tag in _ARTICLE and not frame

    def handle_endtag(self, tag):
        if not self.skipped and tag in _BLOCKS:
            self.flush()
        self.end({tag}, _SCOPES if tag in _SPECIAL else _SPECIAL)

    def handle_data(self, data):
        if self.open and self.open[-1][0] == "head" and data.strip():
            self.end({"head"}, set())
        if not self.skipped:
            self.text.append(data)


#: The begin of a tag, comment or declaration.
_BEGIN = re.compile(r"<[A-Za-z/!?]")


def _closed(html: str) -> str:
    """Without a comment or tag that the end of the page cuts off, which has no text; the parser would scan the rest for each such begin."""
    comment = html.find("<!--", html.rfind("-->") + 1)
    if comment >= 0:
        html = html[:comment]
    begin = _BEGIN.search(html, html.rfind(">") + 1)
    return html[: begin.start()] if begin else html


def page_lines(html: str) -> list[tuple[bool, str]]:
    parser = _Lines()
    parser.feed(_closed(html))
    parser.close()
    parser.flush()
    return parser.lines


def shared_lines(own: list[int], other: list[int]) -> list[int]:
    """Places in own of a longest common subsequence with other: longest rising chains of matches."""
    start = 0
    while start < min(len(own), len(other)) and own[start] == other[start]:
        start += 1
    end = 0
    while end < min(len(own), len(other)) - start and own[-1 - end] == other[-1 - end]:
        end += 1
    places: dict[int, list[int]] = {}
    for at in range(start, len(other) - end):
        places.setdefault(other[at], []).append(at)
    tops: list[int] = []  # of each chain length, the least last place in other
    links: list[tuple] = []  # ... and the chain itself, linked backwards
    for at in range(start, len(own) - end):
        for there in reversed(places.get(own[at], ())):
            length = bisect_left(tops, there)
            chain = (at, links[length - 1] if length else None)
            if length == len(tops):
                tops.append(there)
                links.append(chain)
            else:
                tops[length], links[length] = there, chain
    middle, chain = [], links[-1] if links else None
    while chain:
        middle.append(chain[0])
        chain = chain[1]
    return [*range(start), *reversed(middle), *range(len(own) - end, len(own))]


def _page_key(page_id, url, html: str) -> bytes:
    return hashlib.md5(f"{page_id}\x00{url}\x00{html}".encode(), usedforsecurity=False).digest()


def _line_hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode(), digest_size=8).digest(), "big", signed=True)


def _columns(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))


def _rows(batch: pa.RecordBatch):
    for page_id, url, html in zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "html"))):
        yield page_id, url, html or ""


def line_keys(pages: DataFrame) -> DataFrame:
    """(key, url, hashes): the hashes of a page's lines outside an article; one row per different page."""

    def make(batch: pa.RecordBatch) -> dict:
        rows = list(_rows(batch))
        return {
            "key": [_page_key(*row) for row in rows], "url": batch.column("url"),
            "hashes": [[_line_hash(line) for inside, line in page_lines(html) if not inside] for _, _, html in rows],
        }

    return arrow(_columns(pages), make, "key binary, url string, hashes array<long>").dropDuplicates(["key"])


def _number_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pages with `run`: the number, within their partition, of the run of pages with the same host and lines."""
    last, run = None, -1
    for batch in batches:
        runs = []
        for now in zip(batch.column("host").to_pylist(), batch.column("hashes").to_pylist()):
            run += now != last
            last = now
            runs.append(run)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, pa.int64())], names=[*batch.schema.names, "run"])


def partners(keys: DataFrame) -> DataFrame:
    """keys with `prev` and `next`: host, path and line hashes of the nearest pages in URL order whose host or lines differ."""
    spark = keys.sparkSession
    bare = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?#]*)", 1))
    path = F.regexp_extract(bare, r"^[^/?#]*([^?#]*)", 1)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.select("key", "hashes", F.when(F.col("url").isNull(), F.lit(None)).otherwise(host).alias("host"), path.alias("path"))
    ordered = ordered.repartitionByRange(n, "host", "path", "key").sortWithinPartitions("host", "path", "key")
    ordered = ordered.mapInArrow(_number_runs, "key binary, hashes array<long>, host string, path string, run long")
    ordered = written(ordered.withColumn("at", F.monotonically_increasing_id()), "page-order").withColumn("part", F.shiftright("at", 33))
    page = F.struct("host", "path", "hashes")
    runs = written(ordered.groupBy("part", "run").agg(F.min_by(page, "at").alias("head"), F.max_by(page, "at").alias("tail")), "page-runs")
    # One row per partition in one task: a partition's first run may go on with the last one of the partition before.
    lines = F.struct(F.col("head.host").alias("host"), F.md5(F.array_join("head.hashes", ",").cast("binary")).alias("lines"))
    borders = runs.groupBy("part").agg(F.count("*").alias("runs"), F.min_by(lines, "run").alias("first"), F.max_by(lines, "run").alias("last"))
    order = Window.orderBy("part")
    goes_on = F.coalesce(F.col("first").eqNullSafe(F.lag("last").over(order)), F.lit(False)).cast("long")
    borders = borders.select("part", "runs", goes_on.alias("goes_on"))
    ahead = F.coalesce(F.sum(F.col("runs") - F.col("goes_on")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    borders = borders.select("part", (ahead - F.col("goes_on")).alias("base"))
    placed = runs.join(F.broadcast(borders), "part").withColumn("n", F.col("base") + F.col("run"))
    whole = placed.groupBy("n").agg(F.min_by("head", "part").alias("head"), F.max_by("tail", "part").alias("tail"))
    none = F.lit(None).cast(whole.schema["head"].dataType)
    beside = F.explode(F.array(
        F.struct((F.col("n") + 1).alias("n"), F.col("tail").alias("prev"), none.alias("next")),
        F.struct((F.col("n") - 1).alias("n"), none.alias("prev"), F.col("head").alias("next")),
    ))
    near = whole.select(beside.alias("to")).groupBy("to.n").agg(F.first("to.prev", True).alias("prev"), F.first("to.next", True).alias("next"))
    # Joined by the runs of partitions, so that no run of copies, however long, is one key.
    near = placed.select("part", "run", "n").join(near, "n", "left").select("part", "run", "prev", "next")
    return ordered.join(near, ["part", "run"]).select("key", "host", "path", "hashes", "prev", "next")


def deletions(keys: DataFrame) -> DataFrame:
    """(key, drop): line hashes that a page and its partner share, as places among the page's lines outside an article."""

    def make(batch: pa.RecordBatch) -> dict:
        out = []
        for host, path, own, prev, following in zip(*(batch.column(n).to_pylist() for n in ("host", "path", "hashes", "prev", "next"))):
            near = [x for x in (prev, following) if x and x["host"] == host]
            partner = max(near, key=lambda x: len(commonprefix([path, x["path"]])), default=None)
            out.append(shared_lines(own, partner["hashes"]) if partner else [])
        return {"key": batch.column("key"), "drop": out}

    return arrow(partners(keys), make, "key binary, drop array<int>").where("size(drop) > 0")


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of pages (page_id, url, html): page_id, url, text, n_chars."""
    drop = written(deletions(line_keys(pages)), "shared-lines").withColumnRenamed("key", "page_key")

    def make(batch: pa.RecordBatch) -> dict:
        rows = [(_page_key(*row), page_lines(row[2])) for row in _rows(batch)]
        return {
            "page_id": batch.column("page_id"), "url": batch.column("url"), "key": [key for key, _ in rows],
            "inside": [[inside for inside, _ in lines] for _, lines in rows],
            "body": [zlib.compress("\n".join(line for _, line in lines).encode(), 1) for _, lines in rows],
        }

    def finish(batch: pa.RecordBatch) -> dict:
        texts = []
        for inside, body, dropped in zip(*(batch.column(n).to_pylist() for n in ("inside", "body", "drop"))):
            gone, outside, kept = set(dropped or ()), count(), []
            for line, own in zip(zlib.decompress(body).decode().split("\n"), inside):
                if own or next(outside) not in gone:
                    kept.append(line)
            texts.append("\n\n".join(kept))
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": [len(x) for x in texts]}

    lines = arrow(_columns(pages), make, "page_id long, url string, key binary, inside array<boolean>, body binary")
    joined = lines.join(drop, lines["key"] == drop.page_key, "left").select("page_id", "url", "inside", "body", "drop")
    return arrow(joined, finish, "page_id long, url string, text string, n_chars long")


def op9_main_text(spark, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"))


QUERIES = {"op9_main_text": op9_main_text}
ORACLE: dict[str, str] = {}
