"""Growing log files as a stream of lines.

A streaming data source whose offset is bytes per file. Only complete lines are taken; a line without its line end waits. Each
entry of an offset also has a check sum of the bytes before it, by which a file is known again: under its own name if it grew,
under another name if it was rotated (the remainder is read there), and as a new file, from its start, if it was replaced or
cut. What a batch covers is fixed by its two offsets, so a batch repeated after a failure reads the same bytes, and a restarted
stream goes on behind the last byte it took. Growth beyond ``bytes_per_task`` is read by several tasks, split at line ends.

Files may lie on any file system that Arrow opens (local or shared folders, HDFS, object stores). A cut file that has grown
beyond its old length between two polls, with the same bytes before the old position, is taken for grown.
"""

from __future__ import annotations

import fnmatch
import hashlib
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes before a position that tell whether a file is still the same.
CHECKED = 256
BYTES_PER_TASK = 64 << 20
_BLOCK = 1 << 20
_ROWS = 10_000


@dataclass
class Span(InputPartition):
    """Lines that begin in [start, end) of a file, given as (path, name); check is that of the bytes before ``until``, where the batch ends."""

    name: tuple[str, str]
    start: int
    end: int
    until: int
    check: str
    first: bool


def _check(file, position: int) -> str:
    file.seek(max(0, position - CHECKED))
    return hashlib.md5(file.read(position - max(0, position - CHECKED))).hexdigest()


def _line_end(file, size: int) -> int:
    """The position after the last line end before ``size``, 0 without one."""
    end = size
    while end > 0:
        start = max(0, end - _BLOCK)
        file.seek(start)
        found = file.read(end - start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        end = start
    return 0


class TailReader(DataSourceStreamReader):
    """Offsets are {"files": {name: [bytes, check]}}."""

    def __init__(self, path: str, pattern: str, bytes_per_task: int, fail_on_loss: bool):
        self.path, self.pattern, self.bytes_per_task, self.fail_on_loss = path, pattern, bytes_per_task, fail_on_loss
        self.seen: dict[str, tuple] = {}

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def _files(self) -> list[fs.FileInfo]:
        store, folder = self._place()
        found = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        fits = [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]
        return sorted((f for f in fits if fnmatch.fnmatch(f.base_name, self.pattern)), key=lambda f: f.base_name)

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        store, _ = self._place()
        files, seen = {}, {}
        for info in self._files():
            key = (info.size, info.mtime_ns)
            if self.seen.get(info.base_name, (None,))[0] == key:
                entry = self.seen[info.base_name][1]
            else:
                with store.open_input_file(info.path) as file:
                    size = min(info.size, file.size())
                    end = _line_end(file, size)
                    entry = [end, _check(file, end)]
            seen[info.base_name] = (key, entry)
            if entry[0]:
                files[info.base_name] = entry
        self.seen = seen
        return {"files": files}

    def _holds(self, store, info: fs.FileInfo, entry: list) -> bool:
        if info.size < entry[0]:
            return False
        with store.open_input_file(info.path) as file:
            return file.size() >= entry[0] and _check(file, entry[0]) == entry[1]

    def _found(self, store, files: list[fs.FileInfo], name: str, entry: list) -> fs.FileInfo | None:
        """The file that holds an entry: that of its name, else another one."""
        for info in sorted(files, key=lambda f: f.base_name != name):
            if self._holds(store, info, entry):
                return info
        return None

    def partitions(self, start: dict, end: dict) -> list[Span]:
        store, _ = self._place()
        files, before = self._files(), dict(start["files"])
        grown = {n: e for n, e in end["files"].items() if before.get(n) != e}
        kept = {n for n, e in end["files"].items() if before.get(n) == e}
        spans = []
        # Files that grew under their own name claim their entry of the last offset before rotated ones are looked for.
        places = {name: self._found(store, files, name, entry) for name, entry in grown.items()}
        begins: dict[str, int] = {}
        claimed = set(kept)
        for name, info in places.items():
            if info is not None and name in before and before[name][0] <= grown[name][0] and self._holds(store, info, before[name]):
                begins[name] = before[name][0]
                claimed.add(name)
        for name, info in places.items():
            if info is None:
                if self.fail_on_loss:
                    raise ValueError(f"{name} no longer holds the {grown[name][0]} bytes that this batch covers")
                continue
            if name not in begins:
                others = [(n, e) for n, e in before.items() if n not in claimed and e[0] <= grown[name][0]]
                same = next((n for n, e in others if self._holds(store, info, e)), None)
                if same is not None:
                    claimed.add(same)
                begins[name] = before[same][0] if same is not None else 0
            begin, (until, check) = begins[name], grown[name]
            for at in range(begin, until, self.bytes_per_task):
                spans.append(Span((info.path, name), at, min(at + self.bytes_per_task, until), until, check, at == begin))
        return spans or [Span(("", ""), 0, 0, 0, "", True)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        if partition.end == partition.start:
            return
        store, _ = self._place()
        path, name = partition.name
        entry = [partition.until, partition.check]
        here = store.get_file_info(path)
        if here.type != fs.FileType.File or not self._holds(store, here, entry):
            here = self._found(store, self._files(), name, entry)  # rotated since the batch was planned
            if here is None:
                raise ValueError(f"{name} no longer holds the bytes that this batch covers")
        with store.open_input_file(here.path) as file:
            # A line belongs to the span in which it begins; its rest may lie in the next one.
            position, begin = partition.start, partition.start
            if not partition.first:
                position -= 1
            file.seek(position)
            rest, skip, lines, places = b"", not partition.first, [], []
            while position < partition.until and (begin < partition.end or skip):
                block = file.read(min(_BLOCK, partition.until - position))
                if not block:
                    break
                position += len(block)
                *whole, rest = (rest + block).split(b"\n")
                if skip and whole:
                    begin = partition.start - 1 + len(whole[0]) + 1
                    whole, skip = whole[1:], False
                for line in whole:
                    if begin >= partition.end:
                        break
                    lines.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                    places.append(begin)
                    begin += len(line) + 1
                if len(lines) >= _ROWS:
                    yield self._batch(lines, name, places)
                    lines, places = [], []
            if lines:
                yield self._batch(lines, name, places)

    @staticmethod
    def _batch(lines: list[str], name: str, places: list[int]) -> pa.RecordBatch:
        names = pa.array([name] * len(lines), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(lines, pa.string()), names, pa.array(places, pa.int64())], names=["value", "file", "position"])


class TailSource(DataSource):
    """Options: path (a folder, or one file), pattern (of file names), bytesPerTask, failOnDataLoss."""

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "value string, file string, position long"

    def streamReader(self, schema) -> TailReader:
        path = self.options["path"].rstrip("/")
        pattern = self.options.get("pattern", "*")
        if self.options.get("single", "false") == "true":
            path, pattern = posixpath.split(path)[0], self.options.get("pattern", posixpath.basename(path))
        return TailReader(path, pattern, int(self.options.get("bytesPerTask", BYTES_PER_TASK)), self.options.get("failOnDataLoss", "true") == "true")


def tail_lines(
    spark: SparkSession, path: str, pattern: str | None = None, single: bool = False, bytes_per_task: int = BYTES_PER_TASK, fail_on_loss: bool = True
) -> DataFrame:
    """(value, file, position): the lines of growing files as a stream, each once.

    ``path`` is a folder whose files fit ``pattern``; with ``single`` it is one file, and ``pattern`` may name its rotated forms ("app.log*").
    A run that handles what is there and ends, and that begins by repeating a failed batch, leaves what has come since to the next run.
    """
    spark.dataSource.register(TailSource)
    options = {"single": str(single).lower(), "bytesPerTask": str(bytes_per_task), "failOnDataLoss": str(fail_on_loss).lower()}
    if pattern is not None:
        options["pattern"] = pattern
    return spark.readStream.format("log_tail").options(**options).load(path)
