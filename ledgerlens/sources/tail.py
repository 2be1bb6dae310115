"""A streaming source of the lines of growing files.

The offset of the stream is, for each file, the number of bytes of complete lines and a mark of the file's first line.
Between two offsets lie the bytes that were added: a file that is shorter than before, or whose first line is
another, begins anew; a file that was renamed goes on where it was left under its old name. A line that is not yet
ended is left for later. The bytes are split into ranges that any task may read by itself.

Folders are listed and read through Arrow's file systems (local and shared folders, HDFS and the object stores). Where
Spark alone reaches a store, ``segments.follow_new_segments`` follows files that appear complete.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: bytes of a range, and of one look backwards for the end of a line
RANGE_BYTES, LOOK_BYTES = 32 * 1024 * 1024, 64 * 1024
#: tasks that short ranges are dealt to
TASKS = 200
LINES = pa.schema([("path", pa.string()), ("at", pa.int64()), ("raw", pa.string())])


def open_folder(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


@dataclass
class ByteRange(InputPartition):
    """Lines of a file whose first byte lies from ``first`` up to ``stop``; ``whole`` says that ``first`` begins a line."""

    path: str
    first: int
    stop: int
    whole: bool


@dataclass
class ByteRanges(InputPartition):
    """The ranges of one task."""

    ranges: list[ByteRange]


def _first_line(file, size: int) -> bytes | None:
    held, at = b"", 0
    while at < size:
        part = file.read_at(min(LOOK_BYTES, size - at), at)
        end = part.find(b"\n")
        if end >= 0:
            return held + part[:end]
        held, at = held + part, at + len(part)
    return None


def _complete(file, size: int) -> int:
    """Bytes up to the end of the last complete line."""
    at = size
    while at > 0:
        first = max(0, at - LOOK_BYTES)
        end = file.read_at(at - first, first).rfind(b"\n")
        if end >= 0:
            return first + end + 1
        at = first
    return 0


def added(start: dict, end: dict) -> list[tuple[str, int, int]]:
    """(path, first, stop) of the bytes between two offsets."""
    gone = [(mark, bytes_) for path, (bytes_, mark) in start.items() if end.get(path, (0, None))[1] != mark]
    come = Counter(mark for path, (_, mark) in end.items() if start.get(path, (0, None))[1] != mark)
    once = Counter(mark for mark, _ in gone)
    # where a first line does not tell files apart, none of them is taken for another: lines may come twice, none is lost
    left = {mark: bytes_ for mark, bytes_ in gone if once[mark] == 1 and come[mark] == 1}
    found = []
    for path, (stop, mark) in sorted(end.items()):
        before, known = start.get(path, (0, None))
        first = before if known == mark else left.get(mark, 0)
        if first > stop:  # cut short since
            first = 0
        if first < stop:
            found.append((path, first, stop))
    return found


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.pattern = options["path"], re.compile(options.get("pattern", ".*"))
        self.begin_at_end = options.get("from", "start") == "end"
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.tasks = int(options.get("tasks", TASKS))
        self.known: dict = {}

    def initialOffset(self) -> dict:
        return {"files": self._now() if self.begin_at_end else {}}

    def latestOffset(self) -> dict:
        return {"files": self._now()}

    def _now(self) -> dict:
        store, root = open_folder(self.folder)
        files = {}
        for info in store.get_file_info(pa.fs.FileSelector(root, allow_not_found=True, recursive=True)):
            hidden = any(part[0] in "._" for part in info.path[len(root) :].strip("/").split("/"))
            if not info.is_file or hidden or not self.pattern.search(info.path):
                continue
            seen = info.size, info.mtime_ns
            if self.known.get(info.path, (None,))[0] != seen:
                with store.open_input_file(info.path) as file:
                    first = _first_line(file, info.size)
                    mark = None if first is None else [_complete(file, info.size), hashlib.sha256(first).hexdigest()]
                self.known[info.path] = seen, mark
            if self.known[info.path][1]:
                files[info.path] = self.known[info.path][1]
        return files

    def partitions(self, start: dict, end: dict) -> list[ByteRanges]:
        """Ranges that follow each other, packed into tasks: as many ranges to a task as ``tasks`` tasks need, but no more bytes than
        one range of ``RANGE_BYTES`` has, so that short ranges make neither a task each nor tasks that grow with the log."""
        ranges = []
        for path, first, stop in added(start["files"], end["files"]):
            for at in range(first, stop, self.range_bytes):
                ranges.append(ByteRange(path, at, min(stop, at + self.range_bytes), at == first))
        most = max(1, min(-(-len(ranges) // self.tasks), RANGE_BYTES // self.range_bytes))
        return [ByteRanges(ranges[n : n + most]) for n in range(0, len(ranges), most)]

    def read(self, partition: ByteRanges) -> Iterator[pa.RecordBatch]:
        store, _ = open_folder(self.folder)
        for path, ranges in groupby(partition.ranges, key=lambda r: r.path):
            with store.open_input_file(path) as file:
                for own in ranges:
                    yield self._lines(file, own)

    @staticmethod
    def _lines(file, partition: ByteRange) -> pa.RecordBatch:
        at, stop, size = partition.first, partition.stop, file.size()
        held = b"" if partition.whole else file.read_at(1, at - 1)
        skip = not partition.whole and held != b"\n"
        data = file.read_at(stop - at, at)
        # the last line of a range may end in the next one
        while data and not data.endswith(b"\n") and at + len(data) < size:
            more = file.read_at(min(LOOK_BYTES, size - at - len(data)), at + len(data))
            end = more.find(b"\n")
            data += more if end < 0 else more[: end + 1]
            if end >= 0:
                break
        places, lines = [], []
        for line in data.split(b"\n")[:-1]:
            if not skip and at < stop:
                places.append(at)
                lines.append(line.decode("utf-8", "replace"))
            skip, at = False, at + len(line) + 1
        return pa.RecordBatch.from_arrays([pa.array([partition.path] * len(lines), pa.string()), pa.array(places, pa.int64()), pa.array(lines, pa.string())], schema=LINES)

    def commit(self, end: dict) -> None:
        pass


class GrowingLines(DataSource):
    """Format ``growing_lines``: ``path, at`` (byte offset) and ``raw`` of every complete line of the files of a folder.

    Options: ``path``; ``pattern`` that a file's path must contain; ``from`` (``start``, or ``end`` to pass over what is there already);
    ``rangeBytes``; ``tasks`` that short ranges are packed into.
    """

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "path string, at long, raw string"

    def streamReader(self, schema) -> GrowingLinesReader:
        return GrowingLinesReader({k.lower(): v for k, v in self.options.items()})
