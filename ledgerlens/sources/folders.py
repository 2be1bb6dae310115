"""Listing and reading the files of a folder in tasks.

Spark's own readers gather the names and states of all files on the driver, several kB a folder and listing. Here they stay a table: a task
lists the folder, others what lies in its subfolders, and lines are read from ranges of bytes that are dealt to tasks.

Files are reached through Arrow's file systems, as in ``tail``. Where only Spark reaches a store, and for patterns of names, ``reached`` says so.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.sources.tail import open_folder

#: bytes of one read, rows of one batch of file names, and of one of first lines
READ_BYTES, BATCH_ROWS, BATCH_LINES = 1024 * 1024, 10_000, 100
#: names that Spark's readers pass over
_HIDDEN = re.compile(r"(?!_(?:common_)?metadata)(?:_[^=]*$|\.)|.*\._COPYING_$", re.DOTALL)
#: what ``_metadata.file_path`` writes as %XX
_QUOTED = re.compile(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]')
#: a line of white space and byte-order marks; ``$`` also matches before these ends of a line
_BLANK = re.compile(rb"(?:[ \t\x0b\f\r]|\xef\xbb\xbf)*(?:\xc2\x85|\xe2\x80[\xa8\xa9])?")


def reached(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """A folder's URI, and its name as Spark has it in the paths of its files; None if Arrow finds no folder there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder)
    uri = folder.toUri().toString()
    try:
        store, root = open_folder(uri)
        return (uri, folder.toString()) if store.get_file_info(root).type == pa.fs.FileType.Directory else None
    except (pa.ArrowException, NotImplementedError, OSError):
        return None


def _entries(uri: str, name: str, inside: bool) -> Callable:
    """What lies in a folder or, with ``inside``, the files anywhere in the subfolders among its entries and the files among them."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (("path", pa.string()), ("is_file", pa.bool_()), ("length", pa.int64()), ("mtime_ns", pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(uri)
        root = root.rstrip("/")
        rows = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[1]:
                    rows.append(row)
                    continue
                for info in store.get_file_info(pa.fs.FileSelector(root + row[0][len(name) :], recursive=inside)):
                    own = info.path[len(root) :]
                    if (info.is_file or not inside) and not any(_HIDDEN.match(part) for part in own.split("/")):
                        rows.append((name + own, info.is_file, info.size, info.mtime_ns and info.mtime_ns // 1_000_000 * 1_000_000))
                    if len(rows) >= BATCH_ROWS:
                        yield batch_of(rows)
                        rows = []
        yield batch_of(rows)

    return entries


def list_files(spark: SparkSession, folder: tuple[str, str]) -> DataFrame:
    """``path, length, mtime_ns`` (whole milliseconds) of all files in a folder and below it; hidden ones are passed over, as by Spark's readers."""
    schema = "path string, is_file boolean, length long, mtime_ns long"
    top = spark.range(0, 1, 1, 1).select(F.lit(folder[1]).alias("path"), F.lit(False).alias("is_file"), F.lit(0).cast("long").alias("length"), F.lit(0).cast("long").alias("mtime_ns"))
    found = top.mapInArrow(_entries(*folder, inside=False), schema).repartition(_tasks(spark, 0))
    return found.mapInArrow(_entries(*folder, inside=True), schema).drop("is_file")


def _tasks(spark: SparkSession, least: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), least)


def _range_bytes(spark: SparkSession) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")


def _lines(file, first: int, stop: int) -> Iterator[list[tuple[int, bytes]]]:
    """Offsets and lines, a list a read, of the lines that begin from ``first`` up to ``stop``."""
    skip = first > 0 and file.read_at(1, first - 1) != b"\n"
    file.seek(first)
    at, held = first, b""
    while at < stop:
        part = file.read(READ_BYTES)
        *lines, held = (held + part).split(b"\n") if part else (held, b"") if held else (b"",)
        found = []
        for line in lines:
            if not skip and at < stop:
                found.append((at, line))
            skip, at = False, at + len(line) + 1
        yield found
        if not part:
            return


def read_lines(spark: SparkSession, folder: tuple[str, str], files: DataFrame, number: int, size: int) -> DataFrame:
    """``_path, _start, _at, raw`` of the lines of ``number`` files (path, length) of ``size`` bytes in all: ``_path`` as in ``_metadata.file_path``, the first byte of
    the range that the line was read in, that of the line. A task holds one read and one line."""
    uri, name = folder
    most = _range_bytes(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(uri)
        for batch in batches:
            for path, first, stop in zip(*(c.to_pylist() for c in batch.columns)):
                quoted = _QUOTED.sub(lambda m: f"%{ord(m[0]):02X}", re.sub("^file:/+", "file:///", path))
                with store.open_input_file(root.rstrip("/") + path[len(name) :]) as file:
                    for lines in _lines(file, first, stop):
                        columns = pa.array([quoted] * len(lines)), pa.array([first] * len(lines), pa.int64()), pa.array([x for x, _ in lines], pa.int64()), pa.array([x for _, x in lines], pa.binary())
                        yield pa.RecordBatch.from_arrays([columns[0].cast(pa.string()), *columns[1:]], names=["_path", "_start", "_at", "raw"])

    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(most).cast("long")))
    ranges = files.where("length > 0").select("path", "length", first.alias("first")).select("path", "first", F.least("length", F.col("first") + most).alias("stop"))
    found = ranges.repartition(_tasks(spark, max(-(-size // most), -(-number // BATCH_ROWS)))).mapInArrow(read, "_path string, _start long, _at long, raw binary")
    return found.withColumn("raw", F.col("raw").cast("string"))


def first_lines(spark: SparkSession, folder: tuple[str, str], files: DataFrame, number: int) -> DataFrame:
    """``path, length, mtime_ns`` of ``number`` files and ``raw``, the first line of each that is not blank; no more of a file is read."""
    uri, name = folder

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_folder(uri)
        for batch in batches:
            for part in (batch.slice(n, BATCH_LINES) for n in range(0, batch.num_rows, BATCH_LINES)):
                firsts = []
                for path, length in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    with store.open_input_file(root.rstrip("/") + path[len(name) :]) as file:
                        firsts.append(next((line for lines in _lines(file, 0, length) for _, line in lines if not _BLANK.fullmatch(line)), None))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(firsts, pa.binary())], names=["path", "length", "mtime_ns", "raw"])

    dealt = files.select("path", "length", "mtime_ns").repartition(_tasks(spark, -(-number // BATCH_ROWS)))
    return dealt.mapInArrow(read, "path string, length long, mtime_ns long, raw binary").withColumn("raw", F.col("raw").cast("string"))
