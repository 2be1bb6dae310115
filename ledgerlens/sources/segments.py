"""Segmented JSON-lines logs: reading, following, writing and telling what changed.

A log is a folder of ``audit-N.jsonl`` archives (a larger N is older) and the active
``audit.jsonl``, or a folder this module wrote: ``segment=N`` with a larger N being newer.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

import pyarrow.fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import constants as C
from ledgerlens.operators.ordered import number_rows
from ledgerlens.session import cut_lineage, prepare, scratch_dir
from ledgerlens.sources import folders
from ledgerlens.sources.tail import RANGE_BYTES, GrowingLines, open_folder

_TEXT_FIELDS = (
    "id", "ts", "agent_id", "project", "db_alias", "db_alias_asserted", "resolved_db_alias", "resolved_database", "user_id",
    "actor", "role", "action", "decision", "outcome", "statement_fingerprint", "statement_preview", "permission_level",
    "denial_reason", "error_code", "migration_plan_id", "cancel_target_user_id", "cancel_target_project",
    "cancel_target_db_alias", "chain_id", "prev_hash", "mac", "hash",
)
_NUMBER_FIELDS = ("ts_ms", "duration_ms", "rows_affected", "rows_returned", "seq")
#: the record format; it is declared, never inferred
EVENT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in _TEXT_FIELDS]
    + [T.StructField(name, T.LongType()) for name in _NUMBER_FIELDS]
)

#: what a segment's path contains
SEGMENT_PATTERN = r"(?:/audit(?:-\d+)?\.jsonl|/segment=\d+/[^/]+)$"
_BLANKS = r"^[\s﻿]*$"
#: names of files that Spark's readers unpack
_PACKED = r"\.(?:gz|bz2|zst|zstd|lz4|snappy|deflate)$"


def file_order(path: Column) -> Column:
    """Chronological rank of a segment from its path: archives count down, the active file is last."""
    written = F.regexp_extract(path, r"segment=(\d+)", 1).try_cast("bigint")
    archive = F.regexp_extract(path, r"/audit-(\d+)\.jsonl$", 1).try_cast("bigint")
    return F.coalesce(written, -archive, F.lit(0).cast("bigint"))


def _is_segment(path: Column) -> Column:
    return path.rlike(SEGMENT_PATTERN)


def is_object(raw: str) -> Column:
    """True for text that is exactly one JSON object. The text is parsed inside brackets, so that
    anything after the object is an error instead of being ignored."""
    one = F.expr(f"try_parse_json(concat('[', {raw}, ']'))")
    alone = F.expr(f"try_variant_get(try_parse_json(concat('[', {raw}, ']')), '$[1]', 'variant') IS NULL")
    return F.col(raw).rlike(r"^\s*\{") & one.isNotNull() & alone


def parse_lines(lines: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """``event.*`` columns, ``raw`` and ``malformed`` from a ``raw`` line column."""
    parsed = lines.withColumn("malformed", ~F.coalesce(is_object("raw"), F.lit(False)))
    event = F.when(~F.col("malformed"), F.from_json("raw", schema))
    others = [c for c in lines.columns if c != "raw"]
    return parsed.withColumn("_event", event).select("_event.*", "raw", *others, "malformed")


class _Files:
    """The segment files of a log, in a table (path, length, mtime_ns) that is listed once and never gathered, or those of ``files``. ``dealt`` says
    that tasks may read them by themselves: not where only Spark reaches the store, nor with packed files."""

    def __init__(self, spark: SparkSession, path: str, files: DataFrame | None = None):
        self.folder, self.dealt = folders.reached(spark, path), False
        if self.folder:
            self.table = cut_lineage(folders.list_files(spark, self.folder).where(_is_segment(F.col("path"))), "listed") if files is None else files
            self.number, self.size, packed = self.table.agg(F.count("path"), F.coalesce(F.sum("length"), F.lit(0)), F.count_if(F.col("path").rlike(_PACKED))).first()
            self.dealt = not packed


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of every segment by Spark's reader; contents are pruned away."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    named = files.select("path", "length", "modificationTime", F.col("_metadata.file_path").alias("file_path"))
    return named.where(_is_segment(F.col("path")))


def _lines(spark: SparkSession, path: str, files: list[str] | DataFrame | None) -> DataFrame:
    own = _Files(spark, path, files) if not isinstance(files, list) else None
    if own and own.dealt:
        lines = folders.read_lines(spark, own.folder, own.table, own.number, own.size)
        return _numbered(lines, "_at")
    if isinstance(files, DataFrame):
        files = [r["path"] for r in files.select("path").toLocalIterator()]
    if files == []:
        return spark.createDataFrame([], "_path string, _at int, raw string")
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path if files is None else files).select(
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_in_split"),
        F.col("value").alias("raw"),
    )
    return _numbered(lines, "_in_split")


def _numbered(lines: DataFrame, along: str) -> DataFrame:
    # a split is read in order, so (split start, place in the split) is the order of the file
    numbered = number_rows(lines.where(_is_segment(F.col("_path"))), ["_path"], "_start", [along], "_n")
    return numbered.select("_path", (F.col("_n") - 1).cast("int").alias("_at"), "raw")


def read_segments(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, files: list[str] | DataFrame | None = None) -> DataFrame:
    """``event.*, raw, file, file_ord, line_no, malformed`` for every non-blank line of a log.

    ``(file_ord, line_no)`` is the log order. Blank lines are skipped, a byte-order mark before the
    first line is dropped, and a line that is not one JSON object is marked, not fatal. Segments of any size
    are split by lines. With ``files`` only these are read: names, or rows ``path, length`` of the log's ``manifest``, which never pass through the
    driver where Arrow reaches the folder.
    """
    prepare(spark)
    lines = _lines(spark, path, files).where(~F.col("raw").rlike(_BLANKS))
    lines = lines.select(
        F.regexp_replace("raw", r"^﻿|\r$", "").alias("raw"),
        F.regexp_extract("_path", r"[^/]+(?:/[^/]+)?$", 0).alias("file"),
        file_order(F.col("_path")).alias("file_ord"),
        F.col("_at").alias("line_no"),
    )
    return parse_lines(lines, schema)


def _events(lines: DataFrame, schema: T.StructType) -> DataFrame:
    clean = lines.withColumn("raw", F.regexp_replace("raw", r"^﻿|\r$", "")).where(~F.col("raw").rlike(_BLANKS))
    return parse_lines(clean, schema).where(~F.col("malformed")).drop("malformed")


def follow_segments(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, begin: str = "start", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Streaming read of a log as it grows: ``event.*, raw, file_ord, at`` of every complete line once.

    Lines appended to a file are read when they are complete; a file that was cut short or replaced is read anew, a renamed one
    goes on where it was. ``begin="end"`` passes over what is there when the stream first starts. Unreadable lines are dropped, other files of the
    folder are passed over.
    """
    prepare(spark).dataSource.register(GrowingLines)
    tasks = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lines = spark.readStream.format("growing_lines").option("path", path).option("pattern", SEGMENT_PATTERN).option("from", begin)
    lines = lines.option("rangeBytes", range_bytes).option("tasks", tasks).load()
    return _events(lines.select("raw", file_order(F.col("path")).alias("file_ord"), "at"), schema)


def follow_new_segments(
    spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, max_files: int = 64
) -> DataFrame:
    """Streaming read of segment files that appear complete, in any store that Spark reads; a file is read once, as it is when it is found."""
    prepare(spark)
    lines = (
        spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).text(path)
        .where(_is_segment(F.col("_metadata.file_path"))).select(F.col("value").alias("raw"))
    )
    return _events(lines, schema)


def write_segments(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    max_rows: int,
    keep: int | None = None,
    seq: str = "seq",
    raw: str | None = None,
) -> DataFrame:
    """Write JSON lines in segments of ``max_rows`` sequence numbers and return the retention
    floor as a one-row frame ``(segments, first_segment, retained_from_seq)``.

    The segment is arithmetic on ``seq``, so no global order is needed; each segment is one task
    and one file, sorted inside. Segments are staged and published together when all are written: a run that is repeated leaves one copy, one that
    fails leaves none. A segment that is written again replaces the earlier one, so a log goes on with whole segments.

    ``keep`` writes the newest segments only and removes older ones from the folder once they are published.
    Rows without a sequence number come first in the first segment written. ``raw`` names a
    ready-made line column to write instead of ``columns``. The input is evaluated once, and once more with ``keep``.
    """
    line = F.col(raw) if raw else F.to_json(F.struct(*sorted(columns)))
    segmented = df.withColumn("segment", F.floor((F.col(seq) - 1) / max_rows).cast("bigint"))
    first = 0
    if keep is not None:
        newest = segmented.agg(F.max("segment")).first()[0]
        first = max(0, newest - keep + 1) if newest is not None else 0
    kept = segmented.withColumn("_own", F.coalesce("segment", F.lit(first).cast("bigint"))).where(F.col("_own") >= first)
    seen = Observation()
    (
        kept.observe(seen, F.max("segment").alias("last"), F.min(seq).alias("from_seq"))
        .select(F.col("_own").alias("segment"), seq, line.alias("value"))
        .repartition("segment")
        .sortWithinPartitions("segment", seq)
        .select("segment", "value")
        .write.partitionBy("segment")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .text(path)
    )
    if keep is not None:
        store, root = open_folder(path)
        for info in store.get_file_info(pyarrow.fs.FileSelector(root)):
            number = re.search(r"/segment=(\d+)$", info.path)
            if number and int(number[1]) < first:
                store.delete_dir(info.path)
    last = seen.get["last"]
    row = ((last if last is not None else -1) - first + 1, first, seen.get["from_seq"])
    return df.sparkSession.createDataFrame([row], "segments bigint, first_segment bigint, retained_from_seq bigint")


def publish_files(lines: DataFrame, folder: str, name: Column, order: Sequence[str]) -> None:
    """Write the ``value`` lines of each ``name`` as one file of that name in ``folder``, in the given order.

    The files are staged beside the folder and then renamed, so a reader sees a file as it was before or as it is
    after. Only names pass through the driver.
    """
    staged = scratch_dir(lines.sparkSession, "staged")
    (
        lines.withColumn("_name", name).repartition("_name").sortWithinPartitions("_name", *order)
        .select("_name", "value").write.partitionBy("_name").text(staged)
    )
    store, root = open_folder(staged)
    _, target = open_folder(folder)
    store.create_dir(target)
    for info in store.get_file_info(pyarrow.fs.FileSelector(root, recursive=True)):
        own = re.search(r"/_name=([^/]+)/part-[^/]+$", info.path)
        if own:
            store.move(info.path, f"{target}/{unquote(own[1])}")


def remove_files(folder: str, names: DataFrame) -> None:
    """Remove the files of the given ``name`` from ``folder``."""
    store, root = open_folder(folder)
    for row in names.select("name").toLocalIterator():
        if store.get_file_info(f"{root}/{row[0]}").is_file:
            store.delete_file(f"{root}/{row[0]}")


IDENTITY = ("length", "mtime_ns", "ctime_ns")
STATE = ("first_seq", "first_prev_hash", "chain_id", "key_fingerprint")


def manifest(spark: SparkSession, path: str, key_fingerprint: str) -> DataFrame:
    """Identity and starting point of every segment file: path, length and modification time in nanoseconds,
    the sequence number, link and chain of its first record (null for a file without one), and the
    fingerprint of the key in use.

    Tasks list the folder and read each file up to its first line that is not blank. Where Spark alone reaches the store, its reader lists and
    reads: the first line of a file is in its first split, and of each split only its least line is shuffled.
    """
    own = _Files(spark, path)
    if own.dealt:
        found = folders.first_lines(spark, own.folder, own.table, own.number).withColumn("raw", F.regexp_replace("raw", r"^﻿|\r$", ""))
    else:
        files = _listing(spark, path).select("path", "length", (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"), "file_path")
        lines = (
            spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
            .select(
                F.col("_metadata.file_path").alias("file_path"), F.regexp_replace("value", r"^﻿|\r$", "").alias("raw"),
                F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at")).alias("place"),
            )
            .where(_is_segment(F.col("file_path")) & ~F.col("raw").rlike(_BLANKS))
        )
        found = files.join(lines.groupBy("file_path").agg(F.min_by("raw", "place").alias("raw")), "file_path", "left")
    return parse_lines(found).select(
        "path", "length", "mtime_ns", F.col("mtime_ns").alias("ctime_ns"), F.col("seq").alias("first_seq"), F.col("prev_hash").alias("first_prev_hash"), "chain_id",
        F.lit(key_fingerprint).alias("key_fingerprint"),
    )


def reusable(previous: DataFrame) -> DataFrame:
    """Earlier verdicts that may be trusted at all: of a file with records, whose times are finer
    than a second (two writes inside one whole second cannot be told apart)."""
    fine = (F.col("mtime_ns") % 1_000_000_000 != 0) & (F.col("ctime_ns") % 1_000_000_000 != 0)
    return previous.where(fine & (F.col("records") > 0))


def changed_segments(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Segments that must be read again: no earlier verdict has the same file identity, starting
    point, chain and signing key."""
    on = ["path", *IDENTITY, *STATE]
    return current.join(reusable(previous).select(*on).distinct(), on, "left_anti")


def prune_manifest(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Earlier entries whose file still exists."""
    return previous.join(current.select("path").distinct(), ["path"], "left_semi")
