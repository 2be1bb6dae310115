"""Verifying a log that grows: a kept table of verdicts, one version a run.

A version is a manifest of the log's segments with the verdict, the end and the number of records of each. The next run
reads only segments whose file, starting point, chain or key differ from the last version, or that failed then; those, and segments that no longer
begin where the one before them ends. Versions are written whole and never changed: a run that fails leaves the last one in
place. Segments that are gone are left out of the next version.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import chain
from ledgerlens.session import cut_lineage, prepare
from ledgerlens.sources import segments
from ledgerlens.sources.tail import open_folder

ON = ["path", *segments.IDENTITY, *segments.STATE]
STORE = (
    "path string, length long, mtime_ns long, ctime_ns long, first_seq long, first_prev_hash string, chain_id string, key_fingerprint string,"
    " file_ord long, records long, intact boolean, reason string, broken_seq long, end_chain_id string, end_seq long, end_hash string"
)


def latest_version(store: str) -> int:
    """The number of the newest version that was written to its end, 0 if there is none."""
    files, root = open_folder(store)
    done = [
        int(m[1]) for f in files.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True, recursive=True))
        if (m := re.search(r"/version=(\d+)/_SUCCESS$", f.path))
    ]
    return max(done, default=0)


def read_version(spark: SparkSession, store: str, version: int) -> DataFrame:
    schema = T.StructType.fromDDL(STORE)
    return spark.read.schema(schema).parquet(f"{store}/version={version}") if version else spark.createDataFrame([], schema)


def _ends(known: DataFrame) -> DataFrame:
    return known.select("file_ord", F.col("end_chain_id").alias("chain_id"), F.col("end_seq").alias("seq"), F.col("end_hash").alias("last_hash"))


def _judged(
    spark: SparkSession, path: str, which: DataFrame, trusted: DataFrame, key: bytes, record: Sequence[str], raw: str | None, schema: T.StructType, first: DataFrame | None,
) -> DataFrame:
    """Verdicts, ends and numbers of records of the segments ``which`` (path, length, file_ord), whose files alone are read."""
    log = segments.read_segments(spark, path, schema, which.select("path", "length"))
    ends = log.groupBy("file_ord").agg(
        F.count(F.lit(1)).alias("records"), F.max_by(F.struct(F.col("chain_id").alias("end_chain_id"), F.col("seq").alias("end_seq"), F.col("mac").alias("end_hash")), "line_no").alias("end")
    )
    verdicts = chain.verify_segments(log, key, record, cached=_ends(trusted), first=first, raw=raw)
    return cut_lineage(
        which.select("path", "file_ord").join(ends.select("file_ord", "records", "end.*"), "file_ord", "left")
        .join(verdicts.select("file_ord", "intact", "reason", "broken_seq"), "file_ord", "left")
        # a file without records breaks nothing, and is read again
        .withColumns({"records": F.coalesce("records", F.lit(0)), "intact": F.coalesce("intact", F.lit(True))}),
        "judged",
    )


def verify_incrementally(
    spark: SparkSession, path: str, store: str, key: bytes, record: Sequence[str] = (), raw: str | None = "raw",
    schema: T.StructType = segments.EVENT_SCHEMA, first: DataFrame | None = None,
) -> DataFrame:
    """``file_ord, path, records, intact, reason, broken_seq, read`` of every segment, and a new version in ``store``.

    Equal to the verdicts of a full verification; ``read`` tells which segments were read for it. ``first`` is the retention floor, as in ``chain.verify_segments``. The names
    and states of the files stay in tables; where Spark alone reaches the log's store, they pass through the driver, as those of any files that Spark reads.
    """
    prepare(spark)
    number = latest_version(store)
    fingerprint = hashlib.sha256(key).hexdigest()[:16]
    now = segments.manifest(spark, path, fingerprint).withColumn("file_ord", segments.file_order(F.col("path")))
    now = cut_lineage(now, "manifest")
    known = read_version(spark, store, number)
    trusted = segments.reusable(known).where("intact").join(now.select(*ON), ON, "left_semi")
    trusted = cut_lineage(trusted.select(*T.StructType.fromDDL(STORE).names), "trusted")
    judged = _judged(spark, path, now.join(trusted.select("path"), "path", "left_anti"), trusted, key, record, raw, schema, first)

    # a segment that was trusted must still begin where the one before it ends
    ends = _ends(judged).unionByName(_ends(trusted)).select((F.col("file_ord") + 1).alias("file_ord"), *[F.col(c).alias(f"_{c}") for c in ("chain_id", "seq", "last_hash")])
    linked = (F.col("chain_id") == F.col("_chain_id")) & (F.col("first_seq") == F.col("_seq") + 1) & (F.col("first_prev_hash") == F.col("_last_hash"))
    opening = F.col("_seq").isNull() & (F.col("first_seq") == 1)
    if first is not None:
        opening = opening | (F.col("_seq").isNull() & F.col("_floor").eqNullSafe(F.col("first_seq")))
        ends = ends.join(first.select("file_ord", F.col("retained_from_seq").alias("_floor")), "file_ord", "full_outer")
    loose = trusted.join(ends, "file_ord", "left").where(~F.coalesce(linked | opening, F.lit(False))).select("path", "length", "file_ord")
    loose = cut_lineage(loose, "loose")
    if not loose.isEmpty():
        trusted = trusted.join(loose.select("path"), "path", "left_anti")
        judged = judged.unionByName(_judged(spark, path, loose, trusted.unionByName(judged, allowMissingColumns=True), key, record, raw, schema, first))

    fresh = now.join(judged.drop("file_ord"), "path").select(*trusted.columns)
    version = fresh.withColumn("_read", F.lit(True)).unionByName(trusted.withColumn("_read", F.lit(False)))
    version = cut_lineage(version, "version")
    version.drop("_read").write.parquet(f"{store}/version={number + 1}")
    return version.select("file_ord", "path", "records", "intact", "reason", "broken_seq", F.col("_read").alias("read"))
