"""Exact duplicates by a stateful stream: keyed state on disk, and a check of full bytes on every hit.

Texts are equal when they are identical after lower-casing A-Z only; null counts as empty. The stream reads the
table's files in micro-batches and keeps, for each digest (SHA-256 of the normalised text), the number of rows and
the row that stays so far: its doc_id and its locator (file and row in it). This state lives in RocksDB, on disk, is
written to the checkpoint folder and never expires, so a row meets copies from any earlier batch. Texts are not in the
state. Rows of a batch are folded before they are shuffled, so a text that a third of all rows hold sends one row from each task.

A digest with several rows is a hit. The whole bytes of its rows are then compared (least and greatest text, again
folded before the shuffle), and the located row must be among them. Digests that stand for different texts are
grouped by the texts themselves; with SHA-256 there are none, with a shorter digest the result is the same.

Of equal texts the row with the largest doc_id stays; of rows that also repeat the doc_id, the one latest by locator.
A row without a doc_id stays only if no equal text has one; ``keep_id`` is null then. Long texts are hashed and
compared whole. An empty table gives an empty result. Only doc_id and text are read, whatever else the table holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import ascii_lower, saved, small
from ledgerlens.session import prepare, scratch_dir

#: files of a micro-batch
BATCH_FILES = 10_000
#: state on disk; many stores need no space set aside in advance
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: str = "text") -> Column:
    return ascii_lower(F.coalesce(F.col(text), F.lit("")))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _pattern(path: str) -> str:
    """``path`` as a pattern, which a stream takes for a single file as well as for a folder."""
    return f"{path[:-1]}[{path[-1]}]"


def _marked(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, the normalised text, its digest and the locator of each row."""
    rows = docs.select("doc_id", normalised().alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rows.withColumn("digest", digest(F.col("text")))


def _keeper() -> Column:
    return F.max(F.struct("doc_id", "file", "row"))


def stream_state(spark: SparkSession, path: str, root: str, digest: Callable[[Column], Column] = sha256, batch_files: int = BATCH_FILES) -> DataFrame:
    """digest, keeper (doc_id, file, row), size: the state after all files of ``path`` so far.

    ``root`` is the stream's folder. A later call with the same folder reads only files that have come since.
    """
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", batch_files).parquet(_pattern(path))
    kept = _marked(stream, digest).groupBy("digest").agg(_keeper().alias("keeper"), F.count(F.lit(1)).alias("size"))

    def write(changed: DataFrame, batch: int) -> None:
        # written whole for each batch, so a batch that is repeated after a failure replaces itself
        changed.write.mode("overwrite").parquet(f"{root}/state/batch={batch}")

    before = {name: spark.conf.get(name, None) for name in STORE}
    for name, value in STORE.items():
        spark.conf.set(name, value)
    try:
        running = (
            kept.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True).start()
        )
        running.awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    try:
        changes = spark.read.parquet(f"{root}/state")
    except AnalysisException as none:
        if none.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "digest binary, keeper struct<doc_id: long, file: string, row: long>, size long")
    latest = F.max_by(F.struct("keeper", "size"), "batch").alias("latest")
    return changes.groupBy("digest").agg(latest).select("digest", "latest.*")


def duplicates(
    spark: SparkSession, path: str, root: str | None = None, digest: Callable[[Column], Column] = sha256, batch_files: int = BATCH_FILES
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, file, row: one row per row of the Parquet table at ``path``."""
    prepare(spark)
    state = stream_state(spark, path, root or scratch_dir(spark, "exact-stream"), digest, batch_files)
    hits = small(saved(state.where("size > 1"), "hits"))
    rows = _marked(spark.read.parquet(_pattern(path)), digest)

    held = rows.join(hits, "digest")
    here = (F.col("keeper.file") == F.col("file")) & (F.col("keeper.row") == F.col("row"))
    compared = held.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"), F.count_if(here).alias("located"))
    unequal = saved(compared.where("low <> high or located <> 1").select("digest"), "unequal")

    slim = rows.select("doc_id", "digest", "file", "row", F.sha2("text", 256).alias("text_sha256"))
    joined = slim.join(hits, "digest", "left")
    if not unequal.isEmpty():
        own = rows.join(unequal, "digest", "left_semi")
        exact = own.groupBy("digest", "text").agg(_keeper().alias("keeper"), F.count(F.lit(1)).alias("size"))
        apart = own.join(exact, ["digest", "text"]).select("doc_id", "digest", "file", "row", F.sha2("text", 256).alias("text_sha256"), "keeper", "size")
        joined = joined.join(unequal, "digest", "left_anti").unionByName(apart)
    alone = F.col("size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | here).alias("kept"),
        "text_sha256", "file", "row",
    )
