"""Session helpers: time zone, scratch space and table loading."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def build_session(app: str = "ledgerlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for. On a cluster ``master`` stays unset."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Run-time settings the jobs rely on, set on whatever session they are given.

    Event times are UTC. A skewed join is split even where an aggregate on the same key follows:
    the extra shuffle then carries partial aggregates, while the unsplit join would put a hot key
    into one task.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    Only a session on one machine may leave that setting out; it then gets a temporary folder. On a
    cluster the executors would each write to a disk of their own, so its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.path.join(tempfile.gettempdir(), "ledgerlens-scratch")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fixed_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of fixed values. It is built from Arrow, so Spark knows its size when it plans a join and a
    large other side is not shuffled on a rule's key."""
    fields = T.StructType.fromDDL(schema)
    columns = zip(*rows) if rows else [()] * len(fields)
    return spark.createDataFrame(pa.table([list(c) for c in columns], schema=to_arrow_schema(fields)), fields)


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """The same rows read back from a table written to the shared scratch folder.

    Used where a frame feeds several later steps that would each compute it again. The written
    table also survives the loss of executors.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: rows that one task of a large join sorts and groups
TASK_ROWS = 500_000


def join_tasks(spark: SparkSession, rows: int) -> int | None:
    """Partitions for joins over ``rows`` rows, so that a task holds about ``TASK_ROWS`` of them however large the tables are; None
    while they would fill no more than one task, which is left to Spark."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS)) if rows > TASK_ROWS else None


def spread(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to so many tasks, or as it is."""
    return df.repartition(tasks, *keys) if tasks else df
