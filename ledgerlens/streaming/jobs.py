"""The event-time side on Structured Streaming.

Driver files carry zone-less timestamps, and a watermark needs a real one, so every job takes a
``timestamp`` column under UTC.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import constants as C
from ledgerlens.operators import admission, aggregates, limits
from ledgerlens.operators.policy import approval_window, has_capability, match_approvals
from ledgerlens.session import prepare, scratch_dir
from ledgerlens.streaming.stateful import ANSWERED, ASKED, Decisions, Memory

#: state in RocksDB; the stores of many partitions set no space aside in advance
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

#: buckets of requests that share their state: enough for many tasks, few against the requests of a batch
BUCKETS = 512


def event_time(ts: str) -> Column:
    return F.col(ts).cast("timestamp")


def _remembered(fresh: DataFrame, id_: str, connection: str, arrived: str, row_id: str, memory: Memory, late: str) -> DataFrame:
    rows = fresh.select(F.col(connection).alias("connection"), F.col(id_).alias("id"), F.unix_millis(arrived).alias("at_ms"), F.col(row_id).alias("row_id"), F.col(arrived).alias("_arrived"))
    return rows.withWatermark("_arrived", late).groupBy("connection").transformWithState(memory, Memory.OUTPUT, "append", "EventTime")


def admit_events(
    stream: DataFrame, connection: str, arrived: str = "arrived_at", row_id: str = "row_id", horizon_ms: int = 600_000,
    entries: int = C.WAKE_CACHE_ENTRIES, late: str = "10 seconds",
) -> DataFrame:
    """``row_id, refusal`` of wake events that pass the stateless checks: null when accepted, ``replayed`` within the horizon of
    an id's first use on its connection, ``cache_full`` while a connection's memory holds ``entries`` ids."""
    fresh = stream.where(admission.wake_refusal(F.unix_millis(arrived)).isNull())
    return _remembered(fresh, "wake_id", connection, arrived, row_id, Memory(horizon_ms, entries, refuse=True), late)


def refused_events(stream: DataFrame, arrived: str = "arrived_at") -> DataFrame:
    """The stateless refusals with their reason, for the audit trail."""
    refusal = admission.wake_refusal(F.unix_millis(arrived))
    return stream.withColumn("refusal", refusal).where(F.col("refusal").isNotNull())


def drop_replays(
    stream: DataFrame, connection: str, nonce: str = "nonce", ts: str = "ts", arrived: str = "arrived_at", row_id: str = "row_id",
    horizon_ms: int = C.ENVELOPE_SKEW_MS, entries: int = C.REPLAY_CACHE_ENTRIES, late: str = "10 seconds",
) -> DataFrame:
    """``row_id, refusal`` of fresh envelopes: null for an unused nonce, ``replayed`` for one in memory.

    A frame older than the freshness window is refused anyway, so a nonce is remembered for two windows. A full memory forgets
    the oldest nonce of its connection.
    """
    age = F.unix_millis(arrived) - F.unix_millis(ts)
    fresh = stream.where(F.abs(age) <= horizon_ms)
    return _remembered(fresh, nonce, connection, arrived, row_id, Memory(2 * horizon_ms, entries, refuse=False), late)


def token_bucket_stream(
    stream: DataFrame, keys: Sequence[str], ts: str, row_id: str, burst: int, refill: int, per_ms: int,
    idle_ms: int = C.RATE_IDLE_MS, label: str = "token-bucket", timeout_sec: int = 600,
) -> DataFrame:
    """``keys, row_id, allowed, retry_after_ms``: runs a stream over everything available now into a written table.

    Each micro-batch is worked out by the batch operator, which splits a hot key's rows over many tasks; the state between batches
    is a table of one bucket per key, one version a batch. A batch that is repeated after a failure starts from the version before it and
    replaces what it has written. A bucket is forgotten when idle for ``idle_ms`` of event time (by then it must be full
    again, as it starts full as a new one). A row older than its key's last one counts at that one's time.
    """
    if burst * per_ms > idle_ms * refill:
        raise ValueError("a bucket that is forgotten before it is full again would admit too much: raise idle_ms")
    spark = prepare(stream.sparkSession)
    root = scratch_dir(spark, label)
    policy = {n: F.lit(v).cast("bigint") for n, v in (("burst", burst), ("refill", refill), ("per_ms", per_ms))}
    key = F.struct(*keys).alias("_key")

    def each(rows: DataFrame, number: int) -> None:
        # written first: the work below then runs on the caller's session, with adaptive execution
        rows.select(*keys, row_id, F.unix_millis(ts).alias("_ms")).write.mode("overwrite").parquet(f"{root}/rows/{number}")
        now = spark.read.parquet(f"{root}/rows/{number}")
        known = None
        if number:
            known = spark.read.parquet(f"{root}/state/{number - 1}")
            now = now.withColumn("_key", key).join(known.select(key, F.col("tokens").alias("_held"), F.col("updated_ms").alias("_since")), "_key", "left").drop("_key")
        else:
            now = now.withColumns({"_held": F.lit(None).cast("bigint"), "_since": F.lit(None).cast("bigint")})
        now = now.withColumn("_ms", F.greatest("_ms", "_since"))
        done = limits.token_bucket(now, keys, ["_ms", row_id], policy, "_ms", (F.col("_held"), F.col("_since")), state=True)
        done.drop("_held", "_since").write.mode("overwrite").parquet(f"{root}/data/batch={number}")
        done = spark.read.parquet(f"{root}/data/batch={number}")
        last = F.max_by(F.struct("tokens", "updated_ms"), F.struct("_ms", row_id)).alias("last")
        states = done.groupBy(*keys).agg(last).select(*keys, "last.*")
        if known is not None:
            newest = done.agg(F.max("_ms").alias("_now"))
            idle = known.withColumn("_key", key).join(states.select(key), "_key", "left_anti").drop("_key").crossJoin(F.broadcast(newest))
            states = states.unionByName(idle.where(F.col("_now").isNull() | (F.col("updated_ms") + idle_ms >= F.col("_now"))).drop("_now"))
        states.write.mode("overwrite").parquet(f"{root}/state/{number}")

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    if not query.awaitTermination(timeout_sec):
        query.stop()
        raise TimeoutError(f"stream {label!r} did not finish in {timeout_sec} s")
    return spark.read.parquet(f"{root}/data").select(*keys, row_id, "allowed", "retry_after_ms")


def approval_decisions(requests: DataFrame, responses: DataFrame, window_ms: int = C.APPROVAL_MS, late: str = "5 seconds") -> DataFrame:
    """``request_id, decision, decided_ms``: one row a request, when its first valid answer or its end lies behind the watermark.

    The rules are those of ``policy.match_approvals``; a request that is not decided when a finite stream ends is
    left to ``approvals_left``.
    """
    key = ["request_id", "user_id", "nonce"]
    asked = requests.select(*key, "ts", F.lit(ASKED).alias("what"), F.lit(None).cast("boolean").alias("approved"))
    said = responses.where(has_capability(F.col("role"), F.lit("approve_ddl"))).select(*key, "ts", F.lit(ANSWERED).alias("what"), "approved")
    # an answer with a null in its key answers nothing
    said = said.where(" and ".join(f"{k} is not null" for k in key) + " and ts is not null")
    rows = asked.withWatermark("ts", late).union(said.withWatermark("ts", late))
    rows = rows.select(F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).alias("bucket"), *key, "what", F.unix_millis("ts").alias("ts_ms"), "approved", "ts")
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("user_id", "nonce")}
    return rows.groupBy("bucket").transformWithState(Decisions(approval_window(window_ms), **kinds), Decisions.OUTPUT, "append", "EventTime")


def approvals_left(decided: DataFrame, requests: DataFrame, responses: DataFrame, window_ms: int = C.APPROVAL_MS) -> DataFrame:
    """The closing step of ``approval_decisions`` over a finite log: the requests it has not decided, by the batch rules."""
    left = requests.join(decided.select("request_id"), "request_id", "left_anti")
    return match_approvals(left.select("request_id", "user_id", "ts_ms", "nonce"), responses, window_ms).select("request_id", "decision", "decided_ms")


def activity_sessions(stream: DataFrame, keys: Sequence[str], ts: str, gap: str = "60 seconds", watermark: str = "60 seconds") -> DataFrame:
    """Sessions per key, emitted when the watermark passes their end."""
    windowed = stream.withWatermark(ts, watermark).groupBy(*keys, F.session_window(ts, gap).alias("w"))
    return windowed.agg(F.count(F.lit(1)).alias("events")).select(
        *keys, F.unix_millis("w.start").alias("start_ms"), F.unix_millis("w.end").alias("end_ms"), "events"
    )


def live_counters(stream: DataFrame, ts: str, width: str = "1 hour", watermark: str = "10 minutes", by: Sequence[str] = ()) -> DataFrame:
    """The service counters per time bucket, emitted when the bucket can no longer change."""
    windowed = stream.withWatermark(ts, watermark).groupBy(F.window(ts, width).alias("w"), *by)
    counted = windowed.agg(*[F.count_if(c).alias(n) for n, c in aggregates.counter_columns().items()])
    return counted.select(F.unix_millis("w.start").alias("start_ms"), *by, *aggregates.counter_columns())


def sessions_left(closed: DataFrame, events: DataFrame, keys: Sequence[str], order: Sequence[str], gap_ms: int, ts_ms: str = "ts_ms") -> DataFrame:
    """The closing step of ``activity_sessions`` over a finite log: the sessions that no watermark has ended.

    A key's sessions end in order, so what is left of it are the events from the end of its last one on.
    """
    last = closed.groupBy(F.struct(*keys).alias("_key")).agg(F.max("end_ms").alias("_end"))
    rest = events.withColumn("_key", F.struct(*keys)).join(last, "_key", "left").where(F.col("_end").isNull() | (F.col(ts_ms) >= F.col("_end")))
    return limits.activity_sessions(rest.select(*keys, *order), keys, order, gap_ms, ts_ms).select(*closed.columns)


def counters_left(closed: DataFrame, events: DataFrame, ts: str, width: str = "1 hour", by: Sequence[str] = ()) -> DataFrame:
    """The closing step of ``live_counters`` over a finite log: the buckets that no watermark has ended."""
    end = closed.agg(F.max("start_ms").alias("_last"))
    rest = events.crossJoin(F.broadcast(end)).where(F.col("_last").isNull() | (F.unix_millis(F.window(ts, width)["start"]) > F.col("_last")))
    counted = rest.groupBy(F.window(ts, width).alias("w"), *by).agg(*[F.count_if(c).alias(n) for n, c in aggregates.counter_columns().items()])
    return counted.select(F.unix_millis("w.start").alias("start_ms"), *by, *aggregates.counter_columns())


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started here keep their state in RocksDB, so it is not bounded by the executors' memory."""
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def run_to_table(stream: DataFrame, label: str, timeout_sec: int = 600, root: str | None = None) -> DataFrame:
    """Run a stream over everything available now into a written table and return that table.

    State and offsets are checkpointed in the shared folder, next to the table. With the ``root`` of an earlier run the stream goes on from there.
    """
    spark: SparkSession = prepare(stream.sparkSession)
    root = root or scratch_dir(spark, label)
    with state_on_disk(spark):
        query = (
            stream.writeStream.format("parquet").option("path", f"{root}/data").option("checkpointLocation", f"{root}/checkpoint")
            .outputMode("append").trigger(availableNow=True).start()
        )
    if not query.awaitTermination(timeout_sec):
        query.stop()
        raise TimeoutError(f"stream {label!r} did not finish in {timeout_sec} s")
    return spark.read.schema(stream.schema).parquet(f"{root}/data")


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType, max_files: int = 16) -> DataFrame:
    """A driver table as a file stream. The path is a pattern, which serves a single file as well as
    a folder of files."""
    reader = prepare(spark).readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")
