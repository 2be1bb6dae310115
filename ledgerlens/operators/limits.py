"""Rate, churn, concurrency, chunk and session computations over ordered requests.

The recurrences here are serial in principle. Each block of rows is a small map from the state before it to the
state after it, so the blocks of one key run in parallel; see ``recurrences.py``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.operators.ordered import number_rows, ranged, running, with_previous
from ledgerlens.operators.recurrences import Rule, chain_ends, fold, held_after, request_map, then
from ledgerlens.session import cut_lineage

#: Default width of a time block. A minute keeps both the rows of a hot key inside one block and
#: the blocks of one key (43,200 a month) small enough for a task.
BLOCK_MS = 60_000


def spend(
    tokens: int, elapsed_ms: int, burst: int, refill: int, per_ms: int, no_retry_ms: int = C.NO_RETRY_MS
) -> tuple[int, bool, int]:
    """One request against a bucket: ``(tokens, allowed, retry_after_ms)``.

    Amounts are whole numbers in units of ``1 / per_ms`` token, so no rounding can turn an
    admission into a refusal. A refused request spends nothing.
    """
    tokens = min(burst * per_ms, tokens + max(0, elapsed_ms) * refill)
    if tokens >= per_ms:
        return tokens - per_ms, True, 0
    if refill <= 0:
        return tokens, False, no_retry_ms
    return tokens, False, max(1, -(-(per_ms - tokens) // refill))


def policy_columns(action: str, policies: dict[str, tuple[int, int]] = C.RATE_POLICIES) -> dict[str, Column]:
    """``burst, refill, per_ms`` of each row from its action; an unlisted action is ``other``."""
    burst, refill = F.lit(policies["other"][0]), F.lit(policies["other"][1])
    for name, (size, rate) in policies.items():
        burst = F.when(F.col(action) == name, size).otherwise(burst)
        refill = F.when(F.col(action) == name, rate).otherwise(refill)
    return {"burst": burst.cast("bigint"), "refill": refill.cast("bigint"), "per_ms": F.lit(1000).cast("bigint")}


def _bucket_rule(row: tuple, state: tuple | None) -> tuple[tuple, tuple]:
    ts, burst, refill, per_ms, tokens, last = row
    if state is not None:
        tokens, last = state
    elif tokens is None:
        tokens, last = burst * per_ms, ts
    tokens, allowed, retry = spend(tokens, ts - last, burst, refill, per_ms)
    last = max(ts, last)
    return (allowed, retry, tokens, last), (tokens, last)


def _bucket_summary(columns: list[np.ndarray]) -> tuple:
    times, burst, refill, per_ms = columns[0].tolist(), *(int(c[0]) for c in columns[1:4])
    before = [None if c[0] is None or c[0] != c[0] else int(c[0]) for c in columns[4:]]
    change = request_map(0, burst * per_ms, per_ms)
    for earlier, now in zip(times, times[1:]):
        change = then(change, request_map((now - earlier) * refill, burst * per_ms, per_ms), per_ms)
    *terms, via = change
    return times[0], times[-1], burst, refill, per_ms, *before, *terms, [c for c, _ in via], [k for _, k in via]


def _bucket_advance(state: tuple | None, summary: tuple) -> tuple:
    first, last, burst, refill, per_ms, tokens, since, *terms, c, k = summary
    if state is not None:
        tokens, since = state
    elif tokens is None:
        tokens, since = burst * per_ms, first
    tokens = min(burst * per_ms, tokens + max(0, first - since) * refill)
    return held_after(tokens, (*terms, list(zip(c, k))), per_ms), max(last, since)


BUCKET = Rule(
    _bucket_rule, _bucket_summary, _bucket_advance,
    outputs="allowed boolean, retry_after_ms long, tokens long, updated_ms long",
    state="tokens long, updated_ms long",
    summary="first_ms long, last_ms long, burst long, refill long, per_ms long, tokens long, updated_ms long,"
    " spent_spent long, spent_total long, total_spent long, total_total long, via_c array<long>, via_k array<long>",
)


def token_bucket(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    policy: dict[str, Column],
    ts_ms: str = "ts_ms",
    before: tuple[Column, Column] | None = None,
    state: bool = False,
) -> DataFrame:
    """Add ``allowed, retry_after_ms``: a token bucket per key. ``order`` starts with the time.

    ``policy`` gives ``burst`` and ``refill`` tokens per ``per_ms`` milliseconds, constant per key. A key's bucket starts full, or with
    ``before``: the tokens (in units of ``1 / per_ms``) and the time of its last request, not later than any row; null where there was none.
    With ``state`` the tokens left and the time are added as ``tokens, updated_ms``.

    A block of requests changes a bucket by a map of a few numbers (``recurrences``), so a key's blocks are worked
    out in parallel, however many rows the key has and whether or not its bucket is ever full.
    """
    tokens, updated = before or (F.lit(None), F.lit(None))
    ready = df.withColumns({**policy, "_tokens": tokens.cast("bigint"), "_updated": updated.cast("bigint")})
    done = fold(ready, keys, order, [ts_ms, "burst", "refill", "per_ms", "_tokens", "_updated"], BUCKET, "bucket").drop(*policy, "_tokens", "_updated")
    return done if state else done.drop("tokens", "updated_ms")


def rate_limit(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], policy: dict[str, Column], everyone: tuple[int, int] = C.GLOBAL_POLICY, ts_ms: str = "ts_ms"
) -> DataFrame:
    """Add ``allowed, scope, retry_after_ms``: the bucket that all requests share, then that of the request's key.

    ``everyone`` is the shared bucket's size and its tokens a second. A request that it refuses (scope ``global``) costs its key nothing; one that
    its key refuses (``identity``) has spent a shared token.
    """
    shared = {n: F.lit(v).cast("bigint") for n, v in (("burst", everyone[0]), ("refill", everyone[1]), ("per_ms", 1000))}
    first = token_bucket(df, [], order, shared, ts_ms).withColumnsRenamed({"allowed": "_passed", "retry_after_ms": "_wait"})
    first = cut_lineage(first, "shared")
    second = token_bucket(first.where("_passed"), keys, order, policy, ts_ms)
    refused = first.where("not _passed").withColumns({"allowed": F.lit(False), "retry_after_ms": F.col("_wait")})
    scope = F.when(~F.col("_passed"), "global").when(~F.col("allowed"), "identity")
    return second.unionByName(refused).withColumn("scope", scope).drop("_passed", "_wait")


def attempts_in_window(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], window_ms: int, ts_ms: str = "ts_ms"
) -> DataFrame:
    """Add ``attempts``: earlier rows of the key at most ``window_ms`` old.

    A row leaves the window just after it is ``window_ms`` old; that moment is a row of its own. The count is then a running
    sum of rows come and gone. It is linear in the rows however many lie in one window, and runs over ranges of the order, so one crowded window is many tasks.
    """
    moments = F.array(
        F.struct(F.col(ts_ms).alias("_at"), F.lit(1).alias("_step")), F.struct((F.col(ts_ms) + window_ms + 1).alias("_at"), F.lit(-1).alias("_step"))
    )
    along = ["_at", "_step", *order]
    dealt = ranged(df.select("*", F.inline(moments)), keys, along, "attempts", "_block")
    counted = running(dealt, keys, "_block", along, F.col("_step"), "sum", "attempts", inclusive=False)
    return counted.where("_step = 1").drop("_at", "_step", "_block")


def _cooldown(wait_ms: int) -> Rule:
    """Admits a row that is not over its limit ``wait_ms`` after the last one admitted.

    A block's first admission lies among its open rows of the first ``wait_ms`` or is the one after them. Each of these leads to one last
    admission, found by doubling the pointers from a row to the next one that it lets in.
    """

    def step(row: tuple, last: tuple | None) -> tuple[tuple, tuple | None]:
        ts, over = row
        allowed = not over and (last is None or ts - last[0] >= wait_ms)
        return (allowed,), ((ts,) if allowed else last)

    def summarise(columns: list[np.ndarray]) -> tuple:
        times = columns[0][~columns[1].astype(bool)]
        after = np.maximum(np.searchsorted(times, times + wait_ms), np.arange(len(times)) + 1)
        ends, _ = chain_ends(np.where(after < len(times), after, np.arange(len(times))))
        entries = np.searchsorted(times, columns[0][0] + wait_ms) + 1
        return times[:entries].tolist(), times[ends[:entries]].tolist()

    def advance(last: tuple | None, summary: tuple) -> tuple | None:
        entries, ends = summary
        at = 0 if last is None else bisect_left(entries, last[0] + wait_ms)
        return (ends[at],) if at < len(entries) else last

    return Rule(step, summarise, advance, "allowed boolean", "last_ms long", "entries array<long>, ends array<long>")


def churn_budget(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_in_window: int = C.CHURN_MAX,
    window_ms: int = C.CHURN_WINDOW_MS,
    cooldown_ms: int = C.CHURN_COOLDOWN_MS,
    ts_ms: str = "ts_ms",
) -> DataFrame:
    """Add ``attempts, allowed, reason``. Every attempt, admitted or not, counts in the window; an
    attempt within the cooldown of the last *admitted* one is refused too, as long as that one is still in
    the window.

    The count is a running sum, the cooldown a recurrence whose blocks are mapped in parallel.
    """
    counted = attempts_in_window(df, keys, order, window_ms, ts_ms).withColumn("_over", F.col("attempts") >= max_in_window)
    folded = fold(counted, keys, order, [ts_ms, "_over"], _cooldown(min(cooldown_ms, window_ms + 1)), "churn")
    reason = F.when(F.col("_over"), "churn_limit").when(~F.col("allowed"), "cooldown")
    return folded.withColumn("reason", reason).drop("_over")


def concurrency(
    df: DataFrame,
    by: Sequence[str],
    limit: int,
    start_ms: str = "start_ms",
    end_ms: str = "end_ms",
    row_id: str = "request_id",
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Per group: requests, peak number in flight and how many began over the limit. A request that
    ends when another begins has left before it."""
    began = df.select(*by, row_id, F.col(start_ms).alias("_at"), F.lit(1).cast("bigint").alias("_step"))
    ended = df.select(*by, row_id, F.col(end_ms).alias("_at"), F.lit(-1).cast("bigint").alias("_step"))
    steps = began.unionByName(ended).withColumn("_block", F.floor(F.col("_at") / block_ms))
    level = running(steps, by, "_block", ["_at", "_step", row_id], F.col("_step"), "sum", "in_flight")
    begins = F.col("_step") == 1
    return level.groupBy(*by).agg(
        F.count_if(begins).alias("requests"),
        F.max("in_flight").alias("peak"),
        F.count_if(begins & (F.col("in_flight") > limit)).alias("over_limit"),
    )


def chunk_by_rows(
    df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], rows: int = C.CHUNK_ROWS
) -> DataFrame:
    """Add ``chunk_index``: a chunk closes after ``rows`` rows of its stream."""
    numbered = number_rows(df, keys, block, order, "_n")
    return numbered.withColumn("chunk_index", F.floor((F.col("_n") - 1) / rows)).drop("_n")


def _chunks(rows: int, max_bytes: int) -> Rule:
    """Closes a chunk once it holds ``rows`` rows or ``max_bytes`` bytes.

    A chunk that is open when a block begins closes within its first ``rows`` rows or not at all. From each of these places the chunks
    that follow are fixed; pointers from a chunk's start to the next, found in the running sizes, are doubled to the block's end.
    """

    def step(row: tuple, state: tuple | None) -> tuple[tuple, tuple]:
        index, held, weight = state or (0, 0, 0)
        held, weight = held + 1, weight + row[0]
        full = held >= rows or weight >= max_bytes
        return (index,), ((index + 1, 0, 0) if full else (index, held, weight))

    def summarise(columns: list[np.ndarray]) -> tuple:
        upto = np.concatenate([[0], np.cumsum(columns[0].astype(np.int64))])
        count, places = len(upto) - 1, np.arange(len(upto))
        after = np.minimum(places + rows, np.maximum(np.searchsorted(upto, upto + max_bytes), places + 1))
        ends, closed = chain_ends(np.where(after <= count, after, places))
        entries = slice(0, min(rows, count) + 1)
        return upto[entries].tolist(), count, int(upto[-1]), closed[entries].tolist(), (count - ends[entries]).tolist(), (upto[-1] - upto[ends[entries]]).tolist()

    def advance(state: tuple | None, summary: tuple) -> tuple:
        head, count, total, closed, held_after, weight_after = summary
        index, held, weight = state or (0, 0, 0)
        entry = 0
        if held:
            entry = min(rows - held, max(1, bisect_left(head, max_bytes - weight)))
            if entry > count:
                return index, held + count, weight + total
            index += 1
        return index + closed[entry], held_after[entry], weight_after[entry]

    return Rule(
        step, summarise, advance, "chunk_index long", "index long, held long, weight long",
        "head array<long>, count long, total long, closed array<long>, held array<long>, weight array<long>",
    )


def chunk_by_size(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: str, rows: int = C.CHUNK_ROWS, max_bytes: int = C.CHUNK_BYTES
) -> DataFrame:
    """Add ``chunk_index``: a chunk closes once it holds ``rows`` rows or ``max_bytes`` bytes.

    Where a chunk ends depends on all before it, but on each block of a stream only through the chunk that is open when
    it begins, so a stream of any length is worked out in parallel. A null size is none; sizes are not negative.
    """
    sized = df.withColumn("_size", F.coalesce(F.col(size).cast("bigint"), F.lit(0)))
    return fold(sized, keys, order, ["_size"], _chunks(rows, max_bytes), "chunks").drop("_size")


def latest_state(
    heartbeats: DataFrame, processes: DataFrame, now_ms: int, stale_ms: int = C.STALE_HEARTBEAT_MS
) -> DataFrame:
    """State of every agent from its newest heartbeat ``(agent_id, pid, ts_ms)`` and its process
    ``(agent_id, pid, alive)``: stopped, starting, running or unresponsive."""
    newest = heartbeats.groupBy("agent_id").agg(
        F.max("ts_ms").alias("last_heartbeat_ms"), F.max_by("pid", "ts_ms").alias("_beat_pid")
    )
    stale = F.lit(now_ms) - F.col("last_heartbeat_ms") > stale_ms
    state = (
        F.when(~F.coalesce("alive", F.lit(False)), "stopped")
        .when(F.col("last_heartbeat_ms").isNull(), "starting")
        .when((F.col("_beat_pid") != F.col("pid")) | stale, "unresponsive")
        .otherwise("running")
    )
    return processes.join(newest, "agent_id", "left").select("agent_id", "pid", "last_heartbeat_ms", state.alias("state"))


def activity_sessions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], gap_ms: int = C.IDLE_MS, ts_ms: str = "ts_ms", block_ms: int = BLOCK_MS
) -> DataFrame:
    """Sessions of activity: one ends ``gap_ms`` after its last event. ``order`` starts with the time.

    Built on block-wise neighbours instead of one sort per key, so a hot key stays parallel.
    """
    df = df.withColumn("_block", F.floor(F.col(ts_ms) / block_ms))
    near = with_previous(df.select(*keys, "_block", *order), keys, "_block", order, [ts_ms])
    starts = F.col("previous").isNull() | (F.col(ts_ms) - F.col("previous")[ts_ms] > gap_ms)
    marked = cut_lineage(near.withColumn("_start", F.when(starts, F.col(ts_ms))).select(*keys, "_block", *order, "_start"), "sessions")
    placed = running(marked, keys, "_block", order, F.col("_start"), "max", "start_ms")
    return placed.groupBy(*keys, "start_ms").agg(
        (F.max(ts_ms) + gap_ms).alias("end_ms"), F.count(F.lit(1)).alias("events")
    )
