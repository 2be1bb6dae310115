"""Recurrences against plain Python on random and skewed traffic, and streams against their twins."""

import bisect
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.operators import admission, limits, ordered, policy, recurrences
from ledgerlens.streaming import jobs


def traffic(seed, n=1500, hot=0.4, keys=6, span=400_000):
    """Random requests; one key holds ``hot`` of them and several share a time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(keys)}"
        rows.append((i, key, rng.randrange(span) // rng.choice([1, 1, 500]) * rng.choice([1, 1, 500]) % span))
    return rows


def with_null_key(rows):
    return [(i, None if key == "k0" else key, ts) for i, key, ts in rows]


def in_order(rows):
    by_key = defaultdict(list)
    for i, key, ts in rows:
        by_key[key].append((ts, i))
    return {key: sorted(v) for key, v in by_key.items()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, key string, ts_ms long")


def bucket_by_hand(rows, burst, refill, per_ms):
    out = {}
    for seq in in_order(rows).values():
        tokens, last = burst * per_ms, seq[0][0]
        for ts, i in seq:
            tokens, last = min(burst * per_ms, tokens + (ts - last) * refill), ts
            if tokens >= per_ms:
                tokens -= per_ms
                out[i] = (True, 0)
            else:
                out[i] = (False, max(1, -(-(per_ms - tokens) // refill)) if refill else C.NO_RETRY_MS)
    return out


RULES = [(1, 5, 1, 900), (2, 1, 3, 4000), (3, 50, 1, 400), (4, 3, 2, 100), (5, 2, 1, 10_000), (6, 0, 1, 100), (7, 3, 0, 10)]


def policy_of(burst, refill, per_ms):
    return {k: F.lit(v).cast("bigint") for k, v in (("burst", burst), ("refill", refill), ("per_ms", per_ms))}


@pytest.mark.parametrize(("seed", "burst", "refill", "per_ms"), RULES)
def test_token_bucket(spark, seed, burst, refill, per_ms):
    rows = with_null_key(traffic(seed))
    got = limits.token_bucket(frame(spark, rows), ["key"], ["ts_ms", "id"], policy_of(burst, refill, per_ms)).collect()
    assert {r.id: (r.allowed, r.retry_after_ms) for r in got} == bucket_by_hand(rows, burst, refill, per_ms)
    assert len(got) == len(rows)


@pytest.mark.parametrize(("seed", "burst", "refill", "per_ms"), RULES)
def test_one_key_with_all_rows_is_many_blocks(spark, seed, burst, refill, per_ms):
    rows = [(i, "hot", ts) for i, _, ts in traffic(seed, n=3000, span=100_000)]
    got = limits.token_bucket(frame(spark, rows), ["key"], ["ts_ms", "id"], policy_of(burst, refill, per_ms)).collect()
    assert {r.id: (r.allowed, r.retry_after_ms) for r in got} == bucket_by_hand(rows, burst, refill, per_ms)
    dealt = ordered.ranged(frame(spark, rows), ["key"], ["ts_ms", "id"], "dealt", "block")
    sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < len(rows) / 4


@settings(max_examples=300, deadline=None)
@given(
    st.integers(1, 6), st.integers(0, 5), st.integers(1, 40), st.lists(st.lists(st.integers(0, 120), min_size=1, max_size=30), min_size=1, max_size=4), st.data()
)
def test_a_chain_of_bucket_maps_is_the_serial_bucket(burst, refill, unit, blocks, data):
    full = burst * unit
    start = data.draw(st.integers(0, full))
    maps, tokens = [], start
    for steps in blocks:
        change = None
        for wait in steps:
            one = recurrences.request_map(wait * refill, full, unit)
            change = one if change is None else recurrences.then(change, one, unit)
            tokens = limits.spend(tokens, wait, burst, refill, unit)[0]
        maps.append(change)
    held = start
    for change in maps:
        held = recurrences.held_after(held, change, unit)
    assert held == tokens
    whole = maps[0]
    for change in maps[1:]:
        whole = recurrences.then(whole, change, unit)
    assert recurrences.held_after(start, whole, unit) == tokens


def test_bucket_maps_stay_small():
    rng = random.Random(1)
    for unit, wait in ((1000, 30), (1000, 300), (7, 3), (1000, 1000)):
        change = recurrences.request_map(0, 20 * unit, unit)
        for _ in range(3000):
            change = recurrences.then(change, recurrences.request_map(rng.randrange(wait), 20 * unit, unit), unit)
            assert len(change[4]) < 25


def test_rate_limit_has_two_layers(spark):
    """What the shared bucket refuses costs the key nothing; what the key refuses has cost a shared token."""
    rows = with_null_key(traffic(11, n=2500, span=20_000))
    everyone, (burst, refill, per_ms) = (30, 80), (6, 9, 1000)
    done = limits.rate_limit(frame(spark, rows), ["key"], ["ts_ms", "id"], policy_of(burst, refill, per_ms), everyone)
    got = {r.id: (r.allowed, r.scope, r.retry_after_ms) for r in done.collect()}
    shared, last, own, want = everyone[0] * 1000, None, {}, {}
    for ts, i, key in sorted((ts, i, key) for i, key, ts in rows):
        shared, ok, wait = limits.spend(shared, 0 if last is None else ts - last, *everyone, 1000)
        last = ts
        if ok:
            tokens, since = own.get(key, (burst * per_ms, ts))
            tokens, ok, wait = limits.spend(tokens, ts - since, burst, refill, per_ms)
            own[key] = tokens, ts
            want[i] = (ok, None if ok else "identity", wait)
        else:
            want[i] = (False, "global", wait)
    assert got == want
    assert {s for _, s, _ in want.values()} == {None, "global", "identity"}


def rule_by_blocks(rule, rows, cuts):
    """The outputs when every block starts from the state that the summaries of those before give."""
    outputs, state = [], None
    for first, last in zip([0, *cuts], [*cuts, len(rows)]):
        block = rows[first:last]
        if not block:
            continue
        here = state
        for row in block:
            out, here = rule.step(row, here)
            outputs.append(out)
        state = rule.advance(state, rule.summarise([np.array(c) for c in zip(*block)]))
    return outputs


def serially(rule, rows):
    outputs, state = [], None
    for row in rows:
        out, state = rule.step(row, state)
        outputs.append(out)
    return outputs


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=80), st.integers(1, 12), st.integers(1, 90), st.lists(st.integers(0, 80), max_size=5))
def test_chunk_blocks_equal_the_serial_fold(sizes, rows, most, cuts):
    rule = limits._chunks(rows, most)
    rows = [(s,) for s in sizes]
    assert rule_by_blocks(rule, rows, sorted(min(c, len(rows)) for c in cuts)) == serially(rule, rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.booleans()), min_size=1, max_size=80), st.integers(0, 25), st.lists(st.integers(0, 80), max_size=5))
def test_cooldown_blocks_equal_the_serial_fold(steps, wait, cuts):
    rows, at = [], 0
    for gap, over in steps:
        at += gap
        rows.append((at, over))
    rule = limits._cooldown(wait)
    assert rule_by_blocks(rule, rows, sorted(min(c, len(rows)) for c in cuts)) == serially(rule, rows)


def churn_by_hand(rows, most, window, cooldown):
    out = {}
    for seq in in_order(rows).values():
        times, admitted = [], None
        for ts, i in seq:
            attempts = len(times) - bisect.bisect_left(times, ts - window)
            if attempts >= most:
                out[i] = (attempts, False, "churn_limit")
            elif admitted is not None and ts - admitted < cooldown and ts - admitted <= window:
                out[i] = (attempts, False, "cooldown")
            else:
                out[i], admitted = (attempts, True, None), ts
            times.append(ts)
    return out


def test_ordered_helpers_take_null_keys_as_one_key(spark):
    rows = with_null_key(traffic(9, n=400))
    df = frame(spark, rows).withColumn("block", F.floor(F.col("ts_ms") / 50_000))
    order = ["ts_ms", "id"]
    numbered = {r.id: r.rn for r in ordered.number_rows(df, ["key"], "block", order).collect()}
    near = {r.id: (r.position, r.previous and r.previous.id) for r in ordered.with_previous(df, ["key"], "block", order, ["id"]).collect()}
    total = {r.id: r.n for r in ordered.running(df, ["key"], "block", order, F.col("id"), "sum", "n").collect()}
    for seq in in_order(rows).values():
        held = 0
        for at, (_, i) in enumerate(seq):
            held += i
            assert numbered[i] == at + 1 and near[i] == (at + 1, seq[at - 1][1] if at else None) and total[i] == held
    assert len(numbered) == len(near) == len(total) == len(rows)


def test_attempts_of_one_key_in_one_window_are_counted_in_linear_time(spark):
    df = spark.range(60_000).select("id", F.lit("hot").alias("key"), F.floor(F.col("id") / 6).alias("ts_ms"))
    counted = limits.attempts_in_window(df, ["key"], ["ts_ms", "id"], 60_000)
    assert counted.where(F.col("attempts") == F.col("id")).count() == 60_000
    churned = limits.churn_budget(df, ["key"], ["ts_ms", "id"], 50_000, 60_000, 100)
    # the first of each 100 ms, until there have been too many
    assert churned.where("allowed").agg(F.count("*"), F.max("id")).first() == (84, 49_800)


@pytest.mark.parametrize(("seed", "most", "window", "cooldown"), [(1, 8, 5_000, 700), (2, 100, 300_000, 2_000), (3, 3, 900, 2_000), (4, 40, 20_000, 1)])
def test_churn_budget(spark, seed, most, window, cooldown):
    rows = with_null_key(traffic(seed))
    got = limits.churn_budget(frame(spark, rows), ["key"], ["ts_ms", "id"], most, window, cooldown).collect()
    assert {r.id: (r.attempts, r.allowed, r.reason) for r in got} == churn_by_hand(rows, most, window, cooldown)
    assert len(got) == len(rows)


@pytest.mark.parametrize("block", [1, 1000, 10**9])
def test_ordered_helpers_do_not_depend_on_the_block(spark, block):
    rows = traffic(9)
    df = frame(spark, rows).withColumn("b", F.floor(F.col("ts_ms") / block))
    order = ["ts_ms", "id"]
    df = ordered.number_rows(df, ["key"], "b", order, "rn")
    df = ordered.running(df, ["key"], "b", order, F.col("id"), "sum", "total")
    df = ordered.running(df, ["key"], "b", order, F.col("id"), "min", "low", inclusive=False)
    df = ordered.with_previous(df, ["key"], "b", order, ["id"])
    want = {}
    for seq in in_order(rows).values():
        total, low, last = 0, None, None
        for n, (ts, i) in enumerate(seq, 1):
            total += i
            want[i] = (n, total, low, last, n)
            low, last = (i if low is None else min(low, i)), i
    got = {r.id: (r.rn, r.total, r.low, r.previous and r.previous.id, r.position) for r in df.collect()}
    assert got == want


def test_helpers_without_keys(spark):
    df = spark.range(1000).withColumn("b", F.floor(F.col("id") / 64))
    got = ordered.number_rows(df, [], "b", ["id"], "rn").where("rn <> id + 1").count()
    assert got == 0
    assert ordered.running(df, [], "b", ["id"], F.lit(1), "sum", "s").agg(F.max("s")).first()[0] == 1000


def test_concurrency(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), s := rng.randrange(5000), s + rng.randrange(1, 300)) for i in range(800)]
    df = spark.createDataFrame(rows, "request_id long, db string, start_ms long, end_ms long")
    got = {r.db: (r.requests, r.peak, r.over_limit) for r in limits.concurrency(df, ["db"], 15, block_ms=100).collect()}
    for db in "ab":
        steps = sorted([(s, 1, i) for i, d, s, e in rows if d == db] + [(e, -1, i) for i, d, s, e in rows if d == db], key=lambda x: (x[0], x[1], x[2]))
        level = peak = over = 0
        for _, step, _ in steps:
            level += step
            peak = max(peak, level)
            over += step == 1 and level > 15
        assert got[db] == (sum(d == db for _, d, _, _ in rows), peak, over)


def test_sessions(spark):
    rows = traffic(5)
    got = limits.activity_sessions(frame(spark, rows), ["key"], ["ts_ms", "id"], 300, block_ms=1000).collect()
    want = []
    for key, seq in in_order(rows).items():
        start = last = seq[0][0]
        n = 0
        for ts, _ in seq:
            if ts - last > 300:
                want.append((key, start, last + 300, n))
                start, n = ts, 0
            last, n = ts, n + 1
        want.append((key, start, last + 300, n))
    assert sorted((r.key, r.start_ms, r.end_ms, r.events) for r in got) == sorted(want)


def test_chunks_by_size(spark):
    rng = random.Random(2)
    rows = [(i % 3, i, rng.randrange(60)) for i in range(900)]
    df = spark.createDataFrame(rows, "stream long, id long, size long")
    got = {r.id: r.chunk_index for r in limits.chunk_by_size(df, ["stream"], ["id"], "size", 20, 300).collect()}
    for stream in range(3):
        index = held = weight = 0
        for _, i, size in [r for r in rows if r[0] == stream]:
            assert got[i] == index
            held, weight = held + 1, weight + size
            if held >= 20 or weight >= 300:
                index, held, weight = index + 1, 0, 0


def test_chunks_of_one_stream(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 0, 5, 60, 400])) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, size long")
    got = {r.id: r.chunk_index for r in limits.chunk_by_size(df, [], ["id"], "size", 30, 900).collect()}
    want = serially(limits._chunks(30, 900), [(s or 0,) for _, s in rows])
    assert [got[i] for i in range(5000)] == [c for (c,) in want]


def test_latest_state(spark):
    beats = spark.createDataFrame([("a", 1, 10), ("a", 1, 95_000), ("b", 1, 5_000), ("c", 2, 99_000), ("d", 1, 99_000)], "agent_id string, pid long, ts_ms long")
    procs = spark.createDataFrame([("a", 1, True), ("b", 1, True), ("c", 1, True), ("d", 1, False), ("e", 1, True)], "agent_id string, pid long, alive boolean")
    got = {r.agent_id: r.state for r in limits.latest_state(beats, procs, 100_000).collect()}
    assert got == {"a": "running", "b": "unresponsive", "c": "unresponsive", "d": "stopped", "e": "starting"}


WAKE = "row_id long, wake_id string, reason string, queued_at long, token string, token_expires_at long, arrived_ms long"


def test_admission(spark):
    now = 10_000_000
    fine = dict(wake_id="w", reason="ping", queued_at=now, token="t", token_expires_at=now + 10**6, arrived_ms=now)
    cases = [
        ({}, None), ({}, "replayed"), ({"wake_id": ""}, "malformed"), ({"reason": "x"}, "malformed"), ({"queued_at": None}, "malformed"), ({"token": None}, "malformed"),
        ({"token_expires_at": now + 35_000}, "expired_token"), ({"token_expires_at": now + 35_001, "wake_id": "v"}, None),
        ({"queued_at": now - 150_001}, "stale"), ({"queued_at": now - 150_000, "wake_id": "u"}, None),
        ({"queued_at": now + 30_001}, "future_dated"), ({"queued_at": now + 30_000, "wake_id": "s"}, None),
    ]
    rows = [(i, *(fine | change).values()) for i, (change, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, WAKE)
    got = [r.refusal for r in admission.admit_events(df).orderBy("row_id").collect()]
    assert got == [want for _, want in cases]
    full = [r.refusal for r in admission.admit_events(df, cache_entries=2).orderBy("row_id").collect()]
    assert full == [None, "replayed", *[w for _, w in cases[2:7]], None, "stale", "cache_full", "future_dated", "cache_full"]


# --- streams ------------------------------------------------------------------------------------


@pytest.fixture()
def as_stream(spark, tmp_path):
    """Write a frame as several files and read them back as a stream, one file per batch."""

    def make(df, order, files=5, name="in"):
        rows = df.orderBy(order).collect()
        size = -(-len(rows) // files)
        for at in range(0, len(rows), size):
            spark.createDataFrame(rows[at : at + size], df.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    return make


def test_token_bucket_stream_equals_batch(spark, as_stream):
    rows = traffic(7, n=600)
    df = frame(spark, rows)
    rule = {k: F.lit(v).cast("bigint") for k, v in (("burst", 4), ("refill", 1), ("per_ms", 2000))}
    batch = {r.id: (r.allowed, r.retry_after_ms) for r in limits.token_bucket(df, ["key"], ["ts_ms", "id"], rule).collect()}
    stream = as_stream(df.withColumn("ts", F.timestamp_millis("ts_ms")), "ts_ms")
    live = jobs.token_bucket_stream(stream, ["key"], "ts", "id", 4, 1, 2000)
    assert {r.id: (r.allowed, r.retry_after_ms) for r in live.collect()} == batch


def test_token_bucket_stream_takes_late_rows_and_null_keys(spark, tmp_path):
    """A row older than its key's last one counts at that one's time; a bucket idle long enough is forgotten."""
    batches = [[(0, None, 0), (1, None, 10), (2, "a", 5)], [(3, None, 4), (4, "a", 40)], [(5, None, 100_000), (6, "b", 100_001)], [(7, "a", 100_002)]]
    for n, rows in enumerate(batches):
        frame(spark, rows).withColumn("ts", F.timestamp_millis("ts_ms")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = "id long, key string, ts_ms long, ts timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = {r.id: r.allowed for r in jobs.token_bucket_stream(stream, ["key"], "ts", "id", 2, 1, 50, idle_ms=1000).collect()}
    assert got == {0: True, 1: True, 2: True, 3: False, 4: True, 5: True, 6: True, 7: True}


def test_sessions_stream_equals_batch(spark, as_stream):
    df = frame(spark, traffic(8, n=400))
    batch = limits.activity_sessions(df, ["key"], ["ts_ms", "id"], 60_000)
    stream = as_stream(df.withColumn("ts", F.timestamp_millis("ts_ms")), "ts_ms")
    live = jobs.run_to_table(jobs.activity_sessions(stream, ["key"], "ts", "60 seconds", "0 seconds"), "ss")
    last = df.agg(F.max("ts_ms")).first()[0]
    columns = ["key", "start_ms", "end_ms", "events"]
    want = sorted(tuple(r) for r in batch.where(F.col("end_ms") <= last).select(*columns).collect())
    assert sorted(tuple(r) for r in live.collect()) == want
    whole = live.unionByName(jobs.sessions_left(live, df, ["key"], ["ts_ms", "id"], 60_000))
    assert sorted(tuple(r) for r in whole.select(*columns).collect()) == sorted(tuple(r) for r in batch.select(*columns).collect())


def test_stateless_refusals_on_a_stream(spark, as_stream):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        now = 10_000_000 + i * 500
        rows.append((i, f"w{rng.randrange(250)}", rng.choice(["ping", "ping", "bad"]), now - rng.randrange(200_000), "t", now + rng.randrange(80_000), now))
    df = spark.createDataFrame(rows, WAKE)
    stream = as_stream(df.withColumn("arrived_at", F.timestamp_millis("arrived_ms")), "arrived_ms")
    refused = {r.row_id: r.refusal for r in jobs.run_to_table(jobs.refused_events(stream), "rf").collect()}
    want = {r.row_id: r.refusal for r in admission.admit_events(df).where("refusal IS NOT NULL AND refusal <> 'replayed'").collect()}
    assert refused == want


def remembered_by_hand(rows, horizon, entries, refuse):
    """rows: (row_id, connection, id, at) in order."""
    memories, out = defaultdict(dict), {}
    for row_id, connection, id_, at in rows:
        memory = memories[connection]
        for old in [x for x, since in memory.items() if since + horizon < at]:
            del memory[old]
        out[row_id] = None
        if id_ in memory:
            out[row_id] = "replayed"
        elif len(memory) >= entries and refuse:
            out[row_id] = "cache_full"
        else:
            if len(memory) >= entries:
                del memory[next(iter(memory))]
            memory[id_] = at
    return out


@pytest.mark.parametrize(("horizon", "entries", "refuse"), [(60_000, 1000, True), (60_000, 12, True), (60_000, 12, False), (10**9, 5, False)])
def test_memory_has_a_horizon_and_a_bound(spark, as_stream, horizon, entries, refuse):
    rng = random.Random(7)
    rows = [(i, rng.choice("aab"), f"n{rng.randrange(60)}", 10_000_000 + i * 2_000) for i in range(300)]
    df = spark.createDataFrame([(i, c, x, at, at) for i, c, x, at in rows], "row_id long, connection string, nonce string, ts_ms long, arrived_ms long")
    stream = as_stream(df.withColumns({"arrived_at": F.timestamp_millis("arrived_ms")}), "arrived_ms", name="memory")
    memory = jobs.Memory(horizon, entries, refuse)
    live = jobs.run_to_table(jobs._remembered(stream, "nonce", "connection", "arrived_at", "row_id", memory, "0 seconds"), "memory")
    want = remembered_by_hand(rows, horizon, entries, refuse)
    assert {r.row_id: r.refusal for r in live.collect()} == want
    assert set(want.values()) >= {None, "replayed"} and (entries == 1000 or not refuse or "cache_full" in want.values())


def test_replays_on_a_stream_equal_batch(spark, as_stream):
    """Frames of a nonce lie within two windows of each other, so no memory is needed beyond them."""
    rng = random.Random(4)
    frames = [(i, f"n{rng.randrange(200)}", 10_000_000 + i * 200 - rng.randrange(200_000), 10_000_000 + i * 200) for i in range(400)]
    df = spark.createDataFrame(frames, "row_id long, nonce string, ts_ms long, arrived_ms long")
    batch = {r.row_id for r in admission.drop_replays(df).collect()}
    timed = df.withColumns({"ts": F.timestamp_millis("ts_ms"), "arrived_at": F.timestamp_millis("arrived_ms"), "connection": F.lit("c")})
    live = jobs.run_to_table(jobs.drop_replays(as_stream(timed, "arrived_ms", name="nonces"), "connection"), "rp")
    assert {r.row_id for r in live.where("refusal is null").collect()} == batch


def test_admission_on_a_stream_equals_batch(spark, as_stream):
    rng = random.Random(6)
    rows = []
    for i in range(400):
        now = 10_000_000 + i * 500
        rows.append((i, f"w{rng.randrange(250)}", rng.choice(["ping", "ping", "bad"]), now - rng.randrange(200_000), "t", now + rng.randrange(80_000), now))
    df = spark.createDataFrame(rows, WAKE).withColumns({"arrived_at": F.timestamp_millis("arrived_ms"), "connection": F.lit("c")})
    live = jobs.run_to_table(jobs.admit_events(as_stream(df, "arrived_ms", name="wakes"), "connection"), "ad")
    batch = admission.admit_events(df).where("refusal is null or refusal = 'replayed'")
    assert {r.row_id: r.refusal for r in live.collect()} == {r.row_id: r.refusal for r in batch.collect()}


def test_one_decision_a_request(spark, as_stream):
    """Several answers, early ones, ties and answers that come before their request in another batch; the rest by the closing step."""
    rng = random.Random(3)
    requests = [(i, "u", 1_000_000 + i * 10_000, "n" if i % 9 else None) for i in range(60)]
    answers = []
    for i in range(60):
        for _ in range(rng.randrange(4)):
            at = 1_000_000 + i * 10_000 + rng.choice([-500, 0, 3_000, 3_000, 20_000, 60_000, 60_001, 90_000])
            answers.append((i, rng.choice(["u", "u", "u", "v"]), at, "n", rng.random() < 0.6, rng.choice(["admin", "admin", "viewer"])))
    requests = spark.createDataFrame(requests, "request_id long, user_id string, ts_ms long, nonce string")
    responses = spark.createDataFrame(answers, "request_id long, user_id string, ts_ms long, nonce string, approved boolean, role string")
    batch = {r.request_id: (r.decision, r.decided_ms) for r in policy.match_approvals(requests, responses).collect()}
    def timed(df):
        return df.withColumn("ts", F.timestamp_millis("ts_ms"))
    asked, said = as_stream(timed(requests), "ts_ms", 6, "asked"), as_stream(timed(responses), "ts_ms", 6, "said")
    live = jobs.run_to_table(jobs.approval_decisions(asked, said, late="120 seconds"), "ap")
    decided = live.collect()
    assert len({r.request_id for r in decided}) == len(decided) >= 25
    assert {r.request_id: (r.decision, r.decided_ms) for r in decided}.items() <= batch.items()
    whole = live.unionByName(jobs.approvals_left(live, requests, responses)).collect()
    assert len(whole) == 60 and {r.request_id: (r.decision, r.decided_ms) for r in whole} == batch


class CountedState:
    """A state store in memory that counts the calls made to it."""

    def __init__(self):
        self.calls, self.lists, self.timers = 0, {}, set()

    def getListState(self, name, schema):
        handle = self

        class List:
            def exists(self):
                handle.calls += 1
                return bool(handle.lists.get(name))

            def get(self):
                handle.calls += 1
                return iter(handle.lists[name])

            def put(self, rows):
                handle.calls += 1
                handle.lists[name] = list(rows)

            def clear(self):
                handle.calls += 1
                handle.lists.pop(name, None)

        return List()

    def listTimers(self):
        self.calls += 1
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)


def test_a_row_makes_no_call_to_the_state_store():
    for size in (10, 2000):
        state = CountedState()
        memory = jobs.Memory(60_000, 50, refuse=False)
        memory.init(state)
        rows = [("c", f"n{i % 70}", i * 10, i, None) for i in range(size)]
        want = remembered_by_hand([(i, c, x, at) for c, x, at, i, _ in rows], 60_000, 50, False)
        assert {r.row_id: r.refusal for r in memory.handleInputRows(("c",), iter(rows[::-1]), None)} == want
        assert state.calls <= 5
        state = CountedState()
        decisions = jobs.Decisions(60_000)
        decisions.init(state)
        rows = [(0, i, "u", "n", what, i * 10, True, None) for i in range(size) for what in ("asked", "answered")]
        assert list(decisions.handleInputRows((0,), iter(rows), None)) == []
        assert state.calls <= 5 and len(state.timers) == 1 and len(state.lists["open"]) == 2 * size


def test_blocks_of_one_key_are_summarised_apart(spark, capsys):
    """Without keys the one task that carries the state must not make the summaries too."""
    rule = {n: F.lit(v).cast("bigint") for n, v in (("burst", 4), ("refill", 1), ("per_ms", 2000))}
    limits.token_bucket(frame(spark, traffic(7, n=50)), [], ["ts_ms", "id"], rule).explain()
    assert "Coalesce 1" not in capsys.readouterr().out


def test_rate_policies(spark):
    df = spark.createDataFrame([("query",), ("strange",)], "action string").withColumns(limits.policy_columns("action"))
    assert [(r.burst, r.refill) for r in df.collect()] == [C.RATE_POLICIES["query"], C.RATE_POLICIES["other"]]
