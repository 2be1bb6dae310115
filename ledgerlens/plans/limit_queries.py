"""Rate, churn, concurrency, chunk, session and admission queries, batch and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.operators import admission, filters, limits
from ledgerlens.plans.fixtures import MILLIS, REQUEST_LOG, define_view, view, with_views
from ledgerlens.plans.policy_queries import APPROVALS_SQL
from ledgerlens.plans.registry import query
from ledgerlens.session import read_table, scratch_dir
from ledgerlens.sources import segments
from ledgerlens.streaming import jobs

BURST, REFILL, PER_MS = 3, 1, 1_500_000

TOKEN_SQL = f"""{with_views('request_log', recursive=True)},
n AS (SELECT seq_id, db_alias, ts_ms, row_number() OVER (PARTITION BY db_alias ORDER BY ts_ms, seq_id) AS rn FROM request_log),
b AS (SELECT seq_id, db_alias, ts_ms, rn, CAST({BURST * PER_MS} AS BIGINT) - {PER_MS} AS tokens, true AS allowed, CAST(0 AS BIGINT) AS retry FROM n WHERE rn = 1
  UNION ALL SELECT n.seq_id, n.db_alias, n.ts_ms, n.rn, CASE WHEN f.full_ >= {PER_MS} THEN f.full_ - {PER_MS} ELSE f.full_ END AS tokens,
    f.full_ >= {PER_MS} AS allowed, CASE WHEN f.full_ >= {PER_MS} THEN 0 ELSE greatest(1, ({PER_MS} - f.full_ + {REFILL} - 1) // {REFILL}) END AS retry
  FROM b JOIN n ON n.db_alias = b.db_alias AND n.rn = b.rn + 1, LATERAL (SELECT least({BURST * PER_MS}, b.tokens + (n.ts_ms - b.ts_ms) * {REFILL}) AS full_) f)
SELECT seq_id, db_alias, allowed, retry AS retry_after_ms FROM b"""


@query("token_bucket", TOKEN_SQL)
def token_bucket(spark, sf_dir):
    log = view(spark, sf_dir, "request_log").select("seq_id", "db_alias", "ts_ms")
    policy = {"burst": F.lit(BURST).cast("bigint"), "refill": F.lit(REFILL).cast("bigint"), "per_ms": F.lit(PER_MS).cast("bigint")}
    return limits.token_bucket(log, ["db_alias"], ["ts_ms", "seq_id"], policy).drop("ts_ms")


def _bucket_sql(source: str, key: str, order: str, burst: str, refill: str, per_ms: str, to: str = "") -> str:
    """The serial recurrence over the rows of ``source``, row by row."""
    full = f"({burst}) * {per_ms}"
    return f"""{to}n AS (SELECT *, {full} AS full_, {refill} AS refill_, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn, CONCAT_WS('/', {key}) AS key_ FROM {source}),
{to}b AS (SELECT key_, rn, seq_id, ts_ms, CAST(full_ - {per_ms} AS BIGINT) AS tokens, true AS allowed FROM {to}n WHERE rn = 1
  UNION ALL SELECT n.key_, n.rn, n.seq_id, n.ts_ms, CAST(CASE WHEN f.now_ >= {per_ms} THEN f.now_ - {per_ms} ELSE f.now_ END AS BIGINT) AS tokens, f.now_ >= {per_ms} AS allowed
  FROM {to}b b JOIN {to}n n ON n.key_ = b.key_ AND n.rn = b.rn + 1, LATERAL (SELECT least(n.full_, b.tokens + (n.ts_ms - b.ts_ms) * n.refill_) AS now_) f)"""


#: milliseconds into which a day of the log is pressed, so that the default budgets are exceeded
_RUSH = 86_400_000 // 400
define_view("rush", f"SELECT seq_id, agent_id, action, CAST(floor(ts_ms / {_RUSH}) AS BIGINT) AS ts_ms FROM [request_log]", ("request_log",))


@query(
    "rate_policies",
    f"""{with_views('rush', recursive=True)}, {_bucket_sql(
        'rush', 'agent_id, action', 'ts_ms, seq_id',
        'CASE action ' + ' '.join(f"WHEN '{a}' THEN {size}" for a, (size, _) in C.RATE_POLICIES.items()) + f" ELSE {C.RATE_POLICIES['other'][0]} END",
        'CASE action ' + ' '.join(f"WHEN '{a}' THEN {rate}" for a, (_, rate) in C.RATE_POLICIES.items()) + f" ELSE {C.RATE_POLICIES['other'][1]} END", '1000')}
SELECT seq_id, allowed FROM b""",
)
def rate_policies(spark, sf_dir):
    """The default per-action budgets per agent and action, in a rush that exceeds them."""
    log = view(spark, sf_dir, "rush")
    done = limits.token_bucket(log, ["agent_id", "action"], ["ts_ms", "seq_id"], limits.policy_columns("action"))
    return done.select("seq_id", "allowed")


_RATES = [
    "CASE action " + " ".join(f"WHEN '{a}' THEN {p[i]}" for a, p in C.RATE_POLICIES.items()) + f" ELSE {C.RATE_POLICIES['other'][i]} END" for i in (0, 1)
]


@query(
    "rate_limit",
    f"""{with_views('rush', recursive=True)}, o AS (SELECT *, 'all' AS everyone FROM rush),
{_bucket_sql('o', 'everyone', 'ts_ms, seq_id', str(C.GLOBAL_POLICY[0]), str(C.GLOBAL_POLICY[1]), '1000', 'g')},
p AS (SELECT rush.* FROM rush JOIN gb USING (seq_id) WHERE allowed), {_bucket_sql('p', 'agent_id, action', 'ts_ms, seq_id', *_RATES, '1000', 'k')}
SELECT seq_id, gb.allowed AND kb.allowed AS allowed, CASE WHEN NOT gb.allowed THEN 'global' WHEN NOT kb.allowed THEN 'identity' END AS scope FROM gb LEFT JOIN kb USING (seq_id)""",
)
def rate_limit(spark, sf_dir):
    """The bucket that all requests share and then those of each agent and action, in a rush that exceeds both."""
    done = limits.rate_limit(view(spark, sf_dir, "rush"), ["agent_id", "action"], ["ts_ms", "seq_id"], limits.policy_columns("action"))
    return done.select("seq_id", "allowed", "scope")


@query(
    "token_bucket_one_key",
    f"""{with_views('request_log', recursive=True)}, o AS (SELECT seq_id, ts_ms, 'all' AS everyone FROM request_log),
{_bucket_sql('o', 'everyone', 'ts_ms, seq_id', '40', '1', '1000000')} SELECT seq_id, allowed FROM b""",
)
def token_bucket_one_key(spark, sf_dir):
    """The whole log against one bucket that every request shares."""
    log = view(spark, sf_dir, "request_log").select("seq_id", "ts_ms")
    policy = {n: F.lit(v).cast("bigint") for n, v in (("burst", 40), ("refill", 1), ("per_ms", 1_000_000))}
    return limits.token_bucket(log, [], ["ts_ms", "seq_id"], policy).select("seq_id", "allowed")


WINDOW, COOLDOWN, MOST = 7_200_000, 600_000, 9


@query(
    "churn_budget",
    f"""{with_views('request_log', recursive=True)},
n AS (SELECT seq_id, db_alias, ts_ms, row_number() OVER w AS rn, count(*) OVER (PARTITION BY db_alias ORDER BY ts_ms RANGE BETWEEN {WINDOW} PRECEDING AND CURRENT ROW) - 1 AS attempts
  FROM request_log WINDOW w AS (PARTITION BY db_alias ORDER BY ts_ms, seq_id)),
b AS (SELECT seq_id, db_alias, ts_ms, rn, attempts, attempts < {MOST} AS allowed, CASE WHEN attempts < {MOST} THEN ts_ms ELSE -1000000000000 END AS last_ FROM n WHERE rn = 1
  UNION ALL SELECT n.seq_id, n.db_alias, n.ts_ms, n.rn, n.attempts, n.attempts < {MOST} AND n.ts_ms - b.last_ >= {COOLDOWN} AS allowed,
    CASE WHEN n.attempts < {MOST} AND n.ts_ms - b.last_ >= {COOLDOWN} THEN n.ts_ms ELSE b.last_ END AS last_ FROM b JOIN n ON n.db_alias = b.db_alias AND n.rn = b.rn + 1)
SELECT seq_id, db_alias, attempts, allowed, CASE WHEN attempts >= {MOST} THEN 'churn_limit' WHEN NOT allowed THEN 'cooldown' END AS reason FROM b""",
)
def churn_budget(spark, sf_dir):
    log = view(spark, sf_dir, "request_log").select("seq_id", "db_alias", "ts_ms")
    done = limits.churn_budget(log, ["db_alias"], ["ts_ms", "seq_id"], MOST, WINDOW, COOLDOWN)
    return done.select("seq_id", "db_alias", F.col("attempts").cast("bigint").alias("attempts"), "allowed", "reason")


@query(
    "concurrency",
    f"""{with_views('request_log')}, e AS (SELECT db_alias, seq_id, ts_ms AS t, 1 AS d FROM request_log UNION ALL
  SELECT db_alias, seq_id, ts_ms + 1 + duration_ms * 5000 AS t, -1 AS d FROM request_log),
l AS (SELECT *, sum(d) OVER (PARTITION BY db_alias ORDER BY t, d, seq_id ROWS UNBOUNDED PRECEDING) AS n FROM e)
SELECT db_alias, count(*) FILTER (d = 1) AS requests, CAST(max(n) AS BIGINT) AS peak, count(*) FILTER (d = 1 AND n > 4) AS over_limit FROM l GROUP BY 1""",
)
def concurrency(spark, sf_dir):
    requests = view(spark, sf_dir, "request_log").selectExpr(
        "db_alias", "seq_id AS request_id", "ts_ms AS start_ms", "ts_ms + 1 + duration_ms * 5000 AS end_ms"
    )
    return limits.concurrency(requests, ["db_alias"], 4)


@query(
    "assign_chunks",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1) // 100 AS chunk_index
FROM lineitem""",
)
def assign_chunks(spark, sf_dir):
    items = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    items = items.withColumn("_block", F.floor(F.col("l_orderkey") / 5000))
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return limits.chunk_by_rows(items, ["l_suppkey"], "_block", order).drop("_block", "l_extendedprice")


@query(
    "assign_chunks_by_size",
    """WITH RECURSIVE n AS (SELECT doc_id // 250 AS stream, doc_id, strlen(text) AS size, row_number() OVER (PARTITION BY doc_id // 250 ORDER BY doc_id) AS rn FROM documents),
c AS (SELECT stream, doc_id, rn, CAST(0 AS BIGINT) AS chunk_index, 1 AS held, size AS weight FROM n WHERE rn = 1
  UNION ALL SELECT n.stream, n.doc_id, n.rn, CASE WHEN c.held >= 20 OR c.weight >= 65536 THEN c.chunk_index + 1 ELSE c.chunk_index END AS chunk_index,
    CASE WHEN c.held >= 20 OR c.weight >= 65536 THEN 1 ELSE c.held + 1 END AS held, CASE WHEN c.held >= 20 OR c.weight >= 65536 THEN n.size ELSE c.weight + n.size END AS weight
  FROM c JOIN n ON n.stream = c.stream AND n.rn = c.rn + 1)
SELECT stream, doc_id, chunk_index FROM c""",
)
def assign_chunks_by_size(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / 250).alias("stream"), "doc_id", F.octet_length("text").cast("bigint").alias("size")
    )
    return limits.chunk_by_size(docs, ["stream"], ["doc_id"], "size", rows=20).drop("size")


@query(
    "assign_chunks_one_stream",
    """WITH RECURSIVE n AS (SELECT conv_id, turn, strlen(text) AS size, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM conversations),
c AS (SELECT conv_id, turn, rn, CAST(0 AS BIGINT) AS chunk_index, 1 AS held, size AS weight FROM n WHERE rn = 1
  UNION ALL SELECT n.conv_id, n.turn, n.rn, CASE WHEN c.held >= 100 OR c.weight >= 4096 THEN c.chunk_index + 1 ELSE c.chunk_index END AS chunk_index,
    CASE WHEN c.held >= 100 OR c.weight >= 4096 THEN 1 ELSE c.held + 1 END AS held, CASE WHEN c.held >= 100 OR c.weight >= 4096 THEN n.size ELSE c.weight + n.size END AS weight
  FROM c JOIN n ON n.rn = c.rn + 1)
SELECT conv_id, turn, chunk_index FROM c""",
)
def assign_chunks_one_stream(spark, sf_dir):
    """All conversation turns as one stream of results, in chunks of at most 100 rows that close at 4 KiB."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", F.octet_length("text").cast("bigint").alias("size"))
    return limits.chunk_by_size(turns, [], ["conv_id", "turn"], "size", rows=100, max_bytes=4096).drop("size")


@query(
    "churn_budget_one_key",
    f"""{with_views('request_log', recursive=True)},
n AS (SELECT seq_id, ts_ms, row_number() OVER (ORDER BY ts_ms, seq_id) AS rn, count(*) OVER (ORDER BY ts_ms RANGE BETWEEN {WINDOW} PRECEDING AND CURRENT ROW)
    - count(*) OVER (PARTITION BY ts_ms) + row_number() OVER (PARTITION BY ts_ms ORDER BY seq_id) - 1 AS attempts FROM request_log),
b AS (SELECT seq_id, ts_ms, rn, attempts, attempts < 32 AS allowed, CASE WHEN attempts < 32 THEN ts_ms ELSE -1000000000000 END AS last_ FROM n WHERE rn = 1
  UNION ALL SELECT n.seq_id, n.ts_ms, n.rn, n.attempts, n.attempts < 32 AND n.ts_ms - b.last_ >= {COOLDOWN} AS allowed,
    CASE WHEN n.attempts < 32 AND n.ts_ms - b.last_ >= {COOLDOWN} THEN n.ts_ms ELSE b.last_ END AS last_ FROM b JOIN n ON n.rn = b.rn + 1)
SELECT seq_id, attempts, allowed, CASE WHEN attempts >= 32 THEN 'churn_limit' WHEN NOT allowed THEN 'cooldown' END AS reason FROM b""",
)
def churn_budget_one_key(spark, sf_dir):
    """The whole log as the attempts of one key."""
    log = view(spark, sf_dir, "request_log").select("seq_id", "ts_ms")
    done = limits.churn_budget(log, [], ["ts_ms", "seq_id"], 32, WINDOW, COOLDOWN)
    return done.select("seq_id", F.col("attempts").cast("bigint").alias("attempts"), "allowed", "reason")


_PROCESSES = """SELECT concat('a', CAST(user_id AS VARCHAR(20))) AS agent_id, CAST(max(k) AS BIGINT) AS pid, max(k) % 5 <> 0 AS alive FROM [request_log] GROUP BY user_id"""
_BEATS = """SELECT concat('a', CAST(user_id AS VARCHAR(20))) AS agent_id, CAST(k + CASE WHEN user_id % 6 = 0 THEN 100 ELSE 0 END AS BIGINT) AS pid, ts_ms FROM [request_log] WHERE user_id % 9 <> 0"""
define_view("processes", _PROCESSES, ("request_log",))
define_view("heartbeats", _BEATS, ("request_log",))


@query(
    "latest_state",
    f"""{with_views('processes', 'heartbeats')}, h AS (SELECT agent_id, max(ts_ms) AS last_heartbeat_ms, arg_max(pid, ts_ms) AS beat FROM heartbeats GROUP BY 1)
SELECT p.agent_id, p.pid, last_heartbeat_ms, CASE WHEN NOT alive THEN 'stopped' WHEN last_heartbeat_ms IS NULL THEN 'starting'
  WHEN beat <> pid OR 1706659200000 - last_heartbeat_ms > 90000000 THEN 'unresponsive' ELSE 'running' END AS state FROM processes p LEFT JOIN h USING (agent_id)""",
)
def latest_state(spark, sf_dir):
    return limits.latest_state(view(spark, sf_dir, "heartbeats"), view(spark, sf_dir, "processes"), 1706659200000, 90_000_000)


GAP = 600_000
SESSIONS_SQL = f"""{with_views('request_log')},
g AS (SELECT db_alias, ts_ms, seq_id, CASE WHEN ts_ms - lag(ts_ms) OVER w <= {GAP} THEN 0 ELSE 1 END AS f FROM request_log WINDOW w AS (PARTITION BY db_alias ORDER BY ts_ms, seq_id)),
s AS (SELECT *, sum(f) OVER (PARTITION BY db_alias ORDER BY ts_ms, seq_id ROWS UNBOUNDED PRECEDING) AS n FROM g),
a AS (SELECT db_alias, min(ts_ms) AS start_ms, max(ts_ms) + {GAP} AS end_ms, count(*) AS events FROM s GROUP BY db_alias, n)
SELECT * FROM a"""


@query("activity_sessions", SESSIONS_SQL)
def activity_sessions(spark, sf_dir):
    log = view(spark, sf_dir, "request_log")
    return limits.activity_sessions(log, ["db_alias"], ["ts_ms", "seq_id"], GAP)


_WAKES = """SELECT seq_id AS row_id, CASE WHEN k % 41 = 0 THEN '' ELSE concat('w', CAST(CAST(floor(seq_id / 3) AS BIGINT) AS VARCHAR(20))) END AS wake_id,
  CASE k % 6 WHEN 0 THEN 'browser_request' WHEN 1 THEN 'ping' WHEN 2 THEN 'config_sync' WHEN 3 THEN 'gossip' ELSE 'migration_queued' END AS reason,
  ts_ms - (k - 10) * 2000 AS queued_at, 'tok' AS token, ts_ms + (k - 20) * 3000 AS token_expires_at, ts_ms AS arrived_ms, ts FROM [request_log]"""
define_view("wakes", _WAKES, ("request_log",))
_ADMIT_SQL = f"""{with_views('wakes')}, r AS (SELECT *, CASE WHEN wake_id = '' OR reason = 'gossip' THEN 'malformed' WHEN token_expires_at - 35000 <= arrived_ms THEN 'expired_token'
  WHEN arrived_ms - queued_at > 150000 THEN 'stale' WHEN arrived_ms - queued_at < -30000 THEN 'future_dated' END AS why FROM wakes),
f AS (SELECT *, row_number() OVER (PARTITION BY wake_id, why IS NULL ORDER BY arrived_ms, row_id) AS pos FROM r)"""


@query("admit_events", f"{_ADMIT_SQL} SELECT row_id, coalesce(why, CASE WHEN pos > 1 THEN 'replayed' END) AS refusal FROM f")
def admit_events(spark, sf_dir):
    return admission.admit_events(view(spark, sf_dir, "wakes")).select("row_id", "refusal")


_ENVELOPES = """SELECT seq_id AS row_id, concat('n', CAST(CAST(floor(seq_id / 2) AS BIGINT) AS VARCHAR(20))) AS nonce, ts_ms - (k - 50) * 3000 AS ts_ms, ts_ms AS arrived_ms FROM [request_log]"""
define_view("envelopes", _ENVELOPES, ("request_log",))


@query(
    "drop_replays",
    f"""{with_views('envelopes')} SELECT row_id, nonce FROM (SELECT *, row_number() OVER (PARTITION BY nonce ORDER BY arrived_ms, row_id) AS pos FROM envelopes
  WHERE abs(arrived_ms - ts_ms) <= 120000) t WHERE pos = 1""",
)
def drop_replays(spark, sf_dir):
    return admission.drop_replays(view(spark, sf_dir, "envelopes")).select("row_id", "nonce")


# --- streams over the events file ---------------------------------------------------------------


def _request_stream(spark, sf_dir):
    """request_log as a stream, with a real timestamp."""
    schema = read_table(spark, sf_dir, "events").schema
    events = jobs.table_stream(spark, sf_dir, "events", schema)
    text = REQUEST_LOG.replace("[ms]", MILLIS["spark"]).replace("{", "{{").replace("}", "}}").replace("[events]", "{events}")
    return spark.sql(text, events=events).withColumn("ts", jobs.event_time("ts"))


def _by_phases(spark, tables, time: str, build, label: str, phases: int = 4):
    """Runs the stream that ``build`` makes of ``tables`` as they grow: a part of each, cut at the same times, arrives, then
    the stream takes it as one micro-batch and stops; the next run goes on from its state."""
    folders, root = [scratch_dir(spark, label) for _ in tables], scratch_dir(spark, label)
    cuts = tables[0].approxQuantile(time, [i / phases for i in range(1, phases)], 0.01)
    for low, high in zip([None, *cuts], [*cuts, None]):
        for table, folder in zip(tables, folders):
            part = table if low is None else table.where(F.col(time) > low)
            (part if high is None else part.where(F.col(time) <= high)).write.mode("append").parquet(folder)
        streams = [spark.readStream.schema(table.schema).parquet(folder) for table, folder in zip(tables, folders)]
        done = jobs.run_to_table(build(*streams), label, root=root)
    return done


@query(
    "live_counters",
    f"""{with_views('request_log')}
SELECT ts_ms - ts_ms % 3600000 AS start_ms,
  count(*) FILTER (decision = 'allow' AND outcome <> 'n/a' AND action = 'query') AS queries_served,
  count(*) FILTER (decision = 'allow' AND outcome <> 'n/a' AND action = 'stream_query') AS streams_served,
  count(*) FILTER (decision = 'allow' AND outcome <> 'n/a' AND action = 'migration_run') AS migrations_run,
  count(*) FILTER (decision = 'allow' AND outcome <> 'n/a' AND action = 'cancel') AS cancellations,
  count(*) FILTER (decision = 'deny' AND coalesce(denial_reason, '') = 'buffer_overflow') AS buffer_overflows,
  count(*) FILTER (decision = 'deny' AND coalesce(denial_reason, '') <> 'buffer_overflow') AS permission_denies
FROM request_log GROUP BY start_ms""",
)
def live_counters(spark, sf_dir):
    """The stream's buckets, and those that were still open at its end."""
    closed = jobs.run_to_table(jobs.live_counters(_request_stream(spark, sf_dir), "ts"), "live-counters")
    log = view(spark, sf_dir, "request_log").withColumn("ts", jobs.event_time("ts"))
    return closed.unionByName(jobs.counters_left(closed, log, "ts"))


@query("session_stream", SESSIONS_SQL)
def session_stream(spark, sf_dir):
    """The stream's sessions, and those that were still open at its end."""
    stream = jobs.activity_sessions(_request_stream(spark, sf_dir), ["db_alias"], "ts", "600 seconds")
    closed = jobs.run_to_table(stream, "sessions")
    log = view(spark, sf_dir, "request_log").select("db_alias", "ts_ms", "seq_id")
    return closed.unionByName(jobs.sessions_left(closed, log, ["db_alias"], ["ts_ms", "seq_id"], GAP))


#: arrivals 20 s apart, some ids again after up to 15 minutes; a connection each seven ids
_STREAM_WAKES = """SELECT *, queued_at_ AS queued_at, 'tok' AS token, arrived_ms + (k - 5) * 3000 AS token_expires_at FROM (
  SELECT *, arrived_ms - (k - 10) * 1500 AS queued_at_ FROM (SELECT seq_id AS row_id, k, concat('c', CAST(CAST(floor(seq_id / 3) AS BIGINT) % 7 AS VARCHAR(4))) AS connection,
  CASE WHEN k % 41 = 0 THEN '' ELSE concat('w', CAST(CAST(floor(seq_id / 3) AS BIGINT) AS VARCHAR(20))) END AS wake_id,
  CASE k % 6 WHEN 0 THEN 'browser_request' WHEN 1 THEN 'ping' WHEN 2 THEN 'config_sync' WHEN 3 THEN 'gossip' ELSE 'migration_queued' END AS reason,
  1704067200000 + seq_id * 20000 + CASE WHEN seq_id % 3 = 2 THEN k * 9000 ELSE 0 END AS arrived_ms FROM [request_log]) a) b"""
define_view("stream_wakes", _STREAM_WAKES, ("request_log",))


def _memory_sql(fresh: str, id_: str, horizon: int) -> str:
    """Rows of ``fresh`` and whether the id was used within the horizon of its last accepted use."""
    return f"""n AS (SELECT *, row_number() OVER (PARTITION BY connection, {id_} ORDER BY arrived_ms, row_id) AS rn FROM {fresh}),
b AS (SELECT connection, {id_} AS id, rn, row_id, arrived_ms AS used, true AS fresh FROM n WHERE rn = 1
  UNION ALL SELECT n.connection, n.{id_}, n.rn, n.row_id, CASE WHEN n.arrived_ms > b.used + {horizon} THEN n.arrived_ms ELSE b.used END, n.arrived_ms > b.used + {horizon}
  FROM b JOIN n ON n.connection = b.connection AND n.{id_} = b.id AND n.rn = b.rn + 1)
SELECT row_id, CASE WHEN NOT fresh THEN 'replayed' END AS refusal FROM b"""


@query(
    "admit_stream",
    f"""{with_views('stream_wakes', recursive=True)}, f AS (SELECT * FROM stream_wakes WHERE wake_id <> '' AND reason <> 'gossip' AND token_expires_at - 35000 > arrived_ms
  AND arrived_ms - queued_at <= 150000 AND arrived_ms - queued_at >= -30000), {_memory_sql('f', 'wake_id', 600_000)}""",
)
def admit_stream(spark, sf_dir):
    """Wake events in several micro-batches, with a replay memory of ten minutes for each connection."""
    wakes = view(spark, sf_dir, "stream_wakes").drop("queued_at_").withColumn("arrived_at", F.timestamp_millis("arrived_ms"))
    return _by_phases(spark, [wakes], "arrived_ms", lambda stream: jobs.admit_events(stream, "connection"), "admit")


@query("token_bucket_stream", TOKEN_SQL)
def token_bucket_stream(spark, sf_dir):
    stream = _request_stream(spark, sf_dir).select("seq_id", "db_alias", "ts")
    return jobs.token_bucket_stream(stream, ["db_alias"], "ts", "seq_id", BURST, REFILL, PER_MS, idle_ms=86_400_000 * 60)


_STREAM_ENVELOPES = """SELECT row_id, nonce, connection, arrived_ms, arrived_ms - (k - 50) * 3000 AS sent_ms FROM (SELECT seq_id AS row_id, k,
  concat('n', CAST(CAST(floor(seq_id / 2) AS BIGINT) AS VARCHAR(20))) AS nonce, concat('c', CAST(CAST(floor(seq_id / 2) AS BIGINT) % 5 AS VARCHAR(4))) AS connection,
  1704067200000 + seq_id * 20000 + CASE WHEN seq_id % 2 = 1 THEN k * 4000 ELSE 0 END AS arrived_ms FROM [request_log]) a"""
define_view("stream_envelopes", _STREAM_ENVELOPES, ("request_log",))


@query(
    "replay_stream",
    f"""{with_views('stream_envelopes', recursive=True)}, f AS (SELECT * FROM stream_envelopes WHERE abs(arrived_ms - sent_ms) <= 120000), {_memory_sql('f', 'nonce', 240_000)}""",
)
def replay_stream(spark, sf_dir):
    """Envelopes in several micro-batches, with a nonce memory of two freshness windows for each connection."""
    frames = view(spark, sf_dir, "stream_envelopes").withColumns({"ts": F.timestamp_millis("sent_ms"), "arrived_at": F.timestamp_millis("arrived_ms")})
    return _by_phases(spark, [frames], "arrived_ms", lambda stream: jobs.drop_replays(stream, "connection"), "replays")


@query("approval_stream", APPROVALS_SQL)
def approval_stream(spark, sf_dir):
    """One decision a request from the stream, and by the closing step those that it had left open."""
    asked, said = view(spark, sf_dir, "approval_requests"), view(spark, sf_dir, "approval_responses")
    timed = [df.withColumn("ts", F.timestamp_millis("ts_ms")) for df in (asked, said)]
    done = _by_phases(spark, timed, "ts_ms", jobs.approval_decisions, "approvals")
    return done.unionByName(jobs.approvals_left(done, asked, said))


@query(
    "follow_segments",
    f"""{with_views('request_log')} SELECT concat('r', seq_id) AS id, action, project FROM request_log
WHERE k % 23 <> 0 AND lower(outcome) = 'error' AND ts_ms >= 1704412800000""",
)
def follow_segments(spark, sf_dir):
    """Follow a folder of log files, a file for each database and day, while they grow.

    Between the two runs of the stream all files grow, those of one database are renamed as well, and those of another are cut
    and begin anew. Every line is to come once.
    """
    number = F.substring("db_alias", 3, 1).cast("bigint") * 100_000 + F.floor(F.col("ts_ms") / 86_400_000)
    log = view(spark, sf_dir, "request_log").withColumns({"id": F.concat(F.lit("r"), "seq_id"), "n": number})
    line = F.when(F.col("k") % 23 == 0, F.expr("left(_line, char_length(_line) - 3)")).otherwise(F.col("_line"))
    lines = log.withColumn("_line", F.to_json(F.struct("action", "id", "outcome", "project", "seq_id", "ts_ms"))).select(
        "db_alias", "n", (F.col("k") >= 60).alias("later"), "seq_id", line.alias("value")
    )
    folder, root = scratch_dir(spark, "growing"), scratch_dir(spark, "follow")
    wanted = filters.audit_filter(segments.follow_segments(spark, folder, range_bytes=4096), outcome="ERROR", since=1704412800000, time_column="ts_ms")
    wanted = wanted.select("id", "action", "project")
    order = ["later", "seq_id"]
    segments.publish_files(lines.where("not later"), folder, F.format_string("audit-%d.jsonl", "n"), order)
    jobs.run_to_table(wanted, "follow", root=root)
    moved = lines.where("db_alias = 'db2'")
    segments.publish_files(moved, folder, F.format_string("audit-%d.jsonl", F.col("n") + 1_000_000), order)
    segments.remove_files(folder, moved.select(F.format_string("audit-%d.jsonl", "n").alias("name")).distinct())
    segments.publish_files(lines.where("db_alias not in ('db2', 'db4') or (db_alias = 'db4' and later)"), folder, F.format_string("audit-%d.jsonl", "n"), order)
    return jobs.run_to_table(wanted, "follow", root=root)
