"""Chains, segments and anchors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import aggregates, chain
from ledgerlens.plans.fixtures import define_view, view, with_views
from ledgerlens.plans.registry import query
from ledgerlens.plans.text_queries import KEY, hmac_sql
from ledgerlens.session import cut_lineage, scratch_dir
from ledgerlens.sources import segments, verdicts

RECORD = ["action", "db_alias", "decision", "denial_reason", "id", "outcome", "project", "role", "ts_ms", "user_id"]
LINK_RECORDS = 40

_LOG = """SELECT concat('r', CAST(seq_id AS VARCHAR(20))) AS id, seq_id, ts_ms, db_alias, project,
  CAST(user_id AS VARCHAR(20)) AS user_id, role, action, decision, outcome, denial_reason, k,
  concat(db_alias, '/', CAST(CAST(ts AS DATE) AS VARCHAR(10))) AS shard, CAST(floor(ts_ms / 60000) AS BIGINT) AS minute, CAST(floor(ts_ms / 3600000) AS BIGINT) AS hour
FROM [request_log]"""

_JSON = """'{"action":"' || action || '","chain_id":"' || chain_id || '","db_alias":"' || db_alias || '","decision":"' || decision ||
  '"' || CASE WHEN denial_reason IS NULL THEN '' ELSE ',"denial_reason":"' || denial_reason || '"' END ||
  ',"id":"' || id || '","outcome":"' || outcome || '","prev_hash":"' || PREV || '","project":"' || project || '","role":"' || role ||
  '","seq":' || seq || ',"ts_ms":' || ts_ms || ',"user_id":"' || user_id || '"}' || PREV"""
_GENESIS = "'" + "0" * 64 + "'"


def _mac(alias: str, prev: str) -> str:
    text = _JSON.replace("PREV", prev)
    for name in ("action", "chain_id", "db_alias", "decision", "denial_reason", "id", "outcome", "project", "role", "seq", "ts_ms", "user_id"):
        text = text.replace(f"|| {name} ||", f"|| {alias}.{name} ||").replace(f"WHEN {name} IS", f"WHEN {alias}.{name} IS")
    return hmac_sql(f"({text})")


def chain_sql() -> str:
    """The oracle's chain: a recursive query, one step per sequence number."""
    return f"""{with_views("request_log", recursive=True)}, log AS ({_LOG.replace("[request_log]", "request_log")}),
n AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY ts_ms, seq_id) - 1 AS place FROM log),
r AS (SELECT *, shard || '/' || lpad(CAST(place // {LINK_RECORDS} AS VARCHAR), 6, '0') AS chain_id, place % {LINK_RECORDS} + 1 AS seq FROM n),
c AS (SELECT r.*, {_GENESIS} AS prev_hash, {_mac("r", _GENESIS)} AS mac FROM r WHERE seq = 1
  UNION ALL SELECT r.*, c.mac AS prev_hash, {_mac("r", "c.mac")} AS mac FROM c JOIN r ON r.chain_id = c.chain_id AND r.seq = c.seq + 1)"""


def log(spark, sf_dir):
    return spark.sql(_LOG.replace("[request_log]", "{request_log}"), request_log=view(spark, sf_dir, "request_log"))


def built(spark, sf_dir):
    return chain.build_chain(log(spark, sf_dir), KEY, "shard", "minute", ["ts_ms", "seq_id"], RECORD, LINK_RECORDS)


def stored(spark, sf_dir):
    """The chained log as a written table: a log is built once and then read many times."""
    path = scratch_dir(spark, "chain")
    built(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@query("build_chain", f"{chain_sql()} SELECT chain_id, seq, id, prev_hash, mac FROM c")
def build_chain(spark, sf_dir):
    return built(spark, sf_dir).select("chain_id", "seq", "id", "prev_hash", "mac")


# A planted fault per chain, chosen by the chain's name: edited content, a lost record, a forged
# MAC, a re-linked record, a repeated number, a broken MAC shape, or none.
_FAULT = "length(replace(replace(replace(chain_id, '1', ''), '3', ''), '0', ''))"
_TAMPERED = f"""SELECT chain_id, action, db_alias, decision, denial_reason, id, project, role, ts_ms, user_id, hash_, prev_hash,
  CASE WHEN f = 14 AND seq = 5 THEN 'edited' ELSE outcome END AS outcome,
  CASE WHEN f = 13 AND seq = 7 THEN 6 ELSE seq END AS seq,
  CASE WHEN f = 12 AND seq = 9 THEN replace(mac, 'a', 'b') WHEN f = 11 AND seq = 4 THEN 'none' ELSE mac END AS mac, place
FROM (SELECT *, mac AS hash_, seq AS place, {_FAULT} AS f FROM [chained]) t WHERE NOT (f = 15 AND seq = 6)"""


def tampered(spark, chained):
    rows = spark.sql(_TAMPERED.replace("[chained]", "{chained}"), chained=chained)
    return rows.withColumn("hash", F.when(F.col("mac") == F.col("hash_"), F.col("hash_")).otherwise(F.col("mac"))).drop("hash_")


_STEPS_SQL = f"""p AS (SELECT *, lag(seq) OVER w AS pseq, lag(mac) OVER w AS pmac, row_number() OVER w AS pos, {_mac("t", "t.prev_hash")} AS want
  FROM t WINDOW w AS (PARTITION BY chain_id ORDER BY place)),
s AS (SELECT *, CASE WHEN pos = 1 AND seq > 1 THEN 'seq_gap' WHEN pos = 1 AND prev_hash <> {_GENESIS} THEN 'prev_hash_mismatch'
  WHEN seq = pseq THEN 'seq_duplicate' WHEN seq < pseq THEN 'seq_regression' WHEN seq > pseq + 1 THEN 'seq_gap'
  WHEN prev_hash <> pmac THEN 'prev_hash_mismatch' WHEN length(mac) <> 64 THEN 'malformed' WHEN mac <> want THEN 'mac_mismatch' END AS why FROM p),
g AS (SELECT chain_id, arg_min(why, pos) FILTER (why IS NOT NULL) AS why, min(pos) FILTER (why IS NOT NULL) AS at_,
  arg_min(seq, pos) FILTER (why IS NOT NULL) AS bseq, count(*) AS n, max(seq) AS top, arg_max(mac, pos) AS top_mac FROM s GROUP BY 1)"""


@query(
    "verify_chain",
    f"""{chain_sql()}, t AS ({_TAMPERED.replace("[chained]", "c")}), {_STEPS_SQL},
a AS (SELECT chain_id, max(seq) AS aseq, arg_max(mac, seq) AS amac FROM c GROUP BY 1)
SELECT chain_id, coalesce(why, CASE WHEN aseq > top THEN 'seq_regression' WHEN aseq < top OR amac <> top_mac THEN 'head_mismatch' END) AS reason,
  at_ - 1 AS broken_at, bseq AS broken_seq, coalesce(at_, n) AS events FROM g JOIN a USING (chain_id)""",
)
def verify_chain(spark, sf_dir):
    clean = stored(spark, sf_dir)
    damaged = tampered(spark, clean)
    claims = chain.heads(clean).selectExpr(
        "chain_id", "chain_id AS anchor_chain_id", "seq AS anchor_seq", "last_hash AS anchor_hash"
    )
    damaged = damaged.withColumn("part", F.floor(F.col("place") / 16))
    found = chain.verify_chain(damaged, KEY, RECORD, order=["place"], block="part", anchors=claims)
    return found.select("chain_id", "reason", "broken_at", "broken_seq", "events")


@query(
    "verify_chain_by_join",
    f"""{chain_sql()}, t AS ({_TAMPERED.replace("[chained]", "c")}), {_STEPS_SQL}
SELECT chain_id, why IS NULL AS intact, why AS reason, bseq AS broken_seq FROM g""",
)
def verify_chain_by_join(spark, sf_dir):
    """The same damaged log as ``verify_chain``, in sequence order."""
    return chain.verify_by_join(tampered(spark, stored(spark, sf_dir)), KEY, RECORD)


@query(
    "chain_coverage",
    f"""{chain_sql()} SELECT chain_id, min(CASE WHEN k % 37 <> 0 THEN seq END) AS from_seq, max(CASE WHEN k % 37 <> 0 THEN seq END) AS to_seq,
  count(*) FILTER (k % 41 <> 0) AS records, count(*) FILTER (k % 41 = 0) AS malformed_lines,
  bool_or(k % 37 = 0 AND k % 41 <> 0) AS legacy FROM c GROUP BY 1""",
)
def chain_coverage(spark, sf_dir):
    rows = stored(spark, sf_dir).withColumns(
        {"malformed": F.expr("k % 41 = 0"), "seq": F.expr("CASE WHEN k % 37 <> 0 THEN seq END")}
    )
    return aggregates.chain_coverage(rows)


_ANCHOR_CLAIMS = """SELECT shard AS log_id, 1 + k % 3 AS ord, CASE WHEN k % 29 = 0 THEN concat(shard, '!') ELSE shard END AS chain_id,
  CAST(floor(seq_id / 200) AS BIGINT) AS seq, concat('h', CAST(k % 2 AS VARCHAR(4)), CAST(CAST(floor(seq_id / 200) AS BIGINT) AS VARCHAR(20))) AS last_hash,
  CASE WHEN k % 9 = 0 THEN 1 + CAST(k AS BIGINT) END AS retained_from_seq, seq_id FROM [log]"""


@query(
    "resolve_anchor",
    f"""{with_views("request_log")}, log AS ({_LOG.replace("[request_log]", "request_log")}),
c AS (SELECT *, ord * 1000000 + seq_id AS o FROM ({_ANCHOR_CLAIMS.replace("[log]", "log")}) x)
SELECT log_id, max(seq) AS anchor_seq, arg_max(last_hash, seq * 10000000 + (9999999 - o)) AS anchor_hash,
  arg_max(chain_id, seq * 10000000 + (9999999 - o)) AS anchor_chain_id,
  arg_min(retained_from_seq, o) FILTER (retained_from_seq IS NOT NULL) AS retained_from_seq,
  (SELECT bool_or(n > 1) FROM (SELECT count(DISTINCT chain_id || ' ' || last_hash) AS n FROM c d WHERE d.log_id = c.log_id GROUP BY seq) q) AS conflict
FROM c GROUP BY log_id""",
)
def resolve_anchor(spark, sf_dir):
    claims = spark.sql(_ANCHOR_CLAIMS.replace("[log]", "{log}"), log=log(spark, sf_dir))
    claims = claims.withColumn("o", F.col("ord") * 1_000_000 + F.col("seq_id"))
    return chain.resolve_anchor(claims, ord_column="o")


SEGMENT_ROWS = 500


@query(
    "segments",
    f"""{chain_sql()}, s AS (SELECT *, CAST(seq_id // {SEGMENT_ROWS} AS BIGINT) AS file_ord FROM c)
SELECT file_ord, count(*) FILTER (k % 23 <> 0) AS records, count(*) FILTER (k % 23 = 0) AS malformed_lines,
  min(seq_id) FILTER (k % 23 <> 0) AS first_id, max(seq_id) FILTER (k % 23 <> 0) AS last_id,
  (SELECT min(seq_id) + 1 FROM s) AS retained_from_seq
FROM s GROUP BY file_ord""",
)
def segments_round_trip(spark, sf_dir):
    """Write the whole chained log in segments, damage some lines, and read the folder back."""
    rows = stored(spark, sf_dir).withColumn("position", F.col("seq_id") + 1)
    line = F.to_json(F.struct(*sorted([*RECORD, "chain_id", "seq", "prev_hash", "mac", "hash"])))
    broken = (
        F.when(F.col("k") % 46 == 23, F.expr("left(_line, char_length(_line) - 3)"))
        .when(F.col("k") % 23 == 0, F.lit('["not", "an object"]'))
        .otherwise(F.col("_line"))
    )
    rows = rows.withColumn("_line", line).withColumn("_line", broken)
    path = scratch_dir(spark, "segments")
    floor = segments.write_segments(rows, path, [], SEGMENT_ROWS, seq="position", raw="_line")
    number = F.regexp_replace("id", "^r", "").cast("bigint")
    read = segments.read_segments(spark, path).withColumn("n", number)
    return read.groupBy("file_ord").agg(
        F.count_if(~F.col("malformed")).alias("records"),
        F.count_if("malformed").alias("malformed_lines"),
        F.min("n").alias("first_id"),
        F.max("n").alias("last_id"),
    ).withColumn("retained_from_seq", floor.select("retained_from_seq").scalar())


_INCREMENTAL_RECORD = ["action", "id", "outcome", "user_id"]
_LOG_SEGMENTS = 1_000_000
#: about half of a log, in the middle of a segment
_HALF_SQL = f"CASE WHEN max(seq) < 600 THEN floor(max(seq) / 2) ELSE floor(floor(max(seq) / 2) / {SEGMENT_ROWS}) * {SEGMENT_ROWS} + {SEGMENT_ROWS // 2} END"


def _numbered_log(spark, sf_dir):
    """Five logs, one a database, each a chain of its own; the position puts their segments apart."""
    rows = chain.build_chain(log(spark, sf_dir), KEY, "db_alias", "minute", ["ts_ms", "seq_id"], _INCREMENTAL_RECORD, None)
    path = scratch_dir(spark, "logs")
    database = F.substring("db_alias", 3, 1).cast("bigint")
    line = F.to_json(F.struct(*sorted([*_INCREMENTAL_RECORD, "chain_id", "seq", "prev_hash", "mac", "hash"])))
    rows.select("db_alias", "seq", (database * _LOG_SEGMENTS * SEGMENT_ROWS + F.col("seq")).alias("position"), line.alias("line")).write.parquet(path)
    return spark.read.parquet(path)


def _apart_from_whole_seconds(spark, rows, path):
    """Writes ``rows``; a segment whose time falls on a whole second is never trusted, so it is written again."""
    while True:
        segments.write_segments(rows, path, [], SEGMENT_ROWS, seq="position", raw="line")
        whole = segments.manifest(spark, path, "").where("mtime_ns % 1000000000 = 0").select(segments.file_order(F.col("path")).alias("segment"))
        again = cut_lineage(rows.join(whole, F.floor((F.col("position") - 1) / SEGMENT_ROWS) == F.col("segment"), "left_semi"), "again")
        if again.isEmpty():
            return
        rows = again


@query(
    "verify_incrementally",
    f"""{with_views("request_log")}, n AS (SELECT db_alias, CAST(substring(db_alias, 3, 1) AS BIGINT) AS d, row_number() OVER (PARTITION BY db_alias ORDER BY ts_ms, seq_id) AS seq FROM request_log),
t AS (SELECT d, {_HALF_SQL.replace('floor', '').replace('/', '//')} AS half FROM n GROUP BY d),
s AS (SELECT d, seq, d * {_LOG_SEGMENTS} + (seq - 1) // {SEGMENT_ROWS} AS file_ord, half FROM n JOIN t USING (d)),
g AS (SELECT file_ord, any_value(d) AS d, count(*) AS records, min(seq) AS low, max(seq) AS high, any_value(half) AS half FROM s GROUP BY 1)
SELECT file_ord, records, NOT (d = 0 AND low <= 7 OR d = 1 AND low <= half AND high >= half) AS intact,
  CASE WHEN d = 0 AND low <= 7 THEN 'mac_mismatch' WHEN d = 1 AND low <= half AND high >= half THEN 'seq_gap' END AS reason,
  CASE WHEN d = 0 AND low <= 7 THEN 7 WHEN d = 1 AND low <= half AND high >= half THEN half + 1 END AS broken_seq,
  (d = 0 AND low <= 7) OR (d = 1 AND low <= half AND high >= half) OR (d = 2 AND high > half) AS read
FROM (SELECT file_ord, d, low, high, half, records - CASE WHEN d = 1 AND low <= half AND high >= half THEN 1 ELSE 0 END AS records FROM g) x""",
)
def verify_incrementally(spark, sf_dir):
    """Verify written logs, change some of their segments, and verify again with what is known.

    Of the first log a record is edited, of the second one is lost, the third has grown by its second half. Only the segments that this touches are read again.
    """
    rows = _numbered_log(spark, sf_dir)
    half = rows.groupBy("db_alias").agg(F.expr(f"{_HALF_SQL} AS half"))
    rows = rows.join(F.broadcast(half), "db_alias")
    path, store = scratch_dir(spark, "logs"), scratch_dir(spark, "verdicts")
    _apart_from_whole_seconds(spark, rows.where("db_alias <> 'db2' or seq <= half"), path)
    verdicts.verify_incrementally(spark, path, store, KEY)
    segment = F.floor((F.col("seq") - 1) / SEGMENT_ROWS)
    touched = (
        ((F.col("db_alias") == "db0") & (segment == 0)) | ((F.col("db_alias") == "db1") & (segment == F.floor((F.col("half") - 1) / SEGMENT_ROWS)))
        | ((F.col("db_alias") == "db2") & (segment >= F.floor(F.col("half") / SEGMENT_ROWS)))
    )
    edited = F.when((F.col("db_alias") == "db0") & (F.col("seq") == 7), F.regexp_replace("line", '"outcome":"', '"outcome":"not ')).otherwise(F.col("line"))
    changed = rows.where(touched & ~((F.col("db_alias") == "db1") & (F.col("seq") == F.col("half")))).withColumn("line", edited)
    _apart_from_whole_seconds(spark, changed, path)
    found = verdicts.verify_incrementally(spark, path, store, KEY)
    return found.select("file_ord", "records", "intact", "reason", "broken_seq", "read")


_MANIFEST = """SELECT concat('audit/', shard, '/', CAST(hour AS VARCHAR(20))) AS path, CAST(count(*) AS BIGINT) AS records,
  CAST(sum(k) AS BIGINT) AS length, max(ts_ms) * 1000000 + max(k) % 3 AS mtime_ns, max(ts_ms) * 1000000 + 7 AS ctime_ns,
  CAST(min(seq_id) AS BIGINT) AS first_seq, concat('h', CAST(min(seq_id) AS VARCHAR(20))) AS first_prev_hash, shard AS chain_id,
  'key1' AS key_fingerprint, CAST(max(k) AS INT) AS top FROM [log] GROUP BY shard, hour"""
_EARLIER = """SELECT concat(path, CASE WHEN top % 31 = 0 THEN '.gone' ELSE '' END) AS path, CASE WHEN top % 7 = 0 THEN 0 ELSE records END AS records,
  CASE WHEN top % 11 = 0 THEN length + 1 ELSE length END AS length,
  CASE WHEN top % 13 = 0 THEN mtime_ns - mtime_ns % 1000000000 ELSE mtime_ns END AS mtime_ns, ctime_ns,
  CASE WHEN top % 17 = 0 THEN first_seq + 1 ELSE first_seq END AS first_seq, first_prev_hash, chain_id,
  CASE WHEN top % 19 = 0 THEN 'key0' ELSE key_fingerprint END AS key_fingerprint FROM [current]"""


@query(
    "changed_segments",
    f"""{with_views("request_log")}, log AS ({_LOG.replace("[request_log]", "request_log")}),
cur AS ({_MANIFEST.replace("[log]", "log")}), old AS ({_EARLIER.replace("[current]", "cur")})
SELECT 'read again' AS what, path FROM cur WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.path = cur.path AND old.records > 0
  AND old.length = cur.length AND old.mtime_ns = cur.mtime_ns AND old.ctime_ns = cur.ctime_ns AND old.first_seq = cur.first_seq
  AND old.first_prev_hash = cur.first_prev_hash AND old.chain_id = cur.chain_id AND old.key_fingerprint = cur.key_fingerprint
  AND old.mtime_ns % 1000000000 <> 0 AND old.ctime_ns % 1000000000 <> 0)
UNION ALL SELECT 'kept' AS what, path FROM old WHERE path IN (SELECT path FROM cur)""",
)
def changed_segments(spark, sf_dir):
    current = spark.sql(_MANIFEST.replace("[log]", "{log}"), log=log(spark, sf_dir))
    earlier = spark.sql(_EARLIER.replace("[current]", "{current}"), current=current)
    again = segments.changed_segments(current, earlier).select(F.lit("read again").alias("what"), "path")
    kept = segments.prune_manifest(earlier, current).select(F.lit("kept").alias("what"), "path")
    return again.unionByName(kept)


#: stored lines as another writer might lay them out: keys in any order, blanks, nested fields that are named like the MAC
_STORED_LINES = """SELECT seq_id, concat('p', CAST(k AS VARCHAR(4))) AS prev_hash, concat('{"user": "u', CAST(user_id AS VARCHAR(20)), '", "seq":', CAST(seq_id AS VARCHAR(20)),
  ',"mac":"old","x":{"mac":"', action, '","b":[1, ', CAST(k AS VARCHAR(4)), ',null,"\u00e9"],"a":{"z":', CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END, ',"hash":"', outcome,
  '"}}, "hash":"old","action":"', action, '","prev_hash":"p', CAST(k AS VARCHAR(4)), '"}') AS raw, user_id, k, action, outcome FROM [request_log]"""
define_view("stored_lines", _STORED_LINES, ("request_log",))
_STORED_CANONICAL = """'{"action":"' || action || '","prev_hash":"' || prev_hash || '","seq":' || seq_id || ',"user":"u' || user_id || '","x":{"a":{"hash":"' || outcome ||
  '","z":' || CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END || '},"b":[1,' || k || ',null,"é"],"mac":"' || action || '"}}' || prev_hash"""


@query(
    "stored_line_macs",
    f"""{with_views("stored_lines")} SELECT seq_id, {hmac_sql(f"({_STORED_CANONICAL})")} AS mac FROM stored_lines""",
)
def stored_line_macs(spark, sf_dir):
    """The MAC that each stored line should carry, from the line itself."""
    return view(spark, sf_dir, "stored_lines").select("seq_id", chain.line_mac("raw", KEY).alias("mac"))
