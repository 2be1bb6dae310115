"""Filters, pages and roll-ups of the request log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators import aggregates, filters, pages, text_jobs
from ledgerlens.plans.fixtures import view, with_views
from ledgerlens.plans.registry import query
from ledgerlens.session import cut_lineage, read_table

NOW = dt.datetime(2024, 1, 31)
NOW_MS = 1706659200000

#: the preview and fingerprint input of the plain statements of request_log, for the oracle
PREVIEW_SQL = (
    "regexp_replace(regexp_replace(sql_text, '''[^'']*''', '''?''', 'g'), '= [0-9]+', '= ?', 'g')"
)
AUDIT_SQL = f"""
{with_views("request_log")},
audit AS (SELECT *, {PREVIEW_SQL} AS statement_preview,
  substring(sha256(lower({PREVIEW_SQL})), 1, 16) AS statement_fingerprint,
  CASE WHEN outcome = 'error' THEN 'XX000' END AS error_code FROM request_log)
"""


def audit(spark, sf_dir):
    """request_log with the redacted statement columns of an audit record."""
    log = view(spark, sf_dir, "request_log").withColumn("error_code", F.when(F.col("outcome") == "error", "XX000"))
    log = text_jobs.preview_statements(log, "sql_text", "statement_preview")
    return text_jobs.fingerprint_statements(log, "sql_text", "statement_fingerprint")


@query(
    "service_counters",
    f"""{with_views("request_log")}
SELECT CAST(ts AS DATE) AS day,
  count(*) FILTER (decision = 'allow' AND outcome <> 'n/a' AND action = 'query') AS queries_served,
  count(*) FILTER (decision = 'allow' AND outcome <> 'n/a' AND action = 'stream_query') AS streams_served,
  count(*) FILTER (decision = 'allow' AND outcome <> 'n/a' AND action = 'migration_run') AS migrations_run,
  count(*) FILTER (decision = 'allow' AND outcome <> 'n/a' AND action = 'cancel') AS cancellations,
  count(*) FILTER (decision = 'deny' AND coalesce(denial_reason, '') = 'buffer_overflow') AS buffer_overflows,
  count(*) FILTER (decision = 'deny' AND coalesce(denial_reason, '') <> 'buffer_overflow') AS permission_denies
FROM request_log GROUP BY 1""",
)
def service_counters(spark, sf_dir):
    log = view(spark, sf_dir, "request_log")
    return aggregates.service_counters(log, [F.to_date("ts").alias("day")])


@query(
    "audit_filter",
    f"""{AUDIT_SQL}
SELECT seq_id, project, user_id, action, decision, outcome, statement_fingerprint FROM audit
WHERE lower(project) = 'proj1' AND contains(CAST(user_id AS VARCHAR), '1') AND lower(decision) = 'allow'
  AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'
  AND contains(lower(concat_ws(' ', statement_preview, project, CAST(user_id AS VARCHAR), action, decision,
    outcome, coalesce(error_code, ''), coalesce(denial_reason, ''), statement_fingerprint)), 'from t3 where')""",
)
def audit_filter(spark, sf_dir):
    found = filters.audit_filter(
        audit(spark, sf_dir), project="PROJ1", user="1", decision="Allow", search=" from T3 where ",
        since=dt.datetime(2024, 1, 5), until=dt.datetime(2024, 1, 20, 12),
    )
    return found.select("seq_id", "project", "user_id", "action", "decision", "outcome", "statement_fingerprint")


_SINCE_TEXT = """CASE k % 8 WHEN 0 THEN 'today' WHEN 1 THEN concat(CAST(k AS VARCHAR(4)), 's')
  WHEN 2 THEN concat(CAST(k AS VARCHAR(4)), ' Mins') WHEN 3 THEN concat(' ', CAST(k AS VARCHAR(4)), 'hr ')
  WHEN 4 THEN concat(CAST(k AS VARCHAR(4)), 'days') WHEN 5 THEN concat(CAST(k AS VARCHAR(4)), 'w')
  WHEN 6 THEN '2024-01-09 10:11:12' ELSE concat(CAST(k AS VARCHAR(4)), ' moons') END"""


@query(
    "since_bound",
    f"""{with_views("request_log")},
texts AS (SELECT seq_id, ts_ms, {_SINCE_TEXT} AS since FROM request_log),
parts AS (SELECT *, lower(trim(since)) AS s, TRY_CAST(regexp_extract(lower(trim(since)), '^([0-9]+)', 1) AS BIGINT) AS n,
  regexp_extract(lower(trim(since)), '^[0-9]+\\s*(s|sec|m|min|h|hr|d|day|w|week)s?$', 1) AS u FROM texts)
SELECT seq_id, since, CASE WHEN s = 'today' THEN ts_ms - ts_ms % 86400000
  WHEN u <> '' THEN ts_ms - n * 1000 * CASE substring(u, 1, 1) WHEN 's' THEN 1 WHEN 'm' THEN 60 WHEN 'h' THEN 3600
    WHEN 'd' THEN 86400 ELSE 604800 END
  ELSE epoch_ms(TRY_CAST(trim(since) AS TIMESTAMP)) END AS bound_ms FROM parts""",
)
def since_bound(spark, sf_dir):
    texts = view(spark, sf_dir, "request_log").select("seq_id", "ts_ms", F.expr(_SINCE_TEXT).alias("since"))
    return texts.select("seq_id", "since", filters.since_bound_ms("since", "ts_ms").alias("bound_ms"))


@query(
    "audit_query",
    f"""{with_views("request_log")},
m AS (SELECT seq_id, user_id, outcome FROM request_log WHERE action = 'query' AND decision = 'allow'
  AND ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts < TIMESTAMP '2024-01-28 00:00:00')
SELECT *, (SELECT count(*) FROM m) AS total FROM m ORDER BY seq_id LIMIT 100""",
)
def audit_query(spark, sf_dir):
    log = view(spark, sf_dir, "request_log")
    page = filters.audit_query(
        log, {"action": "query", "decision": "allow"}, ["seq_id"],
        since=dt.datetime(2024, 1, 3), until=dt.datetime(2024, 1, 28),
    )
    return page.select("seq_id", "user_id", "outcome", "total")


@query(
    "audit_report",
    f"""{AUDIT_SQL},
aged AS (SELECT *, greatest(0, ({NOW_MS} - ts_ms) // 1000) AS s FROM audit)
SELECT seq_id, strftime(epoch_ms(ts_ms), '%m-%d %H:%M:%S') AS when_text,
  CASE WHEN s < 5 THEN 'now' WHEN s < 60 THEN concat(s, 's') WHEN s < 3600 THEN concat(s // 60, 'm')
    WHEN s < 86400 THEN concat(s // 3600, 'h') ELSE concat(s // 86400, 'd') END AS age,
  CASE WHEN decision = 'deny' THEN '-' ELSE concat(duration_ms, 'ms') END AS duration_text,
  statement_preview AS preview_text
FROM aged""",
)
def audit_report(spark, sf_dir):
    log = audit(spark, sf_dir).withColumn("duration_ms", F.expr("CASE WHEN decision <> 'deny' THEN duration_ms END"))
    return filters.audit_report(log, NOW_MS).select("seq_id", "when_text", "age", "duration_text", "preview_text")


@query(
    "label_mismatches",
    f"""{with_views("request_log")},
labelled AS (SELECT seq_id, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 11 = 0 THEN 'db9' ELSE db_alias END AS asserted,
  CASE WHEN decision = 'deny' THEN 'unresolved' ELSE db_alias END AS resolved FROM request_log)
SELECT seq_id, asserted, resolved FROM labelled WHERE asserted IS DISTINCT FROM resolved""",
)
def label_mismatches(spark, sf_dir):
    labelled = view(spark, sf_dir, "request_log").selectExpr(
        "seq_id",
        "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 11 = 0 THEN 'db9' ELSE db_alias END AS asserted",
        "CASE WHEN decision = 'deny' THEN 'unresolved' ELSE db_alias END AS resolved",
    )
    return filters.label_mismatches(labelled, "asserted", "resolved")


@query(
    "keyset_page",
    """WITH page AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey < 9000
  ORDER BY o_orderkey DESC LIMIT 51),
sent AS (SELECT * FROM page ORDER BY o_orderkey DESC LIMIT 50)
SELECT *, (SELECT count(*) > 50 FROM page) AS has_more,
  CASE WHEN (SELECT count(*) > 50 FROM page) THEN (SELECT min(o_orderkey) FROM sent) END AS next_value FROM sent""",
)
def keyset_page(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return pages.keyset_page(orders, pages.Cursor("o_orderkey", 9000, "backward"))


@query(
    "recent",
    f"""{with_views("request_log")}
SELECT seq_id, ts_ms, action, outcome FROM request_log WHERE outcome = 'error' ORDER BY ts_ms DESC, seq_id DESC LIMIT 50""",
)
def recent(spark, sf_dir):
    log = view(spark, sf_dir, "request_log").where("outcome = 'error'")
    newest = pages.recent(log, [F.col("ts_ms").desc(), F.col("seq_id").desc()])
    return newest.select("seq_id", "ts_ms", "action", "outcome")


@query(
    "capped",
    f"""{with_views("request_log")}
SELECT db_alias, role, count(*) AS requests FROM request_log GROUP BY 1, 2""",
)
def capped(spark, sf_dir):
    per_role = view(spark, sf_dir, "request_log").groupBy("db_alias", "role").agg(F.count(F.lit(1)).alias("requests"))
    return pages.capped(per_role)


@query(
    "tail_n",
    """SELECT conv_id, turn, role FROM (SELECT conv_id, turn, role FROM conversations
ORDER BY conv_id DESC, turn DESC LIMIT 40) t""",
)
def tail_n(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return pages.tail_n(turns, ["conv_id", "turn"], 40)


@query(
    "error_log_stats",
    f"""{with_views("request_log")},
lines AS (SELECT CAST(floor((ts_ms - 1704067200000) / 604800000) AS BIGINT) AS file_ord, seq_id AS line_no,
  CASE WHEN k % 19 = 0 THEN '' ELSE concat('{{"ts":"', ts_ms, '","op":"', action, '"}}') END AS raw, ts_ms, k
  FROM request_log WHERE outcome = 'error'),
f AS (SELECT file_ord, CAST(sum(strlen(raw) + 1) AS BIGINT) AS size_bytes, count(*) FILTER (raw <> '') AS records,
  max_by(CAST(ts_ms AS VARCHAR), line_no) FILTER (raw <> '') AS last_ts FROM lines GROUP BY 1)
SELECT CAST(sum(size_bytes) AS BIGINT) AS size_bytes, count(*) - 1 AS archives, max_by(records, file_ord) AS records,
  max_by(last_ts, file_ord) AS last_error_ts FROM f""",
)
def error_log_stats(spark, sf_dir):
    lines = (
        view(spark, sf_dir, "request_log")
        .where("outcome = 'error'")
        .selectExpr(
            "CAST(floor((ts_ms - 1704067200000) / 604800000) AS BIGINT) AS file_ord",
            "seq_id AS line_no",
            """CASE WHEN k % 19 = 0 THEN '' ELSE concat('{"ts":"', ts_ms, '","op":"', action, '"}') END AS raw""",
        )
    )
    return aggregates.error_log_stats(lines)


#: the value at the rounded-up share of the sorted durations
_PERCENTILES = ", ".join(
    f"list_sort(list(duration_ms) FILTER (duration_ms IS NOT NULL))[CAST(ceil(round({p} * count(duration_ms), 6)) AS BIGINT)] AS {n}" for n, p in aggregates.PERCENTILES.items()
)


@query(
    "statement_rollup",
    f"""{AUDIT_SQL}
SELECT statement_fingerprint AS fingerprint, count(*) AS calls, count(*) FILTER (outcome = 'error') AS errors,
  CAST(sum(duration_ms) AS BIGINT) AS total_ms, max(duration_ms) AS max_ms, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, {_PERCENTILES}
FROM audit GROUP BY 1""",
)
def statement_rollup(spark, sf_dir):
    return aggregates.statement_rollup(view(spark, sf_dir, "request_log"))


@query(
    "statement_rollup_merged",
    f"""{AUDIT_SQL}
SELECT CAST(ts_ms // 604800000 AS BIGINT) AS week, statement_fingerprint AS fingerprint, count(*) AS calls, count(*) FILTER (outcome = 'error') AS errors,
  CAST(sum(duration_ms) AS BIGINT) AS total_ms, max(duration_ms) AS max_ms, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms, {_PERCENTILES}
FROM audit GROUP BY 1, 2""",
)
def statement_rollup_merged(spark, sf_dir):
    """Weeks from a kept table of days, without the log."""
    log = view(spark, sf_dir, "request_log").withColumn("day", F.floor(F.col("ts_ms") / 86_400_000))
    days = cut_lineage(aggregates.statement_traffic(log, ["day"]), "days")
    # weeks begin with the day 0 of the epoch
    return aggregates.merge_traffic(days.withColumn("week", F.floor(F.col("day") / 7)), ["week"])


_VERDICTS = """SELECT plan_id, idx, CASE k % 5 WHEN 0 THEN 'read' WHEN 1 THEN 'write' WHEN 2 THEN 'utility' WHEN 3 THEN 'ddl'
    ELSE 'unknown' END AS type, concat('V', CAST(k % 9 AS VARCHAR(4))) AS verb, k % 11 <> 0 AS transactional,
  k % 7 <> 0 AS parse_ok, 1 + k % 2 AS statement_count, k FROM [statements]"""


@query(
    "worst_class",
    f"""{with_views("statements")}, v AS ({_VERDICTS.replace("[statements]", "statements")}),
r AS (SELECT *, CASE type WHEN 'read' THEN 0 WHEN 'utility' THEN 1 WHEN 'write' THEN 2 WHEN 'ddl' THEN 3 ELSE 4 END AS rank,
  CASE k % 3 WHEN 0 THEN ['side_effect', 'row_locking'] WHEN 1 THEN ['selects_into'] ELSE CAST([] AS VARCHAR[]) END AS rv,
  CASE k % 4 WHEN 0 THEN ['sequence'] ELSE CAST([] AS VARCHAR[]) END AS se FROM v)
SELECT plan_id, arg_min(type, (-rank) * 100 + idx) AS type, arg_min(verb, (-rank) * 100 + idx) AS verb,
  bool_and(transactional) AS transactional, bool_and(parse_ok) AS parse_ok,
  CAST(sum(statement_count) AS BIGINT) AS statement_count,
  array_to_string(list_sort(list_distinct(flatten(list(rv)))), ',') AS violations,
  array_to_string(list_sort(list_distinct(flatten(list(se)))), ',') AS effects
FROM r GROUP BY plan_id""",
)
def worst_class(spark, sf_dir):
    verdicts = spark.sql(
        _VERDICTS.replace("[statements]", "{statements}"), statements=view(spark, sf_dir, "statements")
    ).withColumns(
        {
            "read_violations": F.expr(
                "CASE k % 3 WHEN 0 THEN array('side_effect', 'row_locking') WHEN 1 THEN array('selects_into') "
                "ELSE CAST(array() AS array<string>) END"
            ),
            "side_effects": F.expr("CASE k % 4 WHEN 0 THEN array('sequence') ELSE CAST(array() AS array<string>) END"),
        }
    )
    worst = aggregates.worst_class(verdicts, ["plan_id"])
    return worst.select(
        "plan_id", "type", "verb", "transactional", "parse_ok", "statement_count",
        F.array_join("read_violations", ",").alias("violations"), F.array_join("side_effects", ",").alias("effects"),
    )


_PLAN_ROWS = """SELECT plan_id, idx, CASE WHEN plan_id % 2 = 0 THEN 'single_tx' ELSE 'per_statement' END AS strategy,
  CASE WHEN k % 12 = 0 THEN 'failed' ELSE 'success' END AS status, duration_ms AS ms,
  CASE WHEN k % 24 = 0 THEN '42P01' WHEN k % 12 = 0 THEN 'odd' END AS pg_error_code FROM [statements]"""


@query(
    "plan_outcome",
    f"""{with_views("statements")}, p AS ({_PLAN_ROWS.replace("[statements]", "statements")}),
g AS (SELECT plan_id, max(strategy) AS strategy, min(idx) FILTER (status = 'failed') AS failed_at,
  arg_min(coalesce(CASE WHEN length(pg_error_code) = 5 THEN pg_error_code END, ''), idx) FILTER (status = 'failed') AS code,
  count(*) FILTER (status = 'success') AS applied, CAST(sum(ms) AS BIGINT) AS total_ms FROM p GROUP BY 1)
SELECT plan_id, CASE WHEN failed_at IS NULL THEN 'committed' WHEN strategy = 'single_tx' THEN 'rolled_back' ELSE 'partial' END
  AS status, failed_at, nullif(code, '') AS error_code,
  CASE WHEN strategy = 'single_tx' AND failed_at > 0 THEN array_to_string(range(failed_at), ',') ELSE '' END AS rolled_back,
  applied, total_ms FROM g""",
)
def plan_outcome(spark, sf_dir):
    rows = spark.sql(_PLAN_ROWS.replace("[statements]", "{statements}"), statements=view(spark, sf_dir, "statements"))
    return aggregates.plan_outcome(rows).select(
        "plan_id", "status", "failed_at", "error_code",
        F.array_join(F.col("rolled_back_indices").cast("array<string>"), ",").alias("rolled_back"), "applied", "total_ms",
    )


@query(
    "parameterised_sql",
    """SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_orderkey >= 100 AND o_orderstatus = 'O' GROUP BY 1""",
)
def parameterised_sql(spark, sf_dir):
    """Bound parameters are Spark's own; the parser refuses a second statement."""
    return spark.sql(
        "SELECT o_orderpriority, count(*) AS orders FROM {orders} WHERE o_orderkey >= :lo AND o_orderstatus = :status GROUP BY 1",
        args={"lo": 100, "status": "O"}, orders=read_table(spark, sf_dir, "orders"),
    )
