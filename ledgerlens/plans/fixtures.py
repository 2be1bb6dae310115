"""Derived tables, each one SQL text that Spark and the oracle engine both run.

The driver tables carry no request log, so every registered query starts from one of these
views. A view reads whole driver tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.session import join_tasks, read_table, spread

#: epoch milliseconds of a zone-less timestamp, per engine
MILLIS = {
    "spark": "timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)",
    "oracle": "(epoch_us(ts) // 1000)",
}

REQUEST_LOG = """
SELECT event_id AS seq_id, ts, [ms] AS ts_ms, user_id,
  concat('agent', CAST(user_id % 7 AS VARCHAR(4))) AS agent_id,
  concat('db', CAST(user_id % 5 AS VARCHAR(4))) AS db_alias,
  concat('proj', CAST(user_id % 3 AS VARCHAR(4))) AS project,
  CASE event_type WHEN 'view' THEN 'query' WHEN 'click' THEN 'stream_query'
       WHEN 'purchase' THEN 'migration_run' WHEN 'signup' THEN 'introspect' ELSE 'cancel' END AS action,
  CASE WHEN k % 10 = 0 THEN 'deny' ELSE 'allow' END AS decision,
  CASE WHEN k % 10 = 0 THEN 'n/a' WHEN event_type = 'error' THEN 'error'
       WHEN k % 17 = 0 THEN 'cancelled' ELSE 'success' END AS outcome,
  CASE WHEN k % 20 = 0 THEN 'buffer_overflow' WHEN k % 10 = 0 THEN 'role_denied' END AS denial_reason,
  CASE user_id % 4 WHEN 0 THEN 'admin' WHEN 1 THEN 'developer' WHEN 2 THEN 'data_reader' ELSE 'viewer' END AS role,
  CAST(floor(value * 10) AS BIGINT) AS duration_ms, k,
  concat('SELECT * FROM t', CAST(k % 7 AS VARCHAR(4)), ' WHERE user_id = ', CAST(user_id AS VARCHAR(20)),
         ' AND note = ''', event_type, ' #', CAST(k AS VARCHAR(4)), '''') AS sql_text
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM [events]) e
"""

#: sixteen statement shapes, eight statements to a plan
STATEMENTS = """
SELECT seq_id AS stmt_id, CAST(floor(seq_id / 8) AS BIGINT) AS plan_id, CAST(seq_id % 8 AS INT) AS idx,
  user_id, duration_ms, k, CASE k % 16
  WHEN 0 THEN concat('SELECT * FROM t', n, ' WHERE user_id = ', u, ' AND note = ''row #', n, '''')
  WHEN 1 THEN concat('select name, count(*) from app.users where id in (1, 22, ', u, ') group by name -- by ', n)
  WHEN 2 THEN concat('INSERT INTO t', n, ' (a, b) VALUES (', u, ', E''it', chr(92), '''s'')')
  WHEN 3 THEN concat('UPDATE "Orders" SET total = 12.5e3 WHERE id = ', u, ';')
  WHEN 4 THEN concat('DELETE FROM t', n, ' WHERE label = U&''x', u, '''')
  WHEN 5 THEN concat('CREATE INDEX CONCURRENTLY idx_', n, ' ON t5 (a)')
  WHEN 6 THEN concat('ALTER TABLE t', n, ' SET TABLESPACE fast')
  WHEN 7 THEN concat('EXPLAIN ANALYZE SELECT pg_sleep(', u, ')')
  WHEN 8 THEN concat('SELECT * INTO copy_t FROM t', n)
  WHEN 9 THEN concat('SELECT * FROM t', n, '  WHERE id = ', u, ' FOR UPDATE')
  WHEN 10 THEN concat('WITH d AS (DELETE FROM t', n, ' RETURNING *) SELECT * FROM d')
  WHEN 11 THEN concat('SELECT ', n, '; DROP TABLE t', n)
  WHEN 12 THEN concat('/* note ', n, ' */ VACUUM FULL t', n)
  WHEN 13 THEN concat('SELECT $q$body ''x'' ', u, '$q$, $1')
  WHEN 14 THEN concat('SELECT ''open ', u)
  ELSE concat('SET statement_timeout = ', u) END AS sql
FROM (SELECT *, CAST(k AS VARCHAR(4)) AS n, CAST(user_id AS VARCHAR(20)) AS u FROM [request_log]) r
"""

RELATIONS = """
SELECT CASE WHEN o_custkey % 50 = 0 THEN 'pgx_tmp' WHEN o_custkey % 51 = 0 THEN 'information_schema'
       ELSE concat('app', CAST(o_custkey % 10 AS VARCHAR(4))) END AS table_schema,
  concat('t', CAST(o_orderkey AS VARCHAR(20))) AS table_name,
  CASE o_orderstatus WHEN 'O' THEN 'BASE TABLE' WHEN 'F' THEN 'VIEW' END AS table_type,
  concat('owner', CAST(o_custkey % 7 AS VARCHAR(4))) AS owner,
  CASE WHEN o_custkey % 3 = 0 THEN concat('about ', o_orderpriority) END AS note,
  o_orderkey, o_custkey
FROM [orders]
"""

RELATION_COLUMNS = """
SELECT r.table_schema, r.table_name, r.o_orderkey,
  concat('c', CAST(l_linenumber AS VARCHAR(4)), '_', CAST(l_partkey AS VARCHAR(20)), '_', CAST(l_suppkey AS VARCHAR(20)))
    AS column_name,
  l_linenumber AS ordinal, CASE l_returnflag WHEN 'A' THEN 'int8' WHEN 'R' THEN 'text' ELSE 'numeric' END AS data_type,
  CASE l_linestatus WHEN 'O' THEN 'YES' ELSE 'NO' END AS is_nullable,
  CASE WHEN l_suppkey % 4 = 0 THEN concat('nextval(', CAST(l_partkey AS VARCHAR(20)), ')') END AS column_default
FROM [lineitem] JOIN [relations] r ON l_orderkey = r.o_orderkey
"""

#: view name -> (text, the tables and views it reads)
VIEWS = {
    "request_log": (REQUEST_LOG, ("events",)),
    "statements": (STATEMENTS, ("request_log",)),
    "relations": (RELATIONS, ("orders",)),
    "relation_columns": (RELATION_COLUMNS, ("lineitem", "relations")),
}


#: views that join or group large tables: their sources with the keys they are dealt by
SPREAD = {
    "relation_columns": {"lineitem": ("l_orderkey",), "relations": ("o_orderkey",)},
    "key_usage": {"relation_columns": ("table_schema", "table_name")},
}


def column_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions for joins over all columns; their number is in the footers of the table."""
    return join_tasks(spark, read_table(spark, sf_dir, "lineitem").count())


def define_view(name: str, text: str, reads: tuple[str, ...]) -> None:
    VIEWS[name] = (text, reads)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Spark form of a view, or a driver table when ``name`` is none."""
    if name not in VIEWS:
        return read_table(spark, sf_dir, name)
    text, reads = VIEWS[name]
    sources = {source: view(spark, sf_dir, source) for source in reads}
    if name in SPREAD:
        tasks = column_tasks(spark, sf_dir)
        sources |= {source: spread(sources[source], tasks, *keys) for source, keys in SPREAD[name].items()}
    text = text.replace("[ms]", MILLIS["spark"])
    text = text.replace("{", "{{").replace("}", "}}")
    for source in reads:
        text = text.replace(f"[{source}]", f"{{{source}}}")
    return spark.sql(text, **sources)


def _closure(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name in VIEWS and name not in seen:
            _closure(VIEWS[name][1], seen)
            seen.append(name)
    return seen


def with_views(*names: str, recursive: bool = False) -> str:
    """``WITH ...`` text defining the views (and what they read) for the oracle."""
    parts = []
    for name in _closure(names, []):
        text = VIEWS[name][0].replace("[ms]", MILLIS["oracle"])
        for source in VIEWS[name][1]:
            text = text.replace(f"[{source}]", source)
        parts.append(f"{name} AS ({text})")
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts)
