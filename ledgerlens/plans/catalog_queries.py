"""Catalog, constraint, error and validity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.operators import catalog, errors, filters, validity
from ledgerlens.plans.fixtures import column_tasks, define_view, view, with_views
from ledgerlens.plans.registry import query
from ledgerlens.plans.text_queries import scrub_sql
from ledgerlens.session import read_table

_USER_SQL = "table_schema NOT LIKE 'pg_%' AND table_schema <> 'information_schema'"


@query("user_objects", f"{with_views('relations')} SELECT table_schema, table_name FROM relations WHERE {_USER_SQL}")
def user_objects(spark, sf_dir):
    return filters.user_objects(view(spark, sf_dir, "relations")).select("table_schema", "table_name")


@query(
    "mask_by_role",
    f"""{with_views('relation_columns')}, r AS (SELECT *, CASE ordinal % 3 WHEN 0 THEN 'viewer' WHEN 1 THEN 'developer' ELSE 'data_reader' END AS role FROM relation_columns)
SELECT table_name, column_name, role, CASE WHEN role = 'developer' THEN column_default END AS column_default,
  CASE WHEN role = 'developer' THEN data_type ELSE '' END AS data_type FROM r WHERE role = 'developer' OR NOT is_nullable = 'YES'""",
)
def mask_by_role(spark, sf_dir):
    columns = view(spark, sf_dir, "relation_columns").withColumn(
        "role", F.expr("CASE ordinal % 3 WHEN 0 THEN 'viewer' WHEN 1 THEN 'developer' ELSE 'data_reader' END")
    )
    masked = filters.mask_by_role(
        columns, "role", blank=["data_type"], null=["column_default"], only_full=F.col("is_nullable") == "YES"
    )
    return masked.select("table_name", "column_name", "role", "column_default", "data_type")


_MATVIEWS = """SELECT concat('app', CAST(c_nationkey % 10 AS VARCHAR(4))) AS table_schema, concat('mv', CAST(c_custkey AS VARCHAR(20))) AS table_name FROM [customer]"""
define_view("matviews", _MATVIEWS, ("customer",))


@query(
    "all_relations",
    f"""{with_views('relations', 'matviews')} SELECT table_schema, table_name, CASE WHEN table_type = 'VIEW' THEN 'view' ELSE 'table' END AS type, owner FROM relations
UNION ALL SELECT table_schema, table_name, 'materialized_view' AS type, NULL AS owner FROM matviews""",
)
def all_relations(spark, sf_dir):
    tables = view(spark, sf_dir, "relations").select("table_schema", "table_name", "table_type", "owner")
    return catalog.all_relations(tables, view(spark, sf_dir, "matviews"))


_INDEXES = """SELECT table_schema, table_name, concat('ix', CAST(ordinal AS VARCHAR(4)), '_', column_name, CASE WHEN ordinal = 1 THEN '_pkey' ELSE '' END) AS indexname,
  concat('CREATE ', CASE WHEN data_type = 'text' THEN 'UNIQUE ' ELSE '' END, 'INDEX ON ', table_name, ' USING btree (', column_name, ', "b")') AS indexdef
FROM [relation_columns] WHERE data_type <> 'int8'"""
define_view("relation_indexes", _INDEXES, ("relation_columns",))


@query(
    "assemble_snapshot",
    f"""{with_views('relation_indexes', 'relation_columns')},
c AS (SELECT table_schema, table_name, string_agg(column_name || ':' || data_type, ',' ORDER BY ordinal, column_name, data_type, is_nullable, coalesce(column_default, '')) AS columns,
  count(*) AS n FROM relation_columns GROUP BY ALL),
i AS (SELECT table_schema, table_name, string_agg(indexname || CASE WHEN contains(indexdef, 'UNIQUE') THEN '!' ELSE '' END || CASE WHEN indexname LIKE '%\\_pkey' ESCAPE '\\' THEN '*' ELSE '' END, ',' ORDER BY indexname, indexdef)
  AS indexes FROM relation_indexes GROUP BY ALL)
SELECT r.table_schema, r.table_name, coalesce(columns, '') AS columns, coalesce(n, 0) AS n_columns, coalesce(indexes, '') AS indexes,
  (SELECT count(*) FROM relations WHERE {_USER_SQL}) AS relations, (SELECT string_agg(DISTINCT table_schema, ',' ORDER BY table_schema) FROM relations WHERE {_USER_SQL}) AS schemas
FROM relations r LEFT JOIN c USING (table_schema, table_name) LEFT JOIN i USING (table_schema, table_name) WHERE {_USER_SQL}""",
)
def assemble_snapshot(spark, sf_dir):
    relations = filters.user_objects(view(spark, sf_dir, "relations")).select("table_schema", "table_name")
    snapshot = catalog.assemble_snapshot(
        relations, view(spark, sf_dir, "relation_columns"), view(spark, sf_dir, "relation_indexes")
    )
    size = catalog.snapshot_size(relations)
    columns = F.array_join(F.transform("columns", lambda c: F.concat(c["column_name"], F.lit(":"), c["data_type"])), ",")
    marks = F.transform(
        "indexes",
        lambda i: F.concat(i["indexname"], F.when(i["is_unique"], "!").otherwise(""), F.when(i["is_primary"], "*").otherwise("")),
    )
    return snapshot.select(
        "table_schema", "table_name", columns.alias("columns"), F.size("columns").cast("bigint").alias("n_columns"),
        F.array_join(marks, ",").alias("indexes"),
    ).withColumns(
        {"relations": size.select("relations").scalar(), "schemas": F.array_join(size.select("schemas").scalar(), ",")}
    )


_CHECKS = """SELECT table_schema, table_name, concat('ck_', column_name) AS constraint_name, concat(column_name, ' > ', CAST(ordinal AS VARCHAR(4))) AS check_clause
FROM [relation_columns] WHERE data_type = 'int8'"""
_TRIGGERS = """SELECT table_schema, table_name, concat('tr', CAST(ordinal AS VARCHAR(4))) AS trigger_name, CASE WHEN ordinal % 2 = 0 THEN 'INSERT' ELSE 'UPDATE' END AS event,
  'BEFORE' AS timing, concat('EXECUTE FUNCTION f_', column_name, '()') AS action_statement FROM [relation_columns] WHERE is_nullable = 'NO'"""
define_view("relation_checks", _CHECKS, ("relation_columns",))
define_view("relation_triggers", _TRIGGERS, ("relation_columns",))


@query(
    "snapshot_checks_and_triggers",
    f"""{with_views('relation_checks', 'relation_triggers')},
c AS (SELECT table_schema, table_name, string_agg(constraint_name || '=' || check_clause, ';' ORDER BY constraint_name, check_clause) AS checks FROM relation_checks GROUP BY ALL),
t AS (SELECT table_schema, table_name, string_agg(trigger_name || ' ' || timing || ' ' || event || ' ' || action_statement, ';' ORDER BY trigger_name, event, timing, action_statement) AS triggers
  FROM relation_triggers GROUP BY ALL)
SELECT r.table_schema, r.table_name, coalesce(checks, '') AS checks, coalesce(triggers, '') AS triggers
FROM relations r LEFT JOIN c USING (table_schema, table_name) LEFT JOIN t USING (table_schema, table_name) WHERE {_USER_SQL}""",
)
def snapshot_checks_and_triggers(spark, sf_dir):
    relations = filters.user_objects(view(spark, sf_dir, "relations")).select("table_schema", "table_name")
    snapshot = catalog.assemble_snapshot(
        relations, view(spark, sf_dir, "relation_columns"), checks=view(spark, sf_dir, "relation_checks"), triggers=view(spark, sf_dir, "relation_triggers")
    )
    checks = F.transform("checks", lambda c: F.concat(c["constraint_name"], F.lit("="), c["check_clause"]))
    triggers = F.transform("triggers", lambda t: F.concat_ws(" ", t["trigger_name"], t["timing"], t["event"], t["action_statement"]))
    return snapshot.select("table_schema", "table_name", F.array_join(checks, ";").alias("checks"), F.array_join(triggers, ";").alias("triggers"))


_CONSTRAINTS = """SELECT table_schema, table_name, concat('k', CAST(o_orderkey AS VARCHAR(20))) AS constraint_name,
  CASE o_custkey % 3 WHEN 0 THEN 'PRIMARY KEY' WHEN 1 THEN 'UNIQUE' ELSE 'FOREIGN KEY' END AS constraint_type, o_orderkey, o_custkey FROM [relations]"""
_USAGE = """SELECT table_schema, table_name, concat('k', CAST(o_orderkey AS VARCHAR(20))) AS constraint_name, column_name,
  row_number() OVER (PARTITION BY table_schema, table_name ORDER BY ordinal, column_name) AS ordinal_position
FROM (SELECT DISTINCT table_schema, table_name, o_orderkey, column_name, ordinal FROM [relation_columns]) c"""
_REFERENCES = """SELECT table_schema, constraint_name, table_schema AS unique_constraint_schema,
  concat('k', CAST(o_orderkey - 1 - o_custkey % 2 AS VARCHAR(20))) AS unique_constraint_name,
  CASE o_custkey % 4 WHEN 0 THEN 'CASCADE' ELSE 'NO ACTION' END AS on_delete, 'NO ACTION' AS on_update
FROM [table_constraints] WHERE constraint_type = 'FOREIGN KEY'"""
define_view("table_constraints", _CONSTRAINTS, ("relations",))
define_view("key_usage", _USAGE, ("relation_columns",))
define_view("referential", _REFERENCES, ("table_constraints",))


@query(
    "key_columns",
    f"""{with_views('table_constraints', 'key_usage')} SELECT c.table_schema, c.table_name, c.constraint_name, c.constraint_type,
  string_agg(u.column_name, ',' ORDER BY u.ordinal_position) AS columns FROM table_constraints c
JOIN key_usage u ON u.constraint_name = c.constraint_name AND u.table_schema = c.table_schema
WHERE c.constraint_type IN ('PRIMARY KEY', 'UNIQUE') AND c.{_USER_SQL.split(' AND ')[0]} GROUP BY ALL""",
)
def key_columns(spark, sf_dir):
    constraints = view(spark, sf_dir, "table_constraints").where("table_schema NOT LIKE 'pg_%'")
    return catalog.key_columns(constraints, view(spark, sf_dir, "key_usage"), column_tasks(spark, sf_dir)).drop("members")


@query(
    "key_flags",
    f"""{with_views('table_constraints', 'key_usage')}, m AS (SELECT u.table_schema, u.table_name, u.column_name, bool_or(c.constraint_type = 'PRIMARY KEY') AS pk,
  bool_or(c.constraint_type = 'UNIQUE') AS uq FROM table_constraints c JOIN key_usage u ON u.constraint_name = c.constraint_name AND u.table_schema = c.table_schema
  WHERE c.constraint_type IN ('PRIMARY KEY', 'UNIQUE') AND u.ordinal_position <= 99 GROUP BY ALL)
SELECT r.table_schema, r.table_name, r.column_name, coalesce(pk, false) AS is_primary_key, coalesce(uq, false) AS is_unique
FROM relation_columns r LEFT JOIN m USING (table_schema, table_name, column_name)""",
)
def key_flags(spark, sf_dir):
    tasks = column_tasks(spark, sf_dir)
    keys = catalog.key_columns(view(spark, sf_dir, "table_constraints"), view(spark, sf_dir, "key_usage"), tasks)
    columns = view(spark, sf_dir, "relation_columns").select("table_schema", "table_name", "column_name")
    return catalog.key_flags(columns, keys, tasks)


@query(
    "foreign_keys",
    f"""{with_views('referential', 'key_usage')} SELECT c.table_schema, c.table_name, c.constraint_name, u.column_name, t.table_schema AS references_schema,
  t.table_name AS references_table, t.column_name AS references_column, r.on_delete, r.on_update FROM table_constraints c
JOIN key_usage u ON u.table_schema = c.table_schema AND u.constraint_name = c.constraint_name
JOIN referential r ON r.table_schema = c.table_schema AND r.constraint_name = c.constraint_name
JOIN key_usage t ON t.table_schema = r.unique_constraint_schema AND t.constraint_name = r.unique_constraint_name AND t.ordinal_position = u.ordinal_position
WHERE c.constraint_type = 'FOREIGN KEY'""",
)
def foreign_keys(spark, sf_dir):
    usage = view(spark, sf_dir, "key_usage")
    tables = view(spark, sf_dir, "table_constraints")
    return catalog.foreign_keys(tables, usage, view(spark, sf_dir, "referential"), usage, column_tasks(spark, sf_dir))


_CLASSES = """SELECT o_orderkey AS oid, table_schema AS schema, table_name AS name, CASE WHEN o_custkey % 4 > 0 THEN concat('IN (', CAST(o_custkey AS VARCHAR(20)), ')') END AS bound FROM [relations]"""
_INHERITS = """SELECT CAST(floor(o_orderkey / 12) AS BIGINT) * 12 AS parent_oid, o_orderkey AS child_oid FROM [relations] WHERE o_orderkey % 12 <> 0"""
define_view("classes", _CLASSES, ("relations",))
define_view("inherits", _INHERITS, ("relations",))


@query(
    "partition_children",
    f"""{with_views('classes', 'inherits')} SELECT p.schema AS parent_schema, p.name AS parent_table,
  string_agg(c.name || ' ' || coalesce(c.bound, ''), ';' ORDER BY c.name) AS partitions FROM inherits i JOIN classes p ON p.oid = i.parent_oid
JOIN classes c ON c.oid = i.child_oid WHERE p.schema NOT LIKE 'pg_%' GROUP BY 1, 2""",
)
def partition_children(spark, sf_dir):
    found = catalog.partition_children(view(spark, sf_dir, "inherits"), view(spark, sf_dir, "classes"))
    text = F.transform("partitions", lambda p: F.concat(p["child_table"], F.lit(" "), p["bound"]))
    return found.select("parent_schema", "parent_table", F.array_join(text, ";").alias("partitions"))


_EDITED = """SELECT c_custkey + CASE WHEN c_custkey % 17 = 0 THEN 10000000 ELSE 0 END AS c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'EDITED' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey FROM [customer]"""


@query(
    "snapshot_diff",
    f"""WITH e AS ({_EDITED.replace('[customer]', 'customer')}) SELECT coalesce(o.c_custkey, e.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'added'
  WHEN e.c_custkey IS NULL THEN 'removed' WHEN o.c_mktsegment IS DISTINCT FROM e.c_mktsegment OR o.c_nationkey IS DISTINCT FROM e.c_nationkey THEN 'changed'
  ELSE 'same' END AS state FROM customer o FULL JOIN e ON e.c_custkey = o.c_custkey""",
)
def snapshot_diff(spark, sf_dir):
    old = read_table(spark, sf_dir, "customer")
    new = spark.sql(_EDITED.replace("[customer]", "{customer}"), customer=old)
    return catalog.snapshot_diff(old, new, ["c_custkey"], ["c_mktsegment", "c_nationkey"])


@query(
    "constraint_check",
    """WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey, l_discount FROM lineitem)
SELECT '23505' AS code, l_orderkey AS a, CAST(l_linenumber AS BIGINT) AS b, count(*) AS n FROM i GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT '23503' AS code, l_orderkey AS a, l_partkey AS b, 1 AS n FROM i WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
UNION ALL SELECT '23502' AS code, l_orderkey AS a, l_partkey AS b, 1 AS n FROM i WHERE l_suppkey IS NULL
UNION ALL SELECT '23514' AS code, l_orderkey AS a, l_partkey AS b, 1 AS n FROM i WHERE NOT l_discount < 0.09""",
)
def constraint_check(spark, sf_dir):
    items = read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey", "l_discount"
    )
    orders = read_table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    check = catalog.constraint_check
    twice = check(items, "unique", ["l_orderkey", "l_linenumber"]).selectExpr("code", "l_orderkey AS a", "CAST(l_linenumber AS BIGINT) AS b", "copies AS n")
    single = [
        check(items, "foreign_key", ["l_orderkey"], (orders, ["o_orderkey"])),
        check(items, "not_null", ["l_suppkey"]),
        check(items, "check", check=F.col("l_discount") < 0.09),
    ]
    for rows in single:
        twice = twice.unionByName(rows.selectExpr("code", "l_orderkey AS a", "l_partkey AS b", "1L AS n"))
    return twice


_FAILURES = """SELECT seq_id, CASE k % 8 WHEN 0 THEN '23505' WHEN 1 THEN '42P01' WHEN 2 THEN '40001' WHEN 3 THEN '22012' WHEN 4 THEN 'odd code' WHEN 5 THEN NULL
    WHEN 6 THEN '58030' ELSE 'auth_failed' END AS code, CASE k % 5 WHEN 0 THEN 'error' WHEN 1 THEN 'loud' WHEN 2 THEN 'Fatal' WHEN 3 THEN 'WARNING' END AS severity, k % 8 = 7 AS pool,
  concat('lock wait for user "u', CAST(user_id AS VARCHAR(20)), '" on host=', db_alias, '.internal:5432 near ''', action, '''') AS message,
  CASE WHEN k % 2 = 0 THEN concat('Key (email)=(u', CAST(user_id AS VARCHAR(20)), '@corp.com) exists, see /var/lib/', project, '/x') END AS detail
FROM [request_log] WHERE outcome = 'error'"""
define_view("failures", _FAILURES, ("request_log",))
_ERROR_RULES = ", ".join(
    "('{}', {}, {}, {}, {})".format(
        c,
        "'" + C.CURATED_MESSAGES[c] + "'" if c in C.CURATED_MESSAGES else "NULL",
        "'" + C.CURATED_HINTS[c] + "'" if c in C.CURATED_HINTS else "NULL",
        c in C.DETAIL_CODES,
        c in C.RETRYABLE_CODES,
    )
    for c in ("23505", "42P01", "40001", "22012", "58030")
)
_RED = r"""regexp_replace(regexp_replace(regexp_replace({}, '"[^"]*"', '"?"', 'g'), '''[^'']*''', '''?''', 'g'), '([:(,=][ ]*)[0-9]{{2,}}', '\1?', 'g')"""


@query(
    "explain_errors",
    rf"""{with_views('failures')}, rules(code, curated, hint, shown, retry) AS (VALUES {_ERROR_RULES}),
j AS (SELECT f.seq_id, coalesce(f.code, 'UNKNOWN') AS code, f.severity, f.pool, r.curated, r.hint, coalesce(r.shown, false) AS shown, coalesce(r.retry, false) AS retry,
  {scrub_sql(_RED.format('f.message'))} AS m, {scrub_sql("regexp_replace(f.detail, '=[(][^)]*[)]', '= (?)', 'g')")} AS d FROM failures f LEFT JOIN rules r ON r.code = f.code)
SELECT seq_id, code, CASE WHEN upper(severity) IN ({", ".join(f"'{s}'" for s in C.SEVERITIES)}) THEN upper(severity) ELSE 'ERROR' END AS severity,
  CASE WHEN pool THEN '{C.POOL_MESSAGES["auth_failed"]}' WHEN shown THEN concat_ws(' ', curated, m, d) ELSE 'Database error (' || code || '). {C.GENERIC_ERROR}' END AS message,
  CASE WHEN shown AND NOT pool THEN hint END AS hint, retry AS retryable, CASE WHEN code = 'odd code' THEN 'INTERNAL' ELSE code END AS audit_code FROM j""",
)
def explain_errors(spark, sf_dir):
    return errors.explain_errors(view(spark, sf_dir, "failures"), errors.code_table(spark), pool="pool").drop("pool")


_CODED = """SELECT seq_id, CASE WHEN denial_reason = 'role_denied' THEN 'role_insufficient' WHEN denial_reason IS NOT NULL THEN denial_reason
  WHEN outcome = 'cancelled' THEN 'query_cancelled' WHEN k % 4 = 0 THEN 'approval_timeout' ELSE 'internal_error' END AS code
FROM [request_log] WHERE outcome <> 'success'"""
define_view("coded", _CODED, ("request_log",))
_CODE_ROWS = ", ".join(
    "('{}', '{}', {}, {}, {})".format(c, e[0], e[1], e[2], f"'{e[3]}'" if e[3] else "NULL")
    for c, e in C.REQUEST_ERRORS.items()
    if c in ("role_insufficient", "query_cancelled", "approval_timeout", "internal_error")
)


@query(
    "describe_codes",
    f"""{with_views('coded')}, t(code, message, fatal, retryable, hint) AS (VALUES {_CODE_ROWS})
SELECT seq_id, c.code, coalesce(t.message, '{C.GENERIC_ERROR}') AS message, coalesce(fatal, false) AS fatal, coalesce(retryable, false) AS retryable, hint
FROM coded c LEFT JOIN t ON t.code = c.code""",
)
def describe_codes(spark, sf_dir):
    return errors.describe_codes(view(spark, sf_dir, "coded"), errors.request_code_table(spark))


_ENTRIES = """SELECT seq_id AS row_id, CASE WHEN k % 5 = 0 THEN 'bad name' WHEN k % 5 = 1 THEN NULL ELSE project END AS project_name,
  concat('db', CAST(CAST(floor(seq_id / 3) AS BIGINT) + k % 2 AS VARCHAR(20))) AS db_alias,
  CASE k % 8 WHEN 0 THEN 'db.internal' WHEN 1 THEN concat('10.0.', CAST(k * 3 AS VARCHAR(4)), '.7') WHEN 2 THEN '2001:db8::1' WHEN 3 THEN '-bad-.host' WHEN 4 THEN 'ho st'
    WHEN 5 THEN '::ffff:10.1.2.3' WHEN 6 THEN '1.2.3.04.' ELSE 'localhost' END AS host,
  CAST(k * 700 AS INT) AS port, CASE WHEN k % 9 = 0 THEN '' ELSE db_alias END AS database, concat('u', CAST(user_id AS VARCHAR(20))) AS user,
  CASE k % 4 WHEN 0 THEN 'DB_PASSWORD' WHEN 1 THEN 'db-password' ELSE NULL END AS password_env, CASE WHEN k % 3 = 0 THEN 'sealed' END AS password_stored,
  CASE k % 5 WHEN 0 THEN 'prefer' ELSE 'require' END AS ssl_mode, CASE k % 6 WHEN 0 THEN 'full' WHEN 1 THEN 'root' END AS permission_override,
  CASE k % 3 WHEN 0 THEN '2024-01-02T03:04:05Z' WHEN 1 THEN '2024-13-02T03:04:05Z' ELSE 'yesterday' END AS created_at FROM [request_log]"""
define_view("registry_entries", _ENTRIES, ("request_log",))


@query(
    "validity_report",
    rf"""{with_views('registry_entries')}, a AS (SELECT row_id, unnest([
  {{'rule': 'project_name', 'ok': project_name IS NULL OR regexp_matches(project_name, '^[a-zA-Z0-9_-]+$')}}, {{'rule': 'db_alias', 'ok': regexp_matches(db_alias, '^[a-zA-Z0-9_-]+$')}},
  {{'rule': 'host', 'ok': host IN ('db.internal', '2001:db8::1', '::ffff:10.1.2.3', 'localhost') OR regexp_matches(host, '^10\.0\.[0-9]+\.7$')}},
  {{'rule': 'port', 'ok': port BETWEEN 1 AND 65535}}, {{'rule': 'database', 'ok': length(database) BETWEEN 1 AND 63}}, {{'rule': 'user', 'ok': length("user") BETWEEN 1 AND 63}},
  {{'rule': 'password_env', 'ok': coalesce(password_env = 'DB_PASSWORD', true)}}, {{'rule': 'password_source', 'ok': password_env IS NOT NULL OR password_stored IS NOT NULL}},
  {{'rule': 'ssl_mode', 'ok': ssl_mode = 'require'}}, {{'rule': 'permission_override', 'ok': coalesce(permission_override = 'full', true)}},
  {{'rule': 'created_at', 'ok': created_at = '2024-01-02T03:04:05Z'}}]) AS r FROM registry_entries)
SELECT row_id, r.rule AS rule, r.ok AS ok FROM a
UNION ALL SELECT row_id, 'duplicate_alias' AS rule, row_id = min(row_id) OVER (PARTITION BY db_alias) AS ok FROM registry_entries""",
)
def validity_report(spark, sf_dir):
    entries = view(spark, sf_dir, "registry_entries")
    report = validity.validity_report(entries, "row_id", validity.registry_rules())
    return report.unionByName(validity.duplicate_report(entries, "row_id", ["db_alias"], "duplicate_alias"))


_PAYLOADS = """SELECT stmt_id AS row_id, CASE WHEN k % 20 = 0 THEN '  ' ELSE sql END AS sql, CAST(CASE WHEN k % 16 = 11 THEN 2 ELSE 1 END AS INT) AS statement_count,
  CASE WHEN k % 9 = 0 THEN NULL ELSE k - 10 END AS timeout_ms, CASE k % 4 WHEN 0 THEN 'migration' WHEN 1 THEN 'read' ELSE 'ddl' END AS intent,
  CASE WHEN k % 7 = 0 THEN NULL ELSE k * 20 END AS page_size, CASE k % 3 WHEN 0 THEN 'timeout' ELSE 'bored' END AS reason,
  CASE WHEN k % 6 = 0 THEN '' ELSE concat('r', CAST(k AS VARCHAR(4))) END AS target_id FROM [statements]"""
define_view("payloads", _PAYLOADS, ("statements",))


@query(
    "payload_report",
    f"""{with_views('payloads')}, a AS (SELECT row_id, unnest([
  {{'rule': 'sql', 'ok': trim(sql) <> ''}}, {{'rule': 'sql_length', 'ok': true}}, {{'rule': 'single_statement', 'ok': statement_count <= 1}},
  {{'rule': 'timeout_ms', 'ok': coalesce(timeout_ms >= 0, true)}}, {{'rule': 'intent', 'ok': intent IN ('read', 'ddl')}},
  {{'rule': 'page_size', 'ok': coalesce(page_size BETWEEN 1 AND 1000, true)}}, {{'rule': 'target_id', 'ok': target_id <> ''}}, {{'rule': 'reason', 'ok': reason = 'timeout'}}]) AS r FROM payloads)
SELECT row_id, r.rule AS rule, r.ok AS ok FROM a""",
)
def payload_report(spark, sf_dir):
    rules = validity.query_rules() | validity.cancel_rules()
    return validity.validity_report(view(spark, sf_dir, "payloads"), "row_id", rules)


_ENVELOPES = """SELECT seq_id AS row_id, CASE WHEN k % 17 = 0 THEN '' WHEN k % 19 = 0 THEN repeat('m', 65) ELSE concat('m', CAST(seq_id AS VARCHAR(20))) END AS id,
  CASE WHEN k % 13 = 0 THEN 'gossip' ELSE action END AS type, CASE WHEN k % 11 = 0 THEN NULL ELSE project END AS project,
  CASE WHEN k % 23 = 0 THEN '' ELSE CAST(user_id AS VARCHAR(20)) END AS user_id, CASE WHEN k % 7 = 0 THEN 'root' ELSE role END AS role, db_alias,
  CASE WHEN k % 29 = 0 THEN 0 ELSE ts_ms END AS ts, CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'short' WHEN 2 THEN repeat('a b-', 5) ELSE repeat('nonce_-9', 2 + k % 8) END AS nonce,
  CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN repeat('ab', 32) WHEN 2 THEN repeat('AB', 32) ELSE 'none' END AS mac FROM [request_log]"""
define_view("message_envelopes", _ENVELOPES, ("request_log",))


@query(
    "envelope_report",
    f"""{with_views('message_envelopes')}, a AS (SELECT row_id, unnest([
  {{'rule': 'id', 'ok': length(id) BETWEEN 1 AND 64}}, {{'rule': 'type', 'ok': type IN ({", ".join(f"'{t}'" for t in C.MESSAGE_TYPES)})}},
  {{'rule': 'project', 'ok': coalesce(length(project) BETWEEN 1 AND 64, false)}}, {{'rule': 'user_id', 'ok': user_id <> ''}}, {{'rule': 'role', 'ok': role <> 'root'}},
  {{'rule': 'db_alias', 'ok': length(db_alias) BETWEEN 1 AND 64}}, {{'rule': 'ts', 'ok': ts > 0}},
  {{'rule': 'nonce', 'ok': nonce IS NULL OR regexp_full_match(nonce, '[A-Za-z0-9_-]{{16,64}}')}}, {{'rule': 'mac', 'ok': mac IS NULL OR regexp_full_match(mac, '[0-9a-f]{{64}}')}}]) AS r FROM message_envelopes)
SELECT row_id, r.rule AS rule, r.ok AS ok FROM a""",
)
def envelope_report(spark, sf_dir):
    return validity.validity_report(view(spark, sf_dir, "message_envelopes"), "row_id", validity.envelope_rules())


_PLAN_HEADS = """SELECT row_id, CASE WHEN min(k) % 9 = 0 THEN '' ELSE concat('p', CAST(row_id AS VARCHAR(20))) END AS plan_id,
  CASE min(k) % 4 WHEN 0 THEN 'all_at_once' WHEN 1 THEN 'single_tx' ELSE 'per_statement' END AS strategy, CASE WHEN max(k) % 5 = 0 THEN NULL ELSE max(k) - 80 END AS timeout_ms,
  CASE WHEN max(k) % 3 > 0 THEN max(k) % 2 = 0 END AS dry_run, CASE min(k) % 6 WHEN 0 THEN 'done' WHEN 1 THEN 'partial' WHEN 2 THEN NULL ELSE 'committed' END AS status,
  min(k) - 2 AS total_ms FROM (SELECT plan_id AS row_id, k FROM [statements]) s GROUP BY row_id"""
_PLAN_LINES = """SELECT plan_id AS row_id, CASE WHEN k % 20 = 0 THEN '  ' ELSE sql END AS sql, CASE k % 16 WHEN 0 THEN 'odd' WHEN 1 THEN 'failed' ELSE 'success' END AS status FROM [statements]"""
define_view("plan_heads", _PLAN_HEADS, ("statements",))
define_view("plan_lines", _PLAN_LINES, ("statements",))


def _plan_payloads(spark, sf_dir):
    lines = view(spark, sf_dir, "plan_lines").groupBy("row_id").agg(F.collect_list("sql").alias("statements"), F.collect_list("status").alias("statement_statuses"))
    return view(spark, sf_dir, "plan_heads").join(lines, "row_id")


@query(
    "plan_report",
    f"""{with_views('plan_heads', 'plan_lines')}, l AS (SELECT row_id, bool_and(trim(sql) <> '') AS texts, count(*) AS n FROM plan_lines GROUP BY 1),
a AS (SELECT row_id, unnest([{{'rule': 'plan_id', 'ok': plan_id <> ''}}, {{'rule': 'statements', 'ok': n BETWEEN 1 AND {C.MAX_PLAN_STATEMENTS}}}, {{'rule': 'statement_text', 'ok': texts}},
  {{'rule': 'strategy', 'ok': strategy <> 'all_at_once'}}, {{'rule': 'timeout_ms', 'ok': coalesce(timeout_ms > 0, true)}}, {{'rule': 'dry_run', 'ok': dry_run IS NOT NULL}}]) AS r FROM plan_heads JOIN l USING (row_id))
SELECT row_id, r.rule AS rule, r.ok AS ok FROM a""",
)
def plan_report(spark, sf_dir):
    return validity.validity_report(_plan_payloads(spark, sf_dir), "row_id", validity.plan_rules())


@query(
    "result_report",
    f"""{with_views('plan_heads', 'plan_lines')}, l AS (SELECT row_id, bool_and(status <> 'odd') AS known FROM plan_lines GROUP BY 1),
a AS (SELECT row_id, unnest([{{'rule': 'plan_id', 'ok': plan_id <> ''}}, {{'rule': 'status', 'ok': coalesce(status <> 'done', false)}}, {{'rule': 'statement_status', 'ok': known}},
  {{'rule': 'total_ms', 'ok': total_ms >= 0}}]) AS r FROM plan_heads JOIN l USING (row_id))
SELECT row_id, r.rule AS rule, r.ok AS ok FROM a""",
)
def result_report(spark, sf_dir):
    return validity.validity_report(_plan_payloads(spark, sf_dir), "row_id", validity.result_rules())
