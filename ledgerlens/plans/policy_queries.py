"""Policy decisions over the request log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.operators import policy
from ledgerlens.plans.fixtures import define_view, view, with_views
from ledgerlens.plans.registry import query

# --- function effects: (schema, name, provolatile, prosecdef, visible)
_CATALOG = """VALUES ('pg_catalog', 'count', 'i', false, true), ('pg_catalog', 'pg_sleep', 'v', false, true),
  ('pg_catalog', 'pg_table_size', 'v', false, true), ('pg_catalog', 'random', 'v', false, true),
  ('app', 'pay', 'v', false, true), ('app', 'pay', 'i', false, true), ('audit', 'pay', 'i', true, false),
  ('app', 'rate', 's', false, true), ('app', 'tax', 'i', false, false), ('legacy', 'tax', 'x', false, false),
  ('pg_catalog', 'nextval', 'v', false, true), ('audit', 'note', 'i', true, false)"""
_REFS = """SELECT seq_id AS stmt_id, CASE k % 13 WHEN 0 THEN 'count' WHEN 1 THEN 'pg_sleep' WHEN 2 THEN 'app.pay' WHEN 3 THEN 'pay'
  WHEN 4 THEN 'Rate' WHEN 5 THEN 'tax' WHEN 6 THEN 'nextval' WHEN 7 THEN 'audit.note' WHEN 8 THEN 'a.b.c' WHEN 9 THEN 'ghost.fn'
  WHEN 10 THEN 'dblink_exec' WHEN 11 THEN 'lower' ELSE 'pg_table_size' END AS name FROM [request_log]"""
define_view("function_refs", _REFS, ("request_log",))


def _effects_sql(table: str, to: str) -> str:
    """The verdict of each distinct name under the function table ``table``, as ``to``."""
    return rf"""{to}_n AS (SELECT DISTINCT lower(name) AS name FROM function_refs),
{to}_s AS (SELECT name, CASE WHEN regexp_matches(name, '^[^.]+\.[^.]+$') THEN split_part(name, '.', 1) END AS q,
  CASE WHEN regexp_matches(name, '^[^.]+\.[^.]+$') THEN split_part(name, '.', 2) ELSE name END AS bare FROM {to}_n),
{to}_d AS (SELECT *, CASE WHEN bare LIKE 'pg\_sleep%' ESCAPE '\' OR bare LIKE 'dblink%' THEN 'remote_io' WHEN bare = 'nextval' THEN 'sequence' END AS kind FROM {to}_s),
{to}_j AS (SELECT d.*, c.schema_, c.vis, c.name AS cname, CASE WHEN c.schema_ = 'pg_catalog' AND d.kind IS NULL AND NOT c.def THEN 0
  WHEN c.def THEN 4 WHEN c.vol = 'i' THEN 0 WHEN c.vol = 's' THEN 1 WHEN c.vol = 'v' THEN 3 ELSE 2 END AS sev
  FROM {to}_d d LEFT JOIN {table} c ON c.name = d.bare AND (d.q IS NULL OR d.q = c.schema_)),
{to}_k AS (SELECT *, max(CASE WHEN vis AND q IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY name) AS sees FROM {to}_j),
{to}_g AS (SELECT name, q, bare, kind, max(CASE WHEN cname IS NOT NULL THEN sev END) AS sev, min(schema_) AS schema_ FROM {to}_k
  WHERE sees = 0 OR vis GROUP BY ALL),
{to} AS (SELECT name, CASE WHEN sev IS NOT NULL THEN coalesce(q, schema_) || '.' || bare WHEN q IS NULL AND kind IS NULL THEN 'pg_catalog.' || bare
    WHEN q IS NOT NULL THEN name END AS qualified_name,
  CASE WHEN sev IS NULL AND q IS NULL AND kind IS NULL THEN 'immutable' WHEN sev IS NULL THEN 'unknown'
    ELSE (['immutable', 'stable', 'unknown', 'volatile', 'security_definer'])[sev + 1] END AS effect,
  concat_ws(',', CASE WHEN sev IS NOT NULL OR q IS NOT NULL OR kind IS NOT NULL THEN kind END,
    CASE WHEN sev > 0 OR (sev IS NULL AND (q IS NOT NULL OR kind IS NOT NULL)) THEN 'unknown_effect' END) AS side_effects,
  sev IS NOT NULL OR (q IS NULL AND kind IS NULL) AS resolved FROM {to}_g)"""


@query(
    "function_effects",
    f"""{with_views("function_refs")}, cat(schema_, name, vol, def, vis) AS ({_CATALOG}), {_effects_sql("cat", "v")}
SELECT stmt_id, r.name, qualified_name, effect, side_effects, resolved FROM function_refs r JOIN v ON v.name = lower(r.name)""",
)
def function_effects(spark, sf_dir):
    catalog = spark.sql(f"SELECT * FROM ({_CATALOG}) AS t(schema, name, provolatile, prosecdef, visible)")
    found = policy.function_effects(view(spark, sf_dir, "function_refs"), catalog)
    return found.withColumn("side_effects", F.array_join(F.array_sort("side_effects"), ","))


#: a site's own function table, from what its agents have seen: other verdicts for some names, none for others
_OWN_FUNCTIONS = """SELECT DISTINCT CASE WHEN name IN ('count', 'pg_sleep', 'pg_table_size') THEN 'pg_catalog' ELSE 'app' END AS schema_,
  CASE WHEN name LIKE 'app.%' THEN substr(name, 5) ELSE lower(name) END AS name,
  CASE WHEN name IN ('Rate', 'tax') THEN 'i' WHEN name = 'pay' THEN 's' ELSE 'v' END AS vol, name = 'pay' AND stmt_id % 2 = 0 AS def, true AS vis
FROM [function_refs] WHERE name NOT IN ('lower', 'nextval', 'a.b.c', 'audit.note', 'ghost.fn')"""
define_view("own_functions", _OWN_FUNCTIONS, ("function_refs",))


@query(
    "function_effects_by_rules",
    f"""{with_views("function_refs", "own_functions")}, cat(schema_, name, vol, def, vis) AS ({_CATALOG}), {_effects_sql("cat", "shipped")}, {_effects_sql("own_functions", "own")},
nothing AS (SELECT * FROM cat WHERE false), {_effects_sql("nothing", "closed")}
SELECT r.stmt_id, r.name, shipped.effect AS shipped_effect, own.effect AS own_effect, closed.effect AS closed_effect, own.resolved AS own_resolved, closed.resolved AS closed_resolved
FROM function_refs r JOIN shipped ON shipped.name = lower(r.name) JOIN own ON own.name = lower(r.name) JOIN closed ON closed.name = lower(r.name)""",
)
def function_effects_by_rules(spark, sf_dir):
    """The same references under the shipped function table, a site's own, and none (fail closed)."""
    found = view(spark, sf_dir, "function_refs")
    shipped = spark.sql(f"SELECT * FROM ({_CATALOG}) AS t(schema, name, provolatile, prosecdef, visible)")
    own = view(spark, sf_dir, "own_functions").selectExpr("schema_ AS schema", "name", "vol AS provolatile", "def AS prosecdef", "vis AS visible")
    verdicts = ["qualified_name", "effect", "side_effects", "resolved"]
    for catalog, label in ((shipped, "shipped"), (own, "own"), (None, "closed")):
        judged = policy.function_effects(found, catalog)
        found = judged.withColumns({f"{label}_effect": F.col("effect"), f"{label}_resolved": F.col("resolved")}).drop(*verdicts)
    return found.drop("shipped_resolved")


# --- registry and scopes
_REGISTRY = """VALUES ('db0', 'proj0', 'main', CAST(NULL AS VARCHAR(20)), 3), ('db1', 'proj1', 'sales', 'manual', 1),
  ('db2', CAST(NULL AS VARCHAR(20)), 'stock', 'full', 2), ('proj2', 'other', 'staff', CAST(NULL AS VARCHAR(20)), 4),
  ('db4', 'proj1', 'sales2', 'auto_upgrade', 5)"""
_ASKED = """SELECT seq_id, CASE WHEN k % 6 = 0 THEN NULL WHEN k % 6 = 1 THEN 'default' ELSE db_alias END AS asserted_alias,
  CASE WHEN k % 5 = 0 THEN 'default' WHEN k % 5 = 1 THEN NULL ELSE project END AS asserted_project FROM [request_log]"""
define_view("asked", _ASKED, ("request_log",))


@query(
    "resolve_entry",
    f"""{with_views("asked")}, reg(db_alias, project_name, database, override, ord) AS ({_REGISTRY}),
x AS (SELECT *, CASE WHEN asserted_alias <> 'default' THEN asserted_alias END AS a, CASE WHEN asserted_project <> 'default' THEN asserted_project END AS p FROM asked),
y AS (SELECT x.*, coalesce((SELECT min(ord) FROM reg WHERE reg.db_alias = x.a), (SELECT min(ord) FROM reg WHERE reg.db_alias = x.p),
  (SELECT min(ord) FROM reg WHERE reg.project_name = x.p), CASE WHEN a IS NULL THEN 1 END) AS pick FROM x)
SELECT seq_id, reg.db_alias AS resolved_alias, reg.database AS resolved_database,
  CASE WHEN pick IS NOT NULL THEN coalesce(reg.override, 'read_only') END AS effective_level,
  CASE WHEN pick IS NULL THEN 'database_not_found' ELSE 'ok' END AS code FROM y LEFT JOIN reg ON reg.ord = y.pick""",
)
def resolve_entry(spark, sf_dir):
    registry = spark.sql(f"SELECT * FROM ({_REGISTRY}) AS t(db_alias, project_name, database, permission_override, ord)")
    found = policy.resolve_entry(view(spark, sf_dir, "asked"), registry)
    return found.select("seq_id", "resolved_alias", "resolved_database", "effective_level", "code")


_RULES = """VALUES ('proj0', 'db1'), ('proj1', CAST(NULL AS VARCHAR(20))), (CAST(NULL AS VARCHAR(20)), 'db3')"""


@query(
    "scope_filter",
    f"""{with_views("request_log")}, rules(p, d) AS ({_RULES})
SELECT seq_id, project, db_alias FROM request_log WHERE EXISTS (SELECT 1 FROM rules
  WHERE (p IS NULL OR p = project) AND (d IS NULL OR d = db_alias))""",
)
def scope_filter(spark, sf_dir):
    rules = spark.sql(f"SELECT * FROM ({_RULES}) AS t(project_name, db_alias)")
    return policy.scope_filter(view(spark, sf_dir, "request_log"), rules, "project", "db_alias").select("seq_id", "project", "db_alias")


_LIST_A = "SELECT DISTINCT project AS project_name, CASE WHEN user_id % 2 = 0 THEN db_alias END AS db_alias FROM [request_log]"
_LIST_B = "SELECT DISTINCT CASE WHEN user_id % 3 = 0 THEN project END AS project_name, db_alias FROM [request_log] WHERE user_id % 5 < 3"


@query(
    "intersect_rules",
    f"""{with_views("request_log")}, a AS ({_LIST_A.replace("[request_log]", "request_log")}), b AS ({_LIST_B.replace("[request_log]", "request_log")})
SELECT DISTINCT coalesce(a.project_name, b.project_name) AS project_name, coalesce(a.db_alias, b.db_alias) AS db_alias FROM a, b
WHERE coalesce(a.project_name = b.project_name, true) AND coalesce(a.db_alias = b.db_alias, true)""",
)
def intersect_rules(spark, sf_dir):
    log = view(spark, sf_dir, "request_log")
    a, b = (spark.sql(t.replace("[request_log]", "{log}"), log=log) for t in (_LIST_A, _LIST_B))
    return policy.intersect_rules(a, b)


# --- decisions
_JUDGED = """SELECT seq_id, role, CASE k % 5 WHEN 0 THEN 'full' WHEN 1 THEN 'read_only' WHEN 2 THEN 'auto_upgrade' WHEN 3 THEN 'manual' ELSE 'odd' END
    AS permission_level, CASE user_id % 6 WHEN 0 THEN 'write' WHEN 1 THEN 'migration' WHEN 2 THEN 'ddl' ELSE 'read' END AS intent, action AS message_type,
  CASE k % 7 WHEN 0 THEN 'write' WHEN 1 THEN 'ddl' WHEN 2 THEN 'utility' ELSE 'read' END AS type,
  CASE k % 7 WHEN 0 THEN CASE WHEN k % 2 = 0 THEN 'SELECT' ELSE 'INSERT' END WHEN 1 THEN 'DROP' WHEN 2 THEN 'VACUUM' ELSE 'SELECT' END AS verb,
  k % 31 <> 0 AS parse_ok, CASE WHEN k % 29 = 0 THEN 0 WHEN k % 23 = 0 THEN 2 ELSE 1 END AS statement_count,
  user_id % 7 = 3 AS plan_granted, user_id % 5 = 2 AS approved, CAST(k % 11 AS INT) AS flaw, CAST(user_id % 4 AS INT) AS fn FROM [request_log]"""
define_view("judged", _JUDGED, ("request_log",))
_FULL_CAPS = {r: C.ROLE_CAPABILITIES[r] for r in ("admin", "developer")}

_DECIDE_SQL = f"""{with_views("judged")},
x AS (SELECT *, CASE flaw WHEN 0 THEN 'side_effect' WHEN 1 THEN 'row_locking' WHEN 2 THEN 'denied_function' WHEN 3 THEN 'multiple_statements' END AS violation,
  CASE fn WHEN 1 THEN 'volatile' WHEN 2 THEN 'unknown' ELSE 'immutable' END AS effect, role IN ('admin', 'developer') AS strong FROM judged),
y AS (SELECT *, type = 'read' AND parse_ok AND statement_count = 1 AND violation IS NULL AND effect = 'immutable' AND flaw <> 4 AS provable,
  coalesce(violation IN ('side_effect', 'row_locking', 'denied_function'), false) AS escaped FROM x),
z AS (SELECT *, CASE WHEN NOT parse_ok OR statement_count = 0 THEN 'unparseable_statement' WHEN statement_count > 1 THEN 'multiple_statements'
  WHEN intent = 'migration' AND message_type <> 'migration_run' THEN 'intent_not_applicable'
  WHEN NOT (intent = type OR (intent = 'read' AND verb = 'SELECT') OR (intent = 'migration' AND message_type = 'migration_run')) THEN 'intent_mismatch'
  WHEN message_type IN ('migration_run', 'cancel') AND NOT strong THEN 'role_insufficient'
  WHEN NOT strong AND (escaped OR NOT (type = 'read' AND provable)) THEN 'role_insufficient'
  WHEN permission_level = 'full' THEN 'allowed' WHEN permission_level <> 'odd' AND provable THEN 'allowed'
  WHEN permission_level = 'auto_upgrade' THEN CASE WHEN plan_granted THEN 'auto_upgrade_granted' ELSE 'plan_not_registered' END
  WHEN permission_level = 'manual' AND approved THEN 'allowed' ELSE 'permission_denied' END AS code FROM y)
"""


def judged(spark, sf_dir):
    return view(spark, sf_dir, "judged").withColumns(
        {
            "read_violations": F.expr(
                "filter(array(CASE flaw WHEN 0 THEN 'side_effect' WHEN 1 THEN 'row_locking' WHEN 2 THEN 'denied_function' "
                "WHEN 3 THEN 'multiple_statements' END), v -> v IS NOT NULL)"
            ),
            "side_effects": F.expr("CASE WHEN flaw = 4 THEN array('sequence') ELSE CAST(array() AS array<string>) END"),
            "function_effects": F.expr(
                "array(named_struct('name', concat('fn', fn), 'effect', CASE fn WHEN 1 THEN 'volatile' WHEN 2 THEN 'unknown' ELSE 'immutable' END, "
                "'resolved', fn <> 2, 'side_effects', CASE WHEN fn = 2 THEN array('unknown_effect') ELSE CAST(array() AS array<string>) END))"
            ),
        }
    )


@query("decide", f"{_DECIDE_SQL} SELECT seq_id, code IN ('allowed', 'auto_upgrade_granted') AS allowed, code FROM z")
def decide(spark, sf_dir):
    return policy.decide(judged(spark, sf_dir), policy.role_capabilities(spark)).select("seq_id", "allowed", "code")


@query(
    "explain_denials",
    f"""{_DECIDE_SQL}, w AS (SELECT *, CASE WHEN flaw = 4 THEN '{C.EFFECT_TEXT["sequence"]}' END AS eff,
  CASE violation WHEN 'row_locking' THEN '{C.STRUCTURAL_ESCAPE_TEXT["row_locking"]}' WHEN 'denied_function' THEN '{C.STRUCTURAL_ESCAPE_TEXT["denied_function"]}'
    WHEN 'multiple_statements' THEN '{C.STRUCTURAL_ESCAPE_TEXT["multiple_statements"]}' END AS esc,
  CASE fn WHEN 1 THEN 'it calls fn1(), which pg_proc reports as {C.VERDICT_TEXT["volatile"]}' END AS verdict FROM z)
SELECT seq_id, 'Read-only mode: ' || CASE WHEN violation IS NOT NULL THEN coalesce(eff, esc,
    CASE WHEN fn = 2 THEN 'pg_proc has no verdict for fn2(), so the call cannot be proved harmless' END, verdict, 'it is not provably free of side effects')
  WHEN type <> 'read' THEN 'it is a ''' || type || ''' statement (' || verb || '), not a read'
  ELSE coalesce(eff, verdict, 'it calls a function pg_proc does not prove IMMUTABLE') END AS reason
FROM w WHERE code = 'permission_denied' AND permission_level = 'read_only'""",
)
def explain_denials(spark, sf_dir):
    refused = policy.decide(judged(spark, sf_dir)).where("code = 'permission_denied' AND permission_level = 'read_only'")
    return refused.select("seq_id", "reason")


# --- plans
_PLANS = f"""SELECT CAST(floor(seq_id / 8) AS BIGINT) AS plan_id, min(ts_ms) AS at_ms, min(ts_ms) + {{ttl}} AS expires_ms,
  concat('hash', CAST(CAST(floor(seq_id / 8) AS BIGINT) % 3 AS VARCHAR(4))) AS statements_hash, min(user_id) AS registered_by,
  CASE WHEN CAST(floor(seq_id / 8) AS BIGINT) % 10 <> 9 THEN min(role) END AS role,
  CASE CAST(floor(seq_id / 8) AS BIGINT) % 4 WHEN 0 THEN 'full' WHEN 1 THEN 'manual' ELSE 'auto_upgrade' END AS level,
  CASE WHEN CAST(floor(seq_id / 8) AS BIGINT) % 17 = 0 THEN ' ' ELSE 'proj' END AS project, 'db' AS db_alias FROM [request_log]
GROUP BY CAST(floor(seq_id / 8) AS BIGINT)""".replace("{ttl}", str(6 * C.PLAN_TTL_MS))
_RUNS = """SELECT seq_id AS run_id, CAST(floor(seq_id / 8) AS BIGINT) + CASE WHEN k % 37 = 0 THEN 1000000000 ELSE 0 END AS plan_id, ts_ms, user_id, role,
  CASE k % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'manual' ELSE 'auto_upgrade' END AS level,
  concat('hash', CAST((CAST(floor(seq_id / 8) AS BIGINT) + CASE WHEN k % 12 = 0 THEN 1 ELSE 0 END) % 3 AS VARCHAR(4))) AS statements_hash,
  CASE WHEN k % 19 = 0 THEN 'elsewhere' ELSE 'proj' END AS project, 'db' AS db_alias FROM [request_log]"""
define_view("plan_registrations", _PLANS, ("request_log",))
define_view("plan_runs", _RUNS, ("request_log",))


def _rank_sql(column: str, ranks) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ranks.items()) + " END"


@query(
    "authorise_plans",
    f"""{with_views("plan_registrations", "plan_runs")},
j AS (SELECT r.*, p.plan_id AS found, CASE WHEN p.plan_id IS NULL THEN 'plan_not_registered' WHEN r.ts_ms > p.expires_ms THEN 'plan_expired'
  WHEN r.statements_hash <> p.statements_hash THEN 'statements_changed' WHEN trim(p.project) = '' OR p.project <> r.project THEN 'plan_scope_mismatch'
  WHEN p.role IS NULL THEN CASE WHEN p.registered_by <> r.user_id THEN 'principal_not_attested' END
  WHEN {_rank_sql("r.level", C.LEVEL_RANK)} < {_rank_sql("p.level", C.LEVEL_RANK)} THEN 'registered_at_more_permissive_level'
  WHEN {_rank_sql("r.role", C.ROLE_RANK)} < {_rank_sql("p.role", C.ROLE_RANK)} OR (p.registered_by <> r.user_id
    AND {_rank_sql("r.role", C.ROLE_RANK)} = {_rank_sql("p.role", C.ROLE_RANK)}) THEN 'runner_not_privileged' END AS why
  FROM plan_runs r LEFT JOIN plan_registrations p ON p.plan_id = r.plan_id),
w AS (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY ts_ms, run_id) AS pos FROM j),
e AS (SELECT *, min(CASE WHEN why IS NULL THEN pos END) OVER (PARTITION BY plan_id) AS used,
  min(CASE WHEN why = 'plan_expired' THEN pos END) OVER (PARTITION BY plan_id) AS gone FROM w),
f AS (SELECT run_id, CASE WHEN pos > used THEN 'plan_already_consumed' WHEN used IS NULL AND pos > gone THEN 'plan_not_registered' ELSE why END AS code FROM e)
SELECT run_id, code IS NULL AS ok, code FROM f""",
)
def authorise_plans(spark, sf_dir):
    runs, plans = view(spark, sf_dir, "plan_runs"), view(spark, sf_dir, "plan_registrations")
    return policy.authorise_plans(runs, plans).select("run_id", "ok", "code")


@query(
    "authorise_cancels",
    f"""{with_views("request_log")},
c AS (SELECT seq_id AS cancel_id, ts_ms, user_id, role, seq_id - 1 - k % 3 AS target_id FROM request_log WHERE action = 'cancel'),
j AS (SELECT c.*, t.user_id AS owner, t.role AS orole, coalesce(t.ts_ms <= c.ts_ms AND c.ts_ms < t.ts_ms + 1000 * t.duration_ms, false) AS running
  FROM c LEFT JOIN request_log t ON t.seq_id = c.target_id)
SELECT cancel_id, CASE WHEN role NOT IN ('admin', 'developer') THEN 'role_insufficient' WHEN NOT running THEN 'cancel_target_not_found'
  WHEN owner <> user_id AND NOT {_rank_sql("role", C.ROLE_RANK)} > {_rank_sql("orole", C.ROLE_RANK)} THEN 'cancel_not_permitted' ELSE 'allowed' END AS code,
  CASE WHEN running THEN owner END AS target_user_id FROM j""",
)
def authorise_cancels(spark, sf_dir):
    log = view(spark, sf_dir, "request_log")
    cancels = log.where("action = 'cancel'").selectExpr(
        "seq_id AS cancel_id", "ts_ms", "user_id", "role", "seq_id - 1 - k % 3 AS target_id"
    )
    requests = log.selectExpr("seq_id AS request_id", "ts_ms AS start_ms", "ts_ms + 1000 * duration_ms AS end_ms", "user_id", "role")
    return policy.authorise_cancels(cancels, requests).select("cancel_id", "code", "target_user_id")


APPROVAL_REQ = """SELECT seq_id AS request_id, user_id, ts_ms, concat('n', CAST(k AS VARCHAR(4))) AS nonce, role, k FROM [request_log] WHERE action = 'migration_run'"""
APPROVAL_RESP = """SELECT request_id, CASE WHEN k % 13 = 0 THEN user_id + 1 ELSE user_id END AS user_id, ts_ms + k * 1000 AS ts_ms,
  CASE WHEN k % 11 = 0 THEN 'wrong' ELSE nonce END AS nonce, k % 5 <> 0 AS approved, role FROM [approval_requests] WHERE k % 7 <> 0
UNION ALL SELECT request_id, user_id, ts_ms + 40000 AS ts_ms, nonce, k % 2 = 0 AS approved, role FROM [approval_requests] WHERE k % 3 = 0"""
define_view("approval_requests", APPROVAL_REQ, ("request_log",))
define_view("approval_responses", APPROVAL_RESP, ("approval_requests",))

APPROVALS_SQL = f"""{with_views("approval_requests", "approval_responses")},
v AS (SELECT q.request_id, r.ts_ms, r.approved, row_number() OVER (PARTITION BY q.request_id ORDER BY r.ts_ms, NOT r.approved) AS pos
  FROM approval_requests q JOIN approval_responses r ON r.request_id = q.request_id AND r.user_id = q.user_id AND r.nonce = q.nonce
  AND r.role IN ('admin', 'developer') AND r.ts_ms >= q.ts_ms AND r.ts_ms <= q.ts_ms + 60000)
SELECT q.request_id, CASE WHEN v.approved IS NULL THEN 'expired' WHEN v.approved THEN 'approved' ELSE 'rejected' END AS decision,
  v.ts_ms AS decided_ms FROM approval_requests q LEFT JOIN v ON v.request_id = q.request_id AND v.pos = 1"""


@query("match_approvals", APPROVALS_SQL)
def match_approvals(spark, sf_dir):
    requests, responses = view(spark, sf_dir, "approval_requests"), view(spark, sf_dir, "approval_responses")
    matched = policy.match_approvals(requests.select("request_id", "user_id", "ts_ms", "nonce"), responses)
    return matched.select("request_id", "decision", "decided_ms")


@query(
    "negotiated_roles",
    f"""{with_views("request_log")}, r AS (SELECT seq_id, CASE WHEN k % 9 = 0 THEN NULL ELSE [role, 'viewer', CASE WHEN k % 2 = 0 THEN 'admin' ELSE 'root' END] END AS asked,
  CASE WHEN k % 3 = 0 THEN 'admin' ELSE 'developer' END AS ceiling FROM request_log)
SELECT seq_id, concat_ws(',', CASE WHEN ceiling = 'admin' AND list_contains(asked, 'admin') THEN 'admin' END,
  CASE WHEN list_contains(asked, 'developer') THEN 'developer' END, CASE WHEN list_contains(asked, 'data_reader') THEN 'data_reader' END,
  CASE WHEN list_contains(asked, 'viewer') THEN 'viewer' END) AS accepted FROM r""",
)
def negotiated_roles(spark, sf_dir):
    asked = view(spark, sf_dir, "request_log").selectExpr(
        "seq_id", "CASE WHEN k % 9 = 0 THEN NULL ELSE array(role, 'viewer', CASE WHEN k % 2 = 0 THEN 'admin' ELSE 'root' END) END AS asked",
        "CASE WHEN k % 3 = 0 THEN 'admin' ELSE 'developer' END AS ceiling",
    )
    accepted = asked.select("seq_id", policy.negotiated_roles("asked", F.col("ceiling")))
    return accepted.withColumn("accepted", F.array_join("accepted", ","))


@query(
    "first_wins",
    f"""{with_views("function_refs")} SELECT name, stmt_id FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY stmt_id) AS pos
  FROM (SELECT CASE WHEN stmt_id % 2 = 0 THEN upper(name) ELSE name END AS name, stmt_id FROM function_refs) t) u WHERE pos = 1""",
)
def first_wins(spark, sf_dir):
    refs = view(spark, sf_dir, "function_refs").selectExpr("CASE WHEN stmt_id % 2 = 0 THEN upper(name) ELSE name END AS name", "stmt_id")
    return policy.first_wins(refs, "name", "stmt_id")


_FACTS = """SELECT seq_id, k % 5 = 0 AS rolsuper, CASE WHEN k % 7 = 0 THEN NULL ELSE k % 11 = 0 END AS rolcreatedb, false AS rolcreaterole, false AS rolreplication,
  k % 13 = 0 AS rolbypassrls, CASE WHEN k % 17 = 0 THEN NULL ELSE k % 3 = 0 END AS can_create_temp, k % 19 = 0 AS can_create_in_public,
  CASE WHEN k % 23 = 0 THEN NULL WHEN k % 4 = 0 THEN 'off' ELSE 'on' END AS default_transaction_read_only, k FROM [request_log]"""
define_view("role_facts", _FACTS, ("request_log",))


@query(
    "policy_findings",
    f"""{with_views("role_facts")} SELECT seq_id, concat_ws('; ', CASE WHEN rolsuper THEN 'rolsuper=true (expected false)' END,
  CASE WHEN rolcreatedb IS NULL THEN 'rolcreatedb could not be read' WHEN rolcreatedb THEN 'rolcreatedb=true (expected false)' END,
  CASE WHEN rolbypassrls THEN 'rolbypassrls=true (expected false)' END,
  CASE WHEN can_create_temp IS NULL THEN 'TEMP on database could not be read' WHEN can_create_temp THEN 'TEMP on database is granted' END,
  CASE WHEN can_create_in_public THEN 'CREATE on schema public is granted' END,
  CASE WHEN k % 6 = 0 THEN 'member of pg_monitor' END,
  CASE WHEN default_transaction_read_only IS NULL THEN 'default_transaction_read_only could not be read'
    WHEN default_transaction_read_only <> 'on' THEN 'default_transaction_read_only=off (expected on)' END) AS findings FROM role_facts""",
)
def policy_findings(spark, sf_dir):
    facts = view(spark, sf_dir, "role_facts").withColumn(
        "memberships", F.expr("CASE WHEN k % 6 = 0 THEN array('app_readers', 'pg_monitor') ELSE array('app_readers') END")
    )
    return policy.policy_findings(facts).select("seq_id", F.array_join("findings", "; ").alias("findings"))
