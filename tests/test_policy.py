"""Reason codes of the policy operators on hand-made rows."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.operators import aggregates, catalog, errors, filters, pages, policy, validity
from ledgerlens.plans import all_queries, fixtures, registry

REQUEST = (
    "role string, permission_level string, intent string, message_type string, type string, verb string, parse_ok boolean, statement_count int, "
    "read_violations array<string>, side_effects array<string>, "
    "function_effects array<struct<name: string, effect: string, resolved: boolean, side_effects: array<string>>>, plan_granted boolean, approved boolean"
)
BASE = dict(
    role="developer", permission_level="read_only", intent="read", message_type="query", type="read", verb="SELECT", parse_ok=True, statement_count=1,
    read_violations=[], side_effects=[], function_effects=[], plan_granted=None, approved=None,
)


def fn(name, effect="immutable", resolved=True, effects=()):
    return (name, effect, resolved, list(effects))


DECISIONS = [
    ({}, "allowed", None),
    ({"parse_ok": False}, "unparseable_statement", None),
    ({"statement_count": 0}, "unparseable_statement", None),
    ({"statement_count": 2}, "multiple_statements", None),
    ({"intent": "migration"}, "intent_not_applicable", None),
    ({"intent": "write"}, "intent_mismatch", None),
    ({"type": "write", "permission_level": "full"}, "allowed", None),  # a SELECT declared as a read
    ({"message_type": "migration_run", "role": "viewer", "intent": "migration"}, "role_insufficient", "Role 'viewer' cannot perform 'migration_run'"),
    ({"message_type": "cancel", "role": "nobody"}, "role_insufficient", None),
    ({"role": "viewer"}, "allowed", None),
    ({"role": "viewer", "type": "ddl", "intent": "ddl", "verb": "DROP"}, "role_insufficient", "Role 'viewer' cannot run 'ddl' statements"),
    ({"role": "viewer", "function_effects": None}, "role_insufficient", None),
    ({"type": "write", "intent": "write", "verb": "INSERT"}, "permission_denied", "Read-only mode: it is a 'write' statement (INSERT), not a read"),
    ({"read_violations": ["row_locking", "selects_into"]}, "permission_denied",
     "Read-only mode: it takes row locks (FOR UPDATE / FOR SHARE), which block other transactions; and it is a SELECT … INTO, which creates and populates a table"),
    ({"read_violations": ["denied_function", "side_effect"], "function_effects": [fn("pg_notify", "volatile", True, ["unknown_effect", "notified"])]},
     "permission_denied", "Read-only mode: it emits a NOTIFY, which is delivered outside the transaction"),
    ({"read_violations": ["side_effect"], "function_effects": [fn(n, "unknown", False, ["unknown_effect"]) for n in "abcda"]}, "permission_denied",
     "Read-only mode: pg_proc has no verdict for a(), b(), c() and 1 more, so the call cannot be proved harmless"),
    ({"read_violations": ["side_effect"], "function_effects": [fn("a", "volatile"), fn("b", "stable"), fn("c", "volatile")]}, "permission_denied",
     "Read-only mode: it calls a(), c(), which pg_proc reports as VOLATILE — it may do anything the calling role may do; and it calls b(), "
     "which pg_proc reports as STABLE — its result depends on the snapshot or the clock"),
    ({"side_effects": ["sequence"]}, "permission_denied", "Read-only mode: it advances a sequence, which persists past a rollback"),
    ({"permission_level": "auto_upgrade"}, "allowed", None),
    ({"permission_level": "auto_upgrade", "type": "ddl", "intent": "ddl", "plan_granted": True}, "auto_upgrade_granted", None),
    ({"permission_level": "auto_upgrade", "type": "ddl", "intent": "ddl"}, "plan_not_registered", None),
    ({"permission_level": "manual", "type": "ddl", "intent": "ddl", "approved": True}, "allowed", None),
    ({"permission_level": "manual", "type": "ddl", "intent": "ddl", "approved": False}, "permission_denied", None),
    ({"permission_level": "root"}, "permission_denied", "Invalid permission level 'root'"),
]


@pytest.mark.parametrize("table", [False, True])
def test_decide(spark, table):
    rows = [tuple((BASE | change).values()) + (i,) for i, (change, _, _) in enumerate(DECISIONS)]
    caps = policy.role_capabilities(spark) if table else None
    got = {r.i: r for r in policy.decide(spark.createDataFrame(rows, REQUEST + ", i int"), caps).collect()}
    for i, (change, code, reason) in enumerate(DECISIONS):
        assert got[i].code == code, change
        assert got[i].allowed == (code in ("allowed", "auto_upgrade_granted"))
        if reason:
            assert got[i].reason == reason


def test_missing_role_rules_refuse(spark):
    rows = spark.createDataFrame([tuple(BASE.values())], REQUEST)
    none = spark.createDataFrame([], "role string, capability string")
    assert policy.decide(rows, none).first().code == "role_insufficient"


CATALOG = [("pg_catalog", "f", "i", False, True), ("app", "f", "v", False, True), ("app", "g", "s", False, False), ("app", "g", "i", True, False), ("app", "x", "?", False, True)]


def test_function_effects(spark):
    names = ["f", "app.f", "pg_catalog.f", "g", "x", "nope", "app.nope", "pg_sleep", "information_schema.z", "a.b.c", ".f", "PG_TABLE_SIZE"]
    catalog_rows = spark.createDataFrame(CATALOG, "schema string, name string, provolatile string, prosecdef boolean, visible boolean")
    refs = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: (r.effect, r.resolved, r.qualified_name) for r in policy.function_effects(refs, catalog_rows).collect()}
    assert got["f"] == ("volatile", True, "app.f")
    assert got["app.f"] == ("volatile", True, "app.f")
    assert got["pg_catalog.f"] == ("immutable", True, "pg_catalog.f")
    assert got["g"] == ("security_definer", True, "app.g")
    assert got["x"] == ("unknown", True, "app.x")
    assert got["nope"] == ("immutable", True, "pg_catalog.nope")
    assert got["app.nope"] == ("unknown", False, "app.nope")
    assert got["pg_sleep"] == ("unknown", False, None)
    assert got["information_schema.z"] == ("immutable", True, "information_schema.z")
    assert got["PG_TABLE_SIZE"][0] == "immutable"
    closed = {r.name: r.resolved for r in policy.function_effects(refs, None).collect()}
    assert closed["app.f"] is False and closed["f"] is True


PLAN = dict(plan_id="p", expires_ms=100, statements_hash="h", registered_by="u", role="developer", level="manual", project="P", db_alias="D")
RUN = dict(run_id=1, plan_id="p", ts_ms=10, user_id="u", role="developer", level="manual", statements_hash="h", project=" P ", db_alias="D")
PLAN_SCHEMA = "plan_id string, expires_ms long, statements_hash string, registered_by string, role string, level string, project string, db_alias string"
RUN_SCHEMA = "run_id long, plan_id string, ts_ms long, user_id string, role string, level string, statements_hash string, project string, db_alias string"


def runs_of(spark, plan, *changes):
    plans = spark.createDataFrame([tuple((PLAN | plan).values())], PLAN_SCHEMA)
    rows = [tuple((RUN | {"run_id": i, "ts_ms": 10 + i} | c).values()) for i, c in enumerate(changes)]
    got = policy.authorise_plans(spark.createDataFrame(rows, RUN_SCHEMA), plans).orderBy("run_id").collect()
    return [r.code for r in got]


def test_plans(spark):
    assert runs_of(spark, {}, {}, {}, {"statements_hash": "x"}) == [None, "plan_already_consumed", "plan_already_consumed"]
    assert runs_of(spark, {}, {"statements_hash": "x"}, {"project": "Q"}, {"role": "viewer"}, {"level": "read_only"}, {"user_id": "v"}, {"user_id": "v", "role": "admin"}) == [
        "statements_changed", "plan_scope_mismatch", "runner_not_privileged", "registered_at_more_permissive_level", "runner_not_privileged", None]
    assert runs_of(spark, {}, {"ts_ms": 100}) == [None]
    assert runs_of(spark, {}, {"ts_ms": 101}, {"ts_ms": 102}, {"plan_id": "q"}) == ["plan_expired", "plan_not_registered", "plan_not_registered"]
    assert runs_of(spark, {"project": " "}, {"project": " "}) == ["plan_scope_mismatch"]
    assert runs_of(spark, {"role": None}, {"user_id": "v"}, {"role": "viewer"}) == ["principal_not_attested", None]
    assert runs_of(spark, {}, {"role": "guest"}) == ["runner_not_privileged"]


def test_cancels(spark):
    requests = spark.createDataFrame([(1, 0, 10, "u", "developer")], "request_id long, start_ms long, end_ms long, user_id string, role string")
    rows = [(0, 5, "u", "developer", 1), (1, 5, "v", "developer", 1), (2, 5, "v", "admin", 1), (3, 10, "u", "developer", 1), (4, 5, "u", "viewer", 1), (5, 5, "u", "admin", 9)]
    cancels = spark.createDataFrame(rows, "cancel_id long, ts_ms long, user_id string, role string, target_id long")
    got = [r.code for r in policy.authorise_cancels(cancels, requests).orderBy("cancel_id").collect()]
    assert got == ["allowed", "cancel_not_permitted", "allowed", "cancel_target_not_found", "role_insufficient", "cancel_target_not_found"]


def test_approvals_and_hot_request(spark):
    requests = spark.createDataFrame([(i, "u", 0, "n") for i in range(5)], "request_id long, user_id string, ts_ms long, nonce string")
    rows = [(0, "u", 60_000, "n", True, "admin"), (1, "u", 60_001, "n", True, "admin"), (2, "v", 1, "n", True, "admin"), (2, "u", 5, "n", True, "viewer"),
            (3, "u", 7, "n", False, "admin"), (3, "u", 9, "n", True, "admin")] + [(4, "u", i, "n", i > 3, "admin") for i in range(3000)]
    responses = spark.createDataFrame(rows, "request_id long, user_id string, ts_ms long, nonce string, approved boolean, role string")
    got = [(r.decision, r.decided_ms) for r in policy.match_approvals(requests, responses).orderBy("request_id").collect()]
    assert got == [("approved", 60_000), ("expired", None), ("expired", None), ("rejected", 7), ("rejected", 0)]
    assert (policy.approval_window(1), policy.approval_window(10**9)) == (5_000, 900_000)


def test_scope(spark):
    entries = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "a"), (None, "c")], "project_name string, db_alias string")
    def kept(*rules):
        df = spark.createDataFrame(list(rules), "project_name string, db_alias string")
        return sorted(map(str, policy.scope_filter(entries, df).toPandas().itertuples(index=False, name=None)))
    assert len(kept()) == 4 and len(kept((None, None))) == 4
    assert kept(("p", None)) == ["('p', 'a')", "('p', 'b')"]
    assert kept((None, "a"), ("p", "a")) == ["('p', 'a')", "('q', 'a')"]
    assert kept(("z", "z")) == []


def test_intersect_keeps_the_narrower_field(spark):
    make = lambda rows: spark.createDataFrame(rows, "project_name string, db_alias string")
    got = policy.intersect_rules(make([("A", "x"), (None, "y")]), make([("A", None), ("B", None)]))
    assert sorted(map(tuple, got.collect())) == [("A", "x"), ("A", "y"), ("B", "y")]


def test_intersect_equals_all_pairs(spark, capsys):
    rng = random.Random(8)
    def rules(n):
        return [(rng.choice([None, "p", "q", "r", "s"]), rng.choice([None, "x", "y", "z"])) for _ in range(n)]
    for sizes in ((6, 6), (1, 9), (12, 3), (0, 4)):
        a, b = rules(sizes[0]), rules(sizes[1])
        want = set()
        for p, d in a:
            for r, e in b:
                if (p is None or r is None or p == r) and (d is None or e is None or d == e):
                    want.add((p if p is not None else r, d if d is not None else e))
        make = lambda rows: spark.createDataFrame(rows, "project_name string, db_alias string")
        merged = policy.intersect_rules(make(a), make(b))
        assert set(map(tuple, merged.collect())) == want - {(None, None)}
    merged.explain("simple")
    assert "NestedLoop" not in capsys.readouterr().out


def test_percentiles_and_rolled_up_sketches(spark):
    """Exact up to the sketch's size, within its rank error beyond, and the same from parts as from the whole."""
    rng = random.Random(2)
    rows = [(i % 7, f"SELECT a FROM t{i % 2} WHERE x = {i}", rng.randrange(10_000) if i % 11 else None, "error" if i % 5 == 0 else "success", i) for i in range(6000)]
    log = spark.createDataFrame(rows, "day int, sql_text string, duration_ms long, outcome string, ts_ms long")
    whole = {r.fingerprint: r for r in aggregates.statement_rollup(log).collect()}
    merged = {r.fingerprint: r for r in aggregates.merge_traffic(aggregates.statement_traffic(log, ["day"])).collect()}
    assert whole == merged and len(whole) == 2
    for shape in (0, 1):
        values = sorted(r[2] for r in rows if r[4] % 2 == shape and r[2] is not None)
        found = next(r for r in whole.values() if r.first_ms == shape)
        assert (found.calls, found.total_ms, found.max_ms) == (3000, sum(values), values[-1])
        assert (found.p50_ms, found.p95_ms, found.p99_ms) == tuple(values[-(-len(values) * p // 100) - 1] for p in (50, 95, 99))
    rough = aggregates.merge_traffic(aggregates.statement_traffic(log, ["day"], size=64)).collect()
    for found in rough:
        values = sorted(r[2] for r in rows if r[4] % 2 == found.first_ms and r[2] is not None)
        for p, value in ((0.5, found.p50_ms), (0.95, found.p95_ms), (0.99, found.p99_ms)):
            assert abs(bisect.bisect_right(values, value) / len(values) - p) < 0.08
    none = aggregates.statement_rollup(log.withColumn("duration_ms", F.lit(None).cast("long"))).first()
    assert (none.p50_ms, none.p99_ms) == (None, None)


def test_key_members_may_hold_commas(spark):
    constraints = spark.createDataFrame([("s", "t", "pk", "PRIMARY KEY"), ("s", "t", "uq", "UNIQUE")], "table_schema string, table_name string, constraint_name string, constraint_type string")
    usage = spark.createDataFrame([("s", "pk", "a,b", 1), ("s", "uq", "c", 2), ("s", "uq", "a,b", 1)], "table_schema string, constraint_name string, column_name string, ordinal_position int")
    columns = spark.createDataFrame([("s", "t", c) for c in ("a,b", "c", "a")], "table_schema string, table_name string, column_name string")
    got = catalog.key_flags(columns, catalog.key_columns(constraints, usage)).collect()
    assert {r.column_name: (r.is_primary_key, r.is_unique) for r in got} == {"a,b": (True, True), "c": (False, True), "a": (False, False)}


def test_large_catalogs_are_dealt_by_their_size(spark, sf_dir, monkeypatch):
    """Joins over many columns get as many tasks as the rows need, and give the same rows."""
    all_queries.load()
    names = ("key_columns", "key_flags", "foreign_keys")
    plain = {n: sorted(map(tuple, registry.QUERIES[n](spark, sf_dir).collect()), key=str) for n in names}
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    tasks = fixtures.column_tasks(spark, sf_dir)
    assert tasks == -(-session.read_table(spark, sf_dir, "lineitem").count() // 500) > 8
    for name in names:
        found = registry.QUERIES[name](spark, sf_dir)
        assert found.rdd.getNumPartitions() == tasks, name
        assert sorted(map(tuple, found.collect()), key=str) == plain[name]


def test_findings(spark):
    schema = "rolsuper boolean, rolcreatedb boolean, rolcreaterole boolean, rolreplication boolean, rolbypassrls boolean, can_create_temp boolean, can_create_in_public boolean, memberships array<string>, default_transaction_read_only string"
    good = (False,) * 7 + ([], "on")
    bad = (True, None, False, False, False, True, None, ["pg_monitor", "x", "pg_read_all_data"], "off")
    got = [r.findings for r in policy.policy_findings(spark.createDataFrame([good, bad], schema)).collect()]
    assert got[0] == []
    assert got[1] == ["rolsuper=true (expected false)", "rolcreatedb could not be read", "TEMP on database is granted", "CREATE on schema public could not be read",
                      "member of pg_monitor, pg_read_all_data", "default_transaction_read_only=off (expected on)"]


def test_errors(spark):
    rows = [
        (0, "23505", "error", 'duplicate key in "users"', "Key (email)=(a@b.co) exists", False), (1, "23505", None, "'open", None, False),
        (2, "99999", "fatal", "secret", "secret", False), (3, None, "x", None, None, False), (4, "auth_failed", None, "host=x", None, True),
        (5, "odd", None, "x", None, True), (6, "40001", "ERROR", "w" * 600, None, False), (7, "free text!", "ERROR", None, None, False),
    ]
    df = spark.createDataFrame(rows, "i int, code string, severity string, message string, detail string, pool boolean")
    got = {r.i: r for r in errors.explain_errors(df, errors.code_table(spark), pool="pool").collect()}
    assert got[0].message == 'A unique constraint was violated: the row already exists. duplicate key in "?" Key (email)= (?) exists'
    assert got[0].hint.startswith("A row with the same value") and not got[0].retryable
    assert got[1].message == "A unique constraint was violated: the row already exists." and got[1].severity == "ERROR"
    assert got[2].message.startswith("Database error (99999). The database rejected") and got[2].severity == "FATAL" and got[2].hint is None
    assert got[3].code == "UNKNOWN" and got[4].message == "PostgreSQL rejected the credentials for this database."
    assert got[5].message == "The agent could not use this database connection."
    assert got[6].retryable and len(got[6].message) == 401 and got[6].message.endswith("…")
    assert got[7].audit_code == "INTERNAL"


def test_validity_shapes(spark):
    hosts = {"a": True, "a-b.c9": True, "-a": False, "a..b": False, "a" * 64: False, "10.0.0.1": True, "010.0.0.1": True, "::1": True, "2001:db8::8a2e:370:7334": True, "1::2::3": False, "fe80::1%eth0": True, "a b": False, "": False}
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = {r.h: r.ok for r in df.select("h", validity.sure(validity.is_host("h")).alias("ok")).collect()}
    assert got == hosts
    times = {"2024-02-29T00:00:00Z": True, "2023-02-29T00:00:00Z": False, "2024-01-01T00:00:00.5+02:00": True, "2024-01-01 00:00:00Z": False}
    df = spark.createDataFrame([(t,) for t in times], "t string")
    assert {r.t: r.ok for r in df.select("t", validity.sure(validity.is_instant("t")).alias("ok")).collect()} == times


def test_filters_and_bounds(spark):
    now = dt.datetime(2024, 5, 6, 7, 8, 9)
    assert filters.since_bound("today", now) == dt.datetime(2024, 5, 6)
    assert filters.since_bound(" 15 Mins ", now) == now - dt.timedelta(minutes=15)
    assert filters.since_bound("2w", now) == now - dt.timedelta(weeks=2)
    assert filters.since_bound("2024-01-02T03:04:05+01:00", now) == dt.datetime(2024, 1, 2, 2, 4, 5)
    assert filters.since_bound("soon", now) is None and filters.since_bound("", now) is None
    df = spark.createDataFrame([(i, "P", dt.datetime(2024, 1, 1, i)) for i in range(5)], "i int, project string, ts timestamp_ntz")
    low, high = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 3)
    assert [r.i for r in filters.audit_filter(df, project="p", since=low, until=high).orderBy("i").collect()] == [1, 2, 3]
    page = filters.audit_query(df, {"project": "P"}, ["i"], 1, since=low, until=high).collect()
    assert [(r.i, r.total) for r in page] == [(1, 2)]
    assert filters.audit_query(df, {"project": "p"}, ["i"]).count() == 0


def test_pages(spark):
    df = spark.range(120)
    def page(*cursor, size=None):
        rows = pages.keyset_page(df, pages.Cursor("id", *cursor), size).collect()
        return [r.id for r in rows], rows[0].has_more if rows else None, rows[0].next_value if rows else None
    assert page(9, size=3) == ([10, 11, 12], True, 12)
    assert page(5, "backward", size=10) == ([4, 3, 2, 1, 0], False, None)
    assert page(69) == (list(range(70, 120)), False, None)
    assert page(200) == ([], None, None)
    rows, more, after = pages.fetch_page(df, pages.Cursor("id", 9), 3)
    assert [r.id for r in rows] == [10, 11, 12] and more and after.last_value == 12
    assert pages.page_size_of(0) == 1 and pages.page_size_of(10**6) == 1000
    with pytest.raises(ValueError):
        pages.keyset_page(df, pages.Cursor("id", None))
    assert pages.capped(df, 120).count() == 120
    with pytest.raises(Exception, match="result exceeds 119 rows"):
        pages.capped(df, 119).collect()
    with pytest.raises(pages.RowCapExceeded):
        pages.check_cap(df, 100)
    assert [r.id for r in pages.tail_n(df, ["id"], 2).collect()] == [118, 119]


def test_plan_outcomes(spark):
    rows = [("a", 0, "single_tx", "success", 1, None), ("a", 1, "single_tx", "failed", 2, "42P01"), ("b", 0, "per_statement", "success", 1, None),
            ("b", 1, "per_statement", "failed", 2, "odd"), ("c", 0, "single_tx", "success", 3, None), ("d", 0, "single_tx", "failed", 3, None)]
    df = spark.createDataFrame(rows, "plan_id string, idx int, strategy string, status string, ms long, pg_error_code string")
    got = {r.plan_id: (r.status, r.error_code, r.rolled_back_indices) for r in aggregates.plan_outcome(df).collect()}
    assert got == {"a": ("rolled_back", "42P01", [0]), "b": ("partial", None, []), "c": ("committed", None, []), "d": ("rolled_back", None, [])}


def test_snapshot_diff_and_constraints(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, None, 1)], "k int, v string, w int")
    new = spark.createDataFrame([(1, "a", None), (2, "c", None), (4, "x", 1)], "k int, v string, w int")
    got = {r.k: r.state for r in catalog.snapshot_diff(old, new, ["k"], ["v", "w"]).collect()}
    assert got == {1: "same", 2: "changed", 3: "removed", 4: "added"}
    check = catalog.constraint_check
    assert check(old.union(old), "unique", ["k", "v"]).count() == 2
    assert [r.k for r in check(old, "foreign_key", ["k"], (new, ["k"])).collect()] == [3]
    assert [r.k for r in check(old, "not_null", ["v"]).collect()] == [3]
    assert [r.k for r in check(old, "check", check=F.col("w") > 1).collect()] == [3]


def test_mask_and_roles(spark):
    df = spark.createDataFrame([("admin", "d", "x"), ("viewer", "d", "x"), (None, "d", "x")], "role string, definition string, kind string")
    got = [(r.role, r.definition) for r in filters.mask_by_role(df, "role", blank=["definition"]).collect()]
    assert got == [("admin", "d"), ("viewer", ""), (None, "")]
    assert filters.mask_by_role(df, "role", only_full=F.col("kind") == "x").count() == 1
    asked = spark.createDataFrame([(["viewer", "root", "admin", "developer"],), ([],), (None,)], "a array<string>")
    assert [r.accepted for r in asked.select(policy.negotiated_roles("a")).collect()] == [["developer", "viewer"], [], []]


def test_large_parents_come_in_parts(spark):
    parents = spark.createDataFrame([("s", "hot"), ("s", "small"), ("s", "none")], "table_schema string, table_name string")
    columns = spark.range(1003).selectExpr("'s' AS table_schema", "CASE WHEN id < 1000 THEN 'hot' ELSE 'small' END AS table_name", "CAST(id AS INT) AS ordinal", "concat('c', id) AS column_name")
    orphan = spark.createDataFrame([("s", "gone", 1, "x")], columns.schema)
    indexes = spark.createDataFrame([("s", "hot", "i_pkey", 'CREATE UNIQUE INDEX i ON hot (a, "b")')], "table_schema string, table_name string, indexname string, indexdef string")
    children = {"columns": (columns.union(orphan), ["ordinal", "column_name"]), "indexes": (indexes.withColumns(catalog.index_columns()), ["indexname", "columns", "is_unique", "is_primary"])}
    rows = catalog.nest(parents, children, part_rows=100).collect()
    hot = [r for r in rows if r.table_name == "hot"]
    assert sorted(r.part for r in hot) == list(range(10))
    assert sorted(c.ordinal for r in hot for c in r.columns) == list(range(1000))
    assert all([c.ordinal for c in r.columns] == sorted(c.ordinal for c in r.columns) for r in hot)
    assert [(i.indexname, i.columns, i.is_unique, i.is_primary) for r in hot for i in r.indexes] == [("i_pkey", ["a", "b"], True, True)]
    rest = {r.table_name: (r.part, [c.ordinal for c in r.columns], r.indexes) for r in rows if r.table_name != "hot"}
    assert rest == {"small": (0, [1000, 1001, 1002], []), "none": (0, [], [])}


def test_payload_rules(spark):
    ok = dict(id="m", type="query", project="p", user_id="u", role="admin", db_alias="d", ts=5, nonce=None, mac=None)
    changes = [{}, {"id": ""}, {"type": "x"}, {"project": "p" * 65}, {"user_id": None}, {"role": "root"}, {"db_alias": None}, {"ts": 0}, {"nonce": "short"}, {"mac": "A" * 64}]
    schema = "id string, type string, project string, user_id string, role string, db_alias string, ts long, nonce string, mac string"
    df = spark.createDataFrame([tuple((ok | c).values()) + (i,) for i, c in enumerate(changes)], schema + ", row_id int")
    bad = validity.validity_report(df, "row_id", validity.envelope_rules()).where("NOT ok").collect()
    assert sorted((r.row_id, r.rule) for r in bad) == [(i, next(iter(c))) for i, c in enumerate(changes) if c]
    plans = spark.createDataFrame(
        [(0, "p", ["a"], "single_tx", None, True), (1, "", [], "both", 0, None), (2, "p", ["a", " "], "per_statement", 5, False)],
        "row_id int, plan_id string, statements array<string>, strategy string, timeout_ms int, dry_run boolean",
    )
    bad = validity.validity_report(plans, "row_id", validity.plan_rules()).where("NOT ok").collect()
    assert sorted((r.row_id, r.rule) for r in bad) == [(1, "dry_run"), (1, "plan_id"), (1, "statements"), (1, "strategy"), (1, "timeout_ms"), (2, "statement_text")]
    results = spark.createDataFrame([(0, "p", "partial", ["failed"], 1), (1, "p", "done", ["odd"], -1)], "row_id int, plan_id string, status string, statement_statuses array<string>, total_ms long")
    bad = validity.validity_report(results, "row_id", validity.result_rules()).where("NOT ok").collect()
    assert sorted(r.rule for r in bad) == ["statement_status", "status", "total_ms"]
    twice = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "row_id int, db_alias string")
    assert sorted((r.row_id, r.ok) for r in validity.duplicate_report(twice, "row_id", ["db_alias"]).collect()) == [(1, True), (2, True), (3, False)]


def test_parts_are_ranges_of_the_ordered_list(spark):
    parents = spark.createDataFrame([("s", "hot"), ("s", "none")], "table_schema string, table_name string")
    columns = spark.range(1000).selectExpr("'s' AS table_schema", "'hot' AS table_name", "CAST((id * 7 % 1000) div 250 * 10 AS INT) AS ordinal", "CASE WHEN id % 2 = 0 THEN 'c' END AS column_name")
    rows = catalog.nest(parents, {"columns": (columns, ["ordinal", "column_name"])}, part_rows=100).collect()
    hot = sorted((r for r in rows if r.table_name == "hot"), key=lambda r: r.part)
    assert [r.part for r in hot] == list(range(10)) and all(len(r.columns) == 100 for r in hot)
    wanted = sorted(((r.ordinal, r.column_name) for r in columns.collect()), key=lambda c: (c[0], c[1] is not None))
    assert sorted(((c.ordinal, c.column_name) for r in hot for c in r.columns), key=str) == sorted(wanted, key=str)
    listed = [c.ordinal for r in hot for c in r.columns]
    assert listed == sorted(listed) and [(r.part, r.columns) for r in rows if r.table_name == "none"] == [(0, [])]
