"""Redaction, fingerprints, previews, scrubbing and classes on hand-made text."""

import hashlib
import hmac as py_hmac
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import classes, mac, redaction, scrubbing
from ledgerlens.functions.register import register
from ledgerlens.operators import text_jobs

MARK = redaction.UNREDACTABLE

REDACTED = [
    ("SELECT 1", "SELECT 1"),
    ("LIMIT 10 5", "LIMIT ? ?"),
    ("a = 1 AND b=12.5e3", "a = ? AND b=?"),
    ("IN (1, 2)", "IN (?, ?)"),
    ("$1, a-1, t.1, 1.5x, 10 1 2, x1, -3", "$1, a-?, t.?, 1.5x, ? ? ?, x1, -?"),
    ("1 2", "1 2"),
    ("1e5 1e 5.", "? 1e ?"),
    ("x[3]", "x[?]"),
    ("'it''s' \"a\"\"b\"", "'?' \"?\""),
    ("E'a\\'b'", "E'?'"),
    ("xE'a\\'", "xE'?'"),
    ("xE'a\\'b'", MARK),
    ("E'a\\", MARK),
    ("U&'\\0041' U&\"c\\\"d\"", "U&'?' U&\"?\""),
    ("$$b 'x'$$ $t$ a $x$ b $t$", "$$?$$ $t$?$t$"),
    ("$a$b$ c $b$", MARK),
    ("a /* x /* y */ z */b", "a b"),
    ("/* a /* b */", MARK),
    ("/*/", MARK),
    ("/**/x", "x"),
    ("a--b\nc", "a\nc"),
    ("a--b", "a"),
    ("'open", MARK),
    ('"open', MARK),
    ("'say \"hi\"' \"it's\"", "'?' \"?\""),
    ("'a'/*c*/'b'--x\n'c'", "'?''?'\n'?'"),
    ("# 5 not a comment", "# 5 not a comment"),
    ("Key (email)=(a@x.com) exists", "Key (email)= (?) exists"),
    ("a / b - c $ d", "a / b - c $ d"),
    ("", ""),
    ("x" * 1_048_577, MARK),
    ("'" + "q" * 1_000_000 + "'", "'?'"),
    ("'" + "''" * 300_000 + "'", "'?'"),
    ("-- " + "e" * 500_000 + "\nE'x'", "\nE'?'"),
    ("/*" * 8 + "*/" * 8 + "a", "a"),
    ("/*" * 9 + "*/" * 9 + "a", "a"),
    ("nul \0 here", MARK),
]


def test_redaction(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(REDACTED)], "i int, sql string")
    got = {r.i: r.redacted for r in text_jobs.redact_statements(df).collect()}
    wrong = [(s[:60], got[i][:60], want[:60]) for i, (s, want) in enumerate(REDACTED) if got[i] != want]
    assert not wrong


def fingerprints(spark, *texts, salt="s"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, sql string")
    return [r.fingerprint for r in text_jobs.fingerprint_statements(df, salt=salt).orderBy("i").collect()]


def test_fingerprint_names_the_shape_not_the_values(spark):
    a, b, c, d, e, f, g = fingerprints(
        spark, "SELECT *  FROM t WHERE a = 12;", "select * from t /* x */ where a = 99", 'SELECT "alpha"', 'SELECT "beta"',
        'select  "alpha" ;', 'SELECT U&"alpha"', "'open",
    )
    assert a == b
    assert c != d and c == e and c == f
    assert g == hashlib.sha256(MARK.encode()).hexdigest()[:16]


def test_fingerprint_is_keyed_by_the_salt(spark):
    assert fingerprints(spark, 'SELECT "alpha"', salt="x") != fingerprints(spark, 'SELECT "alpha"', salt="y")
    assert fingerprints(spark, "SELECT 1", salt="x") == fingerprints(spark, "SELECT 1", salt="y")


def test_fingerprint_of_plain_text_is_sha256_of_the_normal_form(spark):
    (a,) = fingerprints(spark, " SELECT  x FROM t WHERE id = 77 ; ")
    assert a == hashlib.sha256(b"select x from t where id = ?").hexdigest()[:16]


@pytest.mark.parametrize(
    ("text", "length", "cut"),
    [("a" * 200, 200, False), ("a" * 201, 201, True), ("漢" * 170, 170, False), ("漢" * 171, 171, True), ("😀" * 100, 100, False), ("😀" * 101, 101, True), ("é" * 200, 200, False)],
)
def test_preview_caps_units_and_bytes(spark, text, length, cut):
    df = spark.createDataFrame([(f"  {text}\n",)], "sql string")
    (row,) = text_jobs.preview_statements(df).collect()
    assert len(row.preview) == length and row.preview.endswith("…") == cut
    assert len(row.preview.rstrip("…").encode()) <= 512


def test_hmac_and_canonical_text(spark):
    df = spark.createDataFrame([("é\n\"x\"", None, 5)], "b string, a string, c long")
    for key in (b"k", b"x" * 64, b"long" * 40):
        row = df.select(F.expr(mac.canonical_json(["c", "b", "a"])).alias("t"), F.expr(mac.hmac_sha256(mac.canonical_json(["c", "b", "a"]), key)).alias("m")).first()
        assert row.t == '{"b":"é\\n\\"x\\"","c":5}'
        assert row.m == py_hmac.new(key, row.t.encode(), "sha256").hexdigest()


def test_canonical_line_sorts_keys_and_drops_the_mac(spark):
    raw = '{"z":1,"mac":"ab","b":{"y":[3,null],"x":"q"},"a":null,"hash":"ab"}'
    df = spark.createDataFrame([(raw,), ('{"mac":"x","a":2}',), ('{"hash":"x","mac":"y"}',)], "raw string")
    got = [r.c for r in df.select(F.expr(mac.canonical_line("raw")).alias("c")).collect()]
    assert got == ['{"a":null,"b":{"x":"q","y":[3,null]},"z":1}', '{"a":2}', "{}"]


SCRUBBED = [
    ("see postgres://u:p@h:5432/db now", "see <url> now"),
    ("password = 'a b' PASSWORD=x", "password=<redacted> PASSWORD=<redacted>"),
    ("host=db.local dbname: acme", "host=<redacted> dbname=<redacted>"),
    ('no role "bob" here', "no role <redacted> here"),
    ("granted by role bob, ok", "granted by role <redacted>, ok"),
    ("at [::1]:5432 or 10.0.0.1:99", "at <host> or <host>"),
    ("x:5432 y:1", "x:<port> y:1"),
    ("open /var/lib/x and /one", "open <path> and /one"),
    ("mail a.b@c.example.org, z@w", "mail <email>, z@w"),
    ("a@b.c_d@e.f", "<email><email>"),
    ("to db.internal:7", "to <host>"),
    ("  two   blanks\t\there ", "two blanks here"),
    ("secret acme and acme-db", "secret <redacted> and <redacted>"),
    ("", ""),
]


def test_scrub_rules_in_order(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(SCRUBBED)], "i int, text string")
    terms = ["acme", "acme-db", "xy"]
    staged = {r.i: r.scrubbed for r in text_jobs.scrub_text(df, exact_terms=terms).collect()}
    single = {r.i: r.s for r in df.select("i", F.expr(scrubbing.scrub("text", terms)).alias("s")).collect()}
    assert staged == single
    assert [staged[i] for i in range(len(SCRUBBED))] == [want for _, want in SCRUBBED]


def test_scrub_errors(spark):
    text = 'Key (a)=(b) "v" \'w\' C:\\Users\\bob\\x.txt D:\\ /home/ann/a/b.js /srv/n/node_modules/p/i.js /root/ok/z /one ' + "x" * 600
    df = spark.createDataFrame([(text, None)], "message string, stack string")
    row = text_jobs.scrub_errors(df, homes=["/root/"]).first()
    start = 'Key (a)=(?) "?" \'?\' <path><path>/bob/x.txt <path>/D: <path>/a/b.js node_modules/p/i.js ~/ok/z /one '
    assert row.message.startswith(start) and row.message.endswith("…") and len(row.message) == 501
    assert row.stack is None


def test_sql_functions_match_the_jobs(spark):
    names = register(spark, b"key")
    assert {"redact_sql", "fingerprint_sql", "preview_sql", "scrub_text", "mask_credentials", "record_mac"} <= set(names)
    row = spark.sql(
        "SELECT redact_sql('a = 12') r, preview_sql(' b = 12 ') p, fingerprint_sql('A  = 3') f, scrub_text('x@y.zz') s, "
        "mask_credentials('pg://u:p@h') m, record_mac('t') h"
    ).first()
    assert (row.r, row.p, row.s, row.m) == ("a = ?", "b = ?", "<email>", "pg://u:***@h")
    assert row.h == py_hmac.new(b"key", b"t", "sha256").hexdigest()


CLASSES = [
    # sql, type, verb, count, violations
    ("SELECT 1", "read", "SELECT", 1, []),
    ("  /* hi */ select a from b; -- end", "read", "SELECT", 1, []),
    ("SHOW search_path", "read", "SHOW", 1, []),
    ("VALUES (1)", "read", "SELECT", 1, []),
    ("insert into t select 1", "write", "INSERT", 1, []),
    ("WITH a AS (SELECT 1) SELECT * FROM a", "read", "SELECT", 1, []),
    ("WITH a AS (SELECT f((1))) INSERT INTO t SELECT * FROM a", "write", "INSERT", 1, []),
    ("WITH d AS (DELETE FROM t RETURNING *) SELECT * FROM d", "write", "SELECT", 1, ["writable_cte"]),
    ("SELECT * INTO x FROM t", "write", "SELECT", 1, ["selects_into"]),
    ("SELECT * FROM t FOR NO KEY UPDATE", "write", "SELECT", 1, ["row_locking"]),
    ("SELECT pg_read_file('x')", "write", "SELECT", 1, ["denied_function"]),
    ("SELECT app.my_exec(1)", "write", "SELECT", 1, ["denied_function"]),
    ("SELECT 'pg_sleep(1); DROP TABLE t'", "read", "SELECT", 1, []),
    ("SELECT 1; DROP TABLE t; ", "ddl", "DROP", 2, ["multiple_statements"]),
    ("SELECT 1; SELECT 2", "read", "SELECT", 2, ["multiple_statements"]),
    ("EXPLAIN SELECT 1", "read", "EXPLAIN", 1, []),
    ("EXPLAIN (ANALYZE, BUFFERS) DELETE FROM t", "write", "DELETE", 1, ["executable_block"]),
    ("EXPLAIN DELETE FROM t", "write", "DELETE", 1, []),
    ("DO $$ BEGIN END $$", "ddl", "DO", 1, ["executable_block"]),
    ("CALL p()", "ddl", "CALL", 1, ["executable_block"]),
    ("COPY t FROM STDIN", "write", "COPY", 1, []),
    ("COPY (SELECT 1) TO STDOUT", "read", "COPY", 1, []),
    ("COPY t TO PROGRAM 'x'", "ddl", "COPY", 1, ["executable_block"]),
    ("COPY t TO '/tmp/x'", "ddl", "COPY", 1, []),
    ("CREATE UNIQUE INDEX i ON t (a)", "ddl", "CREATE INDEX", 1, []),
    ("CREATE TABLE x AS SELECT 1", "ddl", "CREATE TABLE AS", 1, []),
    ("CREATE TABLE x (a int)", "ddl", "CREATE", 1, []),
    ("GRANT SELECT ON t TO r", "ddl", "GRANT", 1, []),
    ("GRANT admin TO r", "ddl", "GRANT ROLE", 1, []),
    ("VACUUM t", "utility", "VACUUM", 1, []),
    ("SET a = 1", "utility", "SET", 1, []),
    ("SET LOCAL ROLE x", "ddl", "SET", 1, ["executable_block"]),
    ("SET TRANSACTION READ WRITE", "ddl", "SET", 1, ["executable_block"]),
    ("BEGIN", "utility", "TRANSACTION", 1, []),
    ("FETCH 1 FROM c", "unknown", "", 1, ["executable_block"]),
    ("CREATE DATABASE d", "unknown", "DATABASE", 1, ["executable_block"]),
    ("-- nothing", "unknown", "", 0, ["parse_error"]),
    ("SELECT 'open", "unknown", "", 0, ["parse_error"]),
]


def test_classes(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CLASSES)], "i int, sql string")
    got = {r.i: (r.type, r.verb, r.statement_count, r.read_violations) for r in text_jobs.classify_statements(df).collect()}
    wrong = [(c[0], got[i], c[1:]) for i, c in enumerate(CLASSES) if got[i] != (c[1], c[2], c[3], c[4])]
    assert not wrong


def test_main_verb_behind_deep_parentheses(spark):
    deep = f"WITH d AS (SELECT {'(' * 30}1{')' * 30}) DELETE FROM t"
    got = spark.createDataFrame([(deep.lower(),), ("with d as (select 1 delete from t",)], "s string").selectExpr(f"{classes.main_text('s')} AS m")
    assert [r.m for r in got.collect()] == ["delete from t", ""]


def test_called_functions(spark):
    df = spark.createDataFrame([("SELECT count(*), app.f (x) FROM g(1) WHERE a IN (1) AND lower(b) = upper(lower(c))",), ("INSERT INTO t (a) VALUES (now())",)], "sql string")
    got = [sorted(r.functions) for r in text_jobs.classify_statements(df).collect()]
    assert got == [["app.f", "count", "g", "lower", "upper"], ["now"]]


def test_non_transactional(spark):
    rows = [
        ("CREATE INDEX CONCURRENTLY i ON t (a)", "non_transactional"), ("CREATE INDEX i ON t (a)", "transactional"),
        ("DROP INDEX CONCURRENTLY i", "non_transactional"), ("DROP TABLE t", "transactional"), ("VACUUM", "non_transactional"),
        ("ALTER TABLE t SET TABLESPACE x", "non_transactional"), ("ALTER TABLE t ADD c int", "transactional"),
        ("SELECT 1; SELECT 2", "ambiguous"), ("", "ambiguous"), ("'x", "unparseable"), ("EXPLAIN SELECT 1", "ambiguous"),
        ("COMMIT", "non_transactional"), ("INSERT INTO t VALUES (1)", "transactional"), ("frobnicate", "ambiguous"),
    ]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(rows)], "i int, sql string")
    got = {r.i: r.tx_status for r in text_jobs.non_transactional(df).collect()}
    assert [got[i] for i in range(len(rows))] == [want for _, want in rows]


def test_plans_that_are_refused_keep_a_row(spark):
    df = spark.range(501).selectExpr("1 AS plan_id", "CAST(id AS INT) AS idx", "'x' AS sql").union(
        spark.createDataFrame([(2, 1, " B  c "), (2, 0, "A"), (None, 0, "A")], "plan_id int, idx int, sql string")
    )
    rows = {r.plan_id: (r.statements_hash, r.plan_status) for r in text_jobs.plan_hash(df).collect()}
    accepted = (hashlib.sha256(b"1:a|3:b c").hexdigest(), "accepted")
    assert rows == {1: (None, "too_many_statements"), 2: accepted, None: (None, "no_plan_id")}
    rows = {r.plan_id: (r.ambiguous_indices, r.has_non_transactional) for r in text_jobs.plan_transactionality(df).collect()}
    assert rows == {1: (None, True), 2: ([0, 1], True), None: (None, True)}


def test_cells_and_row_sizes(spark):
    df = spark.createDataFrame([("x" * 30, [1, 2], True, None), ("é", None, None, 7)], "s string, a array<int>, b boolean, n long")
    small, big = sorted(text_jobs.truncate_cells(df, 20, 5).collect(), key=lambda r: r.has_truncated_cells)
    assert big.s.truncated and big.s.original_size == 30 and big.s.preview == "xxxxx" and big.s.value is None
    assert small.s.value == "é" and not small.has_truncated_cells
    assert sorted(r.row_bytes for r in text_jobs.row_bytes(df).collect()) == [2 + 4 + 4 + 8, 30 + 5 + 1 + 4]
    assert text_jobs.within_budget(df, 57).first().allowed is False


# --- comments of any depth ----------------------------------------------------------------------


def comments_by_hand(sql):
    """Positions of the block comments, or None where something does not end; one character after the other."""
    found, i, n = [], 0, len(sql)
    while i < n:
        if sql.startswith("--", i):
            end = sql.find("\n", i)
            i = n if end < 0 else end
        elif sql.startswith("/*", i):
            depth, at = 1, i + 2
            while depth and at < n:
                if sql.startswith("/*", at) or sql.startswith("*/", at):
                    depth += 1 if sql[at] == "/" else -1
                    at += 2
                else:
                    at += 1
            if depth:
                return None
            found.append((i + 1, at + 1))
            i = at
        elif sql[i] in "'\"":
            before = sql[max(0, i - 3) : i]
            escapes = re.search(r"(?:^|[^A-Za-z0-9_$])[Uu]&$" if sql[i] == '"' else r"(?:^|[^A-Za-z0-9_$])(?:[Ee]|[Uu]&)$", before)
            quote, at = sql[i], i + 1
            while at < n:
                if escapes and sql[at] == "\\":
                    at += 2
                elif sql[at] == quote and sql[at + 1 : at + 2] == quote:
                    at += 2
                elif sql[at] == quote:
                    break
                else:
                    at += 1
            if at >= n:
                return None
            i = at + 1
        elif tag := re.match(r"\$(?:[A-Za-z_][A-Za-z0-9_]*)?\$", sql[i:]):
            end = sql.find(tag[0], i + len(tag[0]))
            if end < 0:
                return None
            i = end + len(tag[0])
        else:
            i += 1
    return found


def test_block_comments_are_found_at_any_depth(spark):
    rng = random.Random(12)
    pieces = ["/*", "*/", "/*", "*/", "'", '"', "\\", "--", "\n", "$", "$q$", "E'", "xE'", "U&'", 'u&"', "a", " ", "é𝒳", "*", "/", "-", "1"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 24))) for _ in range(4000)]
    texts += ["/*" * n + " it's " + "*/" * n + "'x'" for n in (1, 8, 9, 50, 400)] + ["/*" * 50 + "*/" * 49]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, q string").select("i", F.expr(redaction._block_comments("q")).alias("c")).collect()
    for row in got:
        want = comments_by_hand(texts[row.i])
        assert (None if row.c is None else [tuple(c) for c in row.c]) == want, texts[row.i]


@pytest.mark.parametrize("depth", [8, 9, 50])
def test_deep_comments_change_nothing(spark, depth):
    """Redaction, fingerprint and class are those of the statement without its comments."""
    deep = "/*" * depth + " it's \"; DROP " + "*/" * depth
    rows = [(f"SELECT{deep} a FROM t WHERE x = 'v'{deep}", "SELECT a FROM t WHERE x = 'v'"), (f"{deep}DELETE FROM \"T\"", 'DELETE FROM "T"')]
    df = spark.createDataFrame(rows, "q string, plain string")
    for row in df.selectExpr(*(f"{f(c)} AS {n}_{c}" for c in ("q", "plain") for n, f in (("r", redaction.redact), ("f", lambda x: redaction.fingerprint(x, "s"))))).collect():
        assert row.r_q == row.r_plain and row.f_q == row.f_plain
    a, b = (text_jobs.classify_statements(df.select(F.col(c).alias("sql"))).drop("sql").collect() for c in ("q", "plain"))
    assert a == b
    a, b = (text_jobs.non_transactional(df.select(F.col(c).alias("sql"))).drop("sql").collect() for c in ("q", "plain"))
    assert a == b
    assert spark.createDataFrame([("/*" * depth + "*/" * (depth - 1),)], "q string").selectExpr(redaction.redact("q")).first()[0] == MARK
