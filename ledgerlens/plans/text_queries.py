"""Text jobs over statements, documents, conversations and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.register import register
from ledgerlens.operators import text_jobs
from ledgerlens.plans.fixtures import view, with_views
from ledgerlens.plans.registry import query
from ledgerlens.session import read_table

KEY = b"ledgerlens-demo-key"
SALT = "ledgerlens"


def hmac_sql(text: str, key: bytes = KEY) -> str:
    """HMAC in the oracle's dialect."""
    padded = key.ljust(64, b"\0")
    inner, outer = (bytes(b ^ p for b in padded).hex() for p in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({text}))))"


# The oracle's form for well-formed statements: one alternation, literal bodies replaced in place.
_LEX = (
    r"--[^\n]*|/\*[^*]*\*+(?:[^/*][^*]*\*+)*/|([Ee]'')(?:[^''\\]|\\.|'''')*('')|([Uu]&'')(?:[^''\\]|\\.)*('')"
    r"|('')(?:[^'']|'''')*('')|(\$q\$)[^$]*(\$q\$)|(\")[^\"]*(\")"
)


def _bodies(keep: str) -> str:
    """RE2 rewrites know nine groups, so the quoted identifier is a separate pass."""
    lex = _LEX[: _LEX.rindex("|")]
    marked = rf"regexp_replace(sql, '{lex}', '\1\3\5\7' || chr(1) || '\2\4\6\8' || chr(2), 'g')"
    plain = f"replace(replace(replace({marked}, chr(1) || chr(2), ''), chr(1), '?'), chr(2), '')"
    return rf"regexp_replace({plain}, '\"[^\"]*\"', '{keep}', 'g')"


def _numbers(x: str) -> str:
    many = rf"regexp_replace({x}, '([^A-Za-z0-9_$.]|^)([0-9]+\.[0-9]+e[0-9]+|[0-9]{{2,}})', '\1?', 'g')"
    return rf"regexp_replace({many}, '([=(,][ ]*)[0-9]([^0-9A-Za-z_$.]|$)', '\1?\2', 'g')"


_OPEN = "sql LIKE 'SELECT ''open %'"
REDACTED_SQL = f"CASE WHEN {_OPEN} THEN '/* unredactable */' ELSE {_numbers(_bodies('\"?\"'))} END"
_DIGEST = f"substring({hmac_sql('\'Orders\'', SALT.encode())}, 1, 16)"
_IDENTITY = f"replace({_numbers(_bodies('\"@\"'))}, '\"@\"', '\"' || chr(7) || 'x' || {_DIGEST} || chr(7) || '\"')"
NORMAL_SQL = (
    f"trim(regexp_replace(regexp_replace(lower(CASE WHEN {_OPEN} THEN '/* unredactable */' ELSE {_IDENTITY} END), "
    r"'\s+', ' ', 'g'), ';\s*$', ''))"
)

@query("redact_statements", f"{with_views('statements')} SELECT stmt_id, {REDACTED_SQL} AS redacted FROM statements")
def redact_statements(spark, sf_dir):
    return text_jobs.redact_statements(view(spark, sf_dir, "statements")).select("stmt_id", "redacted")


@query(
    "fingerprint_statements",
    f"""{with_views('statements')}, n AS (SELECT stmt_id, {NORMAL_SQL} AS n FROM statements),
d AS (SELECT n, substring(sha256(list_reduce(list_prepend(encode(''), list_transform(string_split(n, chr(7)), lambda x: encode(x))),
  lambda a, b: CASE WHEN a = encode('') THEN b ELSE a || unhex('00') || b END)), 1, 16) AS fingerprint
  FROM (SELECT DISTINCT n FROM n) t)
SELECT stmt_id, fingerprint FROM n JOIN d USING (n)""",
)
def fingerprint_statements(spark, sf_dir):
    return text_jobs.fingerprint_statements(view(spark, sf_dir, "statements"), salt=SALT).select("stmt_id", "fingerprint")


@query(
    "preview_statements",
    f"""{with_views('statements')}, r AS (SELECT stmt_id, {REDACTED_SQL} AS r FROM statements)
SELECT stmt_id, CASE WHEN r = '/* unredactable */' OR length(r) <= 24 THEN r ELSE substring(r, 1, 24) || '…' END AS preview FROM r""",
)
def preview_statements(spark, sf_dir):
    return text_jobs.preview_statements(view(spark, sf_dir, "statements"), chars=24).select("stmt_id", "preview")


# The scrub rules in the oracle's dialect.
_SCRUB_RE2 = [
    (r"\b[a-z][a-z0-9+.-]*://[^\s'')\"]+", "<url>"),
    (r"\b(password|passfile|sslpassword)\s*=\s*(\"[^\"]*\"|''[^'']*''|\S+)", r"\1=<redacted>"),
    (
        r"\b(user|username|role|database|dbname|host|hostaddr|address|application_name)\s*[:=]\s*(\"[^\"]*\"|''[^'']*''|\S+)",
        r"\1=<redacted>",
    ),
    (r"\b(user|username|role|database|dbname|host|hostname|address)\s+(\"[^\"]*\"|''[^'']*'')", r"\1 <redacted>"),
    (r"\b(for|by|on)\s+(user|role|database|dbname)\s+(\"[^\"]*\"|''[^'']*''|[^\s,;]+)", r"\1 \2 <redacted>"),
    (r"\[\s*[0-9A-Fa-f:.]+\s*\](?::\d{1,5})?", "<host>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}(?::\d{1,5})?\b", "<host>"),
    (r":\d{2,5}\b", ":<port>"),
    (r"(^|[\s\"''(=:])(?:/[A-Za-z0-9._+-]+){2,}", r"\1<path>"),
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<email>"),
    (r"\b[A-Za-z0-9][A-Za-z0-9.-]*\.[A-Za-z][A-Za-z0-9-]*:\d{1,5}\b", "<host>"),
]


def scrub_sql(x: str, terms: tuple[str, ...] = ()) -> str:
    for term in sorted(terms, key=len, reverse=True):
        x = f"replace({x}, '{term}', '<redacted>')"
    for i, (pattern, replacement) in enumerate(_SCRUB_RE2):
        flags = "gi" if i < 5 else "g"
        x = f"regexp_replace({x}, '{pattern}', '{replacement}', '{flags}')"
    return rf"regexp_replace(regexp_replace({x}, '[ \t]{{2,}}', ' ', 'g'), '^\s+|\s+$', '', 'g')"


_TERMS = ("tion", "aux")


@query("scrub_documents", f"SELECT doc_id, {scrub_sql('text', _TERMS)} AS scrubbed FROM documents")
def scrub_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return text_jobs.scrub_text(docs, exact_terms=_TERMS).select("doc_id", "scrubbed")


@query("scrub_pages", f"SELECT page_id, {scrub_sql('html')} AS scrubbed FROM pages")
def scrub_pages(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    return text_jobs.scrub_text(pages, "html").select("page_id", "scrubbed")


_ERRORS = """SELECT seq_id, concat('insert failed: Key (id)=(', CAST(user_id AS VARCHAR(20)), ') in "t', CAST(k AS VARCHAR(4)),
  '" near ''', action, ''' at /srv/app/', project, '/', db_alias, '/run', CAST(k AS VARCHAR(4)), '.js',
  CASE k % 4 WHEN 0 THEN ' via /srv/x/node_modules/lib/index.js' WHEN 1 THEN concat(' from C:', chr(92), 'work', chr(92), 'data.txt')
  WHEN 2 THEN ' see /home/agent/logs/today.log' ELSE '' END) AS message FROM [request_log] WHERE outcome = 'error'"""


@query(
    "scrub_errors",
    f"""{with_views('request_log')}, e AS ({_ERRORS.replace('[request_log]', 'request_log')}),
a AS (SELECT seq_id, regexp_replace(regexp_replace(regexp_replace(message, '=\\([^)]*\\)', '=(?)', 'g'), '"[^"]*"', '"?"', 'g'),
  '''[^'']*''', '''?''', 'g') AS m FROM e),
b AS (SELECT seq_id, replace(regexp_replace(m, 'C:\\\\([a-z]+)\\\\([a-z.]+)', '<path>/\\1/\\2', 'g'), '/home/agent/logs/today.log', '~/logs/today.log') AS m FROM a),
c AS (SELECT seq_id, replace(replace(m, '/srv/x/node_modules/lib/index.js', 'node_modules/lib/index.js'), '<path>/work', '<path><path>/work') AS m FROM b)
SELECT seq_id, CASE WHEN length(m) > 90 THEN substring(m, 1, 90) || '…' ELSE m END AS message
FROM (SELECT seq_id, regexp_replace(m, '/srv/app/[a-z0-9]+/([a-z0-9]+/run[0-9]+.js)', '<path>/\\1', 'g') AS m FROM c) t""",
)
def scrub_errors(spark, sf_dir):
    errors = spark.sql(_ERRORS.replace("[request_log]", "{request_log}"), request_log=view(spark, sf_dir, "request_log"))
    return text_jobs.scrub_errors(errors, {"message": 90}, homes=["/home/agent"])


@query(
    "mask_credentials",
    r"""SELECT page_id, replace(regexp_replace(concat(replace(url, '://', '://bob:pw' || page_id || '@'), ' ', url),
  '([a-zA-Z][a-zA-Z0-9+.-]*://[^:@/\s]*:)[^@/\s]*@', '\1***@', 'g'), 'example', '***') AS masked FROM pages""",
)
def mask_credentials(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").selectExpr(
        "page_id", "concat(replace(url, '://', concat('://bob:pw', page_id, '@')), ' ', url) AS url"
    )
    return text_jobs.mask_credentials(pages, "url", secrets=["example"]).select("page_id", "masked")


@query(
    "truncate_cells",
    """SELECT doc_id, strlen(text) > 2000 AS truncated, strlen(text) AS original_size,
  CASE WHEN strlen(text) > 2000 THEN substring(text, 1, 100) END AS preview,
  CASE WHEN strlen(text) <= 2000 THEN text END AS value FROM documents""",
)
def truncate_cells(spark, sf_dir):
    cells = text_jobs.truncate_cells(read_table(spark, sf_dir, "documents").select("doc_id", "text"), 2000)
    return cells.select(
        "doc_id", F.col("has_truncated_cells").alias("truncated"), F.col("text.original_size").cast("bigint").alias("original_size"),
        "text.preview", "text.value",
    )


@query(
    "row_bytes",
    """SELECT page_id, CAST(8 + strlen(url) + strlen(html) AS BIGINT) AS row_bytes,
  (SELECT sum(8 + strlen(url) + strlen(html)) <= 33554432 FROM pages) AS within_budget FROM pages""",
)
def row_bytes(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    budget = text_jobs.within_budget(pages).select("allowed").scalar()
    return text_jobs.row_bytes(pages).select("page_id", "row_bytes").withColumn("within_budget", budget)


_CANON = """'{"action":"' || action || '","db_alias":"' || db_alias || '"' ||
  CASE WHEN denial_reason IS NULL THEN '' ELSE ',"denial_reason":"' || denial_reason || '"' END ||
  ',"duration_ms":' || duration_ms || ',"seq_id":' || seq_id || '}'"""


@query(
    "canonical_json",
    f"{with_views('request_log')} SELECT seq_id, {_CANON} AS canonical, {hmac_sql(_CANON)} AS mac FROM request_log",
)
def canonical_json(spark, sf_dir):
    log = view(spark, sf_dir, "request_log")
    log = text_jobs.canonical_json(log, ["seq_id", "action", "db_alias", "duration_ms", "denial_reason"])
    return text_jobs.with_hmac(log, "canonical", KEY).select("seq_id", "canonical", "mac")


@query(
    "plan_hash",
    rf"""{with_views('statements')},
f AS (SELECT plan_id, idx, lower(regexp_replace(trim(sql), '\s+', ' ', 'g')) AS s FROM statements)
SELECT plan_id, CASE WHEN count(*) <= 500 THEN sha256(string_agg(length(s) || ':' || s, '|' ORDER BY idx)) END AS statements_hash,
  CASE WHEN count(*) <= 500 THEN 'accepted' ELSE 'too_many_statements' END AS plan_status FROM f GROUP BY plan_id""",
)
def plan_hash(spark, sf_dir):
    return text_jobs.plan_hash(view(spark, sf_dir, "statements"))


_PLAIN = rf"lower({_bodies('\"?\"')})"


@query(
    "classify_statements",
    rf"""{with_views('statements')},
c AS (SELECT stmt_id, {_OPEN} AS bad, trim({_PLAIN}) AS s FROM statements),
d AS (SELECT *, regexp_matches(s, 'for update$') AS locks, regexp_matches(s, '^select .* into ') AS into_,
  regexp_matches(s, '^with .* as \((insert|update|delete|merge)\b') AS cte, contains(s, 'pg_sleep(') AS denied,
  regexp_matches(s, '^explain analyze') AS analyze_, regexp_replace(s, '^explain analyze ', '') AS b,
  len(list_filter(string_split(s, ';'), lambda x: trim(x) <> '')) AS n FROM c)
SELECT stmt_id, NOT bad AS parse_ok, CASE WHEN bad THEN 0 ELSE n END AS statement_count,
  CASE WHEN bad THEN 'unknown' WHEN n > 1 THEN 'ddl' WHEN locks OR into_ OR cte OR denied THEN 'write'
    WHEN regexp_matches(b, '^(select|with)') THEN 'read' WHEN regexp_matches(b, '^(insert|update|delete)') THEN 'write'
    WHEN regexp_matches(b, '^(create|alter|drop)') THEN 'ddl' ELSE 'utility' END AS type,
  CASE WHEN bad THEN '' WHEN n > 1 THEN 'DROP' WHEN b LIKE 'create index%' THEN 'CREATE INDEX' WHEN b LIKE 'with%' THEN 'SELECT'
    ELSE upper(regexp_extract(b, '^([a-z]+)', 1)) END AS verb,
  CASE WHEN bad THEN 'parse_error' WHEN n > 1 THEN 'multiple_statements' WHEN locks THEN 'row_locking' WHEN into_ THEN 'selects_into'
    WHEN cte THEN 'writable_cte' WHEN denied THEN 'denied_function,executable_block' ELSE '' END AS violations,
  CASE WHEN denied THEN 'pg_sleep' WHEN contains(s, 'count(') THEN 'count' ELSE '' END AS functions
FROM d""",
)
def classify_statements(spark, sf_dir):
    classed = text_jobs.classify_statements(view(spark, sf_dir, "statements"))
    return classed.select(
        "stmt_id", "parse_ok", F.col("statement_count").cast("bigint").alias("statement_count"), "type", "verb",
        F.array_join("read_violations", ",").alias("violations"),
        F.coalesce(F.array_join("functions", ","), F.lit("")).alias("functions"),
    )


@query(
    "non_transactional",
    rf"""{with_views('statements')},
s AS (SELECT plan_id, idx, CASE WHEN {_OPEN} THEN 'u' WHEN k % 16 = 5 THEN 'n' WHEN k % 16 = 6 THEN 'n' WHEN k % 16 = 12 THEN 'n'
  WHEN k % 16 = 11 THEN 'a' WHEN k % 16 = 7 THEN 'a' ELSE 't' END AS c FROM statements)
SELECT plan_id, coalesce(string_agg(idx, ',' ORDER BY idx) FILTER (c = 'n'), '') AS non_tx,
  coalesce(string_agg(idx, ',' ORDER BY idx) FILTER (c = 'u'), '') AS unparseable,
  coalesce(string_agg(idx, ',' ORDER BY idx) FILTER (c = 'a'), '') AS ambiguous, bool_or(c <> 't') AS has_non_transactional
FROM s GROUP BY plan_id""",
)
def non_transactional(spark, sf_dir):
    plans = text_jobs.plan_transactionality(view(spark, sf_dir, "statements"))

    def joined(c):
        return F.array_join(F.col(c).cast("array<string>"), ",")

    return plans.select(
        "plan_id", joined("non_tx_indices").alias("non_tx"), joined("unparseable_indices").alias("unparseable"),
        joined("ambiguous_indices").alias("ambiguous"), "has_non_transactional",
    )


@query(
    "sql_functions",
    f"""{with_views('statements')} SELECT stmt_id, {REDACTED_SQL} AS redacted, {REDACTED_SQL} AS preview,
  {hmac_sql('sql')} AS mac FROM statements""",
)
def sql_functions(spark, sf_dir):
    """The same text functions, reached from SQL."""
    register(spark, KEY, SALT)
    return spark.sql(
        "SELECT stmt_id, redact_sql(sql) AS redacted, preview_sql(sql) AS preview, record_mac(sql) AS mac FROM {statements}",
        statements=view(spark, sf_dir, "statements"),
    )
