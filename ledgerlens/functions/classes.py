"""Statement classes from the leading words of redacted text.

This is log analytics, not a parser and never an access guard: it reads text whose literals and
comments are already gone, knows statements by their leading words, and calls anything else
``unknown``.
"""

from __future__ import annotations

from ledgerlens import constants as C
from ledgerlens.functions.redaction import strip_literals
from ledgerlens.functions.sqltext import lit


# Fixed values: (first words, rest of the leading words, class, verb). The first match counts.
VERBS = [
    ("select values table", "", "read", "SELECT"),
    ("show", "", "read", "SHOW"),
    ("insert", "", "write", "INSERT"),
    ("update", "", "write", "UPDATE"),
    ("delete", "", "write", "DELETE"),
    ("merge", "", "write", "MERGE"),
    ("do", "", "ddl", "DO"),
    ("call", "", "ddl", "CALL"),
    ("execute", "", "ddl", "EXECUTE"),
    ("create drop", r"\s+database\b", "unknown", "DATABASE"),
    ("create", r"\s+(?:unique\s+)?index\b", "ddl", "CREATE INDEX"),
    ("create", r"\s+(?:or\s+replace\s+)?(?:(?:global|local)\s+)?(?:temp\s+|temporary\s+)?(?:recursive\s+)?view\b", "ddl", "CREATE VIEW"),
    ("create", r"\s+(?:role|user|group)\b(?!\s+mapping)", "ddl", "CREATE ROLE"),
    ("create", r"\b[^(;]*\btable\b[^(;]*\bas\b", "ddl", "CREATE TABLE AS"),
    ("create", "", "ddl", "CREATE"),
    ("alter", r"\s+system\b", "ddl", "ALTER SYSTEM"),
    ("alter", r"\s+(?:role|user|group)\b(?!\s+mapping)", "ddl", "ALTER ROLE"),
    ("alter", "", "ddl", "ALTER"),
    ("drop", "", "ddl", "DROP"),
    ("truncate", "", "ddl", "TRUNCATE"),
    ("grant", r"\b[\s\S]*\bon\b", "ddl", "GRANT"),
    ("grant", "", "ddl", "GRANT ROLE"),
    ("revoke", r"\b[\s\S]*\bon\b", "ddl", "REVOKE"),
    ("revoke", "", "ddl", "REVOKE ROLE"),
    ("comment", "", "ddl", "COMMENT"),
    ("reindex", "", "ddl", "REINDEX"),
    ("refresh", r"\s+materialized\s+view\b", "ddl", "REFRESH MATERIALIZED VIEW"),
    ("reassign", r"\s+owned\b", "ddl", "REASSIGNOWNED"),
    ("security", r"\s+label\b", "ddl", "SECLABEL"),
    ("lock", "", "ddl", "LOCK"),
    ("cluster", "", "ddl", "CLUSTER"),
    ("vacuum analyze analyse", "", "utility", "VACUUM"),
    ("checkpoint", "", "utility", "CHECKPOINT"),
    ("close", "", "utility", "CLOSEPORTAL"),
    ("deallocate", "", "utility", "DEALLOCATE"),
    ("declare", "", "utility", "DECLARE"),
    ("discard", "", "utility", "DISCARD"),
    ("listen", "", "utility", "LISTEN"),
    ("unlisten", "", "utility", "UNLISTEN"),
    ("notify", "", "utility", "NOTIFY"),
    ("load", "", "utility", "LOAD"),
    ("prepare", r"\s+transaction\b", "utility", "TRANSACTION"),
    ("prepare", "", "utility", "PREPARE"),
    ("start", r"\s+transaction\b", "utility", "TRANSACTION"),
    ("begin commit end rollback abort savepoint release", "", "utility", "TRANSACTION"),
    ("set", r"\s+constraints\b", "utility", "CONSTRAINTSSET"),
    (
        "set reset",
        r"\s+(?:session\s+|local\s+)?(?:role|session\s+authorization|authorization|session_replication_role"
        r"|(?:default_)?transaction_read_only)\b",
        "ddl",
        "SET",
    ),
    ("set", r"\s+(?:session\s+characteristics\s+as\s+)?(?:local\s+)?transaction\b[\s\S]*\bread\s+write\b", "ddl", "SET"),
    ("set reset", "", "utility", "SET"),
]
#: statements that run code whose body was never read
_EXECUTABLE = ("do", "call", "execute")

_EXPLAIN = r"^\s*+explain\s*+(?:\([^)]*+\)\s*+|(?:analyze|analyse|verbose)\b\s*+)*+"
_EXPLAIN_ANALYZE = r"^\s*+explain\s*+(?:\([^)]*\banaly[zs]e\b[^)]*\)|(?:verbose\s+)?analy[zs]e\b)"
_COPY_FROM = r"^\s*+copy\s+(?!\()[\s\S]*?\sfrom\b"
_COPY_PROGRAM = r"^\s*+copy\b[\s\S]*\bto\s+program\b"
_COPY_STDOUT = r"^\s*+copy\b[\s\S]*\bto\s+stdout\b"
_WRITABLE_CTE = r"(?:^\s*+with\b|,|\(\s*+with\b)[\s\S]*?\bas\s*+(?:(?:not\s+)?materialized\s*+)?\(\s*+(?:insert|update|delete|merge)\b"
_LOCKING = r"\bfor\s+(?:no\s+key\s+update|update|share|key\s+share)\b"
_INTO = r"^\s*+(?:with\b[\s\S]*\)\s*+)?select\b(?:(?!\bfrom\b)[\s\S])*\binto\s"

# Leading words of statements that cannot run in a transaction, with their label.
NON_TRANSACTIONAL = [
    ("alter", r"\s+database\b[\s\S]*\bset\s+tablespace\b", "ALTER DATABASE ... SET TABLESPACE"),
    ("alter", r"\s+database\b", "ALTER DATABASE"),
    ("alter", r"\s+subscription\b", "ALTER SUBSCRIPTION"),
    ("alter", r"\s+system\b", "ALTER SYSTEM"),
    ("alter", r"\s+(?:table|index|materialized\s+view)\b[\s\S]*\bset\s+tablespace\b", "ALTER TABLE ... SET TABLESPACE"),
    ("checkpoint", "", "CHECKPOINT"),
    ("cluster", "", "CLUSTER"),
    ("close", "", "CLOSE"),
    ("create", r"\s+database\b", "CREATE DATABASE"),
    ("create", r"\s+subscription\b", "CREATE SUBSCRIPTION"),
    ("create", r"\s+tablespace\b", "CREATE TABLESPACE"),
    ("discard", "", "DISCARD"),
    ("do", "", "DO"),
    ("drop", r"\s+database\b", "DROP DATABASE"),
    ("drop", r"\s+subscription\b", "DROP SUBSCRIPTION"),
    ("drop", r"\s+tablespace\b", "DROP TABLESPACE"),
    ("load", "", "LOAD"),
    ("lock", "", "LOCK"),
    ("prepare", r"\s+transaction\b", "transaction control"),
    ("prepare", "", "PREPARE"),
    ("start", r"\s+transaction\b", "transaction control"),
    ("begin commit end rollback abort savepoint release", "", "transaction control"),
    ("vacuum analyze analyse", "", "VACUUM / ANALYZE"),
    ("create", r"\s+(?:unique\s+)?index\s+concurrently\b", "CREATE INDEX CONCURRENTLY"),
    ("drop", r"\s+index\s+concurrently\b", "DROP INDEX CONCURRENTLY"),
    ("reindex", r"\b[\s\S]*\bconcurrently\b", "REINDEX CONCURRENTLY"),
    ("refresh", r"\s+materialized\s+view\s+concurrently\b", "REFRESH MATERIALIZED VIEW CONCURRENTLY"),
]
#: leading words whose transactionality cannot be proven from the verb
_UNPROVEN = [
    ("explain copy call execute declare deallocate listen unlisten notify fetch move import", "", "true"),
    ("set", r"\s+constraints\b", "true"),
    ("create alter drop", r"\s+user\s+mapping\b", "true"),
]


def first_word(s: str) -> str:
    return f"regexp_extract({s}, {lit(r'^[\s(]*+([a-z]++)')}, 1)"


def _by_words(word: str, text: str, arms, default: str) -> str:
    """A CASE over the first word; only the few arms of that word look at the text."""
    body = ""
    for words, rest, value in arms:
        among = ", ".join(lit(w) for w in words.split())
        tail = f" AND {text} RLIKE {lit(rf'^[\s(]*+[a-z]++{rest}')}" if rest else ""
        body += f"WHEN {word} IN ({among}){tail} THEN {value} "
    return f"CASE {body}ELSE {default} END"


def cleaned(x: str) -> str:
    """Lower-case text without comments and literal bodies."""
    return f"lower({strip_literals(x)})"


def statements_of(clean: str) -> str:
    """Array of the non-blank statements of cleaned text."""
    return f"filter(split({clean}, ';'), s -> s RLIKE {lit(r'\S')})"


def main_text(s: str) -> str:
    """The statement that is classified: an EXPLAIN is unwrapped, and of a WITH statement the part
    after its common table expressions is taken by leaving out all parentheses, at any depth."""
    body = f"CASE WHEN contains({s}, 'explain') THEN regexp_replace({s}, {lit(_EXPLAIN)}, '') ELSE {s} END"
    # text outside of all parentheses, one blank for each outermost pair; an unclosed one hides the rest
    flat = (
        f"aggregate(regexp_extract_all({body}, {lit('[()]|[^()]++')}, 0), named_struct('depth', 0, 'text', ''), (a, x) -> CASE "
        "WHEN x = '(' THEN named_struct('depth', a.depth + 1, 'text', a.text) "
        "WHEN x = ')' THEN named_struct('depth', greatest(a.depth - 1, 0), 'text', IF(a.depth <= 1, concat(a.text, ' '), a.text)) "
        "WHEN a.depth = 0 THEN named_struct('depth', a.depth, 'text', concat(a.text, x)) ELSE a END, a -> a.text)"
    )
    main = f"regexp_extract({flat}, {lit(r'\b(?:select|values|table|insert|update|delete|merge)\b[\s\S]*+')}, 0)"
    return f"CASE WHEN contains({s}, 'with') AND {body} RLIKE {lit(r'^\s*+with\b')} THEN {main} ELSE {body} END"


def class_of(m: str, w: str) -> str:
    """Class of the statement text ``m`` with first word ``w``, before its violations are looked at."""
    return (
        f"CASE WHEN {w} = 'copy' THEN CASE WHEN {m} RLIKE {lit(_COPY_FROM)} THEN 'write' WHEN {m} RLIKE {lit(_COPY_PROGRAM)} THEN 'ddl' "
        f"WHEN {m} RLIKE {lit(_COPY_STDOUT)} THEN 'read' ELSE 'ddl' END "
        f"ELSE {_by_words(w, m, [(words, rest, lit(kind)) for words, rest, kind, _ in VERBS], lit('unknown'))} END"
    )


def verb_of(m: str, w: str) -> str:
    known = _by_words(w, m, [(words, rest, lit(verb)) for words, rest, _, verb in VERBS], lit(""))
    return f"CASE WHEN {w} = 'copy' THEN 'COPY' ELSE {known} END"


def is_denied(f: str) -> str:
    """True for a called function that a read may not use, by its bare name."""
    bare = f"substring_index({f}, '.', -1)"
    names = ", ".join(lit(n) for n in C.DENIED_FUNCTIONS)
    edges = [f"startswith({bare}, {lit(p)})" for p in C.DENIED_PREFIXES] + [f"endswith({bare}, {lit(x)})" for x in C.DENIED_SUFFIXES]
    return f"({bare} IN ({names}) OR {' OR '.join(edges)})"


def violations_of(s: str, m: str, w: str, kind: str, verb: str, calls: str) -> str:
    """Flags of one statement ``s``, found by pattern once literals are gone."""
    is_select = f"{w} IN ('select', 'values', 'table')"
    executable = (
        f"{w} IN ({', '.join(lit(x) for x in _EXECUTABLE)}) OR {kind} = 'unknown' OR ({verb} = 'SET' AND {kind} = 'ddl') "
        f"OR ({w} = 'copy' AND {m} RLIKE {lit(_COPY_PROGRAM)})"
    )
    return (
        "filter(array("
        f"CASE WHEN {is_select} AND contains({s}, 'into') AND {s} RLIKE {lit(_INTO)} THEN 'selects_into' END, "
        f"CASE WHEN {is_select} AND contains({s}, 'for') AND {s} RLIKE {lit(_LOCKING)} THEN 'row_locking' END, "
        f"CASE WHEN {is_select} AND contains({s}, 'with') AND {s} RLIKE {lit(_WRITABLE_CTE)} THEN 'writable_cte' END, "
        f"CASE WHEN {is_select} AND exists({calls}, f -> {is_denied('f')}) THEN 'denied_function' END, "
        f"CASE WHEN {executable} THEN 'executable_block' END), v -> v IS NOT NULL)"
    )


def is_explain(s: str) -> str:
    return f"(contains({s}, 'explain') AND {s} RLIKE {lit(r'^\s*+explain\b')})"


def is_explain_analyze(s: str) -> str:
    return f"(contains({s}, 'explain') AND {s} RLIKE {lit(_EXPLAIN_ANALYZE)})"


def non_transactional_label(s: str, w: str) -> str:
    """Label of a statement that cannot run in a transaction, else null."""
    return _by_words(w, s, [(words, rest, lit(label)) for words, rest, label in NON_TRANSACTIONAL], "CAST(NULL AS STRING)")


def is_unproven(s: str, w: str) -> str:
    known = [(words, rest, "false") for words, rest, _, _ in VERBS] + [("with", "", "false")]
    return _by_words(w, s, [*_UNPROVEN, *known], "true")


#: names followed by a parenthesis that are not calls
_NOT_CALLS = (
    "in values and or not exists any all some as on using from where select over filter within group by order "
    "having union intersect except returning set into table with when then else case end between like is null "
    "partition key references check unique primary default array row rows cast interval numeric decimal varchar "
    "char time timestamp bit float limit offset distinct join lateral recursive materialized analyze verbose "
    "explain insert update delete only if begin"
).split()


#: a relation followed by its column list, which reads like a call
_COLUMN_LIST = (
    r"(?:\binsert\s+into|\breferences|\bcreate\s+(?:unique\s+)?index\b[^(;]*?\bon|\btable(?:\s+if\s+not\s+exists)?|\bcopy)"
    r"\s+(?:only\s+)?[a-z_\"?][a-z0-9_.$\"?]*\s*(?:using\s+[a-z0-9_]+\s*)?\("
)


def called_functions(s: str) -> str:
    """Distinct function names called in cleaned text, dotted when qualified."""
    calls = f"regexp_replace({s}, {lit(_COLUMN_LIST)}, ' ( ')"
    found = f"regexp_extract_all({calls}, {lit(r'(?<![a-z0-9_$.])([a-z_][a-z0-9_$]*+(?:\.[a-z_][a-z0-9_$]*+)?+)\s*+\(')}, 1)"
    words = ", ".join(f"'{w}'" for w in _NOT_CALLS)
    named = f"array_distinct(filter({found}, f -> f NOT IN ({words})))"
    return f"CASE WHEN contains({s}, '(') THEN {named} ELSE CAST(array() AS array<string>) END"


