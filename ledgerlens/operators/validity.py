"""Validity rules as expressions, reported in long form ``(row_id, rule, ok)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import constants as C

# Shapes of names and addresses.
LABEL = "[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?"
HOSTNAME = rf"^{LABEL}(?:\.{LABEL})*$"
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4 = rf"^{OCTET}(?:\.{OCTET}){{3}}$"
_H = "[0-9a-fA-F]{1,4}"
_TAIL4 = r"(?:(?:25[0-5]|(?:2[0-4]|1?[0-9])?[0-9])\.){3}(?:25[0-5]|(?:2[0-4]|1?[0-9])?[0-9])"
IPV6 = (
    rf"^(?:(?:{_H}:){{7}}{_H}|(?:{_H}:){{1,7}}:|(?:{_H}:){{1,6}}:{_H}|(?:{_H}:){{1,5}}(?::{_H}){{1,2}}"
    rf"|(?:{_H}:){{1,4}}(?::{_H}){{1,3}}|(?:[0-9a-fA-F]{{1,3}}:){{1,3}}(?::{_H}){{1,4}}|(?:[0-9a-fA-F]{{1,2}}:){{1,2}}(?::{_H}){{1,5}}"
    rf"|{_H}:(?::{_H}){{1,6}}|:(?:(?::{_H}){{1,7}}|:)|fe80:(?::[0-9a-fA-F]{{0,4}}){{0,4}}%[0-9a-zA-Z]+"
    rf"|::(?:ffff(?::0{{1,4}})?:)?{_TAIL4}|(?:{_H}:){{1,4}}:{_TAIL4})$"
)
ENV_NAME = "^[A-Z][A-Z0-9_]*$"
INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})$"
IDENTIFIER = "^[a-zA-Z0-9_-]+$"
NONCE = "^[A-Za-z0-9_-]{16,64}$"


def sure(rule: Column) -> Column:
    """A rule that cannot be answered is not met."""
    return F.coalesce(rule, F.lit(False))


def is_hostname(c: str) -> Column:
    return F.length(c).between(1, 253) & F.col(c).rlike(HOSTNAME)


def is_host(c: str) -> Column:
    return is_hostname(c) | F.col(c).rlike(IPV4) | F.col(c).rlike(IPV6)


def is_identifier(c: str, longest: int = 64) -> Column:
    return F.length(c).between(1, longest) & F.col(c).rlike(IDENTIFIER)


def is_instant(c: str) -> Column:
    return F.col(c).rlike(INSTANT) & F.col(c).try_cast("timestamp").isNotNull()


def sized(c: str, low: int, high: int) -> Column:
    return F.length(c).between(low, high)


def registry_rules() -> dict[str, Column]:
    """Rules of a database registry entry."""
    return {
        "project_name": F.coalesce("project_name", F.lit("")).isin("") | is_identifier("project_name"),
        "db_alias": is_identifier("db_alias"),
        "host": is_host("host"),
        "port": F.col("port").between(1, 65535),
        "database": sized("database", 1, 63),
        "user": sized("user", 1, 63),
        "password_env": F.col("password_env").isNull() | F.col("password_env").rlike(ENV_NAME),
        "password_source": (F.coalesce("password_env", F.lit("")) != "") | (F.coalesce("password_stored", F.lit("")) != ""),
        "ssl_mode": F.col("ssl_mode").isin(list(C.SSL_MODES)),
        "permission_override": F.col("permission_override").isNull() | F.col("permission_override").isin(list(C.LEVEL_RANK)),
        "created_at": is_instant("created_at"),
    }


def query_rules() -> dict[str, Column]:
    """Rules of a query payload; ``statement_count`` comes from classification."""
    return {
        "sql": F.trim("sql") != "",
        "sql_length": F.octet_length("sql") <= C.MAX_STATEMENT_BYTES,
        "single_statement": F.col("statement_count") <= 1,
        "timeout_ms": F.col("timeout_ms").isNull() | (F.col("timeout_ms") >= 0),
        "intent": F.col("intent").isin("read", "write", "ddl"),
        "page_size": F.col("page_size").isNull() | F.col("page_size").between(1, C.MAX_PAGE_SIZE),
    }


def envelope_rules() -> dict[str, Column]:
    """Rules of a message envelope."""
    return {
        "id": sized("id", 1, 64),
        "type": F.col("type").isin(list(C.MESSAGE_TYPES)),
        "project": sized("project", 1, 64),
        "user_id": F.length("user_id") > 0,
        "role": F.col("role").isin(list(C.ROLES)),
        "db_alias": sized("db_alias", 1, 64),
        "ts": F.col("ts") > 0,
        "nonce": F.col("nonce").isNull() | F.col("nonce").rlike(NONCE),
        "mac": F.col("mac").isNull() | F.col("mac").rlike("^[0-9a-f]{64}$"),
    }


def plan_rules() -> dict[str, Column]:
    """Rules of a plan payload with an array of ``statements``."""
    return {
        "plan_id": F.length("plan_id") > 0,
        "statements": F.size("statements").between(1, C.MAX_PLAN_STATEMENTS),
        "statement_text": F.forall("statements", lambda s: (F.trim(s) != "") & (F.octet_length(s) <= C.MAX_STATEMENT_BYTES)),
        "strategy": F.col("strategy").isin(list(C.STRATEGIES)),
        "timeout_ms": F.col("timeout_ms").isNull() | (F.col("timeout_ms") > 0),
        "dry_run": F.col("dry_run").isNotNull(),
    }


def result_rules() -> dict[str, Column]:
    """Rules of a plan result row."""
    return {
        "plan_id": F.length("plan_id") > 0,
        "status": F.col("status").isin(list(C.PLAN_STATUSES)),
        "statement_status": F.forall("statement_statuses", lambda s: s.isin(list(C.STATEMENT_STATUSES))),
        "total_ms": F.col("total_ms") >= 0,
    }


def cancel_rules() -> dict[str, Column]:
    return {"target_id": F.length("target_id") > 0, "reason": F.col("reason").isin(list(C.CANCEL_REASONS))}


def validity_report(df: DataFrame, row_id: str, rules: Mapping[str, Column]) -> DataFrame:
    """Every rule's answer for every row, in long form. Row-wise, no shuffle."""
    answers = F.array(*[F.struct(F.lit(name).alias("rule"), sure(rule).alias("ok")) for name, rule in rules.items()])
    return df.select(row_id, F.inline(answers))


def duplicate_report(df: DataFrame, row_id: str, keys: Sequence[str], rule: str = "duplicate") -> DataFrame:
    """``ok`` is true for the first row (by ``row_id``) of each key and false for later ones.

    One aggregate per key joined back; a key on a third of all rows is one small row on the other
    side of the join, which adaptive execution can split. Null keys equal each other.
    """
    keyed = df.select(row_id, F.struct(*keys).alias("_key"))
    first = keyed.groupBy("_key").agg(F.min(row_id).alias("_first"))
    return keyed.join(first, "_key").select(
        row_id, F.lit(rule).alias("rule"), (F.col(row_id) == F.col("_first")).alias("ok")
    )
