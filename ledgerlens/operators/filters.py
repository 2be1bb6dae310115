"""Predicates and projections over the audit log."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import constants as C

#: columns a free-text search looks at, in the order they are joined
SEARCHED = (
    "statement_preview", "project", "user_id", "action", "decision", "outcome", "error_code",
    "denial_reason", "statement_fingerprint",
)
_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86_400, "w": 604_800}
_RELATIVE = r"^(\d+)\s*(s|sec|m|min|h|hr|d|day|w|week)s?$"


def _bound(column: Column, value) -> Column:
    """A literal of the column's own kind, so the comparison can be pushed to the scan."""
    if isinstance(value, dt.datetime):
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def audit_filter(
    df: DataFrame,
    *,
    project: str | None = None,
    user: str | None = None,
    action: str | None = None,
    decision: str | None = None,
    outcome: str | None = None,
    search: str | None = None,
    since=None,
    until=None,
    time_column: str = "ts",
) -> DataFrame:
    """The viewer's filter: case-blind equality, ``user`` and ``search`` as substrings, and a
    time range that is inclusive at both ends."""
    for name, wanted in (("project", project), ("action", action), ("decision", decision), ("outcome", outcome)):
        if wanted:
            df = df.where(F.lower(name) == wanted.lower())
    if user:
        df = df.where(F.lower(F.col("user_id").cast("string")).contains(user.lower()))
    if since is not None:
        df = df.where(F.col(time_column) >= _bound(F.col(time_column), since))
    if until is not None:
        df = df.where(F.col(time_column) <= _bound(F.col(time_column), until))
    needle = (search or "").strip().lower()
    if needle:
        parts = [
            F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("") for c in SEARCHED
        ]
        df = df.where(F.lower(F.concat_ws(" ", *parts)).contains(needle))
    return df


def since_bound(text: str | None, now: dt.datetime) -> dt.datetime | None:
    """A time bound from ``today``, a relative amount such as ``15m`` or ``2 days``, or ISO text.

    Unreadable text is no bound. ``now`` is injected; nothing here reads the clock.
    """
    if text is None or not text.strip():
        return None
    cleaned = text.strip().lower()
    if cleaned == "today":
        return now.replace(hour=0, minute=0, second=0, microsecond=0)
    relative = re.match(_RELATIVE, cleaned)
    if relative:
        return now - dt.timedelta(seconds=int(relative[1]) * _UNIT_SECONDS[relative[2][0]])
    try:
        parsed = dt.datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    except ValueError:
        return None
    return parsed.astimezone(dt.timezone.utc).replace(tzinfo=None) if parsed.tzinfo else parsed


def since_bound_ms(text: str, now_ms: str) -> Column:
    """Column form of :func:`since_bound`: epoch milliseconds, null for no bound."""
    cleaned = F.lower(F.trim(F.col(text)))
    amount = F.regexp_extract(cleaned, _RELATIVE, 1).try_cast("bigint")
    unit = F.substring(F.regexp_extract(cleaned, _RELATIVE, 2), 1, 1)
    seconds = F.coalesce(*[F.when(unit == u, F.lit(s)) for u, s in _UNIT_SECONDS.items()])
    now = F.col(now_ms)
    return (
        F.when(cleaned == "today", now - F.pmod(now, F.lit(86_400_000)))
        .when(cleaned.rlike(_RELATIVE), now - amount * seconds * 1000)
        .otherwise(F.unix_millis(F.trim(F.col(text)).try_cast("timestamp")))
    )


def _exact(df: DataFrame, wanted: Mapping[str, object], since, until, time_column: str) -> DataFrame:
    for name, value in wanted.items():
        if value is not None and value != "":
            df = df.where(F.col(name) == F.lit(value))
    if since is not None:
        df = df.where(F.col(time_column) >= _bound(F.col(time_column), since))
    if until is not None:
        df = df.where(F.col(time_column) < _bound(F.col(time_column), until))
    return df


def audit_query(
    df: DataFrame,
    wanted: Mapping[str, object],
    order: Sequence[str],
    limit: int | None = None,
    *,
    since=None,
    until=None,
    time_column: str = "ts",
) -> DataFrame:
    """The sink's query: exact equality, half-open time range, the first ``limit`` matches in log
    order, each carrying ``total``, the number of all matches.

    The page is a top-k (no full sort) and the total a one-row scalar subquery.
    """
    limit = min(limit if limit is not None else C.QUERY_DEFAULT_LIMIT, C.QUERY_MAX_LIMIT)
    matches = _exact(df, wanted, since, until, time_column)
    total = matches.agg(F.count(F.lit(1)).alias("total")).scalar()
    return matches.orderBy(*order).limit(limit).withColumn("total", total)


def audit_report(df: DataFrame, now_ms: int, *, ts_ms: str = "ts_ms") -> DataFrame:
    """Display columns of a log row: short time, age bucket, duration and flattened preview."""
    seconds = F.greatest(F.lit(0), F.floor((F.lit(now_ms) - F.col(ts_ms)) / 1000)).cast("bigint")
    minutes, hours = F.floor(seconds / 60), F.floor(seconds / 3600)
    age = (
        F.when(seconds < 5, F.lit("now"))
        .when(seconds < 60, F.concat(seconds.cast("string"), F.lit("s")))
        .when(minutes < 60, F.concat(minutes.cast("string"), F.lit("m")))
        .when(hours < 24, F.concat(hours.cast("string"), F.lit("h")))
        .otherwise(F.concat(F.floor(hours / 24).cast("string"), F.lit("d")))
    )
    return df.select(
        "*",
        F.date_format(F.timestamp_millis(F.col(ts_ms)), "MM-dd HH:mm:ss").alias("when_text"),
        age.alias("age"),
        F.coalesce(F.concat(F.col("duration_ms").cast("string"), F.lit("ms")), F.lit("-")).alias("duration_text"),
        F.regexp_replace(F.coalesce("statement_preview", F.lit("-")), r"[\r\n\t]+", " ").alias("preview_text"),
    )


def may_see_definitions(role: Column) -> Column:
    full = [r for r, caps in C.ROLE_CAPABILITIES.items() if "introspect_full" in caps]
    return F.coalesce(role.isin(full), F.lit(False))


def mask_by_role(
    df: DataFrame, role: str, *, blank: Sequence[str] = (), null: Sequence[str] = (), only_full: Column | None = None
) -> DataFrame:
    """Definitions are for roles with the full-introspection capability: other roles read ``''``
    in ``blank`` columns, null in ``null`` columns, and no row at all where ``only_full`` holds."""
    full = may_see_definitions(F.col(role))
    if only_full is not None:
        df = df.where(full | ~only_full)
    return df.withColumns(
        {c: F.when(full, F.coalesce(c, F.lit(""))).otherwise(F.lit("")) for c in blank}
        | {c: F.when(full, F.col(c)) for c in null}
    )


def user_objects(df: DataFrame, schema: str = "table_schema") -> DataFrame:
    """Rows outside the system schemas. ``_`` in the pattern is a wildcard, so ``pgx..`` goes too."""
    return df.where(~F.col(schema).like("pg_%") & (F.col(schema) != "information_schema"))


def label_mismatches(df: DataFrame, asserted: str = "db_alias_asserted", resolved: str = "resolved_db_alias") -> DataFrame:
    """Records that contradict themselves: the alias named is not the one that was touched.
    ``unresolved`` is the value of a refusal and differs from every real alias."""
    return df.where(~F.col(asserted).eqNullSafe(F.col(resolved)))
