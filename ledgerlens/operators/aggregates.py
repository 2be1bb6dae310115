"""Roll-ups of the audit log. All are partial-then-final hash aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.functions import redaction


def counter_columns() -> dict[str, Column]:
    """What each service counter counts, as a condition on one record."""
    served = (F.col("decision") == "allow") & (F.col("outcome") != "n/a")
    overflow = (F.col("decision") == "deny") & F.col("denial_reason").eqNullSafe("buffer_overflow")
    return {
        "queries_served": served & (F.col("action") == "query"),
        "streams_served": served & (F.col("action") == "stream_query"),
        "migrations_run": served & (F.col("action") == "migration_run"),
        "cancellations": served & (F.col("action") == "cancel"),
        "buffer_overflows": overflow,
        "permission_denies": (F.col("decision") == "deny") & ~overflow,
    }


def service_counters(df: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[F.count_if(c).alias(name) for name, c in counter_columns().items()])


def chain_coverage(df: DataFrame, by: Sequence[str] = ("chain_id",)) -> DataFrame:
    """First and last sequence number, records and malformed lines per chain. A log with a record
    that lacks ``chain_id`` or ``seq`` is *legacy*: it can be read but never called verified."""
    bad = F.coalesce("malformed", F.lit(False)) if "malformed" in df.columns else F.lit(False)
    unlinked = ~bad & (F.col("seq").isNull() | F.col("chain_id").isNull())
    return df.groupBy(*by).agg(
        F.min("seq").alias("from_seq"),
        F.max("seq").alias("to_seq"),
        F.count_if(~bad).alias("records"),
        F.count_if(bad).alias("malformed_lines"),
        F.coalesce(F.max(unlinked), F.lit(False)).alias("legacy"),
    )


def error_log_stats(df: DataFrame, raw: str = "raw", file_ord: str = "file_ord", position: str = "line_no") -> DataFrame:
    """Bytes over every segment, number of archives, and records and last time of the active one.

    ``file_ord`` grows with age order, so the active segment is the largest. Two aggregates: one
    row per segment, then one row.
    """
    spoken = F.trim(F.col(raw)) != ""
    ts = F.get_json_object(F.when(spoken, F.col(raw)), "$.ts")
    per_file = df.groupBy(file_ord).agg(
        F.sum(F.octet_length(raw) + 1).alias("size_bytes"),
        F.count_if(spoken).alias("records"),
        F.max_by(ts, F.when(ts.isNotNull(), F.col(position))).alias("last_ts"),
    )
    active = F.max_by(F.struct("records", "last_ts"), file_ord)
    return per_file.agg(
        F.sum("size_bytes").alias("size_bytes"),
        (F.count(F.lit(1)) - 1).alias("archives"),
        active.alias("active"),
    ).select(
        "size_bytes", "archives", F.col("active.records").alias("records"), F.col("active.last_ts").alias("last_error_ts")
    )


def class_rank(column: str = "type") -> Column:
    expr = None
    for name, rank in C.CLASS_RANK.items():
        matches = F.col(column) == name
        expr = F.when(matches, rank) if expr is None else expr.when(matches, rank)
    return expr.otherwise(max(C.CLASS_RANK.values()))


def worst_class(df: DataFrame, by: Sequence[str] = ("request_id",), idx: str = "idx") -> DataFrame:
    """One verdict for a request from the verdicts of its statements: the worst class (the first
    statement of that class names the verb), all-of for flags, sums, and the union of violations.

    Unions collect *distinct arrays*, so a group keeps as many as there are combinations of a
    closed vocabulary, not as many as it has statements.
    """
    worst = F.min_by(F.struct("type", "verb"), F.struct(-class_rank(), F.col(idx)))

    def union(c: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))

    return (
        df.groupBy(*by)
        .agg(
            worst.alias("_worst"),
            F.bool_and("transactional").alias("transactional"),
            F.bool_and("parse_ok").alias("parse_ok"),
            F.sum("statement_count").alias("statement_count"),
            union("read_violations").alias("read_violations"),
            union("side_effects").alias("side_effects"),
        )
        .select(*by, "_worst.*", "transactional", "parse_ok", "statement_count", "read_violations", "side_effects")
    )


def plan_outcome(df: DataFrame) -> DataFrame:
    """Outcome of a plan from its per-statement rows ``(plan_id, idx, strategy, status, ms,
    pg_error_code)``.

    A failure rolls a single-transaction plan back, which undoes every earlier statement; in a
    per-statement plan the earlier ones stay, so the plan is partial. The undone indices are a
    range, so no list has to be collected.
    """
    failed = F.col("status") == "failed"
    known = F.when(F.col("pg_error_code").rlike("^[0-9A-Z]{5}$"), F.col("pg_error_code"))
    first = F.min(F.when(failed, F.col("idx")))
    grouped = df.groupBy("plan_id").agg(
        F.max("strategy").alias("strategy"),
        first.alias("failed_at"),
        F.min_by(F.struct(known.alias("code")), F.when(failed, F.col("idx"))).alias("_code"),
        F.count_if(F.col("status") == "success").alias("applied"),
        F.sum("ms").alias("total_ms"),
    )
    undone = F.col("failed_at").isNotNull() & (F.col("strategy") == "single_tx") & (F.col("failed_at") > 0)
    return grouped.select(
        "plan_id",
        F.when(F.col("failed_at").isNull(), "committed")
        .when(F.col("strategy") == "single_tx", "rolled_back")
        .otherwise("partial")
        .alias("status"),
        "failed_at",
        F.when(F.col("failed_at").isNotNull(), F.col("_code.code")).alias("error_code"),
        F.when(undone, F.sequence(F.lit(0), (F.col("failed_at") - 1).cast("int")))
        .otherwise(F.array().cast("array<int>"))
        .alias("rolled_back_indices"),
        "applied",
        "total_ms",
    )


#: size of a latency sketch: exact up to so many values, and a rank error of about 1.7 / size beyond
SKETCH_SIZE = 4096
PERCENTILES = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}


def _traffic(sketch: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col("outcome") == "error").alias("errors"),
        F.sum("duration_ms").alias("total_ms"),
        F.max("duration_ms").alias("max_ms"),
        F.min("ts_ms").alias("first_ms"),
        F.max("ts_ms").alias("last_ms"),
        sketch.alias("latency"),
    ]


def _percentiles(rolled: DataFrame) -> DataFrame:
    """``latency`` replaced by its percentiles; null where there was no duration."""
    found = {name: F.when(F.kll_sketch_get_n_bigint("latency") > 0, F.kll_sketch_get_quantile_bigint("latency", F.lit(rank))) for name, rank in PERCENTILES.items()}
    return rolled.withColumns(found).drop("latency")


def statement_traffic(df: DataFrame, by: Sequence[str] = (), sql: str = "sql_text", salt: str = "ledgerlens", size: int = SKETCH_SIZE) -> DataFrame:
    """Traffic per ``by`` and statement shape, with ``latency``, a quantile sketch of the durations. Sketches merge, so
    the result may be kept and rolled up further (``merge_traffic``) without the log.

    The fingerprint is computed before the shuffle, so only 16 characters, partial sums and sketches of bounded size move.
    """
    shaped = df.withColumn("fingerprint", F.expr(redaction.fingerprint(sql, salt))).withColumn("duration_ms", F.col("duration_ms").cast("bigint"))
    return shaped.groupBy(*by, "fingerprint").agg(*_traffic(F.kll_sketch_agg_bigint("duration_ms", F.lit(size))))


def merge_traffic(parts: DataFrame, by: Sequence[str] = (), percentiles: bool = True) -> DataFrame:
    """Traffic per ``by`` and statement shape from finer ``statement_traffic`` rows: what the log itself would give."""
    merged = parts.groupBy(*by, "fingerprint").agg(
        F.sum("calls").alias("calls"), F.sum("errors").alias("errors"), F.sum("total_ms").alias("total_ms"), F.max("max_ms").alias("max_ms"),
        F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"), F.kll_merge_agg_bigint("latency").alias("latency"),
    )
    return _percentiles(merged) if percentiles else merged


def statement_rollup(df: DataFrame, sql: str = "sql_text", salt: str = "ledgerlens") -> DataFrame:
    """Traffic per statement shape with latency percentiles: the smallest duration that at least that share of the calls do not exceed."""
    return _percentiles(statement_traffic(df, (), sql, salt))
