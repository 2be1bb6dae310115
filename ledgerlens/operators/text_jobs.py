"""Text jobs: the text functions run over whole tables, without Python per row and without a shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import constants as C
from ledgerlens.functions import classes, mac, redaction, scrubbing


def _col(name: str) -> str:
    return f"`{name}`"


def redact_statements(df: DataFrame, sql: str = "sql", to: str = "redacted") -> DataFrame:
    return df.withColumn(to, F.expr(redaction.redact(_col(sql))))


def fingerprint_statements(
    df: DataFrame, sql: str = "sql", to: str = "fingerprint", salt: str = "ledgerlens"
) -> DataFrame:
    """``salt`` keys the digest of quoted identifiers; with the same salt results repeat."""
    return df.withColumn(to, F.expr(redaction.fingerprint(_col(sql), salt)))


def preview_statements(df: DataFrame, sql: str = "sql", to: str = "preview", **caps) -> DataFrame:
    df = df.withColumn("_redacted", F.expr(redaction.redact(redaction.trimmed(_col(sql)))))
    return df.withColumn(to, F.expr(redaction.preview("_redacted", **caps))).drop("_redacted")


def scrub_text(df: DataFrame, text: str = "text", to: str = "scrubbed", exact_terms: Sequence[str] = ()) -> DataFrame:
    """Every rule is its own projection, so the chain stays in generated code and each step reads
    the text once."""
    first, *steps = scrubbing.scrub_steps(_col(text), exact_terms)
    if "t" in df.columns:
        return df.withColumn(to, F.expr(scrubbing.scrub(_col(text), exact_terms)))
    df = df.withColumn("t", F.expr(first))
    for step in steps:
        df = df.withColumn("t", F.expr(step))
    return df.withColumn(to, F.col("t")).drop("t")


def scrub_errors(
    df: DataFrame,
    columns: Mapping[str, int] | None = None,
    homes: Sequence[str] = (),
) -> DataFrame:
    """Clean and clamp the free text of error records in place; ``columns`` maps name to cap."""
    columns = columns or {"message": scrubbing.MESSAGE_CHARS, "stack": scrubbing.STACK_CHARS}
    for name, limit in columns.items():
        df = df.withColumn(name, F.expr(scrubbing.scrub_error_values(_col(name))))
        df = df.withColumn(name, F.expr(scrubbing.shorten_windows_paths(_col(name))))
        df = df.withColumn(name, F.expr(scrubbing.shorten_posix_paths(_col(name), homes)))
        df = df.withColumn(name, F.expr(scrubbing.clamp(_col(name), limit)))
    return df


def mask_credentials(df: DataFrame, text: str = "text", to: str = "masked", secrets: Sequence[str] = ()) -> DataFrame:
    return df.withColumn(to, F.expr(scrubbing.mask_credentials(_col(text), secrets)))


def acceptable_plans(df: DataFrame, plan: str = "plan_id", most: int = C.MAX_PLAN_STATEMENTS) -> DataFrame:
    """Rows of the plans that can exist: the payload rules refuse one of more than ``most``
    statements, so lists per plan are bounded whatever the table holds. See :func:`plan_status`."""
    sizes = df.groupBy(F.col(plan).alias("_plan")).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") <= most)
    return df.join(sizes, F.col(plan) == F.col("_plan"), "left_semi")


def plan_status(df: DataFrame, plan: str = "plan_id", most: int = C.MAX_PLAN_STATEMENTS) -> DataFrame:
    """Every plan with ``plan_status``: accepted, too_many_statements or no_plan_id."""
    status = F.when(F.col(plan).isNull(), "no_plan_id").when(F.count(F.lit(1)) > most, "too_many_statements").otherwise("accepted")
    return df.groupBy(plan).agg(status.alias("plan_status"))


def plan_hash(df: DataFrame, plan: str = "plan_id", idx: str = "idx", sql: str = "sql") -> DataFrame:
    """One row per plan: the hash over its statements in order, null unless ``plan_status`` is accepted."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(idx, sql))), lambda s: s[sql])
    hashed = acceptable_plans(df, plan).groupBy(plan).agg(ordered.alias("_list")).select(
        plan, F.expr(redaction.statement_hash("_list")).alias("statements_hash")
    )
    return plan_status(df, plan).join(hashed, plan, "left").select(plan, "statements_hash", "plan_status")


def _text_size(field: T.StructField) -> str | None:
    c, kind = _col(field.name), field.dataType
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return f"octet_length({c})"
    if isinstance(kind, T.BinaryType):
        return f"octet_length({c})"
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return f"octet_length(to_json({c}))"
    return None


def _cell_text(field: T.StructField) -> str:
    c, kind = _col(field.name), field.dataType
    if isinstance(kind, T.BinaryType):
        return f"base64({c})"
    return c if isinstance(kind, T.StringType) else f"to_json({c})"


def truncate_cells(df: DataFrame, max_bytes: int = C.MAX_CELL_BYTES, preview_chars: int = C.CELL_PREVIEW_CHARS) -> DataFrame:
    """Every sizeable cell becomes ``{value, truncated, original_size, preview}``: an oversized one
    keeps its size and a short sample instead of its value. ``has_truncated_cells`` flags the row."""
    columns, flags = [], []
    for field in df.schema.fields:
        size = _text_size(field)
        if size is None:
            columns.append(F.col(field.name))
            continue
        over = f"coalesce({size} > {max_bytes}, false)"
        flags.append(over)
        columns.append(
            F.expr(
                f"named_struct('value', CASE WHEN NOT {over} THEN {_col(field.name)} END, 'truncated', {over}, "
                f"'original_size', {size}, 'preview', CASE WHEN {over} THEN left({_cell_text(field)}, {preview_chars}) END)"
            ).alias(field.name)
        )
    return df.select(*columns, F.expr(" OR ".join(flags) or "false").alias("has_truncated_cells"))


def _row_size(field: T.StructField) -> str:
    kind, size = field.dataType, _text_size(field)
    if size is None:
        if isinstance(kind, T.BooleanType):
            size = "1"
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            size = "24"
        else:
            size = "8"
    return f"CASE WHEN {_col(field.name)} IS NULL THEN 4 ELSE {size} END"


def row_bytes(df: DataFrame, to: str = "row_bytes") -> DataFrame:
    """Estimated transport size of each row, from the schema's types."""
    return df.withColumn(to, F.expr(" + ".join(_row_size(f) for f in df.schema.fields) or "0").cast("bigint"))


def within_budget(df: DataFrame, max_bytes: int = C.MAX_RESPONSE_BYTES) -> DataFrame:
    """One row: total size and whether a response of that size may be sent."""
    total = row_bytes(df).agg(F.coalesce(F.sum("row_bytes"), F.lit(0)).alias("total_bytes"))
    return total.withColumn("allowed", F.col("total_bytes") <= max_bytes)


def canonical_json(df: DataFrame, columns: Sequence[str], to: str = "canonical") -> DataFrame:
    return df.withColumn(to, F.expr(mac.canonical_json(columns)))


def with_hmac(df: DataFrame, text: str, key: bytes, to: str = "mac") -> DataFrame:
    return df.withColumn(to, F.expr(mac.hmac_sha256(_col(text), key)))


def classify_statements(df: DataFrame, sql: str = "sql") -> DataFrame:
    """Statement count, class, verb and flags of each text, classified by its most dangerous
    statement so that a leading SELECT never hides what follows it."""
    df = df.withColumn("_clean", F.expr(redaction.of_readable(_col(sql), classes.cleaned, "NULL")))
    df = df.withColumn("_parts", F.expr(classes.statements_of("_clean")))
    layers = (
        f"transform(_parts, (s, i) -> named_struct('s', s, 'm', {classes.main_text('s')}, 'i', i))",
        f"transform(_parts, p -> named_struct('s', p.s, 'm', p.m, 'i', p.i, 'w', {classes.first_word('p.m')}, "
        f"'calls', {classes.called_functions('p.s')}))",
        f"transform(_parts, p -> named_struct('s', p.s, 'm', p.m, 'i', p.i, 'w', p.w, 'calls', p.calls, "
        f"'base', {classes.class_of('p.m', 'p.w')}, 'verb', {classes.verb_of('p.m', 'p.w')}))",
        f"transform(_parts, p -> named_struct('i', p.i, 'base', p.base, 'verb', p.verb, 'calls', p.calls, "
        f"'flags', {classes.violations_of('p.s', 'p.m', 'p.w', 'p.base', 'p.verb', 'p.calls')}, "
        f"'explain', {classes.is_explain('p.s')}, 'analyze', {classes.is_explain_analyze('p.s')}))",
    )
    for layer in layers:
        df = df.withColumn("_parts", F.expr(layer))
    df = df.withColumnRenamed("_parts", "_seen")
    # an escaped SELECT counts as a write; EXPLAIN of a clean read is a read of its own
    kind = "CASE WHEN p.base = 'read' AND size(p.flags) > 0 THEN 'write' ELSE p.base END"
    verb = "CASE WHEN p.explain AND p.base = 'read' AND size(p.flags) = 0 THEN 'EXPLAIN' ELSE p.verb END"
    flags = (
        f"CASE WHEN p.analyze AND ({kind}) <> 'read' AND NOT array_contains(p.flags, 'executable_block') "
        "THEN array_append(p.flags, 'executable_block') ELSE p.flags END"
    )
    df = df.withColumn(
        "_seen",
        F.expr(f"transform(_seen, p -> named_struct('i', p.i, 'kind', {kind}, 'verb', {verb}, 'flags', {flags}, 'calls', p.calls))"),
    )
    rank = "CASE p.kind " + " ".join(f"WHEN '{name}' THEN {rank}" for name, rank in C.CLASS_RANK.items()) + " END"
    worst = f"array_max(transform(_seen, p -> named_struct('rank', {rank}, 'first', -p.i, 'kind', p.kind, 'verb', p.verb)))"
    df = df.withColumn("_worst", F.expr(worst))
    count = F.coalesce(F.size("_seen"), F.lit(0))
    failed = F.col("_clean").isNull() | (F.size("_seen") == 0)
    return df.withColumns(
        {
            "parse_ok": F.col("_clean").isNotNull(),
            "statement_count": F.when(F.col("_clean").isNull(), F.lit(0)).otherwise(count),
            "type": F.when(failed, "unknown").otherwise(F.col("_worst.kind")),
            "verb": F.when(failed, "").otherwise(F.col("_worst.verb")),
            "read_violations": F.when(failed, F.array(F.lit("parse_error"))).otherwise(
                F.array_distinct(
                    F.concat(
                        F.when(count > 1, F.array(F.lit("multiple_statements"))).otherwise(F.array().cast("array<string>")),
                        F.flatten(F.col("_seen.flags")),
                    )
                )
            ),
            "functions": F.array_distinct(F.flatten(F.col("_seen.calls"))),
        }
    ).drop("_clean", "_seen", "_worst")


def non_transactional(df: DataFrame, sql: str = "sql") -> DataFrame:
    """Per statement: ``tx_status`` (transactional, non_transactional, ambiguous, unparseable) and
    the label of what cannot run in a transaction."""
    df = df.withColumn("_clean", F.expr(redaction.of_readable(_col(sql), classes.cleaned, "NULL")))
    df = df.withColumn("_count", F.size(F.expr(classes.statements_of("_clean"))))
    df = df.withColumn("_word", F.expr(classes.first_word("_clean")))
    label = F.when(F.col("_count") == 1, F.expr(classes.non_transactional_label("_clean", "_word")))
    df = df.withColumn("non_tx_label", label)
    status = (
        F.when(F.col("_clean").isNull(), "unparseable")
        .when(F.col("_count") != 1, "ambiguous")
        .when(F.col("non_tx_label").isNotNull(), "non_transactional")
        .when(F.expr(classes.is_unproven("_clean", "_word")), "ambiguous")
        .otherwise("transactional")
    )
    return df.withColumn("tx_status", status).drop("_clean", "_count", "_word")


def plan_transactionality(df: DataFrame, plan: str = "plan_id", idx: str = "idx", sql: str = "sql") -> DataFrame:
    """Per plan: the indices that stop it from running in one transaction. A plan whose ``plan_status`` is
    not accepted has null lists and counts as one that cannot."""
    rows = non_transactional(acceptable_plans(df, plan), sql)

    def where(status: str):
        return F.array_sort(F.collect_list(F.when(F.col("tx_status") == status, F.col(idx))))

    grouped = rows.groupBy(plan).agg(
        where("non_transactional").alias("non_tx_indices"),
        where("unparseable").alias("unparseable_indices"),
        where("ambiguous").alias("ambiguous_indices"),
    )
    lists = ("non_tx_indices", "unparseable_indices", "ambiguous_indices")
    found = grouped.withColumn("has_non_transactional", reduce(lambda a, b: a | b, [F.size(c) > 0 for c in lists]))
    return plan_status(df, plan).join(found, plan, "left").select(
        plan, *lists, F.coalesce("has_non_transactional", F.lit(True)).alias("has_non_transactional"), "plan_status"
    )
