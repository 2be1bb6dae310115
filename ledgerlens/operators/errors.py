"""Database errors explained in fixed words, with only cleaned text of the server's own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.functions import redaction, scrubbing
from ledgerlens.operators.text_jobs import scrub_text
from ledgerlens.session import fixed_table


def code_table(spark: SparkSession) -> DataFrame:
    """The rule table ``(code, curated, hint, show_detail, retryable)``."""
    codes = sorted({*C.CURATED_MESSAGES, *C.CURATED_HINTS, *C.DETAIL_CODES, *C.RETRYABLE_CODES})
    rows = [
        (c, C.CURATED_MESSAGES.get(c), C.CURATED_HINTS.get(c), c in C.DETAIL_CODES, c in C.RETRYABLE_CODES) for c in codes
    ]
    return fixed_table(spark, rows, "code string, curated string, hint string, show_detail boolean, retryable boolean")


def request_code_table(spark: SparkSession) -> DataFrame:
    """The rule table of request errors ``(code, message, fatal, retryable, hint)``."""
    rows = [(code, *entry) for code, entry in C.REQUEST_ERRORS.items()]
    return fixed_table(spark, rows, "code string, message string, fatal boolean, retryable boolean, hint string")


def describe_codes(df: DataFrame, codes: DataFrame, code: str = "code") -> DataFrame:
    """Add ``message, fatal, retryable, hint`` to rows with a request error code; an unlisted code
    gets the generic text and is neither fatal nor retryable."""
    rules = codes.select(F.col("code").alias("_code"), "message", "fatal", "retryable", "hint")
    return df.join(rules, F.col(code) == F.col("_code"), "left").select(
        *df.columns,
        F.coalesce("message", F.lit(C.GENERIC_ERROR)).alias("message"),
        F.coalesce("fatal", F.lit(False)).alias("fatal"),
        F.coalesce("retryable", F.lit(False)).alias("retryable"),
        "hint",
    )


def normalised_severity(column: str) -> Column:
    upper = F.upper(column)
    return F.when(upper.isin(list(C.SEVERITIES)), upper).otherwise("ERROR")


def safe_code(column: str, fallback: str = "INTERNAL", pattern: str = "^[A-Za-z0-9_.]{1,32}$") -> Column:
    """A code is a code, never free text."""
    return F.when(F.col(column).rlike(pattern), F.col(column)).otherwise(fallback)


def safe_reason(column: str) -> Column:
    return safe_code(column, "denied", "^[a-z0-9_]{1,32}$")


def _cleaned(df: DataFrame, column: str, to: str, terms: Sequence[str]) -> DataFrame:
    """Redacted, then scrubbed text; null when nothing may be shown."""
    df = df.withColumn("_r", F.expr(redaction.redact(f"`{column}`")))
    df = scrub_text(df, "_r", "_s", terms)
    shown = F.when((F.col("_r") != redaction.UNREDACTABLE) & (F.col("_s") != ""), F.col("_s"))
    return df.withColumn(to, shown).drop("_r", "_s")


def explain_errors(
    errors: DataFrame, codes: DataFrame, exact_terms: Sequence[str] = (), pool: str | None = None
) -> DataFrame:
    """Replace ``message`` and add ``hint, retryable, severity, audit_code``.

    ``errors`` has ``code, severity, message, detail``. A code of the table that may show detail
    gets its fixed sentence plus the cleaned text; any other code only names itself. ``pool`` names
    a flag column for connection-pool errors, whose text is always replaced.
    """
    rules = codes.select(F.col("code").alias("_code"), F.col("curated").alias("_curated"), F.col("hint").alias("_hint"),
                         F.col("show_detail").alias("_show"), F.col("retryable").alias("_retry"))
    df = errors.withColumn("code", F.coalesce(F.when(F.col("code") != "", F.col("code")), F.lit("UNKNOWN")))
    df = df.join(rules, F.col("code") == F.col("_code"), "left")
    df = _cleaned(_cleaned(df, "message", "_message", exact_terms), "detail", "_detail", exact_terms)
    shown = F.concat_ws(" ", F.coalesce("_curated", F.lit("The database reported an error.")), "_message", "_detail")
    generic = F.concat(F.lit("Database error ("), "code", F.lit(f"). {C.GENERIC_ERROR}"))
    text = F.when(F.coalesce("_show", F.lit(False)), shown).otherwise(generic)
    df = df.withColumn("_text", F.regexp_replace(F.regexp_replace(text, r"[ \t]{2,}", " "), r"^\s+|\s+$", ""))
    text = F.expr(scrubbing.clamp("_text", C.ERROR_TEXT_CHARS))
    hint = F.when(F.coalesce("_show", F.lit(False)), F.col("_hint"))
    if pool:
        known = F.lit(C.POOL_FALLBACK)
        for code, message in C.POOL_MESSAGES.items():
            known = F.when(F.col("code") == code, message).otherwise(known)
        text, hint = F.when(F.col(pool), known).otherwise(text), F.when(~F.col(pool), hint)
    others = [c for c in errors.columns if c not in ("code", "severity", "message", "detail")]
    return df.select(
        *others, "code", normalised_severity("severity").alias("severity"), text.alias("message"), hint.alias("hint"),
        F.coalesce("_retry", F.lit(False)).alias("retryable"), safe_code("code").alias("audit_code"),
    )
