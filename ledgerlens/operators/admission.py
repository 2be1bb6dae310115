"""Event-time admission: freshness, expiry and replay decided over tables of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import constants as C


def wake_refusal(arrived_ms: Column) -> Column:
    """First stateless reason to refuse a wake event, or null. Columns: ``wake_id, reason,
    queued_at, token, token_expires_at`` (times in ms)."""
    age = arrived_ms - F.col("queued_at")
    shaped = (
        (F.coalesce("wake_id", F.lit("")) != "")
        & F.coalesce(F.col("reason").isin(list(C.WAKE_REASONS)), F.lit(False))
        & F.col("queued_at").isNotNull()
        & (F.coalesce("token", F.lit("")) != "")
        & F.col("token_expires_at").isNotNull()
    )
    return (
        F.when(~shaped, "malformed")
        .when(F.col("token_expires_at") - C.WAKE_SKEW_MS - C.WAKE_MIN_TOKEN_LIFE_MS <= arrived_ms, "expired_token")
        .when(age > C.WAKE_MAX_AGE_MS + C.WAKE_SKEW_MS, "stale")
        .when(age < -C.WAKE_SKEW_MS, "future_dated")
    )


def admit_events(events: DataFrame, arrived_ms: str = "arrived_ms", row_id: str = "row_id", cache_entries: int | None = None) -> DataFrame:
    """Add ``refusal`` (null when accepted) to wake events.

    Of the events that pass the stateless checks the first to arrive per ``wake_id`` is accepted
    and the rest are ``replayed``; the first is found by an aggregate, so an id repeated very often
    costs no window. With ``cache_entries`` an id that is new after that many have been accepted is
    ``cache_full``, which is the smallest ``cache_entries`` first arrivals by a top-k.
    """
    arrived = F.col(arrived_ms)
    df = events.withColumn("_refusal", wake_refusal(arrived))
    moment = F.struct(arrived_ms, row_id)
    first = (
        df.where(F.col("_refusal").isNull())
        .groupBy(F.col("wake_id").alias("_id"))
        .agg(F.min(moment).alias("_first"))
    )
    if cache_entries is not None:
        kept = first.orderBy("_first").limit(cache_entries)
        last = kept.agg(F.max("_first")).scalar()
    df = df.join(first, F.col("wake_id") == F.col("_id"), "left")
    replay = F.when(moment > F.col("_first"), "replayed")
    if cache_entries is not None:
        df = df.withColumn("_last", last)
        replay = F.when(F.col("_first") > F.col("_last"), "cache_full").otherwise(replay)
    return df.select(*events.columns, F.coalesce("_refusal", replay).alias("refusal"))


def drop_replays(
    df: DataFrame, nonce: str = "nonce", ts_ms: str = "ts_ms", arrived_ms: str = "arrived_ms", row_id: str = "row_id",
    horizon_ms: int = C.ENVELOPE_SKEW_MS,
) -> DataFrame:
    """Envelopes inside the freshness window whose nonce has not been used before, first one wins."""
    fresh = df.where(F.abs(F.col(arrived_ms) - F.col(ts_ms)) <= horizon_ms)
    kept = F.min_by(F.struct(*df.columns), F.struct(arrived_ms, row_id)).alias("_row")
    return fresh.groupBy(F.col(nonce).alias("_nonce")).agg(kept).select("_row.*")
