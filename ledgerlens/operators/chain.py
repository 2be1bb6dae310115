"""Tamper-evident hash chains: building, verifying and anchoring them.

A record's MAC covers its canonical text and the MAC before it, so *building* a chain is serial
inside the chain and parallel across chains; *verifying* only needs each record's neighbour and is
parallel everywhere.
"""

from __future__ import annotations

import hmac
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import constants as C
from ledgerlens.functions import mac
from ledgerlens.operators.ordered import number_rows, with_previous

_HEX64 = "^[0-9a-f]{64}$"
#: columns of the link itself; the rest of a record is its content
LINK = ("chain_id", "seq", "prev_hash")


def _sealer(key: bytes):
    """Fold over rows sorted by chain and position; holds one MAC, whatever the chain's length."""

    genesis = C.GENESIS

    def seal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, last = None, genesis
        for batch in batches:
            before, macs = [], []
            columns = (batch.column(c).to_pylist() for c in ("chain_id", "_head", "_tail"))
            for this, head, tail in zip(*columns):
                if this != chain:
                    chain, last = this, genesis
                before.append(last)
                text = f'{head},"prev_hash":"{last}"{tail}{last}'
                last = hmac.digest(key, text.encode(), "sha256").hex()
                macs.append(last)
            kept = [i for i, name in enumerate(batch.schema.names) if name not in ("_head", "_tail")]
            arrays = [batch.column(i) for i in kept] + [pa.array(before), pa.array(macs), pa.array(macs)]
            names = [batch.schema.names[i] for i in kept] + ["prev_hash", "mac", "hash"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return seal


def build_chain(
    df: DataFrame,
    key: bytes,
    chain: str,
    block: str,
    order: Sequence[str],
    record: Sequence[str],
    link_records: int | None = None,
) -> DataFrame:
    """Add ``chain_id, seq, prev_hash, mac, hash`` to every row.

    ``record`` names the content columns the MAC covers. A chain is cut into links of
    ``link_records`` rows, each a chain of its own starting from genesis, so a key with a third of
    all rows still spreads over many tasks; ``None`` keeps one chain per key. Rows stream through the fold in sorted order: memory
    is one Arrow batch.
    """
    numbered = number_rows(df, [chain], block, order, "_n")
    if link_records:
        link = F.floor((F.col("_n") - 1) / link_records)
        numbered = numbered.withColumns(
            {
                "chain_id": F.concat_ws("/", chain, F.lpad(link.cast("string"), 6, "0")),
                "seq": (F.col("_n") - 1) % link_records + 1,
            }
        )
    else:
        numbered = numbered.withColumns({"chain_id": F.col(chain), "seq": F.col("_n")})
    names = sorted({*record, "chain_id", "seq"})
    head = mac.canonical_json([c for c in names if c < "prev_hash"])
    tail = mac.canonical_json([c for c in names if c > "prev_hash"])
    prepared = numbered.drop("_n").withColumns(
        {
            "_head": F.expr(f"left({head}, char_length({head}) - 1)"),
            "_tail": F.expr(f"CASE WHEN {tail} = '{{}}' THEN '}}' ELSE concat(',', substring({tail}, 2)) END"),
        }
    )
    schema = T.StructType([f for f in prepared.schema.fields if f.name not in ("_head", "_tail")])
    for name in ("prev_hash", "mac", "hash"):
        schema = schema.add(name, "string")
    return prepared.repartition("chain_id").sortWithinPartitions("chain_id", "seq").mapInArrow(_sealer(key), schema)


def record_mac(record: Sequence[str], key: bytes) -> Column:
    """The MAC a record should carry, from its columns."""
    text = mac.canonical_json([*record, *LINK])
    return F.expr(mac.hmac_sha256(f"concat({text}, `prev_hash`)", key))


def line_mac(raw: str, key: bytes) -> Column:
    """The MAC a stored JSON line should carry, from the line itself (unknown fields included)."""
    return F.expr(mac.hmac_sha256(f"concat({mac.canonical_line(raw)}, `prev_hash`)", key))


def _shape() -> Column:
    """Reasons that need nothing but the record, in the order they are looked at."""
    malformed = F.coalesce(F.col("malformed"), F.lit(False))
    return F.when(
        malformed
        | ~F.coalesce(F.col("prev_hash").rlike(_HEX64), F.lit(False))
        | F.col("seq").isNull()
        | (F.col("seq") < 1)
        | (F.coalesce("chain_id", F.lit("")) == ""),
        "malformed",
    )


def _authenticity(expected: Column) -> Column:
    shaped = F.coalesce(F.col("mac").rlike(_HEX64), F.lit(False)) & F.col("hash").eqNullSafe(F.col("mac"))
    return F.when(~shaped, "malformed").when(~expected.eqNullSafe(F.col("mac")), "mac_mismatch")


def verify_chain(
    df: DataFrame,
    key: bytes,
    record: Sequence[str],
    keys: Sequence[str] = ("chain_id",),
    block: str | None = None,
    order: Sequence[str] = ("seq",),
    anchors: DataFrame | None = None,
    raw: str | None = None,
    block_rows: int = 1_000_000,
) -> DataFrame:
    """One row per log: ``intact, reason, broken_at, broken_seq, events`` and the observed head.

    ``keys`` name a log, ``order`` its record order and ``block`` a column cutting that order into
    pieces (default: ranges of ``block_rows`` sequence numbers; for segment files use the file).
    The first failing record decides. Each record is compared with the one before it; no step
    groups a whole log. ``raw`` verifies stored lines instead of ``record`` columns.

    ``anchors`` (one row per log: ``keys, anchor_chain_id, anchor_seq, anchor_hash,
    retained_from_seq, conflict, expected_prev_hash``; see :func:`resolve_anchor`) says where the
    log starts and ends. It is joined after aggregation, so a hot log does not skew the join.
    """
    if "malformed" not in df.columns:
        df = df.withColumn("malformed", F.lit(False))
    if block is None:
        block = "_block"
        df = df.withColumn(block, F.floor(F.coalesce("seq", F.lit(0)) / block_rows))
    expected = line_mac(raw, key) if raw else record_mac([c for c in record if c not in LINK], key)
    df = df.withColumns({"_shape": _shape(), "_auth": _authenticity(expected)})
    kept = [*keys, block, *[c for c in order if c not in keys and c != block]]
    kept += [c for c in ("chain_id", "seq", "prev_hash", "mac", "_shape", "_auth") if c not in kept]
    linked = with_previous(df.select(*kept), keys, block, order, ["chain_id", "seq", "mac"])

    before = F.col("previous")
    step = (
        F.when(F.col("_shape").isNotNull(), F.col("_shape"))
        .when(F.col("chain_id") != before["chain_id"], "chain_id_mismatch")
        .when(F.col("seq") == before["seq"], "seq_duplicate")
        .when(F.col("seq") < before["seq"], "seq_regression")
        .when(F.col("seq") > before["seq"] + 1, "seq_gap")
        .when(~F.col("prev_hash").eqNullSafe(before["mac"]), "prev_hash_mismatch")
        .otherwise(F.col("_auth"))
    )
    later = F.when(F.col("position") > 1, step)
    broken = F.when(later.isNotNull(), F.col("position"))
    seen = linked.groupBy(*keys).agg(
        F.max("position").alias("_count"),
        F.min_by(F.struct("chain_id", "seq", "prev_hash", "_shape", "_auth"), "position").alias("_first"),
        F.min_by(F.struct(later.alias("reason"), "position", "seq"), broken).alias("_broken"),
        F.max_by(F.struct("chain_id", "seq", "mac"), "position").alias("_head"),
    )
    return _conclude(seen, keys, anchors)


def _conclude(seen: DataFrame, keys: Sequence[str], anchors: DataFrame | None) -> DataFrame:
    """First-record checks, anchor comparison and the verdict, on one row per log."""
    wanted = {
        "anchor_chain_id": "string", "anchor_seq": "bigint", "anchor_hash": "string", "retained_from_seq": "bigint",
        "conflict": "boolean", "expected_prev_hash": "string",
    }
    if anchors is not None:
        seen = seen.join(anchors, list(keys), "full_outer")
    for name, kind in wanted.items():
        if name not in seen.columns:
            seen = seen.withColumn(name, F.lit(None).cast(kind))
    start = F.coalesce("retained_from_seq", F.lit(1))
    first, head = F.col("_first"), F.col("_head")
    adopts = F.col("expected_prev_hash").isNull() & (start > 1)
    opening = F.coalesce("expected_prev_hash", F.lit(C.GENESIS))
    at_first = (
        F.when(first["_shape"].isNotNull(), first["_shape"])
        .when(first["chain_id"] != F.col("anchor_chain_id"), "chain_id_mismatch")
        .when(first["seq"] < start, "seq_regression")
        .when(first["seq"] > start, "seq_gap")
        .when(~adopts & (first["prev_hash"] != opening), "prev_hash_mismatch")
        .otherwise(first["_auth"])
    )
    anchored = F.col("anchor_seq").isNotNull()
    at_end = F.when(anchored & (F.col("anchor_seq") > head["seq"]), "seq_regression").when(
        anchored & ((F.col("anchor_seq") < head["seq"]) | (F.col("anchor_hash") != head["mac"])), "head_mismatch"
    )
    missing = F.when(F.col("_count").isNull(), F.when(F.col("anchor_seq") > 0, "log_missing").otherwise("empty"))
    conflict = F.when(F.coalesce("conflict", F.lit(False)), "head_mismatch")
    place = F.when(
        missing.isNull() & conflict.isNull(),
        F.when(at_first.isNotNull(), F.struct(F.lit(1).cast("bigint").alias("position"), first["seq"].alias("seq"))).when(
            F.col("_broken.reason").isNotNull(), F.struct("_broken.position", "_broken.seq")
        ),
    )
    return seen.select(
        *keys,
        F.coalesce(missing, conflict, at_first, F.col("_broken.reason"), at_end).alias("reason"),
        place.alias("_place"),
        F.coalesce("_count", F.lit(0)).alias("_count"),
        conflict.alias("_conflict"),
        head["seq"].alias("observed_seq"),
        head["mac"].alias("observed_hash"),
    ).select(
        *keys,
        F.col("reason").isNull().alias("intact"),
        "reason",
        (F.col("_place.position") - 1).alias("broken_at"),
        F.col("_place.seq").alias("broken_seq"),
        F.when(F.col("_conflict").isNotNull(), 0).otherwise(F.coalesce("_place.position", "_count")).alias("events"),
        F.when(F.col("reason").isNull(), F.col("observed_seq")).alias("observed_seq"),
        F.when(F.col("reason").isNull(), F.col("observed_hash")).alias("observed_hash"),
    )


def verify_segments(
    log: DataFrame,
    key: bytes,
    record: Sequence[str],
    segment: str = "file_ord",
    order: Sequence[str] = ("line_no",),
    cached: DataFrame | None = None,
    first: DataFrame | None = None,
    raw: str | None = None,
) -> DataFrame:
    """Verify a log segment by segment: one row per segment that had to be read.

    Segments are numbered without holes. ``cached`` holds the trusted ends ``(segment, chain_id,
    seq, last_hash)`` of segments that need no reading; ``first`` the retention floor of the oldest
    one ``(segment, retained_from_seq)``. A segment must continue where the one before it ends,
    whether that end is trusted or read now, so the log is intact exactly when every row is. Ends
    meet by an equi-join on the segment number.
    """
    rows = log if cached is None else log.join(cached.select(segment).distinct(), [segment], "left_anti")
    along = F.struct(*order)
    ends = rows.groupBy(segment).agg(F.max_by(F.struct("chain_id", "seq", F.col("mac").alias("last_hash")), along).alias("_end"))
    read = ends.select(segment)
    ends = ends.select(segment, "_end.*")
    if cached is not None:
        ends = ends.unionByName(cached.select(segment, "chain_id", "seq", "last_hash"))
    starts = ends.select(
        (F.col(segment) + 1).alias(segment),
        F.col("chain_id").alias("anchor_chain_id"),
        (F.col("seq") + 1).alias("retained_from_seq"),
        F.col("last_hash").alias("expected_prev_hash"),
    )
    if first is not None:
        starts = starts.unionByName(first.select(segment, "retained_from_seq"), allowMissingColumns=True)
    starts = starts.join(read, [segment], "left_semi")
    blocked = rows.withColumn("_block", F.lit(0))
    return verify_chain(blocked, key, record, [segment], "_block", order, starts, raw)


def verify_by_join(df: DataFrame, key: bytes, record: Sequence[str], keys: Sequence[str] = ("chain_id",)) -> DataFrame:
    """Verification in *sequence* order by an equi-join with the record numbered one less.

    An alternative for a log whose order is its sequence number; it agrees with
    :func:`verify_chain` there. Records of one number are folded first (a second one is ``seq_duplicate``), so a number that repeats
    very often fans nothing out; malformed records have their reason, those without a number come first. Both sides shuffle on ``keys + seq``.
    """
    if "malformed" not in df.columns:
        df = df.withColumn("malformed", F.lit(False))
    checked = df.withColumns({"_shape": _shape(), "_auth": _authenticity(record_mac([c for c in record if c not in LINK], key))})
    one = F.struct((~F.col("malformed")).alias("sound"), "mac", "prev_hash", "_shape", "_auth")
    current = checked.groupBy(*keys, F.coalesce("seq", F.lit(0)).alias("seq")).agg(F.min(one).alias("_one"), F.count(F.lit(1)).alias("_copies")).select(
        *keys, "seq", "_copies", "_one.mac", "_one.prev_hash", "_one._shape", "_one._auth"
    )
    before = current.select(*keys, (F.col("seq") + 1).alias("seq"), F.col("mac").alias("_mac"), F.lit(True).alias("_follows"))
    joined = current.join(before, [*keys, "seq"], "left")
    step = (
        F.when(F.col("_shape").isNotNull(), F.col("_shape"))
        .when(F.col("_copies") > 1, "seq_duplicate")
        .when((F.col("seq") > 1) & F.col("_follows").isNull(), "seq_gap")
        .when(F.col("prev_hash") != F.coalesce("_mac", F.lit(C.GENESIS)), "prev_hash_mismatch")
        .otherwise(F.col("_auth"))
    )
    broken = F.when(step.isNotNull(), F.col("seq"))
    return joined.groupBy(*keys).agg(
        F.max(step.isNotNull()).alias("_failed"),
        F.min_by(step, broken).alias("reason"),
        F.min(broken).alias("broken_seq"),
    ).select(*keys, (~F.col("_failed")).alias("intact"), "reason", "broken_seq")


def resolve_anchor(claims: DataFrame, keys: Sequence[str] = ("log_id",), ord_column: str = "ord") -> DataFrame:
    """One anchor per log from claims ``(keys, ord, chain_id, seq, last_hash, retained_from_seq)``.

    The highest sequence number wins; two claims at one sequence number that differ are a
    contradiction, which verification reports and never breaks like a tie. The retention floor
    comes from the earliest claim that has one.
    """
    per_seq = claims.groupBy(*keys, "seq").agg(
        F.min_by(F.struct("chain_id", "last_hash"), ord_column).alias("_claim"),
        (F.min(F.struct("chain_id", "last_hash")) != F.max(F.struct("chain_id", "last_hash"))).alias("_differs"),
        F.min(F.when(F.col("retained_from_seq").isNotNull(), F.struct(ord_column, "retained_from_seq"))).alias("_floor"),
    )
    return per_seq.groupBy(*keys).agg(
        F.max_by("_claim", "seq").alias("_claim"),
        F.max("seq").alias("anchor_seq"),
        F.max("_differs").alias("conflict"),
        F.min("_floor").alias("_floor"),
    ).select(
        *keys,
        F.col("_claim.chain_id").alias("anchor_chain_id"),
        "anchor_seq",
        F.col("_claim.last_hash").alias("anchor_hash"),
        F.col("_floor.retained_from_seq").alias("retained_from_seq"),
        "conflict",
    )


def heads(df: DataFrame, keys: Sequence[str] = ("chain_id",)) -> DataFrame:
    """The last record of every chain, as a claim."""
    return df.groupBy(*keys).agg(F.max("seq").alias("seq"), F.max_by("mac", "seq").alias("last_hash"))
