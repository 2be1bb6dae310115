"""Ordered computations that stay parallel when one key holds most of the rows.

A window partitioned by the key alone would put a hot key into one task. These helpers take a
``block`` column that cuts each key's order into consecutive pieces (an hour, a segment file, a
range of sequence numbers). Rows are only ever ordered inside one ``(key, block)`` group; what
crosses a block border is carried by a one-row-per-block summary, which is the only thing that is
ordered by key alone. The main data is shuffled once, on ``keys + block``.

``block`` must be non-decreasing along ``order`` within a key. Null keys are one key like any other: rows
and summaries meet on a struct of keys and block, whose null fields are equal to each other, so that the
windows, the summary and the join all use the same partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import cut_lineage

#: the struct of keys and block while a helper works
PLACE = "_place"


def placed(df: DataFrame, keys: Sequence[str], block: str) -> DataFrame:
    return df.withColumn(PLACE, F.struct(*keys, block))


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], label: str, block: str) -> DataFrame:
    """``df`` with a ``block`` along (keys, order) that no hot key or crowded time can make large: the number of the
    range that a row falls into. Ranges are found by sampling, so the rows are written out with their number once."""
    ranges = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return cut_lineage(df.repartitionByRange(ranges, *keys, *order).withColumn(block, F.spark_partition_id()), label)


def inside(order: Sequence[str]):
    return Window.partitionBy(PLACE).orderBy(*order)


def across(keys: Sequence[str], block: str):
    key = [F.col(PLACE)[k] for k in keys] or [F.lit(0)]
    return Window.partitionBy(*key).orderBy(F.col(PLACE)[block])


def before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _upto(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def number_rows(
    df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], name: str = "rn"
) -> DataFrame:
    """``row_number() over (partition by keys order by order)``, block by block."""
    df = placed(df, keys, block)
    sizes = (
        df.groupBy(PLACE)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_skip", F.coalesce(F.sum("_size").over(before(across(keys, block))), F.lit(0)))
        .drop("_size")
    )
    return (
        df.withColumn("_local", F.row_number().over(inside(order)))
        .join(sizes, PLACE, "left")
        .withColumn(name, F.col("_skip") + F.col("_local"))
        .drop(PLACE, "_skip", "_local")
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    block: str,
    order: Sequence[str],
    value: Column,
    how: str,
    name: str,
    inclusive: bool = True,
) -> DataFrame:
    """Running ``sum``, ``min`` or ``max`` of ``value`` along the order of each key."""
    fold = {"sum": F.sum, "min": F.min, "max": F.max}[how]
    df = placed(df, keys, block).withColumn("_value", value)
    totals = (
        df.groupBy(PLACE)
        .agg(fold("_value").alias("_total"))
        .withColumn("_carry", fold("_total").over(before(across(keys, block))))
        .drop("_total")
    )
    frame = _upto(inside(order)) if inclusive else before(inside(order))
    local = df.withColumn("_local", fold("_value").over(frame)).join(totals, PLACE, "left")
    if how == "sum":
        merged = F.coalesce(F.col("_carry"), F.lit(0)) + F.coalesce(F.col("_local"), F.lit(0))
    else:
        merged = {"min": F.least, "max": F.greatest}[how]("_carry", "_local")
    return local.withColumn(name, merged).drop(PLACE, "_value", "_carry", "_local")


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    block: str,
    order: Sequence[str],
    carry: Sequence[str],
    name: str = "previous",
    position: str = "position",
) -> DataFrame:
    """Attach the preceding row's ``carry`` columns (a struct, null on the first row) and the
    1-based position of every row within its key."""
    packed = F.struct(*[F.col(c) for c in carry])
    along = F.struct(*[F.col(c) for c in order])
    df = placed(df, keys, block)
    blocks = across(keys, block)
    tails = (
        df.groupBy(PLACE)
        .agg(F.max_by(packed, along).alias("_tail"), F.count(F.lit(1)).alias("_size"))
        .withColumn("_carried", F.lag("_tail").over(blocks))
        .withColumn("_skip", F.coalesce(F.sum("_size").over(before(blocks)), F.lit(0)))
        .drop("_tail", "_size")
    )
    return (
        df.withColumn("_near", F.lag(packed).over(inside(order)))
        .withColumn("_local", F.row_number().over(inside(order)))
        .join(tails, PLACE, "left")
        .withColumn(name, F.coalesce("_near", "_carried"))
        .withColumn(position, F.col("_skip") + F.col("_local"))
        .drop(PLACE, "_near", "_local", "_carried", "_skip")
    )
