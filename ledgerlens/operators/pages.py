"""Pages, recent rows, row caps and tails: all bounded top-k plans, never a full sort."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import constants as C


class Cursor(NamedTuple):
    column: str
    last_value: object
    direction: str = "forward"


class RowCapExceeded(ValueError):
    """A result is larger than its cap. It is never cut silently."""


def page_size_of(requested: int | None) -> int:
    return min(max(int(requested if requested is not None else C.PAGE_SIZE), 1), C.MAX_PAGE_SIZE)


def keyset_rows(df: DataFrame, cursor: Cursor, page_size: int | None = None) -> DataFrame:
    """The page after ``cursor`` plus one look-ahead row, in cursor order.

    The bound is exclusive and a plain comparison, so it reaches the scan; the order and limit
    become one top-k.
    """
    if cursor.last_value is None:
        raise ValueError("cursor.last_value must be defined")
    if cursor.direction not in ("forward", "backward"):
        raise ValueError("cursor.direction must be forward or backward")
    key = F.col(cursor.column)
    forward = cursor.direction == "forward"
    bounded = df.where(key > F.lit(cursor.last_value) if forward else key < F.lit(cursor.last_value))
    return bounded.orderBy(key.asc() if forward else key.desc()).limit(page_size_of(page_size) + 1)


def keyset_page(df: DataFrame, cursor: Cursor, page_size: int | None = None) -> DataFrame:
    """One page with its ``has_more`` flag and ``next_value``, both constant over the page.

    The table is read once: the windows below run over the top-k's at most ``page_size + 1`` rows.
    """
    size = page_size_of(page_size)
    rows = keyset_rows(df, cursor, size)
    key, forward = F.col(cursor.column), cursor.direction == "forward"
    page = Window.partitionBy(F.lit(0))
    sent = F.col("_rn") <= size
    last = (F.max if forward else F.min)(F.when(sent, key)).over(page)
    return (
        rows.withColumn("_rn", F.row_number().over(page.orderBy(key.asc() if forward else key.desc())))
        .withColumn("has_more", F.count(F.lit(1)).over(page) > size)
        .withColumn("next_value", F.when(F.col("has_more"), last))
        .where(sent)
        .drop("_rn")
    )


def fetch_page(df: DataFrame, cursor: Cursor, page_size: int | None = None):
    """``(rows, has_more, next cursor)`` for a caller that shows one page. Collects the page only."""
    size = page_size_of(page_size)
    rows = keyset_rows(df, cursor, size).collect()
    more, rows = len(rows) > size, rows[:size]
    return rows, more, cursor._replace(last_value=rows[-1][cursor.column]) if more else None


def recent(df: DataFrame, order: Sequence[Column], limit: int = C.RECENT_LIMIT) -> DataFrame:
    """The newest ``limit`` rows, newest first."""
    return df.orderBy(*order).limit(limit if limit > 0 else C.RECENT_LIMIT)


def tail_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows in log order."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)


def capped(df: DataFrame, max_rows: int = C.MAX_QUERY_ROWS) -> DataFrame:
    """The same rows, or an error inside the plan when there are more than ``max_rows``.

    The count is a scalar subquery over no columns: partial counts are summed, no rows move.
    """
    size = df.agg(F.count(F.lit(1))).scalar()
    message = F.concat(F.lit(f"result exceeds {max_rows} rows: "), F.col("_size").cast("string"))
    within = F.when(F.col("_size") > max_rows, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_size", size).where(within).drop("_size")


def check_cap(df: DataFrame, max_rows: int = C.MAX_QUERY_ROWS) -> DataFrame:
    """Driver form of :func:`capped` for callers that want the error before they start reading."""
    size = df.count()
    if size > max_rows:
        raise RowCapExceeded(f"result has {size} rows, the cap is {max_rows}")
    return df
