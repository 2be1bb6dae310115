"""Recurrences along the order of a key, parallel also when one key holds all rows.

Rows are dealt by ranges of (keys, order), so every block has about as many rows as any other, whatever
their keys and times. A key that lies in several ranges crosses a border between two; there are fewer such keys than
ranges. For these, each block is summarised by itself as a map from the state before it to the state after it; one state per block is
then carried over these maps. With its true start state every block is folded, in parallel again.

A rule gives the step from row to row, the summary of a block's rows and how a state passes a summary. What
makes a recurrence parallel is that its summaries are small: see ``bucket_map``, ``cooldown_map`` and ``chunk_map``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlens.operators.ordered import PLACE, placed, ranged

BLOCK = "_block"


@dataclass(frozen=True)
class Rule:
    """A recurrence. States and summaries are tuples of the fields of their schemas; the first state of a key is None."""

    step: Callable[[tuple, tuple | None], tuple[tuple, tuple]]  # (row, state) -> (outputs, state)
    summarise: Callable[[list[np.ndarray]], tuple]  # a block's inputs, column by column -> summary
    advance: Callable[[tuple | None, tuple], tuple | None]  # (state, summary) -> state after the block
    outputs: str
    state: str
    summary: str


def _by_piece(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Consecutive slices of the batches that agree in ``names``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        pieces = list(zip(*(batch.column(n).to_pylist() for n in names)))
        first = 0
        for at in range(1, len(pieces) + 1):
            if at == len(pieces) or pieces[at] != pieces[first]:
                yield pieces[first], batch.slice(first, at - first)
                first = at


def _summaries(rule: Rule, where: Sequence[str], inputs: Sequence[str], schema: T.StructType):
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, head, held = None, None, []

        def summary() -> pa.RecordBatch:
            columns = [np.concatenate([part[i] for part in held]) for i in range(len(inputs))]
            row = [*(pa.array([v], f.type) for v, f in zip(head, target)), *(pa.array([v], f.type) for v, f in zip(rule.summarise(columns), list(target)[len(where):]))]
            return pa.RecordBatch.from_arrays(row, schema=target)

        for this, part in _by_piece(batches, where):
            if held and this != piece:
                yield summary()
                held = []
            piece = head = this
            held.append([part.column(i).to_numpy(zero_copy_only=False) for i in inputs])
        if held:
            yield summary()

    return run


def _starts(rule: Rule, keys: Sequence[str], summary: Sequence[str], schema: T.StructType):
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for this, part in _by_piece(batches, keys or [BLOCK]):
            if keys and this != key:
                key, state = this, None
            starts = []
            for row in zip(*(part.column(n).to_pylist() for n in summary)):
                starts.append(state)
                state = rule.advance(state, row)
            fields = target.field("_start").type
            values = pa.array([None if s is None else dict(zip((f.name for f in fields), s)) for s in starts], fields)
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in [*keys, BLOCK]), values], schema=target)

    return run


def _folded(rule: Rule, where: Sequence[str], inputs: Sequence[str], added: T.StructType):
    kinds = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, state = None, None
        for this, part in _by_piece(batches, where):
            if this != piece:
                first = part.column("_start")[0].as_py()
                piece, state = this, None if first is None else tuple(first.values())
            produced = []
            for row in zip(*(part.column(i).to_pylist() for i in inputs)):
                out, state = rule.step(row, state)
                produced.append(out)
            columns = [pa.array([row[i] for row in produced], f.type) for i, f in enumerate(kinds)]
            kept = part.drop_columns(["_start"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*kept.schema.names, *kinds.names])

    return run


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], inputs: Sequence[str], rule: Rule, label: str) -> DataFrame:
    """``df`` with the rule's outputs, folded in order within each key. Null keys are one key."""
    dealt = ranged(df, keys, order, label, BLOCK)
    where = [*keys, BLOCK]
    place = [dealt.schema[k] for k in where]

    key = F.struct(*keys) if keys else F.lit(0)
    crossing = dealt.groupBy(key.alias("_key")).agg(F.min(BLOCK).alias("low"), F.max(BLOCK).alias("high")).where("low < high").select("_key")
    rows = dealt.select(*dict.fromkeys([*where, *order, *inputs])).withColumn("_key", key).join(F.broadcast(crossing), "_key", "left_semi").drop("_key")
    summed = T.StructType([*place, *T.StructType.fromDDL(rule.summary).fields])
    summaries = rows.repartition(*where).sortWithinPartitions(*where, *order).mapInArrow(_summaries(rule, where, inputs, summed), summed)

    state = T.StructType([*place, T.StructField("_start", T.StructType.fromDDL(rule.state))])
    # a shuffle also without keys: without it the one task would summarise all blocks as well
    along = summaries.repartition(*keys) if keys else summaries.repartition(1)
    starts = along.sortWithinPartitions(*where).mapInArrow(_starts(rule, keys, summed.names[len(place):], state), state)

    added = T.StructType.fromDDL(rule.outputs)
    begun = placed(dealt, keys, BLOCK).join(F.broadcast(placed(starts, keys, BLOCK).select(PLACE, "_start")), PLACE, "left").drop(PLACE)
    schema = T.StructType([*dealt.schema.fields, *added.fields])
    return begun.repartition(*where).sortWithinPartitions(*where, *order).mapInArrow(_folded(rule, where, inputs, added), schema).drop(BLOCK)


# --- token buckets ------------------------------------------------------------------------------
#
# With ``spent`` the tokens spent so far and ``total`` those spent or held, a request after an inflow d gives
#
#   total' = min(spent + full, total + d)          spent' = min(spent + unit, whole(total + d))
#
# where ``whole`` rounds down to whole tokens. Both are the least of a few terms, and so is any chain of them:
#
#   spent' = min(spent + ss, whole(total + ts))
#   total' = min(spent + st, total + tt, whole(total + c) + k for (c, k) in via)
#
# ``via`` are the ways through a full bucket after a refusal; all but a few are never the least.

BucketMap = tuple[int, int, int, int, list[tuple[int, int]]]  # ss, st, ts, tt, via


def request_map(inflow: int, full: int, unit: int) -> BucketMap:
    return min(unit, full), full, inflow, inflow, []


def _useful(via: list[tuple[int, int]], st: int, tt: int, unit: int) -> list[tuple[int, int]]:
    """``via`` without the terms that another term is never above."""
    kept: list[tuple[int, int]] = []
    for c, k in sorted(set(via), key=lambda t: (t[0] + t[1], t)):
        if c + k - unit + 1 >= tt or c // unit * unit + k >= st:
            continue
        if all(-((c - d) // unit) * unit + j > k for d, j in kept):
            kept.append((c, k))
    return kept


def then(first: BucketMap, second: BucketMap, unit: int) -> BucketMap:
    """The map of ``first`` and then ``second``."""
    ss1, st1, ts1, tt1, via1 = first
    ss2, st2, ts2, tt2, via2 = second
    ss = min(ss1 + ss2, (st1 + ts2) // unit * unit)
    st = min([ss1 + st2, st1 + tt2, *((st1 + c) // unit * unit + k for c, k in via2)])
    ts = min([ts1 + ss2, tt1 + ts2, *(c + (k + ts2) // unit * unit for c, k in via1)])
    via = [(ts1, st2), *((c, k + tt2) for c, k in via1), *((tt1 + c, k) for c, k in via2)]
    via += [(c, (k + d) // unit * unit + j) for c, k in via1 for d, j in via2]
    return ss, st, ts, tt1 + tt2, _useful(via, st, tt1 + tt2, unit)


def held_after(tokens: int, change: BucketMap, unit: int) -> int:
    """Tokens in a bucket that held ``tokens`` before ``change``."""
    ss, st, ts, tt, via = change
    spent = min(ss, (tokens + ts) // unit * unit)
    return min([st, tokens + tt, *((tokens + c) // unit * unit + k for c, k in via)]) - spent


# --- pointers -----------------------------------------------------------------------------------


def chain_ends(successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the chain of successors from each place ends, and after how many steps.

    Places that are their own successor are ends. Successors of successors are taken until nothing changes, in as many rounds as the
    longest chain's length has binary digits.
    """
    steps = (successor != np.arange(len(successor))).astype(np.int64)
    while True:
        further = successor[successor]
        if (further == successor).all():
            return successor, steps
        steps = steps + steps[successor]
        successor = further
