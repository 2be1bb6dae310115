"""Shards of near equal bytes: best-fit-decreasing packing of indivisible groups of equal texts.

Groups above a small share of all bytes are packed one by one. By that very share there are at most
``shards * HEAVY`` of them, however large the table is. All other groups are dealt by a hash of
their text into ``shards * UNITS`` units. Units and large groups, a bounded list, go through
best-fit decreasing on the driver: sorted by size, each enters the bin with the least remaining
capacity that still holds it, found in a balanced search tree (a treap). The capacity is the
smallest, by bisection, that needs no more than the given number of bins. Rows never leave the
executors.

A null text counts as an empty one; texts of any length are hashed whole. Repeated rows are rows of one group. Null doc_ids are numbered
like any other. An empty table gives an empty result.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved
from ledgerlens.operators import ordered

HEAVY, UNITS = 64, 256
ROW_BYTES = 16
#: pieces of a shard that are numbered on their own
PIECES = 256


class Treap:
    """Sorted multiset of (remaining capacity, bin): insert, and take out the least that is large enough."""

    def __init__(self, seed: int = 11):
        self.root, self.random = None, random.Random(seed)

    def _split(self, node, key):
        """Nodes below ``key``, and the others. Iterative descents are not needed: the depth is logarithmic."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return (node[0], node[1], node[2], low), high
        low, high = self._split(node[2], key)
        return low, (node[0], node[1], high, node[3])

    def _join(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            return (low[0], low[1], low[2], self._join(low[3], high))
        return (high[0], high[1], self._join(low, high[2]), high[3])

    def insert(self, key):
        low, high = self._split(self.root, key)
        self.root = self._join(self._join(low, (key, self.random.random(), None, None)), high)

    def take(self, key):
        low, high = self._split(self.root, key)
        node = high
        while node is not None and node[2] is not None:
            node = node[2]
        if node is None:
            return None
        _, rest = self._split(high, (*node[0][:-1], node[0][-1] + 1))
        self.root = self._join(low, rest)
        return node[0]


def best_fit(sizes: list[int], capacity: int, bins: int) -> list[int] | None:
    """The bin of each of ``sizes`` (descending), or None if ``bins`` bins of ``capacity`` do not do."""
    tree, used, places = Treap(), 0, []
    for size in sizes:
        found = tree.take((size, -1))
        if found is None:
            if used == bins or size > capacity:
                return None
            found = (capacity, used)
            used += 1
        tree.insert((found[0] - size, found[1]))
        places.append(found[1])
    return places


def pack(sizes: list[int], bins: int) -> list[int]:
    """Best fit decreasing at the smallest capacity found by bisection."""
    if not sizes:
        return []
    low = max(max(sizes), -(-sum(sizes) // bins))
    high = low
    while (found := best_fit(sizes, high, bins)) is None:
        high += max(1, high // 8)
    while low < high:
        middle = (low + high) // 2
        if (less := best_fit(sizes, middle, bins)) is None:
            low = middle + 1
        else:
            found, high = less, middle
    return found


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of ``docs`` (doc_id, text, any more columns)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = saved(
        docs.select(
            "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"),
            F.md5(text).alias("kind"),
        ).withColumn("unit", F.pmod(F.xxhash64("kind"), F.lit(shards * UNITS))),
        "rows",
    )
    groups = saved(rows.groupBy("kind", "unit").agg(F.sum("size").alias("size")), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    # sizes above total / (shards * HEAVY): fewer than shards * HEAVY groups
    heavy = groups.where(F.col("size") * (shards * HEAVY) > total).select("kind", "size").collect()
    light = groups.where(F.col("size") * (shards * HEAVY) <= total).groupBy("unit").agg(F.sum("size").alias("size")).collect()
    items = sorted([(-r["size"], r["kind"], -1) for r in heavy] + [(-r["size"], "", r["unit"]) for r in light])
    places = pack([-size for size, _, _ in items], shards)
    plan = list(zip(items, places))
    of_group = spark.createDataFrame([(kind, place) for (_, kind, unit), place in plan if unit < 0], "kind string, own int")
    of_unit = spark.createDataFrame([(unit, place) for (_, _, unit), place in plan if unit >= 0], "unit long, shared int")
    placed = (
        rows.join(F.broadcast(of_group), "kind", "left").join(F.broadcast(of_unit), "unit", "left")
        .withColumn("shard", F.coalesce("own", "shared"))
        .withColumn("piece", F.pmod(F.xxhash64("doc_id", "size"), F.lit(PIECES)))
    )
    numbered = ordered.number_rows(placed, ["shard"], "piece", ["doc_id", "kind"], "slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("slot") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
