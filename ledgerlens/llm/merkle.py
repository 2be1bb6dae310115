"""A Merkle manifest of a table, with a witness for every row.

Rows are leaves, in order, of one tree per value of a column; the trees' roots are the leaves of the top tree. Eight
consecutive nodes (at the end fewer, even one) become the hash of their digests, until one is left.

Witnesses grow as nodes are appended (``Appender``). A node's witness is what stands left and right of it in its run, level by
level. While a run is open its nodes' witnesses are partial; the sibling that completes the run extends them, and
the run becomes one node of the run above. Leaves are appended in aligned blocks of ``8 ** LEVELS``, each block by itself
in any task, as no run crosses an aligned border. The block roots are then appended likewise, in blocks of their own, as many times as the tree is
high, and each block's witness extends those of its rows. No task sees more than one block, whatever one tree holds.

A null is a value of the tree column like any other, and comes first. Rows of a tree are ordered by the key column, nulls first, then by
leaf; rows equal in both are interchangeable. A table of one row is its own root, an empty table has none. Long
texts are hashed whole; columns other than the given ones are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import saved, small

ARITY = 8
#: levels of a block
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_SIDES = pa.struct([("left", pa.string()), ("right", pa.string())])


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Appender:
    """A subtree of ``height`` levels that takes nodes in order.

    ``witnesses`` has a list for every node appended, of (left, right) for each level that is complete above it.
    """

    def __init__(self, height: int):
        self.height, self.root = height, None
        self.witnesses: list[list[tuple[str, str]]] = []
        self._open: list[list[tuple[str, list[int]]]] = [[] for _ in range(height)]

    def append(self, node: str) -> None:
        self.witnesses.append([])
        self._push(0, node, [len(self.witnesses) - 1])

    def _push(self, level: int, node: str, below: list[int]) -> None:
        if level == self.height:
            self.root = node
            return
        self._open[level].append((node, below))
        if len(self._open[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self._open[level] = self._open[level], []
        nodes = [n for n, _ in run]
        for i, (_, below) in enumerate(run):
            sides = "".join(nodes[:i]), "".join(nodes[i + 1 :])
            for leaf in below:
                self.witnesses[leaf].append(sides)
        self._push(level + 1, digest("".join(nodes)), [leaf for _, below in run for leaf in below])

    def close(self) -> str | None:
        """Completes the runs that are open, lowest first, and returns the root."""
        for level in range(self.height):
            if self._open[level]:
                self._complete(level)
        return self.root


def _attach(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, position, digest, height, ...) with the witness inside their block; its first row has ``block_root``."""
    schema = T.StructType([
        *nodes.schema.fields, T.StructField("witness", T.ArrayType(T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))),
        T.StructField("block_root", T.StringType()),
    ])

    def run(block: pa.Table) -> pa.Table:
        block = block.drop_columns(["block"]).sort_by("position")
        tree = Appender(min(LEVELS, block["height"][0].as_py()))
        for node in block["digest"].to_pylist():
            tree.append(node)
        root = tree.close()
        sides = [s for w in tree.witnesses for s in w]
        offsets = pa.array(range(0, len(sides) + 1, tree.height) if tree.height else [0] * (block.num_rows + 1), pa.int32())
        pairs = pa.StructArray.from_arrays([pa.array([s[0] for s in sides], pa.string()), pa.array([s[1] for s in sides], pa.string())], fields=list(_SIDES))
        witness = pa.ListArray.from_arrays(offsets, pairs)
        roots = pa.array([root] + [None] * (block.num_rows - 1), pa.string())
        return block.append_column("witness", witness).append_column("block_root", roots)

    blocks = nodes.withColumn("block", F.floor(F.col("position") / ARITY**LEVELS))
    return blocks.groupBy("tree", "block").applyInArrow(run, schema)


def _placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with their position in the order of their tree, and the tree's height.

    Ranges of the order are counted and numbered each by itself; one row for a range and tree carries the counts across.
    """
    ranges = max(8, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = saved(nodes.repartitionByRange(ranges, "tree", *order).withColumn("_place", F.struct("tree", F.spark_partition_id().alias("range"))), "ranges")
    tree = Window.partitionBy("_place.tree")
    sizes = dealt.groupBy("_place").agg(F.count(F.lit(1)).alias("_n")).select(
        "_place", F.sum("_n").over(tree.orderBy("_place.range")).alias("_upto"), "_n", F.sum("_n").over(tree).alias("_all"),
    )
    near = F.row_number().over(Window.partitionBy("_place").orderBy(*order)) - 1
    # eight times as many leaves are one octal digit more
    height = F.when(F.col("_all") == 1, 0).otherwise(F.length(F.conv((F.col("_all") - 1).cast("string"), 10, 8)))
    return (
        dealt.withColumn("_near", near).join(sizes, "_place")
        .withColumn("position", F.col("_upto") - F.col("_n") + F.col("_near")).withColumn("height", height)
        .drop("_place", "_near", "_upto", "_n", "_all")
    )


def witnessed(nodes: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (tree, digest, ...) with ``position`` and ``witness``, and the roots (tree, root).

    ``order`` names columns that tell all nodes of a tree apart.
    """
    rounds, roots, level = [], None, _placed(nodes, order)
    while True:
        attached = saved(_attach(level), "attached")
        rounds.append(attached)
        ends = attached.where("block_root is not null")
        done = ends.where(F.col("height") <= LEVELS).select("tree", F.col("block_root").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        level = saved(
            ends.where(F.col("height") > LEVELS).select(
                "tree", F.floor(F.col("position") / ARITY**LEVELS).alias("position"), F.col("block_root").alias("digest"), (F.col("height") - LEVELS).alias("height"),
            ),
            "block-roots",
        )
        if level.isEmpty():
            break
    whole = rounds.pop()
    while rounds:
        above = saved(whole.select(F.struct("tree", F.col("position").alias("block")).alias("_place"), F.col("witness").alias("_above")), "above")
        below = rounds.pop().withColumn("_place", F.struct("tree", F.floor(F.col("position") / ARITY**LEVELS).alias("block")))
        whole = below.join(small(above, ARITY**LEVELS), "_place", "left").withColumn(
            "witness", F.concat("witness", F.coalesce("_above", F.expr("cast(array() as array<struct<left: string, right: string>>)")))
        ).drop("_place", "_above")
    return whole.drop("height", "block_root"), roots


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row: each value as ``-`` if null, else its number of UTF-8 bytes, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def folded(node: Column, witness: Column) -> Column:
    """The root that ``node`` gives with ``witness``."""
    return F.aggregate(witness, node, lambda below, side: F.sha2(F.concat(side["left"], below, side["right"]), 256))


def siblings(witness: Column) -> Column:
    """All digests of a witness, lowest level first, left to right."""
    return F.array_join(F.transform(witness, lambda side: F.concat(side["left"], side["right"])), "")


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, tree: str = "lang", key: str = "doc_id", carry: dict[str, Column] | None = None
) -> DataFrame:
    """``key, tree, position, leaf, witness, subroot, root`` of each row of ``docs``, and the columns of ``carry``.

    ``folded(leaf, witness)`` is ``root`` for every row that has not been changed.
    """
    carry = carry or {}
    leaves = saved(
        docs.select(
            F.col(tree).alias("tree"), F.col(key).alias("key"), leaf([F.col(f) for f in fields]).alias("digest"), *[c.alias(f"carry_{n}") for n, c in carry.items()],
        ).withColumn("serial", F.monotonically_increasing_id()),
        "leaves",
    )
    rows, roots = witnessed(leaves, ["key", "digest", "serial"])
    tops, top = witnessed(roots.select(F.lit(0).alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest")), ["name"])
    last = top.first()
    tops = saved(
        tops.select(F.struct(F.col("name").alias("tree")).alias("_tree"), F.col("digest").alias("subroot"), F.col("witness").alias("_above")), "tops"
    )
    return (
        rows.withColumn("_tree", F.struct("tree")).join(small(tops, ARITY**LEVELS), "_tree")
        .select(
            F.col("key").alias(key), F.col("tree").alias(tree), "position", F.col("digest").alias("leaf"), F.concat("witness", "_above").alias("witness"),
            "subroot", F.lit(last["root"] if last else None).cast("string").alias("root"), *[F.col(f"carry_{n}").alias(n) for n in carry],
        )
    )
