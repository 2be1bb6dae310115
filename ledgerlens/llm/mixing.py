"""Sources mixed to target weights: Sainte-Lague seats for blocks of equal size, then seeded blocks.

Targets: every source gets a share of all words by its weight, at most ``repeats`` times its own
words; what is over goes to the others by weight. That is one level ``t = weight * level`` cut at
the caps, found over the sources sorted by cap / weight.

Seats: the words are cut into blocks of ``block`` words and the blocks are dealt to the sources by
the divisor method with the odd divisors 1, 3, 5, ... (highest quotients win), ties to the
source that comes first. Quotients far from the border are settled by rounding; only a few per source are ranked.

Blocks: the documents of a source lie on a line in seeded order. A source with q seats over n blocks takes
every block ``q div n`` times and ``q mod n`` of them once more, evenly spread with a seeded
start. So what a document gives is arithmetic on its place on the line, and no block becomes a row.
The line is laid in two steps (pieces of a source, then documents of a piece), so a source that
holds a third of all rows is no group in one task.

A null text has no words; words of texts of any length are all counted. Null is a source of its own, the last one. Repeated rows are documents of their own. An
empty table, or one without words, gives zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import BLANK_WORD, saved
from ledgerlens.operators import ordered

BLOCK, REPEATS, SEED = 8, 3, 20
#: pieces of a source that are laid on their own
PIECES = 1024


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(BLANK_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, repeats: int = REPEATS, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Adds rank, weight, total and target to ``sizes`` (source, source_size), one row per source."""
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    weighed = (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("total", F.sum("source_size").over(every)).withColumn("cap", repeats * F.col("source_size"))
    )
    by_level = every.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    # the level if all sources before this one stop at their caps
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    return (
        weighed.withColumn("level", level)
        .withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(every))
        .withColumn("target", F.least(F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"), F.col("cap").cast("double")))
        .drop("level", "cap")
    )


def seats(mix: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds ``quota``, whole blocks per source, to the table of ``targets``."""
    every = Window.partitionBy(F.lit(0))
    rough = (
        mix.withColumn("sources", F.count(F.lit(1)).over(every))
        .withColumn("wanted", F.round(F.sum("target").over(every) / block).cast("long"))
        .withColumn("near", F.floor(F.col("target") / block + 0.5))
        .withColumn("slack", F.ceil(F.when(F.col("total") > 0, F.col("target") / F.col("total")).otherwise(0.0) * F.col("sources") / 2) + 2)
        .withColumn("sure", F.greatest(F.lit(0).cast("long"), F.col("near") - F.col("slack")))
    )
    open_ = (
        rough.where("target > 0").withColumn("left", F.col("wanted") - F.sum("sure").over(every))
        .withColumn("seat", F.explode(F.expr("sequence(sure + 1, near + slack + 1)")))
        .withColumn("quotient", F.col("target") / (2 * F.col("seat") - 1))
        .withColumn("place", F.row_number().over(every.orderBy(F.col("quotient").desc(), "rank", "seat")))
        .groupBy("rank").agg(F.sum(F.when(F.col("place") <= F.col("left"), 1).otherwise(0)).alias("more"))
    )
    return (
        rough.join(open_, "rank", "left").withColumn("quota", F.col("sure") + F.coalesce("more", F.lit(0)))
        .drop("sources", "wanted", "near", "slack", "sure", "more")
    )


def shard_quotas(quotas: DataFrame, shards: int) -> DataFrame:
    """(source, shard, quota): each source's seats over ``shards`` shards, at most one apart within a source."""
    return quotas.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select(
        "source", "shard",
        (F.floor(F.col("quota") * (F.col("shard") + 1) / shards) - F.floor(F.col("quota") * F.col("shard") / shards)).alias("quota"),
    )


def mix(docs: DataFrame, block: int = BLOCK, repeats: int = REPEATS, seed: int = SEED, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """doc_id, source, text_key, size, source_size, target, quota, taken for each row of ``docs`` (doc_id, text, source, any more columns)."""
    rows = saved(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key")), "sizes"
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    quotas = seats(targets(sources, repeats, weights), block)
    # integers only from here on: n blocks on the line, every one taken ``base`` times, ``extra`` of them once more
    quotas = saved(
        quotas.withColumn("n", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block)))
        .withColumn("quota", F.least("quota", repeats * F.col("n")))
        .withColumn("base", F.expr("quota div n")).withColumn("extra", F.expr("quota % n"))
        .withColumn("turn", F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.lit(seed)), F.col("n"))),
        "quotas",
    )
    name = F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"), F.coalesce("source", F.lit("")))
    line = rows.withColumn("name", name).withColumn("order", F.xxhash64("doc_id", F.lit(seed))).withColumn("piece", F.shiftrightunsigned("order", 54))
    line = ordered.running(line, ["name"], "piece", ["order", "doc_id", "size", "text_key"], F.col("size"), "sum", "end")
    small = quotas.withColumn("name", name).drop("source", "rank", "weight", "total")
    placed = line.join(small, "name")

    def upto(x: str) -> str:
        """Words taken by the extra blocks on the line before word ``x``."""
        k = f"({x} div {block})"
        chosen = f"(({k} * extra + turn) div n - turn div n)"
        one = f"((({k} + 1) * extra + turn) div n - ({k} * extra + turn) div n)"
        return f"({block} * {chosen} + ({x} % {block}) * {one})"

    taken = F.expr(f"base * size + {upto('end')} - {upto('(end - size)')}")
    return placed.withColumn("taken", taken.cast("long")).select(
        "doc_id", "source", "text_key", "size", "source_size", "target", "quota", "taken"
    )


def whole_documents(mixed: DataFrame) -> DataFrame:
    """(doc_id, source, text_key, copies) from the rows of ``mix``: the words taken, as whole copies of documents.

    In each source the documents are sorted by size, and the running sum of ``taken / size`` is rounded
    down; a document gets the steps that fall on it. So its copies are ``taken / size`` rounded down
    or up, and as neighbours are of like size the words of a source stay near those taken. Rows that are equal in
    doc_id, source and text count as one line of their own each; they get the copies of the first.
    """
    unit = 1 << 20
    line = (
        mixed.groupBy("doc_id", "source", "text_key").agg(F.max("size").alias("size"), F.first("taken").alias("taken"))
        .withColumn("name", F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"), F.coalesce("source", F.lit(""))))
        # longest first, cut into ranges of like size
        .withColumn("piece", -F.floor(F.log2(F.greatest(F.lit(1), F.col("size"))) * 8))
        .withColumn("share", F.when(F.col("size") > 0, F.expr(f"taken * {unit} div size")).otherwise(F.lit(unit)).cast("long"))
        .withColumn("down", -F.col("size"))
    )
    line = ordered.running(line, ["name"], "piece", ["down", "doc_id", "text_key"], F.col("share"), "sum", "upto")
    half = unit // 2
    return line.select(
        "doc_id", "source", "text_key", F.expr(f"cast((upto + {half}) div {unit} - (upto - share + {half}) div {unit} as int)").alias("copies")
    )
