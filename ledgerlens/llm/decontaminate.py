"""Benchmark decontamination: a prefix-filtered set join over item-sized windows.

Every item is cut into windows of ``window`` words, every window into shingles of up to three
words. One pass over the documents joins their shingles with the benchmark's (by hash, then
word by word) and keeps the places found. These give each shingle's frequency over the whole
corpus. A document that contains a window contains all its shingles, so the necessary prefix is one
shingle: the rarest. Its places, moved by its offset in the window and bounded by the document's
length, are the candidates; a candidate counts if every shingle of the window is at its place,
which is word-by-word equality.

The benchmark's tables are broadcast only up to a measured number of rows, beyond it the joins shuffle.

A null text has no words, a null benchmark text no windows; items without item_id mark words but
are not listed. Rows that repeat a doc_id are judged each on its own text. An empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import ascii_lower, saved, small

WINDOW, SHINGLE = 10, 3
#: what separates words once A-Z are lower case, and before
BREAK_LOWER, BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NO_DOC = -(1 << 63)


def words_of(text: Column, lower: bool = True) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.array_remove(F.split(ascii_lower(text) if lower else text, BREAK_LOWER if lower else BREAK, -1), "")


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, window, width): the words of each window, joined by spaces."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where("size(w) > 0")
    return (
        words.withColumn("width", F.least(F.lit(window), F.size("w")))
        .withColumn("start", F.explode(F.expr("sequence(1, size(w) - width + 1)")))
        .select("item_id", F.expr("array_join(slice(w, start, width), ' ')").alias("window"), "width")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of ``docs`` (doc_id, text, any more columns)."""
    return judged(docs, benchmark, window).drop("text_key")


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The columns of ``contamination`` and text_key, the xxhash64 of the text each row was judged on."""
    items = saved(item_windows(benchmark, window), "items")
    windows = items.select("window", "width").distinct().withColumn("k", F.least(F.lit(SHINGLE), F.col("width")))
    parts = saved(
        windows.withColumn("w", F.split("window", " ")).withColumn("offset", F.explode(F.expr("sequence(0, width - k)")))
        .select("window", "width", "k", "offset", F.expr("array_join(slice(w, offset + 1, k), ' ')").alias("shingle")),
        "parts",
    )
    known = small(saved(parts.select("k", "shingle").distinct().withColumn("h", F.xxhash64("shingle")), "shingles"))
    text_key, doc = F.xxhash64("text"), F.coalesce("doc_id", F.lit(NO_DOC))
    split = docs.select(doc.alias("doc"), text_key.alias("text_key"), words_of(F.col("text")).alias("w"))
    hits = None
    for k in sorted(r["k"] for r in parts.select("k").distinct().collect()):  # 1, 2 or 3
        runs = F.arrays_zip(*[F.expr(f"slice(w, {i + 1}, size(w))").alias(f"w{i}") for i in range(k)])
        placed = split.select("doc", "text_key", F.size("w").alias("n_words"), F.posexplode(runs).alias("at", "run"))
        joined = placed.where(F.col(f"run.w{k - 1}").isNotNull()).select(
            "doc", "text_key", "n_words", "at", F.concat_ws(" ", *[F.col(f"run.w{i}") for i in range(k)]).alias("own")
        )
        # equality on the words is asked both ways, so that the join itself stays on one number
        found = joined.withColumn("h", F.xxhash64("own")).join(known.where(F.col("k") == k).drop("k"), "h").where(
            "startswith(own, shingle) and startswith(shingle, own)"
        ).select("doc", "text_key", "n_words", "at", "shingle")
        hits = found if hits is None else hits.union(found)
    base = docs.select("doc_id", doc.alias("doc"), text_key.alias("text_key"), F.size(words_of(F.col("text"), lower=False)).cast("long").alias("n_words"))
    if hits is None:
        found = docs.sparkSession.createDataFrame([], "doc long, text_key long, n_hit long, n_items long, ids string")
    else:
        found = _contained(saved(hits.distinct(), "hits"), parts, items)
    n_hit = F.coalesce("n_hit", F.lit(0))
    return base.join(found, ["doc", "text_key"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "text_key",
    )


def _contained(hits: DataFrame, parts: DataFrame, items: DataFrame) -> DataFrame:
    rarity = hits.groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    prefix = small(saved(
        parts.join(rarity, "shingle", "left").groupBy("window", "width", "k")
        .agg(F.min_by(F.struct("shingle", "offset", "seen"), F.struct(F.coalesce("seen", F.lit(0)), "offset")).alias("rarest"))
        .where("rarest.seen is not null").select("window", "width", "k", "rarest.shingle", "rarest.offset"),
        "prefix",
    ))
    starts = (
        hits.join(prefix, "shingle").withColumn("start", F.col("at") - F.col("offset"))
        .where("start >= 0 and start + width <= n_words").select("doc", "text_key", "start", "window", "width", "k")
    )
    asked = starts.join(small(parts.select("window", "offset", "shingle")), "window").withColumn("at", F.col("start") + F.col("offset"))
    sure = saved(
        asked.join(hits.drop("n_words"), ["doc", "text_key", "at", "shingle"])
        .groupBy("doc", "text_key", "start", "window", "width", "k").agg(F.count(F.lit(1)).alias("there"))
        .where("there = width - k + 1").select("doc", "text_key", "start", "window", "width"),
        "sure",
    )
    words = (
        sure.select("doc", "text_key", F.explode(F.expr("sequence(start, start + width - 1)")).alias("at")).distinct()
        .groupBy("doc", "text_key").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    listed = (
        sure.select("doc", "text_key", "window").distinct().join(small(items.where("item_id is not null").select("window", "item_id").distinct()), "window")
        .select("doc", "text_key", F.col("item_id").cast("string").alias("item")).distinct()
        .groupBy("doc", "text_key").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("ids"))
    )
    return words.join(listed, ["doc", "text_key"], "left")
