"""From raw documents to shards: classify, fold near duplicates, decontaminate, mix, shard.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet to the shared scratch folder and reads it back as the next stage's documents. All stages but the last
keep the columns of ``documents``. No stage caps or samples its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, mixing, near_dedup, quality, sharding
from ledgerlens.llm.common import saved, table
from ledgerlens.operators import ordered

#: the classifier has no SQL form; tests compare the stages with brute-force versions
ORACLE_SQL = None


def _text_key(docs: DataFrame) -> DataFrame:
    """``docs`` and the key of each row's text, a number also for a null text (as in the operators)."""
    return docs.withColumn("_key", F.xxhash64("text"))


def _same_row(docs: DataFrame, decided: DataFrame, wanted: str) -> DataFrame:
    """Rows of ``docs`` whose doc_id and text ``decided`` (doc_id, text_key) marks; null doc_ids match each other."""
    chosen = decided.where(wanted).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")).distinct()
    keyed = _text_key(docs)
    return keyed.join(chosen, keyed["doc_id"].eqNullSafe(chosen["_id"]) & (keyed["_key"] == chosen["_text"]), "left_semi").drop("_key")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier scores below its threshold."""
    probability = quality.scorer(quality.learn(docs, table(spark, sf_dir, "labels")))
    return docs.withColumn("_score", probability("text")).where(F.col("_score") >= quality.THRESHOLD).drop("_score")


def fold_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one text of each near-duplicate group (five words, 0.8): of the smallest doc_id, then of the smallest key of the text.

    Groups are of (doc_id, text): texts that share a doc_id are judged each by itself, and rows equal in both are one.
    Rows without a doc_id are linked with nothing, as in the operator.
    """
    named, without = _text_key(docs.where("doc_id is not null")), _text_key(docs.where("doc_id is null"))
    pairs = saved(named.select("doc_id", "_key").distinct(), "pairs")
    if pairs.groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = near_dedup.near_duplicates(docs, words=5, percent=80).where("kept")
        chosen = pairs.join(kept.select("doc_id"), "doc_id", "left_semi")
    else:
        # one number for each (doc_id, text), in the order of doc_id
        ranges = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
        pairs = saved(pairs.repartitionByRange(ranges, "doc_id", "_key").withColumn("_range", F.spark_partition_id()), "ranges")
        numbered = saved(ordered.number_rows(pairs, [], "_range", ["doc_id", "_key"], "_number").select("doc_id", "_key", "_number"), "numbered")
        texts = named.select("doc_id", "_key", "text").join(numbered, ["doc_id", "_key"]).select(F.col("_number").cast("long").alias("doc_id"), "text")
        kept = near_dedup.near_duplicates(saved(texts, "numbered-texts"), words=5, percent=80).where("kept")
        chosen = numbered.join(kept.select(F.col("doc_id").alias("_number")), "_number", "left_semi").select("doc_id", "_key")
    # rows that are equal in doc_id and text are one document
    rest = [c for c in docs.columns if c != "doc_id"]
    one = [r.groupBy("doc_id", "_key").agg(F.min(F.struct(*rest)).alias("_row")) for r in (named.join(chosen, ["doc_id", "_key"], "left_semi"), without)]
    return one[0].unionByName(one[1]).select(*[F.col("doc_id") if c == "doc_id" else F.col("_row")[c].alias(c) for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text holds a window of a benchmark item."""
    return _same_row(docs, decontaminate.judged(docs, table(spark, sf_dir, "benchmark")), "not contaminated")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats, keeps or leaves out whole documents so that each source's words come near its target."""
    copies = mixing.whole_documents(mixing.mix(docs))
    keyed = docs.withColumn("_key", F.xxhash64("text"))
    matched = keyed.join(
        copies.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_key").alias("_text"), "copies"),
        keyed["doc_id"].eqNullSafe(F.col("_id")) & keyed["source"].eqNullSafe(F.col("_source")) & (keyed["_key"] == F.col("_text")),
    )
    return matched.where("copies > 0").withColumn("_copy", F.explode(F.expr("sequence(1, copies)"))).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return sharding.shard(docs)


STAGES = [
    ("quality classifier", classify),
    ("near duplicates", fold_near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
