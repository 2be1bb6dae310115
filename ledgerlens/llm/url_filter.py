"""URL rules by a sorted sweep over reversed-host keys.

``com.example.www.`` is the key of host ``www.example.com``: all hosts below ``example.com`` are the
keys that start with ``com.example.``, one interval of the sorted keys. The intervals of a rule set
are nested or disjoint, so between two neighbouring interval borders the same rules are active: each
border carries the stack of rules active from there on. Sorting borders and urls together and
carrying the last stack forward gives every url its active rules; of those whose path fits, the
longest wins.

Borders and urls are cut into ranges of the sorted keys together. Ranges are swept independently; one row a range, its last border,
is carried on to the ranges behind it. A salt behind the key lets a range end inside a run of
equal keys: one host may hold any share of the rows.

Of several rules of one length that fit, the one whose text is greater wins, and of one rule with two verdicts ``block``. A null url, or one without ``://``, has an empty host and path and fits no rule. Repeated rows are judged
one by one. ``DEFAULT`` is the verdict where no rule fits. An empty table gives an empty result, no rules fit nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import ascii_lower, saved

DEFAULT = "allow"
#: ranges are at least so many; more partitions in the session make more
RANGES = 8


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path`` as the rules see them."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(coalesce(url, ''), locate('://', coalesce(url, '')) + 3)")).otherwise("")
    return (
        pages.withColumn("_rest", rest)
        .withColumn("host", ascii_lower(F.regexp_extract("_rest", r"^[^/?#]*", 0)))
        .withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1))
        .drop("_rest")
    )


def host_key(host):
    """Labels from the last to the first, each with a dot behind it; empty for an empty host."""
    return F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def borders(rules: DataFrame) -> DataFrame:
    """(key, stack): from ``key`` on, the rules of ``stack`` are active. ``rules``: host, path, verdict."""
    rule = F.struct(
        F.char_length(F.concat("host", "path")).alias("length"), F.concat("host", "path").alias("rule"),
        F.col("path").alias("path"), F.col("verdict").alias("verdict"),
    )
    hosts = (
        rules.where("host is not null and path is not null and verdict is not null").withColumn("host", ascii_lower(F.col("host")))
        .withColumn("start", host_key(F.col("host"))).groupBy("start").agg(F.sort_array(F.collect_set(rule)).alias("own"))
    )
    # '/' follows '.': the first key behind all that start with ``start``
    after = F.expr("concat(substring(start, 1, length(start) - 1), '/')")
    starts = hosts.where("start <> ''").select(F.col("start").alias("key"))
    keys = starts.union(hosts.where("start <> ''").select(after.alias("key"))).distinct()
    # a border's stack: the rules of every enclosing interval, by the labels of its key
    chain = (
        keys.withColumn("labels", F.split("key", r"\."))
        .withColumn("up", F.explode(F.expr("sequence(1, size(labels))")))
        .select("key", F.expr("concat(array_join(slice(labels, 1, up), '.'), '.')").alias("start")).where("startswith(key, start)")
    )
    return (
        chain.join(hosts, "start").groupBy("key").agg(F.flatten(F.collect_list("own")).alias("stack"))
        .join(keys, "key", "right").withColumn("stack", F.coalesce("stack", F.array().cast("array<struct<length:int,rule:string,path:string,verdict:string>>")))
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``pages`` (page_id, url, any more columns) as page_id, host, path, rule, verdict."""
    spark = pages.sparkSession
    ranges = max(RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = with_parts(pages.select("page_id", "url")).drop("url").withColumn("key", host_key(F.col("host")))
    edges = borders(rules).select("key", "stack", F.lit(0).alias("kind"))
    # a border comes before the urls of its key
    every = keyed.withColumn("kind", F.lit(1)).unionByName(edges, allowMissingColumns=True).withColumn("salt", F.xxhash64("page_id", "path"))
    cut = saved(every.repartitionByRange(ranges, "key", "kind", "salt").withColumn("range", F.spark_partition_id()).drop("salt"), "ranges")
    # one row a range: the stack of the last border before it
    last = F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("stack")
    earlier = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut.groupBy("range").agg(last).select("range", F.last("stack", ignorenulls=True).over(earlier).alias("carried"))
    along = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = cut.withColumn("own", F.last("stack", ignorenulls=True).over(along)).where("kind = 1").join(carried, "range")
    best = F.expr("array_max(filter(coalesce(own, carried), r -> startswith(path, r.path)))")
    return swept.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
