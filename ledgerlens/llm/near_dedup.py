"""Near duplicates: one-permutation MinHash, banded buckets, star-shaped candidates, links confirmed on full sets.

Each text becomes a set of shingle hashes. One hash function fills ``bands * rows`` bins; an empty
bin borrows from a bin chosen by its own probe sequence (optimal densification). Sets that agree
on all rows of a band share a bucket. Inside a bucket only the edges from its smallest member to
the others are candidates, so a bucket of m members gives m - 1 pairs. Every candidate is
confirmed on the two full sets.

A star can miss a link between two members that are both too far from the hub. Members in another
component than their hub get a second star of their own. A member x that is then still apart
can only be linked to a member y whose difference from the hub overlaps its own: |x ^ y| is the size of
(x ^ hub) ^ (y ^ hub), and it must stay below the bound that x ^ hub exceeds. So the differences are
joined on their necessary prefixes, in the order of how many of the hub's members have a shingle, rarest
first. This finds every remaining link of a bucket without forming its pairs.

Equal sets are folded into one class first, so copies never meet in a bucket.

Rows without a doc_id are linked with nothing. Rows that repeat a doc_id count as one document.
A null or empty text has an empty set and is linked with nothing. Texts of any length are taken whole, as one set; an empty table gives an
empty result. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import GOLDEN, WordHashes, mixed, saved, signed, utf8

ROWS = 5
#: the chance, at most, that two sets which are just alike enough share no band
MISSED = 1e-6
#: probes of an empty bin before it takes the next filled one in order
PROBES = 512


def bands_for(percent: int, rows: int = ROWS, missed: float = MISSED) -> int:
    """Bands of ``rows`` rows that two sets of this similarity all miss with a chance of ``missed`` at most."""
    return max(1, math.ceil(math.log(missed) / math.log1p(-min(percent / 100, 0.999) ** rows)))


def shingles(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; a shorter text is one run."""
    h = hashes.of(utf8(text).lower().split())
    if not len(h):
        return h
    width = min(words, len(h))
    with np.errstate(over="ignore"):
        total = np.zeros(len(h) - width + 1, np.uint64)
        factor = GOLDEN
        for k in range(width):
            total += h[k : len(h) - width + 1 + k] * factor
            factor = factor * GOLDEN + np.uint64(2)
        return np.unique(mixed(total + np.uint64(width)))


def probe_table(bins: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        seeds = np.arange(bins * PROBES, dtype=np.uint64) * GOLDEN
    return (mixed(seeds) % np.uint64(bins)).astype(np.int64).reshape(bins, PROBES)


def signature(values: np.ndarray, bins: int, probes: np.ndarray) -> np.ndarray:
    """The least hash of each bin (bins are equal ranges of the hash), empty bins densified."""
    at = ((values >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    filled = np.zeros(bins, bool)
    filled[at[first]] = True
    least = np.zeros(bins, np.uint64)
    least[at[first]] = values[first]
    empty = np.flatnonzero(~filled)
    for t in range(PROBES):
        if not len(empty):
            return least
        donor = probes[empty, t]
        found = filled[donor]
        least[empty[found]] = least[donor[found]]
        empty = empty[~found]
    for i in empty:
        least[i] = values[first[np.searchsorted(at[first], i) % len(first)]]
    return least


def _signatures(words: int, least: int, bands: int, rows: int):
    bins = bands * rows

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, probes = WordHashes(), probe_table(bins)
        with np.errstate(over="ignore"):
            factors = mixed(np.arange(1, bins + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
        for frame in frames:
            n, h1, h2, keys = [], [], [], []
            for text in frame["text"]:
                s = shingles(text, words, hashes)
                n.append(len(s))
                with np.errstate(over="ignore"):
                    h1.append(int(signed(s.sum(dtype=np.uint64)[None])[0]))
                    h2.append(int(signed(mixed(s + GOLDEN).sum(dtype=np.uint64)[None])[0]))
                    if len(s) < least:
                        keys.append(np.empty(0, np.int64))
                    else:
                        sums = (mixed(signature(s, bins, probes)) * factors).reshape(bands, rows).sum(axis=1, dtype=np.uint64)
                        keys.append(signed(mixed(sums)))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_shingles": n, "h1": h1, "h2": h2, "buckets": keys})

    return run


def _sets(words: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            yield pd.DataFrame({"rep": frame["rep"], "set": [signed(shingles(t, words, hashes)) for t in frame["text"]]})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected ``edges`` (a, b); component is the smallest node.

    Each round maps every node to its smallest neighbour or itself and keeps the edges between
    different images; the maps are then composed backwards. Nothing is gathered by node but minima.
    """
    spark = edges.sparkSession
    maps = []
    edges = saved(edges.where("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        to = saved(both.groupBy("node").agg(F.least("node", F.min("other")).alias("to")), "images")
        maps.append(to)
        left = to.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = to.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = saved(
            edges.join(left, "a").join(right, "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    found = maps[-1].select("node", F.col("to").alias("component"))
    for to in reversed(maps[:-1]):
        above = found.select(F.col("node").alias("to"), "component")
        found = to.join(above, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    return saved(found, "components")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, bands: int | None = None, rows: int = ROWS
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs`` (doc_id, text, any more columns).

    Linked are documents with ``100 * |A and B| >= percent * |A or B|``; ``component_id`` is the
    smallest doc_id reachable over links, ``kept`` marks the document that carries it.
    """
    texts = docs.select("doc_id", "text")
    bands = bands or bands_for(percent, rows)
    # two different sets can only be linked from this size on
    least = max(2, -(-100 // (100 - percent)) - 1) if percent < 100 else 1 << 60
    marks = saved(
        texts.mapInPandas(
            _signatures(words, least, bands, rows), "doc_id long, n_shingles long, h1 long, h2 long, buckets array<long>"
        ),
        "signatures",
    )
    kind = ["n_shingles", "h1", "h2"]
    full = marks.where("n_shingles > 0 and doc_id is not null")
    classes = saved(full.groupBy(*kind).agg(F.min("doc_id").alias("rep"), F.any_value("buckets").alias("buckets")), "classes")

    members = classes.select("rep", "n_shingles", F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last").drop("last")
    members = saved(members.join(shared, "bucket"), "buckets")
    wanted = members.select("rep").distinct()
    sets = saved(
        texts.where("doc_id is not null").join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
        .withColumnRenamed("doc_id", "rep").mapInPandas(_sets(words), "rep long, set array<long>"),
        "sets",
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a"))
        b = sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b"))
        both = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - both
        return pairs.join(b, "b").join(a, "a").where(100 * both >= percent * union).select("a", "b")

    def by_size(pairs: DataFrame) -> DataFrame:
        return pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b").distinct()

    def stars(members: DataFrame) -> DataFrame:
        hubs = members.where("rep = hub").select("hub", F.col("n_shingles").alias("n_a")).distinct()
        return by_size(
            members.where("rep <> hub").join(hubs, "hub")
            .select(F.col("hub").alias("a"), F.col("rep").alias("b"), "n_a", F.col("n_shingles").alias("n_b"))
        )

    def placed(members: DataFrame, found: DataFrame) -> DataFrame:
        own = found.select(F.col("node").alias("rep"), "component")
        hub = found.select(F.col("node").alias("hub"), F.col("component").alias("of_hub"))
        return (
            members.join(own, "rep", "left").join(hub, "hub", "left")
            .withColumn("component", F.coalesce("component", "rep")).withColumn("of_hub", F.coalesce("of_hub", "hub"))
        )

    links = saved(confirmed(stars(members)), "links")
    found = components(links)

    # members apart from their hub: a star of their own
    apart = placed(members, found).where("component <> of_hub").select("bucket", "rep", "n_shingles")
    second = apart.groupBy("bucket").agg(F.min("rep").alias("hub"))
    apart = saved(apart.join(second, "bucket"), "apart")
    links = saved(links.union(confirmed(stars(apart))).distinct(), "links")
    found = components(links)

    # members still apart: the links that remain show in the differences from the hub
    here = placed(members.select("hub", "rep", "n_shingles").distinct(), found)
    split = here.where("component <> of_hub").select("hub").distinct()
    here = saved(here.join(split, "hub", "left_semi").where("rep <> hub"), "here")
    own = sets.select("rep", "set")
    base = sets.select(F.col("rep").alias("hub"), F.col("set").alias("of_all"))
    c = f"({100 - percent} / {100 + percent})"
    away = (
        here.join(own, "rep").join(base, "hub")
        .withColumn("far", F.concat(F.array_except("set", "of_all"), F.array_except("of_all", "set")))
        .withColumn("d", F.size("far")).withColumn("n_hub", F.size("of_all"))
        # the overlap that a member needs with one that is apart; and that one which is apart needs with any
        .withColumn("need", F.expr(f"greatest(1, ceil((d + {c} * (n_hub - n_shingles)) / 2 - 1e-9))"))
        .withColumn("need_apart", F.expr(f"greatest(1, ceil((d - {c} * (n_shingles + least(n_hub, n_shingles * 100 / {percent}))) / 2 - 1e-9))"))
        .withColumn("apart", F.col("component") != F.col("of_hub"))
    )
    away = saved(away.select("hub", "rep", "n_shingles", "component", "apart", "d", "need", "need_apart", "far"), "differences")
    # the rarest of a hub's differences come first; most are found in one member only
    each = away.select("hub", "rep", F.explode("far").alias("shingle"))
    common = each.groupBy("hub", "shingle").agg(F.count("*").alias("n")).where("n > 1")
    rarest = each.join(common, ["hub", "shingle"], "left").groupBy("hub", "rep").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "shingle")))["shingle"].alias("far")
    )
    away = saved(
        away.drop("far").join(rarest, ["hub", "rep"]).select(
            "hub", "rep", "n_shingles", "component", "apart", "d",
            F.expr("slice(far, 1, cast(greatest(0, d - need + 1) as int))").alias("prefix"),
            F.expr("case when apart then slice(far, 1, cast(greatest(0, d - need_apart + 1) as int)) end").alias("prefix_apart"),
        ),
        "away",
    )

    def side(rows: DataFrame, name: str, prefix: str) -> DataFrame:
        return rows.select(
            "hub", F.col("rep").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("component").alias(f"of_{name}"),
            F.col("d").alias(f"d_{name}"), F.col("apart").alias(f"apart_{name}"), F.posexplode(prefix).alias(f"i_{name}", "shingle"),
        )

    # the overlap that two differences of these sizes need bounds the places of their first common shingle
    overlap = f"greatest(1, ceil((d_a + d_b - {c} * (n_a + n_b)) / 2 - 1e-9))"
    pairs = side(away.where("apart"), "a", "prefix_apart").join(side(away, "b", "prefix"), ["hub", "shingle"]).where(
        f"of_a <> of_b and (a < b or not apart_b) and 100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) and least(d_a - i_a, d_b - i_b) >= {overlap}"
    )
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    more = saved(confirmed(pairs), "links")
    if not more.isEmpty():
        found = components(links.union(more))

    # rows that share a doc_id are one document: its classes are one node, the smallest doc_id of each class
    ids = saved(
        full.join(classes.drop("buckets"), kind).join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id")),
        "placed",
    )
    return (
        marks.select("doc_id", "n_shingles").join(ids, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
