"""Secrets in texts: three base rules, and long tokens that look random to two character Markov models.

Places come from SQL alone: what a pattern matches, and what lies between its matches, alternate, so
a running sum of their lengths gives every match its code points.

The models are first-order character chains of random strings and of ordinary identifiers over the
alphabet of tokens. They are trained from labelled samples: random strings are digests in
several encodings; ordinary identifiers are words of ``SAMPLE_DOCS`` documents (those with the smallest hashes of
their doc_id), alone and joined in the usual ways. A token of ``TOKEN`` characters or more is a secret if
the log-likelihood ratio of its transitions is above ``EVIDENCE`` on average and it holds both letters and digits or
both cases. Such spans are added where no base span overlaps them.

A null text is empty. Rows that repeat a doc_id are judged each on its own text. Without documents to
learn from, the ordinary model is uniform and adds nothing certain.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved

#: fixed values: the base rules, in the order in which kinds are listed
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE, ACCESS_LENGTH = 8, 16

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
TOKEN, EVIDENCE, BACKING = 20, 1.5, 20.0
LONG_TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{TOKEN},}}"
SAMPLE_DOCS, SAMPLE_STRINGS = 400, 4000
NO_DOC = -(1 << 63)


def samples(docs: DataFrame, n_docs: int = SAMPLE_DOCS, n_strings: int = SAMPLE_STRINGS) -> DataFrame:
    """(token, random): labelled training strings."""
    seeds = docs.sparkSession.range(n_strings).select(F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256).alias("x"))
    base64 = F.regexp_replace(F.base64(F.unhex("x")), "=", "")
    random = seeds.select(F.explode(F.array(F.col("x"), base64, base64, base64, F.upper("x"), F.regexp_replace(base64, "[+/]", "_"))).alias("token"))
    # hashes choose the documents; only the texts of those chosen move
    named = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("key"), "text")
    chosen = named.select("doc_id", "key").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "key").limit(n_docs)
    words = (
        named.join(F.broadcast(chosen), ["doc_id", "key"], "left_semi").groupBy("doc_id", "key").agg(F.min("text").alias("text"))
        .select(F.expr(r"regexp_extract_all(text, '[A-Za-z]{2,16}', 0)").alias("w"))
        .select(F.explode(F.arrays_zip(F.col("w").alias("a"), F.expr("slice(w, 2, size(w))").alias("b"))).alias("p")).select("p.a", "p.b").where("b is not null")
    )
    ordinary = words.select(F.explode(F.array(
        F.col("a"), F.concat("a", F.lit("_"), "b"), F.concat("a", F.lit("-"), "b"), F.concat("a", F.initcap("b")),
        F.concat("a", F.lit("/"), "b"), F.concat(F.upper("a"), F.lit("_"), F.upper("b")), F.concat("a", F.pmod(F.xxhash64("b"), F.lit(100)).cast("string")),
    )).alias("token"))
    return random.withColumn("random", F.lit(True)).union(ordinary.withColumn("random", F.lit(False)))


def ratios(labelled: DataFrame) -> list[float]:
    """log P(next | this, random) - log P(next | this, ordinary) for all pairs of the alphabet, row by row."""
    pairs = (
        labelled.select("random", F.explode(F.expr("transform(sequence(1, greatest(1, length(token) - 1)), i -> substring(token, i, 2))")).alias("pair"))
        .where("length(pair) = 2").groupBy("random", "pair").count().collect()  # at most two alphabets squared
    )
    size, place = len(ALPHABET), {c: i for i, c in enumerate(ALPHABET)}
    chains = {}
    for side in (True, False):
        counts = [[0.0] * size for _ in range(size)]
        for r in pairs:
            if r["random"] == side and r["pair"][0] in place and r["pair"][1] in place:
                counts[place[r["pair"][0]]][place[r["pair"][1]]] = float(r["count"])
        # rows seen seldom lean on the frequencies of single characters
        single = [sum(row[j] for row in counts) + 0.5 for j in range(size)]
        share = [x / sum(single) for x in single]
        chains[side] = [[(n + BACKING * share[j]) / (sum(row) + BACKING) for j, n in enumerate(row)] for row in counts]
    return [math.log(a) - math.log(b) for one, other in zip(chains[True], chains[False]) for a, b in zip(one, other)]


def scan(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row of ``docs`` (doc_id, text, any more columns).

    ``table``: the log ratios, by default learnt from ``docs``.
    """
    table = table or ratios(samples(docs))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_DOC)).alias("doc"), F.xxhash64("text").alias("text_key"), text.alias("text"))
    kinds = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("markov", LONG_TOKEN))
    any_match = None
    for _, pattern in kinds:
        any_match = F.col("text").rlike(pattern) if any_match is None else any_match | F.col("text").rlike(pattern)
    places = F.array(*[
        F.struct(
            F.lit(order).alias("order"), F.lit(kind).alias("kind"),
            F.transform(F.split("text", pattern, -1), lambda x: F.char_length(x)).alias("between"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("matches"),
            (F.regexp_extract_all("text", F.lit(pattern), F.lit(2)) if kind == "assign" else F.array().cast("array<string>")).alias("values"),
        ) for order, (kind, pattern) in enumerate(kinds)
    ])
    pieces = (
        keyed.where(any_match).select("doc", "text_key", F.explode(places).alias("k"))
        .select("doc", "text_key", "k.order", "k.kind", F.posexplode(F.arrays_zip("k.between", "k.matches", "k.values")).alias("i", "p"))
        .where("p.matches is not null")
        .select("doc", "text_key", "order", "kind", "i", F.col("p.between").alias("between"), F.col("p.matches").alias("match"), F.col("p.values").alias("value"))
        .distinct()
    )
    along = Window.partitionBy("doc", "text_key", "order").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = len(ALPHABET)
    at = lambda i: f"locate(substring(match, {i}, 1), '{ALPHABET}')"
    score = F.expr(
        f"aggregate(sequence(1, length(match) - 1), 0D, (sum, i) -> sum + element_at(ratios, ({at('i')} - 1) * {size} + {at('i + 1')}))"
    )
    mixed = F.col("match").rlike("[0-9]") & F.col("match").rlike("[A-Za-z]") | F.col("match").rlike("[a-z]") & F.col("match").rlike("[A-Z]")
    placed = (
        pieces.withColumn("end", F.sum(F.col("between") + F.char_length("match")).over(along)).withColumn("start", F.col("end") - F.char_length("match"))
        .withColumn("ratios", F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>"))
        .where(
            F.when(F.col("kind") == "assign", F.char_length("value") >= ASSIGN_VALUE)
            .when(F.col("kind") == "access", F.char_length("match") >= ACCESS_LENGTH)
            .when(F.col("kind") == "hex", F.lit(True))
            .otherwise(mixed & (score > EVIDENCE * (F.char_length("match") - 1)))
        )
    )
    base = F.col("kind") != "markov"
    by_start = Window.partitionBy("doc", "text_key").orderBy("start", "order")
    behind, ahead = by_start.rowsBetween(Window.unboundedPreceding, -1), by_start.rowsBetween(1, Window.unboundedFollowing)
    free = (F.coalesce(F.max(F.when(base, F.col("end"))).over(behind), F.lit(0)) <= F.col("start")) & (
        F.coalesce(F.first(F.when(base, F.col("start")), ignorenulls=True).over(ahead), F.col("end")) >= F.col("end")
    )
    kept = placed.withColumn("free", free).where(base | F.col("free"))
    one = F.struct("start", "order", F.concat_ws(":", "kind", "start", "end").alias("span"))
    count = lambda kind: F.count(F.when(F.col("kind") == kind, 1)).alias(f"n_{kind}")
    listed = kept.groupBy("doc", "text_key").agg(
        count("assign"), count("access"), count("hex"),
        F.array_join(F.sort_array(F.collect_list(F.when(base, one))).getField("span"), ",").alias("base"),
        F.array_join(F.sort_array(F.collect_list(one)).getField("span"), ",").alias("spans"),
    )
    return keyed.select("doc_id", "doc", "text_key").join(listed, ["doc", "text_key"], "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
