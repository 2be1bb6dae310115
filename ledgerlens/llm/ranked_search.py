"""Ranked lexical search over bit-sliced Bloom signatures.

Documents are indexed in blocks. For each level of occurrences (at least 1, 2, 3, 4, 6, ... times) a block
holds a Bloom filter of every document's terms, stored by slices: one bitmap over the block's documents for
each bit of the filters. A term's bitmap is the AND of a few slices; it names all documents that hold the
term that often and, now and then, one that does not. So the number of levels on which a document is named
bounds its occurrences from above, and the weighted sum over a query's terms bounds its score.

The documents with the highest bounds are scored exactly first; the score of the k-th best is a floor.
A second pass over the index excludes every document whose bound is below the floor (or equals it with a
doc_id that would lose the tie). All others are scored exactly from their whole texts. Bounds only decide who is
scored, never a score, so results equal those of a full scan.

Documents of a block have similar numbers of terms, so their filters share one length. Very long texts are
indexed whole, in blocks of fewer documents. Blocks are rows of a table of about a megabyte at most.

Weights are ``floor(1000 * ln((2N + 2) / (2 df + 1)))``; see ``exact_scores`` for the score. A null text, an empty text
and a text without terms count nowhere and are never found. Each row of ``docs`` is a document of its own: rows that
repeat a doc_id each take a rank. Documents without a doc_id come after those with one of the same score.
Items equal in item_id and text are one; a null item or one without terms finds nothing. With empty tables
the result is empty. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import WordHashes, saved, small, utf8

#: a level names the documents that hold a term at least so many times
LEVELS = (1, 2, 3, 4, 6, 9, 14, 21, 32, 48, 72, 108, 162, 243, 365, 548, 822)
#: bits of a filter for each term, and slices that a term sets: a false match in a thousand
BITS, HASHES = 16, 6
#: documents of a block, and bytes of its first level, at most (eight documents at least)
BLOCK_DOCS, BLOCK_BYTES = 256, 1 << 20
#: terms and documents that a task holds while it forms blocks of similar length
HELD_TERMS, HELD_DOCS = 1 << 21, 8192
#: items, and their terms, that one pass over the index answers
PASS_ITEMS, PASS_TERMS = 2000, 100_000

#: term characters are 0-9, A-Z, a-z and everything beyond ASCII; capital letters become small ones, the rest blanks
_TERMS = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(128)).lower() + bytes(range(128, 256))

INDEX = "doc_ids array<long>, text_keys array<long>, n array<long>, top array<long>, widths array<int>, slices array<binary>"


def terms_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(_TERMS).split()


def slice_numbers(hashes: np.ndarray, width: int) -> np.ndarray:
    """The slices of each term, shape (terms, HASHES)."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return ((low[:, None] + np.arange(HASHES, dtype=np.uint64) * high[:, None]) % np.uint64(width)).astype(np.int64)


def _block(held: list[tuple]) -> dict:
    """One index row of documents (doc_id, text_key, number of terms, hashes, occurrences)."""
    places = -(-len(held) // 8) * 8
    at = np.repeat(np.arange(len(held)), [len(d[3]) for d in held])
    hashes, often = np.concatenate([d[3] for d in held]), np.concatenate([d[4] for d in held])
    widths, slices = [], []
    for level in LEVELS:
        on = often >= level
        if not on.any():
            break
        width = max(64, BITS * int(np.bincount(at[on]).max()))
        named = np.zeros((width, places), bool)
        named[slice_numbers(hashes[on], width), at[on][:, None]] = True
        widths.append(width)
        slices.append(np.packbits(named, axis=1).tobytes())
    return {
        "doc_ids": [d[0] for d in held], "text_keys": [d[1] for d in held], "n": [d[2] for d in held],
        "top": [int(d[4].max()) for d in held], "widths": widths, "slices": slices,
    }


def _blocks(held: list[tuple]) -> Iterator[pd.DataFrame]:
    held.sort(key=lambda d: len(d[3]), reverse=True)
    first = 0
    while first < len(held):
        fit = BLOCK_BYTES * 8 // (BITS * len(held[first][3])) // 8 * 8
        last = first + min(BLOCK_DOCS, max(8, fit))
        yield pd.DataFrame([_block(held[first:last])])
        first = last


def _index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known, held, weight = WordHashes(), [], 0
    for frame in frames:
        for doc, key, text in zip(frame["doc_id"].astype("Int64"), frame["text_key"], frame["text"]):
            counts = Counter(terms_of(text))
            if not counts:
                continue
            often = np.fromiter(counts.values(), np.int64, len(counts))
            held.append((None if pd.isna(doc) else int(doc), int(key), int(often.sum()), known.of(list(counts)), often))
            weight += len(counts)
            if weight >= HELD_TERMS or len(held) >= HELD_DOCS:
                yield from _blocks(held)
                held, weight = [], 0
    if held:
        yield from _blocks(held)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text): one row a block, written to the shared scratch folder."""
    return saved(_keyed(docs).mapInPandas(_index, INDEX), "signatures")


def totals(indexed: DataFrame) -> tuple[int, int]:
    """Number of documents with a term, and of all their terms."""
    row = indexed.select(F.size("doc_ids").alias("d"), F.expr("aggregate(n, 0L, (a, x) -> a + x)").alias("n")).agg(F.sum("d"), F.sum("n")).first()
    return int(row[0] or 0), int(row[1] or 0)


def document_frequencies(docs: DataFrame, terms: Sequence[bytes]) -> dict[bytes, int]:
    """In how many documents each of ``terms`` stands; every task sends one count for a term."""
    wanted = frozenset(terms)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for frame in frames:
            for text in frame["text"]:
                seen.update(wanted.intersection(terms_of(text)))
        yield pd.DataFrame({"term": list(seen), "df": list(seen.values())})

    found = docs.select("text").mapInPandas(run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r["term"]): r["df"] for r in found.collect()}


@dataclass
class Queries:
    """A bounded block of items: ``terms`` are the distinct ones, ``of`` their occurrences by item."""

    ids: list
    terms: list[bytes]
    weights: np.ndarray  # of each term
    first: np.ndarray  # term t stands in items[first[t]:first[t + 1]], times[...] times
    items: np.ndarray
    times: np.ndarray
    documents: int
    words: int

    def rounding(self, n: np.ndarray) -> np.ndarray:
        """A document's m, from its number of terms."""
        return 25 + (75 * n * self.documents) // self.words


def queries(block: list[tuple], docs: DataFrame, documents: int, words: int) -> Queries:
    counts = [Counter(terms_of(text)) for _, text in block]
    terms = sorted(set().union(*counts))
    number = {t: i for i, t in enumerate(terms)}
    df = document_frequencies(docs, terms)
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(t, 0) + 1))) for t in terms]
    uses = sorted((number[t], i, c) for i, own in enumerate(counts) for t, c in own.items())
    by_term, items, times = (np.array(x, np.int64) for x in zip(*uses)) if uses else (np.empty(0, np.int64),) * 3
    first = np.searchsorted(by_term, np.arange(len(terms) + 1))
    return Queries([b[0] for b in block], terms, np.array(weights, np.int64), first, items, times, documents, words)


def _part(often: np.ndarray, rounding: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * often) // (1000 * often + 8 * rounding)


def _spread(q: Queries, term: np.ndarray, value: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Adds ``value`` of (term, doc) to the doc's sum of every item that holds the term: (items, docs)."""
    uses = q.first[term + 1] - q.first[term]
    each = np.repeat(np.arange(len(term)), uses)
    use = np.arange(len(each)) - np.repeat(np.cumsum(uses) - uses, uses) + q.first[term][each]
    sums = np.zeros(len(q.ids) * docs, np.int64)
    np.add.at(sums, q.items[use] * docs + doc[each], value[each] * q.times[use])
    return sums.reshape(len(q.ids), docs)


def bounds(q: Queries, hashes: np.ndarray, n, top, widths, slices) -> np.ndarray:
    """An upper bound of every document's score for every item: (items, documents of the block)."""
    docs = len(n)
    level = np.zeros((len(hashes), docs), np.uint8)
    term = np.arange(len(hashes))
    named = np.full((len(hashes), -(-docs // 8)), 255, np.uint8)
    for width, held in zip(widths, slices):
        bits = np.frombuffer(held, np.uint8).reshape(width, -1)
        named = named & np.bitwise_and.reduce(bits[slice_numbers(hashes[term], int(width))], axis=1)
        on = named.any(axis=1)
        term, named = term[on], named[on]
        if not len(term):
            break
        level[term] += np.unpackbits(named, axis=1)[:, :docs]
    n, top = np.asarray(n, np.int64), np.asarray(top, np.int64)
    most = np.array([0, *(x - 1 for x in LEVELS[1:]), 1 << 40], np.int64)
    parts = _part(np.minimum(most[:, None], top), q.rounding(n))
    term, doc = np.nonzero(level)
    return _spread(q, term, parts[level[term, doc], doc] * q.weights[term], doc, docs)


def _hashes(q: Queries) -> np.ndarray:
    return WordHashes().of(q.terms)


def _leaders(indexed: DataFrame, q: Queries, count: int) -> DataFrame:
    """(item, doc_id, text_key, bound): the ``count`` highest bounds of each item."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, items = _hashes(q), len(q.ids)
        best = np.zeros((items, 0), np.int64)
        docs, keys = np.zeros((items, 0), object), np.zeros((items, 0), np.int64)
        for frame in frames:
            for row in frame.itertuples(index=False):
                now = bounds(q, hashes, row.n, row.top, row.widths, row.slices)
                own = np.empty(now.shape[1], object)
                own[:] = [None if d is None or d != d else int(d) for d in row.doc_ids]
                best = np.concatenate([best, now], axis=1)
                docs = np.concatenate([docs, np.broadcast_to(own, now.shape)], axis=1)
                keys = np.concatenate([keys, np.broadcast_to(np.asarray(row.text_keys, np.int64), now.shape)], axis=1)
                if best.shape[1] > count:
                    top = np.argpartition(-best, count - 1, axis=1)[:, :count]
                    best, docs, keys = (np.take_along_axis(x, top, axis=1) for x in (best, docs, keys))
        item, at = np.nonzero(best)
        yield pd.DataFrame({"item": item, "doc_id": pd.array(list(docs[item, at]), "Int64"), "text_key": keys[item, at], "bound": best[item, at]})

    found = indexed.mapInPandas(run, "item long, doc_id long, text_key long, bound long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "doc_id", "text_key"))
    return found.withColumn("_place", place).where(F.col("_place") <= count).drop("_place")


def _open(indexed: DataFrame, q: Queries, floors: dict[int, tuple[int, int | None]]) -> DataFrame:
    """(item, doc_id, text_key) of all pairs whose bound does not exclude them."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _hashes(q)
        floor = np.array([floors.get(i, (0, None))[0] for i in range(len(q.ids))], np.int64)
        last = np.array([x if (x := floors.get(i, (0, None))[1]) is not None else np.iinfo(np.int64).max for i in range(len(q.ids))], np.int64)
        for frame in frames:
            for row in frame.itertuples(index=False):
                now = bounds(q, hashes, row.n, row.top, row.widths, row.slices)
                ids = pd.array(row.doc_ids, "Int64")
                order = ids.fillna(np.iinfo(np.int64).max).to_numpy(np.int64)
                item, at = np.nonzero((now > floor[:, None]) | ((now == floor[:, None]) & (now > 0) & (order <= last[:, None])))
                yield pd.DataFrame({"item": item, "doc_id": ids[at], "text_key": np.asarray(row.text_keys, np.int64)[at]})

    return indexed.mapInPandas(run, "item long, doc_id long, text_key long")


def exact_scores(docs: DataFrame, q: Queries, pairs: DataFrame) -> DataFrame:
    """(item, doc_id, score) of the documents in ``pairs`` (item, doc_id, text_key), from their whole texts.

    The score is the sum over the item's terms, repeats included, of weight * ((10^9 * tf) div (1000 * tf + 8 * m)).
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = {t: i for i, t in enumerate(q.terms)}
        for frame in frames:
            parts = []
            for doc, text, wanted in zip(frame["doc_id"].astype("Int64"), frame["text"], frame["items"]):
                words = terms_of(text)
                counts = Counter(t for t in map(number.get, words) if t is not None)
                term = np.fromiter(counts, np.int64, len(counts))
                often = np.fromiter(counts.values(), np.int64, len(counts))
                value = _part(often, q.rounding(np.int64(len(words)))) * q.weights[term]
                sums = _spread(q, term, value, np.zeros(len(term), np.int64), 1)[:, 0]
                wanted = np.asarray(wanted, np.int64)
                parts.append(pd.DataFrame({"item": wanted, "doc_id": pd.array([doc] * len(wanted), "Int64"), "score": sums[wanted]}))
            if parts:
                yield pd.concat(parts)

    wanted = saved(pairs.groupBy("doc_id", "text_key").agg(F.collect_set("item").alias("items")), "pairs")
    wanted = small(wanted.withColumnsRenamed({"doc_id": "_id", "text_key": "_key"}))
    keyed = _keyed(docs)
    rows = keyed.join(wanted, keyed["doc_id"].eqNullSafe(wanted["_id"]) & (keyed["text_key"] == wanted["_key"])).select("doc_id", "text", "items")
    return rows.mapInPandas(run, "item long, doc_id long, score long").where("score > 0")


def _best(scores: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k)


def _passes(items: DataFrame) -> Iterator[list[tuple]]:
    """The items (item_id, text) that have terms, in bounded blocks as they come."""
    block, weight = [], 0
    for item, text in items.select("item_id", "text").where("text is not null").distinct().toLocalIterator():
        terms = len(set(terms_of(text)))
        if not terms:
            continue
        if block and (len(block) >= PASS_ITEMS or weight + terms > PASS_TERMS):
            yield block
            block, weight = [], 0
        block.append((item, text))
        weight += terms
    if block:
        yield block


def search(indexed: DataFrame, docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item (item_id, text).

    ``indexed`` is ``index(docs)``. Items are answered in blocks, each with two passes over the index.
    """
    spark = docs.sparkSession
    documents, words = totals(indexed)
    found = []
    for block in _passes(items) if documents else ():
        q = queries(block, docs, documents, words)
        first = saved(_best(exact_scores(docs, q, _leaders(indexed, q, 2 * k)), k), "leaders")
        floors = {r["item"]: (r["score"], r["doc_id"]) for r in first.where(F.col("rank") == k).collect()}
        best = _best(exact_scores(docs, q, _open(indexed, q, floors)), k)
        names = spark.createDataFrame(pd.DataFrame({"item": np.arange(len(q.ids)), "item_id": q.ids}), "item long, item_id " + dict(items.dtypes)["item_id"])
        found.append(saved(best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked"))
    if not found:
        kind = dict(items.dtypes)["item_id"]
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``search`` with an index of its own."""
    return search(index(docs), docs, items, k)
