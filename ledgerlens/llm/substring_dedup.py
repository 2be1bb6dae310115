"""Repeated passages: difference-cover anchors, then whole windows.

Words at positions whose remainder modulo ``PERIOD`` is in the difference cover start an anchor.
For any two positions some common shift below the period brings both onto the cover, so two equal
windows of ``window`` words always hold two anchors of ``window - PERIOD + 1`` words at the same
offset. Anchors that only one text holds are dropped; around the others every whole window is hashed
(96 bits) and the smallest doc_id that starts it is found. Only anchors (about a fifth of all
words) and the windows of passages that do repeat are shuffled, each in two steps: minima with
map-side combination, then a join that adaptive execution may split, so a passage that a third of
all documents hold is no group in one task.

Documents with the same word sequence are decided by their digest alone: only the one with the
smallest doc_id takes part.

Rows without a doc_id lose nothing and count as a source for nobody. Rows that repeat a doc_id are
judged each on its own text, as sources they count as that doc_id. A null text has no words. Texts of any length
are read whole, one at a time; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import GOLDEN, WordHashes, mixed, saved, signed, utf8

#: a perfect difference cover: every difference modulo 31 occurs
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: anchor rows handed over at once
CHUNK = 200_000


def rolling(h: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A hash of each run of ``width`` word hashes, put together from runs of doubling width."""
    if len(h) < width:
        return np.empty(0, np.uint64)
    count = len(h) - width + 1
    with np.errstate(over="ignore"):
        total, at, run, span = np.full(count, salt, np.uint64), 0, h, 1
        while True:
            if width & span:
                total = mixed((total ^ run[at : at + count]) * GOLDEN + np.uint64(span))
                at += span
            if at == width:
                return total
            run = mixed(run[:-span] * GOLDEN + run[span:])
            span *= 2


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _base(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        split = [utf8(t).split() for t in frame["text"]]
        yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_words": [len(w) for w in split], "whole": [_digest(w) for w in split]})


def _anchors(window: int):
    width = window - PERIOD + 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        on = np.zeros(PERIOD, bool)
        on[list(COVER)] = True
        for frame in frames:
            parts, rows = [], 0
            for doc, text in zip(frame["doc_id"], frame["text"]):
                words = utf8(text).split()
                if len(words) < window:
                    continue
                at = np.flatnonzero(on[np.arange(len(words) - width + 1) % PERIOD])
                text_id = xxhash.xxh3_128_intdigest(b" ".join(words)) & ((1 << 63) - 1)
                parts.append((signed(rolling(hashes.of(words), width, 0)[at]), np.full(len(at), doc, np.int64), np.full(len(at), text_id, np.int64), at.astype(np.int32)))
                rows += len(at)
                if rows > CHUNK:
                    yield pd.DataFrame(dict(zip(("anchor", "doc_id", "text_id", "at"), map(np.concatenate, zip(*parts)))))
                    parts, rows = [], 0
            if parts:
                yield pd.DataFrame(dict(zip(("anchor", "doc_id", "text_id", "at"), map(np.concatenate, zip(*parts)))))

    return run


def near_anchors(at: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Starts of the windows that contain an anchor starting at one of ``at``."""
    at = at[at < n_words]
    marks = np.zeros(n_words + 2, np.int64)
    np.add.at(marks, np.maximum(at - (PERIOD - 1), 0), 1)
    np.add.at(marks, at + 1, -1)
    return np.flatnonzero(np.cumsum(marks)[: max(0, n_words - window + 1)] > 0)


def _windows(window: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            for doc, key, text, at in zip(frame["doc_id"], frame["text_key"], frame["text"], frame["at"]):
                h = hashes.of(utf8(text).split())
                starts = near_anchors(np.asarray(at, np.int64), len(h), window)
                if len(starts):
                    yield pd.DataFrame({
                        "k1": signed(rolling(h, window, 0)[starts]), "k2": signed(rolling(h, window, 7)[starts]).astype(np.int32),
                        "doc_id": np.full(len(starts), doc, np.int64), "text_key": np.full(len(starts), key, np.int64),
                        "at": starts.astype(np.int32),
                    })

    return run


def _cut(window: int, texts: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            whole, removed, kept, out = [], [], [], []
            for text, starts in zip(frame["text"], frame["starts"]):
                words = utf8(text).split()
                marks = np.zeros(len(words) + 1, np.int64)
                starts = np.asarray(starts, np.int64)
                np.add.at(marks, starts, 1)
                np.add.at(marks, starts + window, -1)
                rest = [words[i] for i in np.flatnonzero(np.cumsum(marks)[: len(words)] == 0)]
                whole.append(_digest(words))
                removed.append(len(words) - len(rest))
                kept.append(_digest(rest))
                out.append(b" ".join(rest).decode("utf-8", "surrogatepass") if texts else None)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "whole": whole, "cut": removed, "rest": kept, "kept_text": out})

    return run


def repeated_passages(docs: DataFrame, window: int = 50, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and ``kept_text`` where ``texts``) for each row of ``docs``.

    Removed is every word covered by a window of ``window`` words that also starts in a document
    with a smaller doc_id. ``kept_text`` is null where nothing was removed.
    """
    if window < PERIOD + 7:
        raise ValueError(f"a window of less than {PERIOD + 7} words leaves too short an anchor")
    every = docs.select("doc_id", "text")
    base = saved(every.mapInPandas(_base, "doc_id long, n_words long, whole string"), "base")
    own = every.where("doc_id is not null")
    anchors = own.mapInPandas(_anchors(window), "anchor long, doc_id long, text_id long, at int")
    shared = saved(
        anchors.select("anchor", "text_id").groupBy("anchor").agg(F.min("text_id").alias("low"), F.max("text_id").alias("high"))
        .where("low <> high").select("anchor"),
        "anchors",
    )
    firsts = saved(base.where("doc_id is not null").groupBy("whole").agg(F.min("doc_id").alias("first")), "firsts")
    leaders = firsts.select(F.col("first").alias("doc_id")).distinct()
    hits = anchors.select("anchor", "doc_id", "at").join(shared, "anchor").groupBy("doc_id").agg(F.collect_list("at").alias("at"))
    open_ = saved(own.withColumn("text_key", F.xxhash64("text")).join(hits.join(leaders, "doc_id", "left_semi"), "doc_id"), "open")
    # the windows are read twice; written once, their texts are hashed once
    windows = saved(open_.mapInPandas(_windows(window), "k1 long, k2 int, doc_id long, text_key long, at int"), "windows")
    least = (
        windows.select("k1", "k2", "doc_id").groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").drop("last")
    )
    covered = (
        windows.join(least, ["k1", "k2"]).where("first < doc_id")
        .groupBy("doc_id", "text_key").agg(F.collect_list("at").alias("starts"))
    )
    cut = (
        open_.drop("at").join(covered, ["doc_id", "text_key"])
        .mapInPandas(_cut(window, texts), "doc_id long, whole string, cut long, rest string, kept_text string")
        .dropDuplicates(["doc_id", "whole"])
    )
    copy = F.coalesce((F.col("first") < F.col("doc_id")) & (F.col("n_words") >= window), F.lit(False))
    return (
        base.join(firsts, "whole", "left").join(cut, ["doc_id", "whole"], "left")
        .select(
            "doc_id", "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"),
            F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("rest", "whole")).alias("kept_sha256"),
            *([F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if texts else []),
        )
    )
