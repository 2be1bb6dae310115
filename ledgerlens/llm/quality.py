"""Document quality by supervised subword embeddings.

Every word and every character 4-gram (over the bytes, words joined by one space) is hashed into a
table of vectors; a word that only repeats the word before it has one row of its own. A document is the average of the vectors of all its words and 4-grams, and a softmax layer on
it gives the classes. Vectors and layer are trained together by stochastic gradient descent in numpy, on
a bounded sample: at most ``PER_CLASS`` labelled documents of each class, those with the smallest
hashes of their doc_id, whole texts. The sample's class weights restore the label frequencies.
As the average and the layer are linear, scoring needs one number per table row.

Every document is scored from its text alone. A null or empty text has no features and gets
the score of the layer's bias. Documents whose labels contradict each other are not learnt from, nor is a label
without a document. With no labels of one class the model is that bias: the smoothed label frequency.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import WordHashes, utf8

BITS, DIM = 16, 16
PER_CLASS, EPOCHS, RATE, SEED = 1000, 6, 4.0, 5
THRESHOLD = 0.3
#: the table row of every word that equals the word before it
REPEAT = 0
_P = [np.uint32(p) for p in (2654435761, 2246822519, 3266489917, 668265263)]


def features(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Table rows of all words (first half of the table) and byte 4-grams (second half)."""
    words = utf8(text).split()
    if not words:
        return np.empty(0, np.int64)
    h = hashes.of(words)
    own = (h >> np.uint64(64 - BITS)).astype(np.int64)
    own[1:][h[1:] == h[:-1]] = REPEAT
    b = np.frombuffer(b" " + b" ".join(words) + b"  ", np.uint8).astype(np.uint32)
    with np.errstate(over="ignore"):
        grams = b[:-3] * _P[0] + b[1:-2] * _P[1] + b[2:-1] * _P[2] + b[3:] * _P[3]
        grams = (grams ^ (grams >> np.uint32(15))) * _P[1]
    return np.concatenate([own, (grams >> np.uint32(32 - BITS)).astype(np.int64) + (1 << BITS)])


def train(samples: list[tuple[int, float, np.ndarray, np.ndarray]], prior: float) -> tuple[np.ndarray, float]:
    """``samples``: (class, loss weight, table rows, their counts). Returns the log-odds of each table row and the bias."""
    rng = np.random.default_rng(SEED)
    table = rng.uniform(-1 / DIM, 1 / DIM, (2 << BITS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.array([0.0, np.log(prior / (1 - prior))], np.float32)
    if len({s[0] for s in samples}) == 2:
        steps, done = EPOCHS * len(samples), 0
        for _ in range(EPOCHS):
            for i in rng.permutation(len(samples)):
                cls, weight, rows, counts = samples[i]
                rate = RATE * weight * (1 - done / steps)
                done += 1
                if not len(rows):
                    continue
                share = (counts / counts.sum()).astype(np.float32)
                vectors = table[rows]
                mean = share @ vectors
                logits = mean @ layer + bias
                p = np.exp(logits - logits.max())
                p /= p.sum()
                p[cls] -= 1
                table[rows] = vectors - np.outer(share, rate * (layer @ p))
                layer -= rate * 0.1 * np.outer(mean, p)
    return (table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def _features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for frame in frames:
        found = [np.unique(features(t, hashes), return_counts=True) for t in frame["text"]]
        yield pd.DataFrame({
            "doc_id": frame["doc_id"], "quality": frame["quality"], "rows": [r.astype(np.int32) for r, _ in found],
            "counts": [n.astype(np.int32) for _, n in found],
        })


def learnt_from(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5 != 0


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """The model, from labels (doc_id, quality) of documents that are not held out.

    At most ``per_class`` documents of each label are learnt from, chosen among those that ``docs`` holds, and one text of each, however many rows
    repeat its doc_id.
    """
    sound = (
        labels.join(docs.select("doc_id"), "doc_id", "left_semi").where(learnt_from(F.col("doc_id")) & F.col("quality").isin(0, 1)).groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other")
    )
    counts = {r["quality"]: r["count"] for r in sound.groupBy("quality").count().collect()}
    chosen = None
    for cls in (0, 1):  # at most per_class rows each
        part = sound.where(F.col("quality") == cls).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .mapInPandas(_features, "doc_id long, quality int, rows array<int>, counts array<int>").toArrow().combine_chunks()
    )
    # views of one flat copy of all table rows and counts
    classes, ids = rows["quality"].to_numpy(), rows["doc_id"].to_numpy()
    flat = {c: rows[c].combine_chunks() for c in ("rows", "counts")}
    at = flat["rows"].offsets.to_numpy()
    values, seen = (flat[c].values.to_numpy() for c in ("rows", "counts"))
    got = {int(c): int((classes == c).sum()) for c in np.unique(classes)}
    total = sum(counts.get(c, 0) for c in got) or 1
    weight = {c: counts[c] / total * len(classes) / n for c, n in got.items()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    samples = []
    for i in np.argsort(ids, kind="stable"):
        part = slice(at[i], at[i + 1])
        samples.append((int(classes[i]), weight[int(classes[i])], values[part], seen[part]))
    return train(samples, prior)


def scorer(model: tuple[np.ndarray, float]):
    """A column function: the probability of label 1 for a text."""
    odds, bias = model

    def run(texts):
        hashes = WordHashes()
        for series in texts:
            out = np.empty(len(series))
            for i, text in enumerate(series):
                rows = features(text, hashes)
                x = bias + (float(odds[rows].mean(dtype=np.float64)) if len(rows) else 0.0)
                out[i] = 1 / (1 + np.exp(-x)) if x > -700 else 0.0
            yield pd.Series(out)

    run.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text, any more columns)."""
    probability = scorer(learn(docs, labels))
    scored = docs.select("doc_id", F.coalesce(~learnt_from(F.col("doc_id")), F.lit(False)).alias("held_out"), probability("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
