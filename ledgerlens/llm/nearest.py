"""Approximate nearest neighbours by largest inner product: stable projections, kd-tree, chi-square stopping.

One more component, sqrt(M^2 - |x|^2), turns the largest inner product into the smallest distance. A
seeded Gaussian matrix projects the vectors to ``PROJECTED`` dimensions; the squared projected distance over
the squared distance follows a chi-square distribution. A kd-tree over the projections (its upper part cuts
the table into cells, learnt on at most ``SAMPLE`` rows; its lower part is built inside each cell over every row)
yields leaves by growing projected distance. Their vectors are verified in full until the next leaf is farther,
in projection, than the chi-square quantile ``CERTAIN`` allows for the k-th distance found so far.

A query first searches the cell it falls in, then every other cell that the same test
leaves open. Cells above ``CELL`` rows, as of equal vectors, are split by hash, and many queries of one cell
are dealt over several tasks, so no group is unbounded.

Null vectors, zero vectors, and those that hold null or non-finite components take no part, nor do rows
without vec_id. Vectors meet those of the same length only. Rows that repeat a vec_id and vector count once; a query never
finds its own vec_id. Ties go to the smaller vec_id. Without vectors or queries the result is empty; with fewer than k
candidates all are returned. Other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import saved

PROJECTED, CERTAIN_Z, SEED = 8, 2.33, 3  # the 0.99 quantile
SAMPLE, CELL, LEAF, QUERIES = 20_000, 8192, 128, 2048
#: leaves verified between two stopping tests
STEP = 4


def chi_square(m: int, z: float = CERTAIN_Z) -> float:
    """Quantile of the chi-square distribution with ``m`` degrees of freedom (cube-root normal approximation)."""
    return m * (1 - 2 / (9 * m) + z * math.sqrt(2 / (9 * m))) ** 3


def projection(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim + 1, PROJECTED))


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0))
    return np.hstack([x, rest[:, None]])


def cut(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: median cuts across the widest dimension."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        spread = np.ptp(points[rows], axis=0) if len(rows) > size else np.zeros(1)
        if len(rows) <= size or spread.max() <= 0:
            leaves += [rows[i : i + size] for i in range(0, len(rows), size)]
            continue
        half = len(rows) // 2
        order = np.argpartition(points[rows, spread.argmax()], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return leaves


def cells(sample: np.ndarray, count: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Disjoint boxes (low, high) that fill the space, about equally many sample rows in each."""
    every = (np.full(sample.shape[1], -np.inf), np.full(sample.shape[1], np.inf))
    todo, boxes = [(sample, count, *every)], []
    while todo:
        rows, want, low, high = todo.pop()
        if want <= 1 or len(rows) < 2 or np.ptp(rows, axis=0).max() <= 0:
            boxes.append((low, high))
            continue
        d = np.ptp(rows, axis=0).argmax()
        at = float(np.quantile(rows[:, d], (want // 2) / want))
        left = rows[:, d] < at
        if not left.any() or left.all():
            boxes.append((low, high))
            continue
        below, above = high.copy(), low.copy()
        below[d] = above[d] = at
        todo += [(rows[left], want // 2, low, below), (rows[~left], want - want // 2, above, high)]
    return boxes


def _gaps(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    gap = np.maximum(low[None] - points[:, None], 0) + np.maximum(points[:, None] - high[None], 0)
    return (gap * gap).sum(axis=2)


def _search(k: int, longest: dict[int, float]):
    """Verifies leaves by growing projected distance; ``reach`` is the k-th score known before, or null."""
    limit = chi_square(PROJECTED)

    def run(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(data) and len(asked):
            dim = int(data["dim"].iloc[0])
            top = longest[dim]
            ids, x = data["vec_id"].to_numpy(np.int64), np.stack(data["x"].to_numpy())
            q, own = np.stack(asked["x"].to_numpy()), asked["query_id"].to_numpy(np.int64)
            reach = asked["reach"].to_numpy(np.float64, na_value=-np.inf)
            matrix = projection(dim)
            px = lifted(x, top) @ matrix
            pq = np.hstack([q, np.zeros((len(q), 1))]) @ matrix
            leaves = cut(px, LEAF)
            low, high = (np.stack([f(px[r], axis=0) for r in leaves]) for f in (np.min, np.max))
            square = (q * q).sum(axis=1) + top * top
            for i in range(len(q)):
                gap = _gaps(pq[i : i + 1], low, high)[0]
                order = np.argsort(gap, kind="stable")
                best_ids, best = np.empty(0, np.int64), np.empty(0)
                for s in range(0, len(order), STEP):
                    known = max(reach[i], best[k - 1] if len(best) >= k else -np.inf)
                    if gap[order[s]] > limit * max(square[i] - 2 * known, 0) + 1e-9:
                        break
                    rows = np.concatenate([leaves[j] for j in order[s : s + STEP]])
                    rows = rows[ids[rows] != own[i]]
                    got = (x[rows] * q[i]).sum(axis=1)
                    good = got >= known
                    best_ids, best = np.concatenate([best_ids, ids[rows[good]]]), np.concatenate([best, got[good]])
                    first = np.lexsort((best_ids, -best))[:k]
                    best_ids, best = best_ids[first], best[first]
                out.append(pd.DataFrame({"query_id": own[i], "vec_id": best_ids, "score": best}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})

    return run


def nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each vec_id divisible by ``every`` its ``k`` nearest of all rows.

    ``vectors``: vec_id, embedding, any more columns.
    """
    spark = vectors.sparkSession
    sound = (
        vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x")).where("vec_id is not null and x is not null and size(x) > 0")
        .where(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
        .withColumn("norm", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c))).where("norm > 0")
        .withColumn("dim", F.size("x")).dropDuplicates(["vec_id", "x"])
    )
    sound = saved(sound, "vectors")
    stats = {r["dim"]: r for r in sound.groupBy("dim").agg(F.max("norm").alias("longest"), F.count(F.lit(1)).alias("n")).collect()}
    longest = {d: float(r["longest"]) for d, r in stats.items()}
    boxes, number = {}, 0
    for dim, r in stats.items():
        sample = sound.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("x").toPandas()
        points = lifted(np.stack(sample["x"].to_numpy()), longest[dim]) @ projection(dim)
        own = cells(points, -(-r["n"] // CELL))
        boxes[dim] = (np.stack([b[0] for b in own]), np.stack([b[1] for b in own]), number)
        number += len(own)

    def place(frames):
        for frame in frames:
            cell = np.empty(len(frame), np.int64)
            for dim, rows in frame.groupby("dim").indices.items():
                low, high, offset = boxes[dim]
                p = lifted(np.stack(frame["x"].iloc[rows].to_numpy()), longest[dim]) @ projection(dim)
                inside = ((p[:, None] >= low[None]) & (p[:, None] < high[None])).all(axis=2)
                cell[rows] = inside.argmax(axis=1) + offset
            yield frame.assign(cell=cell)

    def route(frames):
        limit = chi_square(PROJECTED)
        for frame in frames:
            for query, x, again, reach in zip(frame["query_id"], frame["x"], frame["again"], frame["reach"]):
                low, high, offset = boxes[len(x)]
                p = (np.append(x, 0.0) @ projection(len(x)))[None]
                far = np.inf if reach is None or np.isnan(reach) else limit * max(float(x @ x) + longest[len(x)] ** 2 - 2 * reach, 0) + 1e-9
                # the first round asks the home cell alone, the second all others that stay open
                home = int(((p >= low) & (p < high)).all(axis=1).argmax())
                asked = [c + offset for c in np.flatnonzero(_gaps(p, low, high)[0] <= far) if c != home] if again else [home + offset]
                if asked:
                    yield pd.DataFrame({"query_id": query, "x": [x] * len(asked), "reach": reach, "cell": asked})

    data = saved(sound.select("vec_id", "x", "dim").mapInPandas(place, "vec_id long, x array<double>, dim int, cell long"), "cells")
    # cells of more rows than a task should hold are split by hash; there are at most SAMPLE cells
    shares = saved(data.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (2 * CELL)).alias("shares")), "shares")
    data = data.join(F.broadcast(shares), "cell").withColumn("share", F.pmod(F.xxhash64("vec_id"), F.col("shares"))).drop("shares")
    asked = sound.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "x")

    def answers(queries: DataFrame) -> DataFrame:
        routed = queries.mapInPandas(route, "query_id long, x array<double>, reach double, cell long")
        routed = saved(routed, "routed")
        loads = saved(routed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("loads")), "loads")
        here = (
            routed.join(F.broadcast(loads), "cell").withColumn("load", F.pmod(F.xxhash64("query_id"), F.col("loads")))
            .join(F.broadcast(shares), "cell").withColumn("share", F.explode(F.expr("sequence(0L, shares - 1)"))).drop("loads", "shares")
        )
        there = data.join(F.broadcast(loads), "cell").withColumn("load", F.explode(F.expr("sequence(0L, loads - 1)"))).drop("loads")
        key = ["cell", "share", "load"]
        return saved(there.groupBy(*key).cogroup(here.groupBy(*key)).applyInPandas(_search(k, longest), "query_id long, vec_id long, score double"), "answers")

    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.distinct().withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)

    if not stats:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    first = answers(asked.withColumn("again", F.lit(False)).withColumn("reach", F.lit(None).cast("double")))
    reach = best(first).where(F.col("rank") == k).select("query_id", F.col("score").alias("reach"))
    second = answers(asked.withColumn("again", F.lit(True)).join(reach, "query_id", "left"))
    return best(first.union(second)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
