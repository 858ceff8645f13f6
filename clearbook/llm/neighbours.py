"""Approximate neighbours of largest inner product: stable projections in a kd-tree, and a chi-square stopping test.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, so that the largest inner product is the
smallest distance. A few Gaussian (2-stable) projections of a vector are its point in a kd-tree: the squared projected
distance over the squared distance follows a chi-square law. A query takes leaves in the order of their projected distance
and computes exact products for their vectors. It stops at the leaf of which a vector as near as the best found so far
would have, with at least the wanted confidence, a smaller projected distance.

Vectors are dealt to shards of a fixed number of rows, each with a tree of its own, and every block of queries goes to
every shard: all rows are indexed, and no task holds more than one shard and one block.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 8
LEAF = 512


def chi_square_quantile(share: float, degrees: int) -> float:
    """Quantile of the chi-square law for an even number of degrees, from its closed form by bisection."""
    half = degrees // 2

    def law(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(half))

    low, high = 0.0, 10.0 * degrees + 100
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if law(middle) < share else (low, middle)
    return high


def projection(width: int, count: int = PROJECTIONS) -> np.ndarray:
    """Gaussian directions, the same in every task."""
    return np.random.default_rng(width * 1000 + count).standard_normal((width, count))


class Shard:
    """kd-tree over the projected distinct vectors of a shard; equal vectors are one point with the smallest ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, count: int) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        self.vectors, member = np.unique(vectors, axis=0, return_inverse=True)
        # A query needs no more of equal vectors than the smallest ids, and one more for its own.
        place = np.argsort(member.ravel(), kind="stable")
        bounds = np.searchsorted(member.ravel()[place], np.arange(len(self.vectors) + 1))
        self.ids = [ids[place[a : min(b, a + count + 1)]] for a, b in zip(bounds[:-1], bounds[1:])]
        rest = np.sqrt(np.maximum(norm * norm - np.einsum("ij,ij->i", self.vectors, self.vectors), 0))
        self.directions = projection(vectors.shape[1] + 1)
        points = np.column_stack((self.vectors, rest)) @ self.directions
        leaves: list[np.ndarray] = []
        stack = [np.arange(len(points))]
        while stack:
            part = stack.pop()
            if len(part) <= LEAF:
                leaves.append(part)
                continue
            own = points[part]
            axis = int(np.argmax(own.max(0) - own.min(0)))
            middle = len(part) // 2
            split = np.argpartition(own[:, axis], middle)
            stack += [part[split[:middle]], part[split[middle:]]]
        # Vectors in the order of the leaves, so that a leaf is a slice.
        self.bounds = np.concatenate(([0], np.cumsum([len(leaf) for leaf in leaves])))
        dealt = np.concatenate(leaves)
        self.vectors, self.ids = self.vectors[dealt], [self.ids[i] for i in dealt.tolist()]
        self.low = np.array([points[leaf].min(0) for leaf in leaves])
        self.high = np.array([points[leaf].max(0) for leaf in leaves])

    def search(self, query_id: int, query: np.ndarray, norm: float, count: int, limit: float) -> list[tuple[float, int]]:
        """(score, id) of the ``count`` nearest found, nearest first."""
        point = np.append(query, 0.0) @ self.directions
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        distance = np.einsum("ij,ij->i", gap, gap)
        own = float(query @ query)
        slack = 1e-9 * norm * math.sqrt(own)
        best: list[tuple[float, int]] = []
        for leaf in np.argsort(distance, kind="stable").tolist():
            if len(best) == count:
                # Squared distance of the last of the best in the space with one more component.
                reach = norm * norm + own - 2 * best[0][0]
                if distance[leaf] > limit * max(reach, 0.0):
                    break
            start, end = self.bounds[leaf], self.bounds[leaf + 1]
            scores = self.vectors[start:end] @ query
            # The last bits of a product depend on how it is computed; what is near the limit is computed alone.
            least = best[0][0] - slack if len(best) == count else -math.inf
            if end - start > count + 1:
                least = max(least, np.partition(scores, -count - 1)[-count - 1] - slack)
            for at in (np.flatnonzero(scores >= least) + start).tolist():
                score = float(np.dot(self.vectors[at], query))
                for vec_id in self.ids[at].tolist():
                    if vec_id == query_id:
                        continue
                    if len(best) < count:
                        heapq.heappush(best, (score, -vec_id))
                    elif (score, -vec_id) > best[0]:
                        heapq.heapreplace(best, (score, -vec_id))
        return [(score, -vec_id) for score, vec_id in sorted(best, reverse=True)]


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero, and has neither null nor non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    queries: Column,
    count: int = 20,
    confidence: float = 0.9,
    shard_rows: int = 65_536,
    block_rows: int = 4_096,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``count`` largest inner products found for each query, ties to the smaller id.

    ``vectors`` has vec_id and embedding (array of numbers); ``queries`` is a condition on its rows. Vectors that are null,
    zero or hold null or non-finite components, and rows with a null vec_id, take no part; neither do a query's own rows.
    Vectors of another length are in a space of their own. Of rows that repeat a vec_id, the smallest vector counts.
    """
    number = F.transform("embedding", lambda x: x.cast("double")).alias("vector")
    clean = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long"), number, queries.alias("asks"))
    clean = clean.where(usable(F.col("vector"))).groupBy("vec_id").agg(
        F.min("vector").alias("vector"), F.max("asks").alias("asks")
    )
    squared = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    sizes = clean.groupBy(F.size("vector").alias("width")).agg(
        F.count("*").alias("n"), F.max(squared).alias("squared"), F.sum(F.col("asks").cast("long")).alias("asking")
    )
    plan = [(r.width, r.n, math.sqrt(r.squared), r.asking or 0) for r in sizes.collect()]
    spark = vectors.sparkSession
    shape = spark.createDataFrame(
        [(w, max(1, -(-n // shard_rows)), max(1, -(-a // block_rows)), m) for w, n, m, a in plan] or [(0, 1, 1, 0.0)],
        "width int, shards int, blocks int, norm double",
    )
    rows = clean.withColumn("width", F.size("vector")).join(F.broadcast(shape), "width")
    mixed = F.xxhash64("vec_id")
    stored = rows.select(
        "width", "norm", "vec_id", "vector", F.lit(False).alias("asks"),
        F.pmod(mixed, "shards").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    asking = rows.where("asks").select(
        "width", "norm", "vec_id", "vector", "asks",
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.pmod(mixed, "blocks").cast("int").alias("block"),
    )
    limit = chi_square_quantile(confidence, PROJECTIONS)

    def search(group: pd.DataFrame) -> pd.DataFrame:
        norm = float(group["norm"].iloc[0])
        base, ask = group[~group["asks"]], group[group["asks"]]
        found = []
        if len(base):
            shard = Shard(base["vec_id"].to_numpy(), np.stack(base["vector"].to_list()), norm, count)
            for query_id, query in zip(ask["vec_id"].tolist(), ask["vector"]):
                found += [(query_id, vec_id, score) for score, vec_id in shard.search(query_id, query, norm, count, limit)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    parts = stored.unionByName(asking).groupBy("width", "shard", "block").applyInPandas(
        search, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("query_id", "rank", "vec_id", "score")
