"""Approximate nearest neighbours through a few stable projections.

Vectors are projected to ``PROJECTIONS`` dimensions with Gaussian (2-stable)
weights: the squared projected distance of two vectors, over their squared
distance, follows a chi-square law with that many degrees of freedom.  A kd-tree
over the projections yields a query's neighbours in order of projected
distance; they are verified on the original vectors, a few at a time.  The
search stops when a vector nearer than the k-th found so far would, with
probability ``CONFIDENCE``, have come up already.

Rows are dealt to blocks of bounded size by a hash of their id, and every block
of queries meets every block of rows in a task of its own; each block has its
own tree.  A query's best of all blocks are merged by rank.  Equal vectors of a
block are one point of its tree, and all their ids are considered in order, so
large groups of copies cost nothing and ties go to the smaller id.

Defined results: vectors null, empty, zero or with a null or non-finite
component take no part; vectors of different length never meet; rows of equal
id and vector count once; a null id takes no part; with fewer than k candidates
all are returned.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import ship_package

#: even; with 24 of them and this confidence 36 to 52 % of the given vectors are verified
#: at a recall of 0.96 to 0.98 (8 projections: 71 to 78 %)
PROJECTIONS = 24
CONFIDENCE = 0.95
NEIGHBOURS = 10
ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 2048
_LEAF = 32
_OPEN = 24   # leaves opened together
_RUN = 32    # points handed out together, in order of projected distance
_SEED = 42


def chi_square_quantile(p: float, freedom: int) -> float:
    """The value that a chi-square variable of even ``freedom`` stays below with probability p."""
    def beyond(x: float) -> float:
        term = total = math.exp(-x / 2)
        for i in range(1, freedom // 2):
            term *= x / 2 / i
            total += term
        return total

    low, high = 0.0, 1.0
    while beyond(high) > 1 - p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if beyond(middle) > 1 - p else (low, middle)
    return high


class KdTree:
    """Median splits on the widest dimension; points of a leaf lie together."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, int, int]] = []  # start, end, left, right
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        waiting = [(0, len(points), -1, 0)]
        while waiting:
            start, end, parent, side = waiting.pop()
            rows = points[self.order[start:end]]
            node = len(self.nodes)
            self.nodes.append((start, end, -1, -1))
            self.low.append(rows.min(axis=0))
            self.high.append(rows.max(axis=0))
            if parent >= 0:
                s, e, left, right = self.nodes[parent]
                self.nodes[parent] = (s, e, node, right) if side == 0 else (s, e, left, node)
            if end - start > _LEAF:
                axis = int(np.argmax(self.high[-1] - self.low[-1]))
                middle = (end - start) // 2
                self.order[start:end] = self.order[start:end][np.argpartition(rows[:, axis], middle)]
                waiting += [(start, start + middle, node, 0), (start + middle, end, node, 1)]
        leaves = [i for i, node in enumerate(self.nodes) if node[2] < 0]
        leaves.sort(key=lambda i: self.nodes[i][0])
        self.points = points[self.order]
        self.places = [np.arange(*self.nodes[i][:2]) for i in leaves]
        self.low, self.high = np.array([self.low[i] for i in leaves]), np.array([self.high[i] for i in leaves])

    def nearest(self, query: np.ndarray):
        """Yield (places, bound): points in order of distance, ``_RUN`` at a time.

        Leaves are opened in order of the distance of their box, and a point is
        yielded once no unopened box is nearer.  Every point not yet yielded has a
        squared distance of ``bound`` at least.
        """
        gaps = np.maximum(0, np.maximum(self.low - query, query - self.high))
        reach = np.einsum("ij,ij->i", gaps, gaps)
        order = np.argsort(reach, kind="stable")
        held, held_at = np.zeros(0), np.zeros(0, np.int64)
        for first in range(0, len(order), _OPEN):
            at = np.concatenate([self.places[i] for i in order[first:first + _OPEN]])
            apart = self.points[at] - query
            held = np.concatenate([held, np.einsum("ij,ij->i", apart, apart)])
            held_at = np.concatenate([held_at, at])
            bound = reach[order[first + _OPEN]] if first + _OPEN < len(order) else math.inf
            sorted_by = np.argsort(held, kind="stable")
            held, held_at = held[sorted_by], held_at[sorted_by]
            sure = int(np.searchsorted(held, bound, side="right"))
            for start in range(0, sure, _RUN):
                end = min(start + _RUN, sure)
                yield self.order[held_at[start:end]], float(held[end]) if end < len(held) else bound
            held, held_at = held[sure:], held_at[sure:]


class Block:
    """The distinct vectors of a block, their ids and the tree over their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int, confidence: float):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.any(vectors[1:] != vectors[:-1], axis=1)
        keep = np.concatenate([[True], new | (ids[1:] != ids[:-1])])  # equal rows once
        first = np.concatenate([[True], new])
        self.vectors = vectors[first]
        groups = (np.cumsum(first) - 1)[keep]
        self.ids = np.split(ids[keep], np.flatnonzero(np.diff(groups)) + 1)
        weights = np.random.default_rng(_SEED).standard_normal((vectors.shape[1], projections))
        self.weights, self.tree = weights, KdTree(self.vectors @ weights)
        self.limit = chi_square_quantile(confidence, projections)
        self.verified = 0  # distances computed on original vectors

    def search(self, own: int, query: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k nearest found: (distance, id), nearest first."""
        best: list[tuple[float, int]] = []
        for places, bound in self.tree.nearest(query @ self.weights):
            self.verified += len(places)
            apart = self.vectors[places] - query
            distances = np.sqrt((apart * apart).sum(axis=1))
            worst = best[-1][0] if len(best) == k else math.inf
            if len(distances) > k:  # one place may be the query's own
                worst = min(worst, np.partition(distances, k)[k])
            near = distances <= worst
            for place, distance in zip(places[near], distances[near]):
                own_out = [i for i in self.ids[place][:k + 1].tolist() if i != own][:k]
                best += [(float(distance), i) for i in own_out]
            best = sorted(best)[:k]
            if len(best) == k and bound >= self.limit * best[-1][0] ** 2:
                break
        return best


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, vector, dim of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)).withColumn(
        "dim", F.size("vector"))


def nearest(vectors: DataFrame, every: int = 100, k: int = NEIGHBOURS, id_col: str = "vec_id",
            vector_col: str = "embedding", projections: int = PROJECTIONS,
            confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = usable(vectors, id_col, vector_col)
    is_query = F.col("vec_id") % every == 0
    n, asked = rows.agg(F.count(F.lit(1)), F.sum(is_query.cast("long"))).first()
    row_blocks = max(1, -(-n // ROWS_PER_BLOCK))
    query_blocks = max(1, -(-(asked or 0) // QUERIES_PER_BLOCK))

    def dealt(blocks: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(blocks))

    def all_of(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))

    left = rows.select("dim", dealt(row_blocks).alias("b"), all_of(query_blocks).alias("q"), "vec_id", "vector")
    right = rows.where(is_query).select(
        "dim", all_of(row_blocks).alias("b"), dealt(query_blocks).alias("q"), "vec_id", "vector")

    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(points) and len(queries):
            block = Block(points["vec_id"].to_numpy(), np.stack(points["vector"]), projections, confidence)
            for own, vector in zip(queries["vec_id"], queries["vector"]):
                found += [(own, i, d) for d, i in block.search(int(own), np.asarray(vector), k)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    keys = ["dim", "b", "q"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
