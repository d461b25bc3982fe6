"""Approximate nearest neighbours by cosine with vantage-point trees per shard.

Vectors are dealt to shards of bounded size by a hash, so copies of one vector spread out. Each shard is
a vantage-point tree over unit vectors: a node splits its points at the median distance to one of them.
Blocks of queries meet every shard; within it all queries of a block go down the tree together, each
first to its nearest leaf, then to every child that the triangle inequality doesn't rule out. A child
is passed over if its least possible distance exceeds ``factor`` times the query's k-th best so far:
factor 1 is exact, a smaller one searches less. The best of all shards are merged by partial top-k.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, as
candidates or queries; nor does one whose length differs from the query's; a query's own id is no
candidate of it, in repeated rows neither; ties go to the smaller id; with fewer candidates than k all
are returned; a null id is a candidate without a name and takes no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SHARD_ROWS = 1024
QUERY_BLOCK = 1024
LEAF = 32
#: Similarities closer than this are compared again in full precision.
CLOSE = 1e-9
#: Rounding of distances near zero.
SLACK = 1e-7


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision, adding the dimensions up in their order."""
    dot = np.zeros(len(a))
    norm_a, norm_b = np.zeros(len(a)), np.zeros(len(a))
    for d in range(a.shape[1]):
        dot += a[:, d] * b[:, d]
        norm_a += a[:, d] * a[:, d]
        norm_b += b[:, d] * b[:, d]
    return np.clip(dot / np.sqrt(norm_a * norm_b), -1.0, 1.0)


class Tree:
    """Vantage-point tree of unit vectors. ``nodes`` hold the vantage point, two children and for each
    the least and largest distance of its points to the vantage point; leaves hold row numbers."""

    def __init__(self, points: np.ndarray, seed: int = 11) -> None:
        self.points = points
        self._draw = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> tuple:
        if len(rows) <= LEAF:
            return (rows,)
        vantage = self.points[rows[self._draw.integers(len(rows))]]
        away = np.sqrt(np.maximum(0, 2 - 2 * (self.points[rows] @ vantage)))
        order = np.argsort(away, kind="stable")
        half = len(rows) // 2
        if away[order[0]] == away[order[-1]]:
            return (rows,)
        near, far = order[:half], order[half:]
        return (
            vantage,
            (self._build(rows[near]), away[near[0]], away[near[-1]]),
            (self._build(rows[far]), away[far[0]], away[far[-1]]),
        )

    def search(
        self, queries: np.ndarray, own: np.ndarray, names: np.ndarray, k: int, factor: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Candidate (query, row) pairs: all that may be among the k best, ties included."""
        best = np.full((len(queries), k), -np.inf)
        pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        seen_leaf = np.full(len(queries), -1, np.int64)

        def leaf(rows: np.ndarray, active: np.ndarray) -> None:
            for low in range(0, len(rows), 512):
                part = rows[low : low + 512]
                sims = queries[active] @ self.points[part].T
                sims[own[active][:, None] == names[part][None, :]] = -np.inf
                width = min(k, len(part))
                top = np.partition(sims, len(part) - width, axis=1)[:, len(part) - width :]
                merged = np.concatenate([best[active], top], axis=1)
                best[active] = np.sort(merged, axis=1)[:, -k:]
                q, r = np.nonzero(sims >= np.maximum(best[active, 0] - CLOSE, -2.0)[:, None])
                pairs.append((active[q], part[r], sims[q, r]))

        def descend(node: tuple, active: np.ndarray) -> None:
            """Each query to its nearest leaf, for a first bound."""
            if not len(active):
                return
            if len(node) == 1:
                seen_leaf[active] = id(node)
                leaf(node[0], active)
                return
            away = np.sqrt(np.maximum(0, 2 - 2 * (queries[active] @ node[0])))
            near = away <= (node[1][2] + node[2][1]) / 2
            descend(node[1][0], active[near])
            descend(node[2][0], active[~near])

        def visit(node: tuple, active: np.ndarray) -> None:
            if len(node) == 1:
                active = active[seen_leaf[active] != id(node)]
                if len(active):
                    leaf(node[0], active)
                return
            away = np.sqrt(np.maximum(0, 2 - 2 * (queries[active] @ node[0])))
            for child, low, high in node[1:]:
                least = np.maximum(away - high, low - away)
                reach = np.sqrt(np.maximum(0, 2 - 2 * np.maximum(best[active, 0], -1)))
                inside = least <= factor * reach + SLACK
                if inside.any():
                    visit(child, active[inside])

        everyone = np.arange(len(queries))
        descend(self.root, everyone)
        visit(self.root, everyone)
        q, r, sims = (np.concatenate(c) for c in zip(*pairs, strict=True))
        stays = sims >= np.maximum(best[q, 0] - CLOSE, -2.0)
        return q[stays], r[stays]


def usable(vector: Column) -> Column:
    """Is it a vector with finite components, not all zero?"""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    df: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 5, factor: float = 1.0
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest rows of ``df`` found for each
    row of ``queries``, whose columns are named alike."""

    def taken(frame: DataFrame) -> DataFrame:
        v = F.col(vector).cast("array<double>")
        return frame.select(F.col(key).cast("bigint").alias("id"), v.alias("vector")).where(
            F.col("id").isNotNull() & usable(F.col("vector"))
        ).withColumn("dims", F.size("vector"))

    rows, asked = taken(df), taken(queries).dropDuplicates(["id", "vector"])
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def all_of(n: int) -> Column:
        return F.sequence(F.lit(0), F.lit(n - 1))

    # Numbered rows: ids may repeat, so the vector is part of what is hashed.
    left = rows.select(
        F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int").alias("shard"),
        F.explode(all_of(blocks)).alias("block"), "dims", "id", "vector", F.lit(False).alias("asks"),
    )
    right = asked.select(
        F.explode(all_of(shards)).alias("shard"),
        F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int").alias("block"),
        "dims", "id", "vector", F.lit(True).alias("asks"),
    )

    def search(task: pa.Table) -> pa.Table:
        asks, ids = task["asks"].to_numpy(), task["id"].to_numpy()
        flat = task["vector"].combine_chunks()
        points = flat.flatten().to_numpy().reshape(len(ids), -1)
        ask, have = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(ask) or not len(have):
            return pa.table({"query_id": ids[:0], "vec_id": ids[:0], "score": np.zeros(0)})
        largest = np.abs(points).max(axis=1, keepdims=True)
        unit = points / largest
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        tree = Tree(unit[have])
        q, r = tree.search(unit[ask], ids[ask], ids[have], k, factor)
        score = cosine(points[ask[q]], points[have[r]])
        order = np.lexsort((ids[have[r]], -score, q))
        q, r, score = q[order], r[order], score[order]
        first = np.searchsorted(q, q)
        top = np.arange(len(q)) - first < k
        return pa.table({"query_id": ids[ask[q[top]]], "vec_id": ids[have[r[top]]], "score": score[top]})

    found = (
        left.unionByName(right)
        .groupBy(F.struct("shard", "block", "dims"))
        .applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    )
    line = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
