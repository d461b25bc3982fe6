"""Hard negatives: rows of another label that score almost as high with an anchor as its positives.

Components are rounded down to integers, so scores, inner products, are exact.

1. Rows are dealt evenly to shards of about ``SHARD_ROWS``, whatever their label, id or vector. A shard's
   different vectors get one more coordinate that makes them equally long, so they lie on a sphere where
   inner products with a query are cosines. Over them a cover tree is grown: each level's centres cover
   their members within a radius that shrinks by ``BASE`` from level to level, and a node keeps the
   radius it really needs. A node that would fall apart into little more than single rows stays whole.
   Trees are written once, as rows.
2. Anchors meet every shard, in blocks. A search descends best first: from the angle to a node's centre
   and the angle of its radius follow the highest and the lowest score in it. Nodes outside every open
   window are skipped, leaves are verified by their exact products, and a window that has its ``k``
   rows goes up to the last of them. When the best node left is below all windows the search ends.
3. The first search finds each anchor's positives, with one open window; the second takes a window from
   each positive. The best of all shards are the best of all rows.

Work is anchors times shards, as every fixed share of the rows that asks makes it. Memory of a task: one
shard and ``ANCHOR_BLOCK`` anchors.

Edge cases: rows with a null id, label or vector, or with a null or infinite component or NaN take no
part; vectors of different lengths do not meet; repeated rows are one row, also where they are anchors;
rows of one id with different vectors are different rows, but not each other's positives, and of those
that score alike with an anchor one counts; a zero or empty vector scores 0; a negative positive score
leaves no window; scores beyond 2 to the 53rd are the nearest doubles, and end at the largest long, as
components end at 1e150; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import heapq
from bisect import insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm.common import stage

SHARD_ROWS = 8192
ANCHOR_BLOCK = 4096
#: From one level of a tree to the next radii shrink by this factor.
BASE = 1.3
#: Rows of a node that is not divided further.
LEAF = 48
#: Components are multiplied by this and rounded down.
SCALE = 256
PERCENT = 80
#: The largest score, and the largest component: no sum of products overflows.
_MOST = float((1 << 63) - 1024)
_LARGEST = 1e150


class Tree:
    """A cover tree, in arrays. Node 0 is the root, the children of a node are next to each other, and
    the points below it are one run of ``points``."""

    def __init__(self, points: np.ndarray, nodes: np.ndarray, radius: np.ndarray) -> None:
        self.points = points
        self.centre, self.low, self.high, self.first, self.last = nodes.T
        size = (points * points).sum(axis=1)
        self.norm = float(np.sqrt(size.max())) if len(size) else 0.0
        # A chord of the sphere, as an angle.
        share = radius / self.norm if self.norm else radius
        self.cos = np.clip(1 - share * share / 2, -1, 1)
        self.sin = np.sqrt(1 - self.cos * self.cos)

    @staticmethod
    def grown(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Order of the points, nodes (centre, run of points, run of children) and radii of a new tree."""
        size = (points * points).sum(axis=1)
        longest = size.max()
        full = np.column_stack([points, np.sqrt(np.maximum(0, longest - size))])

        def apart(one: int, many: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(0, 2 * longest - 2 * (full[many] @ full[one])))

        order = np.arange(len(points))
        away = apart(0, order)
        nodes, radius, reaches = [[0, 0, len(points), 0, 0]], [float(away.max())], [float(away.max())]
        at = 0
        while at < len(nodes):
            centre, low, high, _, _ = nodes[at]
            members, reach = order[low:high], min(reaches[at], radius[at]) / BASE
            at += 1
            if high - low <= LEAF or radius[at - 1] == 0:
                continue
            away = own = apart(centre, members)
            left, groups = members, []
            while True:
                near = away <= reach
                # Rounding must not keep a centre from covering itself.
                near |= left == centre
                groups.append((centre, left[near], float(away[near].max())))
                left, own = left[~near], own[~near]
                if not len(left) or 4 * len(groups) > len(members):
                    break
                centre = int(left[np.argmax(own)])
                away = apart(centre, left)
            if len(left):
                continue
            nodes[at - 1][3:] = len(nodes), len(nodes) + len(groups)
            for one, inside, needed in groups:
                order[low : low + len(inside)] = inside
                nodes.append([one, low, low + len(inside), 0, 0])
                radius.append(needed)
                reaches.append(reach)
                low += len(inside)
        made = np.array(nodes, np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        made[:, 0] = place[made[:, 0]]
        return order, made, np.array(radius)

    def bounds(self, query: np.ndarray, length: float, nodes: slice) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest score that the points below each node can have."""
        most = length * self.norm
        slack = 1e-6 * most + 1e-6
        if most == 0:
            zero = np.zeros(nodes.stop - nodes.start)
            return zero - slack, zero + slack
        cos = np.clip(self.points[self.centre[nodes]] @ query / most, -1, 1)
        sin = np.sqrt(1 - cos * cos)
        near, far = cos * self.cos[nodes], sin * self.sin[nodes]
        high = np.where(cos >= self.cos[nodes], most, most * (near + far))
        low = np.where(-cos >= self.cos[nodes], -most, most * (near - far))
        return np.clip(low - slack, -_MOST, _MOST), np.clip(high + slack, -_MOST, _MOST)

    def search(
        self, query: np.ndarray, fits: np.ndarray, firsts: np.ndarray, ids: list, own: int,
        windows: list[tuple[float, float]], k: int,
    ) -> tuple[list[list[tuple[float, int]]], int]:
        """For each window the first ``k`` (negated score, id) of points that ``fits``, without the id
        ``own``; and how many points were verified."""
        found: list[list[tuple[float, int]]] = [[] for _ in windows]
        lows, ends = [w[0] for w in windows], [w[1] for w in windows]
        length = float(np.sqrt(query @ query))
        queue, verified = [(-np.inf, 0)], 0
        while queue:
            best, node = heapq.heappop(queue)
            if -best < min(lows):
                break
            if self.last[node]:
                children = slice(self.first[node], self.last[node])
                low, high = self.bounds(query, length, children)
                inside = np.zeros(len(low), bool)
                for a, b in zip(lows, ends, strict=True):
                    inside |= (high >= a) & (low <= b)
                for n in np.flatnonzero(inside):
                    heapq.heappush(queue, (-high[n], int(children.start + n)))
                continue
            run = slice(self.low[node], self.high[node])
            score = np.clip(self.points[run] @ query, -_MOST, _MOST)
            verified += len(score)
            for w, kept in enumerate(found):
                at = np.flatnonzero((score >= lows[w]) & (score <= ends[w]) & fits[run])
                for n in at[np.lexsort((firsts[run][at], -score[at]))]:
                    entry = -float(score[n])
                    if len(kept) >= k and (entry, int(firsts[run][n])) > kept[-1]:
                        break
                    for one in ids[self.low[node] + n][: k + 1]:
                        if one != own and (entry, one) not in kept:
                            insort(kept, (entry, one))
                    del kept[k:]
                if len(kept) >= k:
                    lows[w] = -kept[-1][0]
        return found, verified


def usable(vector: Column) -> Column:
    """Is it a vector of finite components?"""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def _matrix(vectors: pa.ChunkedArray, count: int) -> np.ndarray:
    return vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(count, -1)


def _integers(vectors: pa.ChunkedArray, count: int, scale: int) -> np.ndarray:
    """Components times ``scale``, rounded down; no negative zeros."""
    return np.floor(np.clip(scale * _matrix(vectors, count).astype(np.float64), -_LARGEST, _LARGEST)) + 0.0


_TREE = (
    "dims int, shard int, part int, centre int, low int, high int, first int, last int, radius double, "
    "label bigint, ids array<bigint>, vector array<double>"
)


def trees(rows: DataFrame, shards: int, scale: int = SCALE) -> DataFrame:
    """Cover trees of (``id``, ``label``, ``vector``, ``dims``): a row per node (``part`` is its number)
    and a row per different vector and label (``part`` is its place, ``radius`` null)."""

    def grow(task: pa.Table) -> pa.Table:
        ids, labels = task["id"].to_numpy(), task["label"].to_numpy()
        points = _integers(task["vector"], len(ids), scale)
        # Rows of one label and vector are one point, with the ids in their order.
        known: dict[bytes, list[int]] = {}
        for n, (label, point) in enumerate(zip(labels.tolist(), points, strict=True)):
            known.setdefault(label.to_bytes(8, "big", signed=True) + point.tobytes(), []).append(n)
        groups = list(known.values())
        heads = np.array([g[0] for g in groups])
        order, nodes, radius = Tree.grown(points[heads])
        size, count = len(order), len(nodes)
        listed = [sorted(set(ids[groups[n]].tolist())) for n in order]

        def column(of_nodes: list, of_points: list, kind: pa.DataType) -> pa.Array:
            return pa.array([*of_nodes, *of_points], kind)

        nothing, none = [None] * count, [None] * size
        small = pa.int32()
        return pa.table({
            "dims": column([points.shape[1]] * count, [points.shape[1]] * size, small),
            "shard": column([task["shard"][0].as_py()] * count, [task["shard"][0].as_py()] * size, small),
            "part": column(range(count), range(size), small),
            **{
                name: column(nodes[:, n].tolist(), none, small)
                for n, name in enumerate(("centre", "low", "high", "first", "last"))
            },
            "radius": column(radius.tolist(), none, pa.float64()),
            "label": column(nothing, labels[heads[order]].tolist(), pa.int64()),
            "ids": column(nothing, listed, pa.list_(pa.int64())),
            "vector": column(nothing, list(points[heads[order]]), pa.list_(pa.float64())),
        })

    # Dealt by a running number, so that no id, label or vector gathers in one place.
    dealt = rows.withColumn(
        "shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    )
    return dealt.groupBy(F.struct("dims", "shard")).applyInArrow(grow, _TREE)


def _searched(forest: DataFrame, asks: DataFrame, shards: int, blocks: int, same: bool, k: int, scale: int) -> DataFrame:
    """``ask``, ``id``, ``positive_id``, ``positive_score`` of each window, and the rows found in it, by shard."""
    schema = "ask bigint, id bigint, positive_id bigint, positive_score bigint, found_id bigint, score bigint"

    def search(tree: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        names = ("ask", "id", "positive_id", "positive_score", "found_id", "score")
        if tree.num_rows and asked.num_rows:
            tree = tree.sort_by("part")
            is_point = tree["radius"].is_null()
            held, nodes = tree.filter(is_point), tree.filter(pc.invert(is_point))
            shape = np.column_stack([nodes[c].to_numpy() for c in ("centre", "low", "high", "first", "last")])
            use = Tree(_matrix(held["vector"], held.num_rows), shape, nodes["radius"].to_numpy())
            labels, ids = held["label"].to_numpy(), held["ids"].to_pylist()
            firsts = np.array([i[0] for i in ids], np.int64)
            queries = _integers(asked["vector"], asked.num_rows, scale)
            listed = asked.select(["ask", "id", "label", "windows"]).to_pylist()
            for query, said in zip(queries, listed, strict=True):
                given = said["windows"]
                ranges = [(float(w["least"]), float(w["most"])) for w in given] if given else [(-np.inf, np.inf)]
                fits = (labels == said["label"]) if same else (labels != said["label"])
                found, _ = use.search(query, fits, firsts, ids, said["id"], ranges, k)
                for n, kept in enumerate(found):
                    key = (said["ask"], said["id"], *((given[n]["positive_id"], given[n]["most"]) if given else (None, None)))
                    out += [(*key, one, int(-entry)) for entry, one in kept]
        columns = zip(*out, strict=True) if out else [[]] * len(names)
        return pa.table({n: pa.array(list(c), pa.int64()) for n, c in zip(names, columns, strict=True)})

    def all_of(n: int) -> Column:
        return F.sequence(F.lit(0), F.lit(n - 1))

    spread = forest.withColumn("block", F.explode(all_of(blocks)))
    met = asks.withColumn("block", F.pmod(F.xxhash64("ask"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(all_of(shards))
    )
    key = ["dims", "shard", "block"]
    return spread.groupBy(*key).cogroup(met.groupBy(*key)).applyInArrow(search, schema).distinct()


def mine(
    df: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 5,
    percent: int = PERCENT,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Negatives score from ``percent`` of a positive's score up to all of it. ``is_anchor`` and ``label``
    (by default the column of that name) are expressions over ``df``.
    """
    given = df.select(
        F.col(key).cast("bigint").alias("id"),
        (F.col("label") if label is None else label).cast("bigint").alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    rows = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("dims", F.size("vector"))
    total = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = (max(1, -(-n // size)) for n, size in zip(total, (SHARD_ROWS, ANCHOR_BLOCK), strict=True))
    forest = stage(trees(rows.drop("asks"), shards, scale), "negatives-trees")
    anchors = stage(
        rows.where("asks").drop("asks").dropDuplicates(["id", "label", "vector"])
        .withColumn("ask", F.monotonically_increasing_id()),
        "negatives-anchors",
    )
    whole = "array<struct<least:bigint,most:bigint,positive_id:bigint>>"
    first = _searched(forest, anchors.withColumn("windows", F.lit(None).cast(whole)), shards, blocks, True, positives, scale)
    line = Window.partitionBy("ask").orderBy(F.col("score").desc(), "found_id")
    best = first.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= positives)
    score = F.col("score")
    # The share of a score, rounded up, without leaving the longs.
    least = F.expr(f"score div 100 * {percent} + (score % 100 * {percent} + 99) div 100")
    windows = (
        best.where(score >= 0)
        .select("ask", F.struct(least.alias("least"), score.alias("most"), F.col("found_id").alias("positive_id")).alias("window"))
        .groupBy("ask").agg(F.collect_list("window").alias("windows"))
    )
    second = _searched(forest, anchors.join(windows, "ask"), shards, blocks, False, negatives, scale)
    line = Window.partitionBy("ask", "positive_id", "positive_score").orderBy(F.col("score").desc(), "found_id")
    ranked = second.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= negatives)
    return ranked.select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
