"""Near-duplicate documents by bottom-k sketches of one hash function.

A document is the set of its distinct word shingles, held as 64-bit hashes. Its sketch is the ``k``
smallest of them. Documents are linked if 100 * intersection >= 80 * union, and the connected
components of the links are the groups of near copies.

1. Equal sets are one class; everything after works on classes.
2. Inverted lists of retained values. Two sets this similar share about 0.8 k retained values, so at
   least ``k / 2`` (the chance of fewer is below 1e-7 for k = 64). Each class therefore needs listing
   under its rarest k - k/2 + 1 values only, by the rule of prefix filtering, and not at all if fewer
   than k/2 of its values occur elsewhere. A value that very many documents hold is thus passed over
   without losing a link.
3. Every class joins the group of the most central class in its lists, the one with most values that
   occur elsewhere: of a text and its edited copies that is the text itself. Within a group, the exact
   distance of each class to its hub comes first. Jaccard distance is a metric, so only classes whose
   hub distances differ by at most the linking distance are compared further, block against block.
   A task holds two bounded blocks, counts all intersections at once, and emits one row a class.
4. Classes of different groups that share a list are the few pairs left: the sketch of their union
   estimates their similarity, and those near the threshold are compared on full sets.
5. Components come from alternating large-star and small-star steps over the link table.

Links are always confirmed on full sets. No candidate, list or block is capped or dropped.

Edge cases: null or empty texts and texts without words have the empty set and are linked with
nothing; a text with fewer words than a shingle is one shingle; a repeated row is an exact copy; rows
with a null id take part, but name no component while another row of it has an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm import common

SHINGLE_WORDS = 5
SIMILARITY = 80
K = 64
#: First, classes are sought that share at least a quarter of their ``PROBE`` smallest values.
PROBE = 16
#: Shingles in a block of classes that are compared with another block.
BLOCK_SHINGLES = 1 << 14
#: Margin of the estimated similarity below the threshold, about six standard deviations.
MARGIN = 30
CACHE_WORDS = 100_000


class _WordHashes(dict):
    """64-bit hash of a word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _scrambled(h: np.ndarray) -> np.ndarray:
    """A one-to-one mix of all bits."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def shingle_set(text: str | None, words: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles. Bytes split at ASCII white space only."""
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return np.zeros(0, np.int64)
    each = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(each))
    count = len(each) - width + 1
    h = np.full(count, width, np.uint64)
    for j in range(width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + each[j : j + count]
    return np.unique(_scrambled(h).view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def sketches(df: DataFrame, key: str, text: str, words: int, k: int = K) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, ``set_key`` (of the whole set) and ``sketch`` of every row."""

    @F.arrow_udf("n_shingles int, set_key binary, sketch array<bigint>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _WordHashes()
        for texts in batches:
            sets = [shingle_set(t, words, hashes) for t in texts.to_pylist()]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    _lists([s[:k] for s in sets]),
                ],
                ["n_shingles", "set_key", "sketch"],
            )

    made = df.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_key"), sketch(F.col(text)).alias("s"))
    return made.select("doc_id", "text_key", "s.n_shingles", "s.set_key", "s.sketch")


def _listed(classes: DataFrame, values: Column, least: Column) -> DataFrame:
    """``class_id``, ``size`` of its list and ``found``: its values that occur elsewhere, rarest first.

    Only classes with at least ``least`` of them.
    """
    postings = classes.select("class_id", F.size(values).alias("size"), F.explode(values).alias("value"))
    shared = postings.groupBy("value").agg(F.count(F.lit(1)).alias("on")).where("on > 1")
    return (
        postings.join(shared, "value")
        .groupBy("class_id", "size")
        .agg(F.array_sort(F.collect_list(F.struct("on", "value"))).alias("found"))
        .where(F.size("found") >= least)
    )


def _likely(classes: DataFrame) -> DataFrame:
    """Classes that can have a link at all: enough of their smallest values occur elsewhere."""
    probed = _listed(classes, F.slice("sketch", 1, PROBE), F.ceil(F.col("size") / 4))
    return classes.join(probed.select("class_id"), "class_id")


def _prefixes(likely: DataFrame) -> DataFrame:
    """Inverted lists: ``value``, ``class_id``, ``n_shingles``, ``central`` (values found elsewhere)."""
    half = F.ceil(F.col("size") / 2).cast("int")
    # Values found nowhere else are rarer still and take the first places.
    places = F.size("found") - half + 1
    listed = _listed(likely, F.col("sketch"), half).select(
        "class_id", F.size("found").alias("central"), F.slice("found", F.lit(1), places).alias("rare")
    )
    return (
        listed.join(likely.select("class_id", "n_shingles"), "class_id")
        .select("class_id", "n_shingles", "central", F.explode("rare.value").alias("value"))
    )


def _grouped(postings: DataFrame) -> DataFrame:
    """``postings`` with the ``hub`` of each class: the most central class in any of its lists."""
    rank = F.struct("central", (-F.col("class_id")).alias("first"))
    best = postings.groupBy("value").agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("on"))
    meets = postings.join(best.where("on > 1"), "value")
    hubs = meets.groupBy("class_id").agg((-F.max("best").getField("first")).alias("hub"))
    return meets.drop("best", "on").join(hubs, "class_id")


def _counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of membership matrices."""
    values_a, values_b = np.concatenate(a), np.concatenate(b)
    common_values = np.intersect1d(values_a, values_b)
    total = np.zeros((len(a), len(b)), np.float32)
    owner_a = np.repeat(np.arange(len(a)), [len(s) for s in a])
    owner_b = np.repeat(np.arange(len(b)), [len(s) for s in b])
    for low in range(0, len(common_values), 4096):
        part = common_values[low : low + 4096]
        sides = []
        for values, owner, rows in ((values_a, owner_a, len(a)), (values_b, owner_b, len(b))):
            inside = (values >= part[0]) & (values <= part[-1])
            at = np.searchsorted(part, values[inside])
            hit = part[at] == values[inside]
            matrix = np.zeros((rows, len(part)), np.float32)
            matrix[owner[inside][hit], at[hit]] = 1
            sides.append(matrix)
        total += sides[0] @ sides[1].T
    return np.rint(total).astype(np.int64)


def _linked(a: list[np.ndarray], b: list[np.ndarray], similarity: int) -> np.ndarray:
    both = _counts(a, b)
    sizes = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :]
    return 100 * both >= similarity * (sizes - both)


def _roots(ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest id of each row's component, from the links between rows."""
    root = ids.copy()
    while len(left):
        least = np.minimum(root[left], root[right])
        after = root.copy()
        np.minimum.at(after, left, least)
        np.minimum.at(after, right, least)
        if np.array_equal(after, root):
            break
        root = after
    return root


def _sets(rows: pa.ChunkedArray) -> list[np.ndarray]:
    return [r.values.to_numpy() for chunk in rows.chunks for r in chunk]


def _full_sets(df: DataFrame, key: str, text: str, words: int, wanted: DataFrame) -> DataFrame:
    """The wanted classes with their ``shingles``, made from their documents again.

    A class meets the rows of its id and text only: rows without id or of one id are not all met by each.
    """

    @F.arrow_udf("set_key binary, shingles array<bigint>")
    def full(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _WordHashes()
        for texts in batches:
            sets = [shingle_set(t, words, hashes) for t in texts.to_pylist()]
            keys = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            yield pa.StructArray.from_arrays([keys, _lists(sets)], ["set_key", "shingles"])

    # Else the filter below would carry it beneath the join, to every document.
    full = full.asNondeterministic()

    def named(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("none"))

    texts = df.select(named(F.col(key)).alias("name"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    met = wanted.withColumn("name", named(F.col("rep"))).join(texts, ["name", "text_key"]).withColumn("f", full("text"))
    # Another text of the same hash goes; equal rows are one.
    return (
        met.where(F.col("set_key") == F.col("f.set_key"))
        .withColumn("shingles", F.col("f.shingles"))
        .drop("f", "text", "rep", "set_key", "text_key")
        .dropDuplicates(["name", "class_id"])
        .drop("name")
    )


def _hub_distances(members: DataFrame, similarity: int) -> DataFrame:
    """``members`` with ``cell``: by how many linking distances a class lies off its hub; 0 is linked.

    A hub is sent to every block of its group, so a large group is many tasks.
    """
    # A hub may itself be at home in the group of a more central class.
    groups = members.where("class_id != hub").select(F.col("hub").alias("h"), "blocks").distinct()
    hub_of = groups.join(
        members.select(F.col("class_id").alias("h"), F.col("shingles").alias("hub_set")), "h"
    )
    copies = hub_of.select(
        F.col("h").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("h").alias("class_id"), F.col("hub_set").alias("shingles"), F.lit(True).alias("is_hub"),
    )
    others = members.where("class_id != hub").select(
        "hub", "block", "class_id", "shingles", F.lit(False).alias("is_hub")
    )

    def measure(group: pa.Table) -> pa.Table:
        is_hub = group["is_hub"].to_numpy()
        sets, ids = _sets(group["shingles"]), group["class_id"].to_numpy()
        hub = sets[int(np.flatnonzero(is_hub)[0])]
        rest = np.flatnonzero(~is_hub)
        cells = np.zeros(len(rest), np.int32)
        for n, at in enumerate(rest):
            both = len(np.intersect1d(hub, sets[at], assume_unique=True))
            union = len(hub) + len(sets[at]) - both
            # Distance in units of the linking distance, rounded up: (0, 1] is 0, (1, 2] is 1, ...
            cells[n] = max(0, -(-100 * (union - both) // ((100 - similarity) * union)) - 1)
        return pa.table({"class_id": ids[rest], "cell": pa.array(cells)})

    # One struct as key: rows dealt by hub alone would put a whole group in one task.
    measured = (
        copies.unionByName(others)
        .groupBy(F.struct("hub", "block"))
        .applyInArrow(measure, "class_id bigint, cell int")
    )
    return members.join(measured, "class_id", "left").withColumn(
        "cell", F.when(F.col("class_id") == F.col("hub"), F.lit(0)).otherwise(F.col("cell"))
    )


def _compared(celled: DataFrame, similarity: int) -> DataFrame:
    """Links within groups: (``a``, ``b``) with b the smallest class of a's component in a task.

    Cell 0 is linked with the hub already and is not compared with itself. By the triangle
    inequality classes two cells apart or more are no links, so a block meets its own cell, from cell 1
    on, and the next one.
    """
    sized = celled.groupBy("hub", "cell").agg(F.sum("n_shingles").alias("shingles"))
    blocks = sized.select(
        "hub", "cell", F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int").alias("n")
    )
    upper = blocks.select("hub", (F.col("cell") - 1).alias("cell"), F.col("n").alias("above"))
    lower = blocks.select("hub", (F.col("cell") + 1).alias("cell"), F.col("n").alias("below"))
    placed = (
        celled.join(blocks, ["hub", "cell"])
        .join(upper, ["hub", "cell"], "left")
        .join(lower, ["hub", "cell"], "left")
        .withColumn("mine", F.pmod(F.xxhash64("class_id"), F.col("n")).cast("int"))
    )

    def numbers(count: Column) -> Column:
        return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

    def task(low_cell: Column, low: Column, high_cell: Column, high: Column, side: int) -> Column:
        return F.struct(
            low_cell.alias("lc"), low.alias("lb"), high_cell.alias("hc"), high.alias("hb"),
            F.lit(side).alias("side"),
        )

    cell, mine = F.col("cell"), F.col("mine")
    own = F.transform(
        numbers(F.when(cell > 0, F.col("n")).otherwise(0)),
        lambda o: task(cell, F.least(mine, o), cell, F.greatest(mine, o), 2),
    )
    up = F.transform(numbers(F.coalesce("above", F.lit(0))), lambda o: task(cell, mine, cell + 1, o, 0))
    down = F.transform(numbers(F.coalesce("below", F.lit(0))), lambda o: task(cell - 1, o, cell, mine, 1))
    spread = placed.select(
        "hub", "class_id", "shingles", "mine", F.explode(F.concat(own, up, down)).alias("t")
    ).select("hub", "t.lc", "t.lb", "t.hc", "t.hb", "t.side", "class_id", "mine", "shingles")

    def compare(group: pa.Table) -> pa.Table:
        side, sets = group["side"].to_numpy(), _sets(group["shingles"])
        ids, mine = group["class_id"].to_numpy(), group["mine"].to_numpy()
        if side[0] == 2:
            low_block = group["lb"][0].as_py()
            left = np.flatnonzero(mine == low_block)
            right = np.flatnonzero(mine == group["hb"][0].as_py())
        else:
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(left) or not len(right):
            return pa.table({"a": ids[:0], "b": ids[:0]})
        hit = _linked([sets[n] for n in left], [sets[n] for n in right], similarity)
        x, y = np.nonzero(hit)
        root = _roots(ids, left[x], right[y])
        moved = root != ids
        return pa.table({"a": ids[moved], "b": root[moved]})

    task_key = F.struct("hub", "lc", "lb", "hc", "hb")
    return spread.groupBy(task_key).applyInArrow(compare, "a bigint, b bigint")


def _estimated(crossing: DataFrame, classes: DataFrame, similarity: int, k: int) -> DataFrame:
    """Pairs of different groups whose union sketch comes near the threshold.

    The k smallest values of both sketches are the sketch of the union; those in both, of them, are its
    part of the intersection.
    """
    a = classes.select(F.col("class_id").alias("a"), F.col("sketch").alias("sketch_a"))
    b = classes.select(F.col("class_id").alias("b"), F.col("sketch").alias("sketch_b"))
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, k)
    both = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    return (
        crossing.join(a, "a").join(b, "b")
        .where(100 * both >= (similarity - MARGIN) * F.size(union))
        .select("a", "b")
    )


def _crossing(grouped: DataFrame, similarity: int) -> DataFrame:
    """Distinct pairs of classes of different groups that share a list, their sizes permitting."""
    several = (
        grouped.groupBy("value").agg(F.min("hub").alias("low"), F.max("hub").alias("high"))
        .where(F.col("low") != F.col("high")).select("value")
    )
    mixed = grouped.join(several, "value").select("value", "class_id", "hub", "n_shingles")
    x, y = mixed.alias("x"), mixed.alias("y")
    fits = 100 * F.least("x.n_shingles", "y.n_shingles") >= similarity * F.greatest(
        "x.n_shingles", "y.n_shingles"
    )
    return (
        x.join(y, (F.col("x.value") == F.col("y.value")) & (F.col("x.hub") < F.col("y.hub")) & fits)
        .select(F.col("x.class_id").alias("a"), F.col("y.class_id").alias("b"))
        .distinct()
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Pairs whose full sets are linked."""
    a = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("set_a"), F.col("n_shingles").alias("n_a"))
    b = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("set_b"), F.col("n_shingles").alias("n_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (
        pairs.join(a, "a").join(b, "b")
        .where(100 * both >= similarity * (F.col("n_a") + F.col("n_b") - both))
        .select("a", "b")
    )


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of the links (a, b).

    Alternates large-star (neighbours above a node point to the smallest neighbour) and small-star
    (neighbours below do), until the links stay as they are: then each is (node, component). A node's
    smallest neighbour is aggregated before the shuffle and joined back, so a node with very many
    neighbours is split.
    """
    edges = common.stage(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    mark, count = None, edges.count()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(below, "u")
        small = (
            joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(below.select("u", F.col("m").alias("v"))).distinct()
        )
        # A step makes no link more than two for each there was.
        edges = common.stage(small, "links", 2 * count)
        now = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        if now == mark:
            break
        mark, count = now, now[0]
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(edges.select(F.col("v"), F.col("v"))).distinct()


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = SHINGLE_WORDS,
    similarity: int = SIMILARITY,
    k: int = K,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of every row."""
    rows = common.stage(sketches(df, key, text, words, k), "minhash-rows")
    # The row that stands for a class: the smallest id there is, and one text of it.
    stands = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key"))
    classes = common.stage(
        rows.where("n_shingles > 0")
        .groupBy("set_key")
        .agg(stands.alias("one"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
        .select("set_key", F.col("one.doc_id").alias("rep"), "one.text_key", "n_shingles", "sketch")
        .withColumn("class_id", F.monotonically_increasing_id()),
        "minhash-classes",
        rows.count(),
    )
    n_classes = classes.count()
    likely = common.stage(
        _likely(classes.where("n_shingles > 1").select("class_id", "n_shingles", "sketch")),
        "minhash-likely",
        n_classes,
    )
    grouped = common.stage(_grouped(_prefixes(likely)), "minhash-groups")
    near = common.stage(
        _estimated(_crossing(grouped, similarity), likely, similarity, k), "minhash-crossing"
    )
    homes = grouped.select("class_id", "hub", "n_shingles").distinct()
    sizes = homes.groupBy("hub").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("blocks")
    )
    wanted = (
        homes.join(sizes, "hub")
        .withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
        .join(classes.select("class_id", "rep", "text_key", "set_key"), "class_id")
    )
    sets = common.stage(_full_sets(df, key, text, words, wanted), "minhash-sets")
    celled = common.stage(
        _hub_distances(sets, similarity)
        .select("class_id", "hub", "n_shingles", "shingles", "cell"),
        "minhash-cells",
    )
    links = (
        celled.where("cell = 0 AND class_id != hub").select(F.col("class_id").alias("a"), F.col("hub").alias("b"))
        .union(_compared(celled, similarity))
        .union(_confirmed(near, sets, similarity))
    )
    found = components(links)
    joined = classes.join(found, classes["class_id"] == found["node"], "left").select(
        "set_key", "rep", F.coalesce("component", "class_id").alias("component")
    )
    smallest = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = common.stage(
        joined.join(smallest, "component").select("set_key", "component_id"), "minhash-named", n_classes
    )
    own = rows.select("doc_id", "n_shingles", "set_key")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        own.join(named, "set_key", "left")
        .select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
