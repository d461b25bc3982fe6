"""Document fingerprints: SimHash over weighted terms, and a search within a Hamming radius.

A term is a pair of neighbouring words (a text of one word is that word); its weight is the square root
of its number in the text. Each term's 128-bit hash votes with its weight on every bit, and the sign of
the sum is the bit. Words are split at ASCII white space and compared by bytes.

``within`` finds all pairs within a Hamming radius by permuted block tables: the bits are cut into
radius + 1 blocks, one of which must agree in a pair, so each table permutes another block to the front
and joins on it. A pair is reported by the first table that holds it. Very full buckets are cut by the
exact distance to a pivot: by the triangle inequality only rows whose distances to it differ by at most
the radius are compared.

``near_classes`` finds with the same tables which fingerprints are connected by steps within the radius,
without a list of pairs: a task reports each fingerprint with one other of its class. Buckets of up to
``CELL`` rows are compared whole. In a fuller one every row within the radius of the first pivot is linked
with that pivot, and the others meet only rows whose distances to two pivots fit, block against block.

Edge cases: a null text counts as empty; an empty text's fingerprint is all zeros, and two of them are
alike; equal texts have equal fingerprints; a fingerprint that is null takes no part in the search; rows
without id belong to the class of their text, whose id is the smallest there is, or null if there is none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm import common
from pricewright.llm.minhash import components

BITS = 128
CACHE_WORDS = 100_000
#: Neighbouring ids form slices; their number follows that of the rows within these bounds.
ROWS_A_SLICE = 5000
LEAST_SLICES = 512
MOST_SLICES = 10_000
#: Bits that near fingerprints may differ in.
RADIUS = 3
#: Rows that are compared with each other in one place; fuller buckets are cut.
CELL = 2048


class _WordHashes(dict):
    """Two 64-bit hashes of a word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _spread(h: np.ndarray, salt: int) -> np.ndarray:
    h = h ^ np.uint64(salt)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def fingerprint(text: str | None, hashes: dict[bytes, int]) -> bytes:
    words = (text or "").encode("utf-8").split()
    if not words:
        return bytes(BITS // 8)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(each) > 1:
        each = each[:-1] * np.uint64(0x9E3779B97F4A7C15) + each[1:]
    terms, times = np.unique(each, return_counts=True)
    weights = np.sqrt(times).astype(np.float32)
    votes = np.zeros(BITS, np.float32)
    for low in range(0, len(terms), 8192):
        part = terms[low : low + 8192]
        both = np.stack([_spread(part, 1), _spread(part, 2)], axis=1)
        bits = np.unpackbits(both.view(np.uint8).reshape(len(part), -1), axis=1)
        votes += weights[low : low + 8192] @ bits
    return np.packbits(votes * 2 > weights.sum(dtype=np.float32)).tobytes()


def fingerprints(text: Column) -> Column:
    """Fingerprint of every whole text, as lowercase hex."""

    @F.arrow_udf("string")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _WordHashes()
        for texts in batches:
            yield pa.array([fingerprint(t, hashes).hex() for t in texts.to_pylist()], pa.string())

    return made(text)


def distance(a: Column, b: Column) -> Column:
    """Number of different bits of two hex fingerprints."""
    total = F.lit(0)
    for low in range(1, BITS // 4 + 1, 8):
        x, y = (F.conv(F.substring(c, low, 8), 16, 10).cast("bigint") for c in (a, b))
        total = total + F.bit_count(x.bitwiseXOR(y))
    return total


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - distance(a, b) / BITS


def within(df: DataFrame, key: str, fp: str, radius: int) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints at most ``radius`` bits apart, with ``distance``, and
    the first id of each: equal fingerprints are one, so that copies make no pairs.

    A table for each of radius + 1 blocks of bits; a block is the key of its table's join.
    """
    each = common.stage(
        df.where(F.col(fp).isNotNull()).groupBy(F.col(fp).alias("fp"))
        .agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("copies")),
        "simhash-distinct",
    )
    digits = BITS // 4
    if not 0 <= radius < digits:
        raise ValueError(f"the radius must be from 0 to {digits - 1}")
    ends = [digits * n // (radius + 1) for n in range(radius + 2)]
    cut = F.array(
        *[F.struct(F.lit(n).alias("t"), F.substring("fp", ends[n] + 1, ends[n + 1] - ends[n]).alias("block")) for n in range(radius + 1)]
    )
    tables = each.select("fp", "first", F.explode(cut).alias("k")).select("fp", "first", "k.t", "k.block")
    # A pivot a bucket; the distance to it, in steps of the radius, is part of the key.
    pivots = tables.groupBy("t", "block").agg(F.min("fp").alias("pivot"), F.count(F.lit(1)).alias("n"))
    off = F.floor(distance(F.col("fp"), F.col("pivot")) / max(1, radius + 1)).cast("int")
    placed = tables.join(pivots.where("n > 1"), ["t", "block"]).select("t", "block", "fp", "first", off.alias("ring"))
    right = placed.withColumn("ring", F.explode(F.array(F.col("ring") - 1, F.col("ring"), F.col("ring") + 1)))
    x, y = placed.alias("x"), right.alias("y")
    met = x.join(
        y,
        (F.col("x.t") == F.col("y.t")) & (F.col("x.block") == F.col("y.block"))
        & (F.col("x.ring") == F.col("y.ring")) & (F.col("x.fp") < F.col("y.fp")),
    )
    earlier = F.lit(False)
    for n in range(radius):
        same = F.substring("x.fp", ends[n] + 1, ends[n + 1] - ends[n]) == F.substring(
            "y.fp", ends[n] + 1, ends[n + 1] - ends[n]
        )
        earlier = earlier | ((F.col("x.t") > n) & same)
    apart = distance(F.col("x.fp"), F.col("y.fp"))
    return met.where((apart <= radius) & ~earlier).select(
        F.col("x.fp").alias("a"), F.col("y.fp").alias("b"), apart.alias("distance"),
        F.col("x.first").alias("first_a"), F.col("y.first").alias("first_b"),
    )


def _half(fp: Column, low: int) -> Column:
    """16 hex digits as a number of 64 bits."""
    return F.conv(F.substring(fp, low, 16), 16, -10).cast("bigint")


def _apart(high: str, low: str) -> Column:
    """Distance of the row's two halves to two others."""
    return F.bit_count(F.col("high").bitwiseXOR(F.col(high))) + F.bit_count(F.col("low").bitwiseXOR(F.col(low)))


def _joined(high: np.ndarray, low: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row of its class, by steps of at most ``radius`` bits."""
    first = np.full(len(high), -1)
    left = np.arange(len(high))
    while len(left):
        seed, left = left[0], left[1:]
        first[seed] = seed
        reached = [seed]
        while reached and len(left):
            n = reached.pop()
            apart = np.bitwise_count(high[left] ^ high[n]) + np.bitwise_count(low[left] ^ low[n])
            found = left[apart <= radius]
            if len(found):
                first[found] = seed
                reached.extend(found)
                left = left[apart > radius]
    return first


def _linked(pieces: DataFrame, radius: int) -> DataFrame:
    """``a``, ``b``: each row of a piece with the first row of its class in the piece. A piece is small."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: np.ndarray) -> pa.RecordBatch:
            made: list[tuple[str, str]] = []
            starts = [0, *(np.flatnonzero(np.diff(rows[0])) + 1), rows.shape[1]]
            for start, end in zip(starts[:-1], starts[1:], strict=True):
                high, low = rows[1:, start:end].view(np.uint64)
                first = _joined(high, low, radius)
                for n in np.flatnonzero(first != np.arange(len(first))):
                    m = first[n]
                    made.append((f"{high[n]:016x}{low[n]:016x}", f"{high[m]:016x}{low[m]:016x}"))
            return pa.RecordBatch.from_arrays(
                [pa.array([link[n] for link in made], pa.string()) for n in (0, 1)], ["a", "b"]
            )

        held = np.empty((3, 0), np.int64)
        for batch in batches:
            rows = np.concatenate([held, np.stack([batch.column(n).to_numpy() for n in range(3)])], axis=1)
            whole = int(np.searchsorted(rows[0], rows[0, -1])) if rows.shape[1] else 0
            held = rows[:, whole:]
            if whole:
                yield links(np.ascontiguousarray(rows[:, :whole]))
        if held.shape[1]:
            yield links(np.ascontiguousarray(held))

    dealt = pieces.select("piece", "high", "low").repartition("piece").sortWithinPartitions("piece")
    return dealt.mapInArrow(found, "a string, b string")


def near_classes(df: DataFrame, key: str, fp: str, radius: int = RADIUS) -> DataFrame:
    """``fp`` and ``near_id``, the smallest ``key`` of all rows that steps of at most ``radius`` bits reach."""
    digits = BITS // 4
    if not 0 <= radius < digits:
        raise ValueError(f"the radius must be from 0 to {digits - 1}")
    each = common.stage(
        df.where(F.col(fp).isNotNull()).groupBy(F.col(fp).alias("fp")).agg(F.min(key).alias("first")),
        "simhash-each",
    )
    ends = [digits * n // (radius + 1) for n in range(radius + 2)]
    blocks = [F.xxhash64(F.lit(n), F.substring("fp", ends[n] + 1, ends[n + 1] - ends[n])) for n in range(radius + 1)]
    tables = each.select(_half(F.col("fp"), 1).alias("high"), _half(F.col("fp"), 17).alias("low"), F.explode(F.array(*blocks)).alias("bucket"))
    row = F.struct("high", "low")
    buckets = tables.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("p"), F.max(row).alias("q")).where("n > 1")
    placed = tables.join(buckets, "bucket")
    small = placed.where(f"n <= {CELL}").select(F.col("bucket").alias("piece"), "high", "low")

    full = placed.where(f"n > {CELL}").withColumn("to_p", _apart("p.high", "p.low"))
    pivot = F.col("to_p") <= radius
    text = [F.lpad(F.lower(F.hex(c)), 16, "0") for c in ("high", "low", "p.high", "p.low")]
    stars = full.where(pivot).select(F.concat(*text[:2]).alias("a"), F.concat(*text[2:]).alias("b"))
    step = radius + 1
    ringed = full.select(
        "bucket", "high", "low", pivot.alias("at_p"),
        F.floor(F.col("to_p") / step).cast("int").alias("r"), F.floor(_apart("q.high", "q.low") / step).cast("int").alias("s"),
    )
    # One side stays in its cell and the other is also sent to the cells around it.
    cell = ["bucket", "r", "s"]
    own = ringed.where("NOT at_p").select(*cell, "high", "low")
    near = [F.array(*[F.col(c) + n for n in (-1, 0, 1)]) for c in ("r", "s")]
    sent = (
        ringed.withColumn("r", F.explode(near[0])).withColumn("s", F.explode(near[1])).select(*cell, "high", "low")
    )

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias(name))

    cells = counted(own, "owns").join(counted(sent, "sends"), cell)

    def dealt(rows: DataFrame, mine: str, theirs: str) -> DataFrame:
        slot = F.pmod(F.xxhash64("high", "low"), F.col(mine)).cast("int").alias(mine)
        all_theirs = F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)).alias(theirs)
        out = rows.join(cells, cell).select(*cell, "high", "low", slot, all_theirs)
        return out.select(F.xxhash64(F.lit("cell"), *cell, "owns", "sends").alias("piece"), "high", "low")

    pieces = small.union(dealt(own, "owns", "sends")).union(dealt(sent, "sends", "owns"))
    links = _linked(pieces, radius).union(stars)
    met = components(links).select(F.col("node").alias("fp"), "component")
    named = each.join(met, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("class"))
    least = named.groupBy("class").agg(F.min("first").alias("near_id"))
    return named.join(least, "class").select("fp", "near_id")


def with_near_classes(df: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``compare_next``'s rows with ``near_id``, the class of their fingerprints. Other columns stay."""
    made = common.stage(df, "simhash-rows")
    classes = near_classes(made, "doc_id", "fingerprint", radius).withColumnRenamed("fp", "fingerprint")
    return made.join(classes, "fingerprint", "left").select(*made.columns, "near_id")


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id``, ``text`` and ``next_text``, the text of the next id in ascending order; the last id's
    is the first's. One shuffle of the texts.

    Approximate quantiles, which are ids that occur, cut the ids into slices. A slice's first rows are
    also sent to the slice before it, so each slice holds the successor of its last row. Null ids come
    first; rows of one id are in the order of their texts.
    """
    rows = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.count(F.lit(1)), F.count("doc_id"), F.min("doc_id")).first()
    nulls = size[0] > size[1]
    slices = min(max(LEAST_SLICES, size[0] // ROWS_A_SLICE), MOST_SLICES)
    shares = [n / slices for n in range(1, slices)]
    found = rows.select(F.percentile_approx("doc_id", shares, 10 * slices)).first()[0] if size[1] else []
    cuts = sorted({size[2], *found}) if size[1] else []
    # Slice 0 is that of null ids; slice n has the ids from the n-th cut on. Cuts are sought in two
    # steps, among the first of each group and then within the group.
    width = max(1, math.isqrt(len(cuts)))
    groups = [cuts[n : n + width] for n in range(0, len(cuts), width)] or [[]]
    heads = F.lit([g[0] for g in groups if g]).cast("array<bigint>")
    inner = F.array(*[F.lit(g).cast("array<bigint>") for g in groups])
    group = F.size(F.filter(heads, lambda c: c <= F.col("doc_id")))
    theirs = F.coalesce(F.get(inner, group - 1), F.array().cast("array<bigint>"))
    place = (group - 1) * width + F.size(F.filter(theirs, lambda c: c <= F.col("doc_id")))
    own = F.when(F.col("doc_id").isNull(), 0).otherwise(place)
    first, last = (0 if nulls or not cuts else 1), len(cuts)
    before = F.when(own == first, F.lit(last)).otherwise(own - 1)
    starting = F.col("doc_id").isNull() | F.array_contains(theirs, F.col("doc_id"))
    copies = F.array(F.struct(own.alias("slice"), F.lit(False).alias("ahead")))
    ahead = F.array(F.struct(before.alias("slice"), F.lit(True).alias("ahead")))
    sent = rows.withColumn("to", F.explode(F.when(starting, F.concat(copies, ahead)).otherwise(copies)))
    dealt = sent.select("doc_id", "text", "to.slice", "to.ahead").repartitionByRange(
        min(slices, _shuffle_partitions(df)), "slice"
    ).sortWithinPartitions("slice", "ahead", F.col("doc_id").asc_nulls_first(), "text")
    schema = dealt.select("doc_id", "text", F.col("text").alias("next_text")).schema

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the slice, id and text of the last row, whose successor is still to come
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(n).to_pylist() for n in range(4)]
            for doc_id, text_, slice_, is_ahead in zip(*columns, strict=True):
                if held and held[0] == slice_:
                    out.append((held[1], held[2], text_))
                held = None if is_ahead else (slice_, doc_id, text_)
            if out:
                names = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f) for c, f in zip(names, (batch.schema.field(0).type, pa.string(), pa.string()), strict=True)],
                    ["doc_id", "text", "next_text"],
                )

    return dealt.mapInArrow(follow, schema)


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the start of the following text."""
    part = len(text) // 4
    return text[: len(text) - part] + following[:part]


def compare_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form and their likeness, and that to the next text."""
    pairs = with_next(df, key, text)

    @F.arrow_udf("n_chars bigint, sha string, own string, edited string, following string")
    def made(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hashes = _WordHashes()
        seen: tuple[str, str] = ("", fingerprint("", hashes).hex())
        for texts, nexts in batches:
            rows = []
            for a, b in zip(texts.to_pylist(), nexts.to_pylist(), strict=True):
                e = edited(a, b)
                # In ascending order a text's successor is the next row's text.
                own = seen[1] if seen[0] == a else fingerprint(a, hashes).hex()
                following = fingerprint(b, hashes).hex()
                seen = (b, following)
                sha = hashlib.sha256(e.encode("utf-8")).hexdigest()
                rows.append((len(a), sha, own, fingerprint(e, hashes).hex(), following))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            types = (pa.int64(), *[pa.string()] * 4)
            yield pa.StructArray.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                ["n_chars", "sha", "own", "edited", "following"],
            )

    f = pairs.select("doc_id", made("text", "next_text").alias("f"))
    return f.select(
        "doc_id",
        "f.n_chars",
        F.col("f.sha").alias("edited_sha256"),
        F.col("f.own").alias("fingerprint"),
        F.col("f.edited").alias("edited_fingerprint"),
        likeness(F.col("f.own"), F.col("f.edited")).alias("near_edited"),
        likeness(F.col("f.own"), F.col("f.following")).alias("near_next"),
    )
