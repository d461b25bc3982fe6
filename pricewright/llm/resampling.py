"""Importance resampling: draw documents so that their hashed word runs resemble a target's.

1. Features of a text are its words and its pairs of consecutive words, hashed to ``BUCKETS`` buckets.
   Every task counts buckets in one array and sends at most that many rows, so the counts of both
   sides are ``BUCKETS`` numbers whatever the corpus holds.
2. The gain of a bucket is a smoothed log ratio of its share in the target and in the corpus, as one
   array that goes to the tasks. A text's weight is the mean gain of its features: one lookup in the
   array for all of them. Weight plus Gumbel noise from the id is the score; drawing the highest
   scores is then sampling without replacement in proportion to exp(weight).
3. Scores are written once. The score that divides drawn from undrawn is found by bisection: exact
   count jobs over the written scores, each of which settles four halvings. Where many documents share
   that score, a second bisection over their ids divides those.
4. Only the drawn rows are shuffled, by ranges of (score, id), and numbered within a range; a range's
   offset is the sum of the counts before it.

Memory: an array of ``BUCKETS`` numbers, and the words of ``BLOCK`` bytes of a text at a time.

Edge cases: a null or empty text has no features and weight 0, and is not drawn if words are asked for;
a null id counts as empty text in the noise and comes last among ties; repeated rows are separate
documents, equal ids with equal scores are ranked by ``n_features`` and then as stored; an empty target
gives gains for its absence; an empty table an empty result; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import stage

BUCKETS = 10_000
#: Bytes of a text whose words are in memory at a time.
BLOCK = 1 << 20
#: Share of the documents that is drawn, and the least words of a document that can be.
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
#: Thresholds counted by one job: it narrows the interval to a sixteenth.
CUTS = 15
_LAST = (1 << 63) - 1

#: Upper case becomes lower case; ASCII letters and digits and all bytes of other characters are words.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def features(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and buckets of all features, of one block of the text after another."""
    folded = text.translate(_FOLD)
    at, before = 0, None
    while at < len(folded):
        end = folded.find(b" ", at + BLOCK)
        end = len(folded) if end < 0 else end
        words = folded[at:end].split()
        at = end
        if not words:
            continue
        single = list(map(crc32, words))
        # The checksum of "a b" goes on from that of "a".
        lefts = [before, *single[:-1]] if before is not None else single[:-1]
        rights = [b" " + w for w in words[len(words) - len(lefts) :]]
        before = single[-1]
        found = np.fromiter(single, np.int64, len(single)), np.fromiter(map(crc32, rights, lefts), np.int64, len(lefts))
        yield len(words), np.concatenate(found) % BUCKETS


def counts(texts: DataFrame, text: str) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                for _, found in features(value):
                    total += np.bincount(found, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    given = texts.select(F.col(text).cast("binary").alias("text")).where(F.col("text").isNotNull())
    each = given.mapInArrow(count, "bucket bigint, n bigint")
    # At most BUCKETS rows.
    rows = each.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of each bucket's share in the target and the corpus."""
    s_all, t_all = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in pairs], np.int64)


def weights(text: Column, gain: np.ndarray) -> Column:
    """Struct of ``n_words``, ``n_features`` and ``weight``, the floored mean gain of the features."""

    @F.arrow_udf("n_words bigint, n_features bigint, weight bigint")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = np.zeros((3, len(texts)), np.int64)
            for row, value in enumerate(texts.to_pylist()):
                words = size = total = 0
                for n, found in features(value or b""):
                    words, size, total = words + n, size + len(found), total + int(gain[found].sum())
                out[:, row] = words, size, total // size if size else 0
            yield pa.StructArray.from_arrays([pa.array(c) for c in out], ["n_words", "n_features", "weight"])

    return weigh.asNondeterministic()(text)


def noise(key: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variable that the id settles."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(said, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def threshold(rows: DataFrame, value: str, wanted: int) -> tuple[int, int]:
    """The smallest v for which at least ``wanted`` rows have ``value`` <= v, and how many have less.

    ``rows`` are stored and have at least ``wanted`` rows. Every job counts exactly, at several cuts.
    """
    column = F.col(value)
    low, high = rows.agg(F.min(column), F.max(column)).first()
    below = 0
    while low < high:
        cuts = sorted({low + (high - low) * i // (CUTS + 1) for i in range(1, CUTS + 1)})
        counted = rows.agg(*[F.count_if(column <= F.lit(c).cast("bigint")) for c in cuts]).first()
        for cut, n in zip(cuts, counted, strict=True):
            if n >= wanted:
                high = cut
                break
            low, below = cut + 1, n
    return high, below


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with their number ``rank`` in the whole order, which is a total one: shuffled once by
    ranges, numbered within each, and moved on by the counts of the ranges before."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = batch.num_rows
            more = [pa.array(np.full(size, part, np.int64)), pa.array(np.arange(at + 1, at + size + 1))]
            at += size
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "part", "nth"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    ranges = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = stage(ranges.mapInArrow(number, f"{schema}, part bigint, nth bigint"), "resampling-ranges")
    # A row for each partition.
    sizes = {r["part"]: r["n"] for r in numbered.groupBy("part").agg(F.max("nth").alias("n")).collect()}
    offsets, total = [], 0
    for part in range(max(sizes, default=-1) + 1):
        offsets.append(total)
        total += sizes.get(part, 0)
    ahead = F.element_at(F.lit(offsets or [0]).cast("array<bigint>"), (F.col("part") + 1).cast("int"))
    return numbered.select(*rows.columns, (ahead + F.col("nth")).alias("rank"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` of every document and the ``rank`` of those drawn.

    ``percent`` of the documents that have ``least_words`` are drawn. Both frames have a column ``text``.
    """
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    gain = gains(counts(docs, "text"), counts(target, text))
    found = docs.select("doc_id", weights(F.col("text").cast("binary"), gain).alias("w")).select("doc_id", "w.*")
    scored = stage(
        found.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
        .withColumn("place", F.monotonically_increasing_id()),
        "resampling-scores",
    )
    # Highest score first is the smallest of its negative.
    can = scored.where(F.col("n_words") >= least_words).select(
        (-F.col("score")).alias("down"), F.coalesce("doc_id", F.lit(_LAST)).alias("id")
    )
    wanted = can.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if wanted == 0:
        return scored.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    down, below = threshold(can, "down", wanted)
    tied, _ = threshold(can.where(F.col("down") == down), "id", wanted - below)
    drawn = (F.col("n_words") >= least_words) & (
        (F.col("score") > -down)
        | ((F.col("score") == -down) & (F.coalesce("doc_id", F.lit(_LAST)) <= F.lit(tied).cast("bigint")))
    )
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("place").asc()]
    chosen = ranked(scored.where(drawn).select(*columns, "place"), order)
    # Only rows that repeat the last id and score can be too many.
    rank = F.when(F.col("rank") <= wanted, F.col("rank"))
    return chosen.select(*columns, rank.alias("rank")).unionByName(
        scored.where(~drawn).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    )
