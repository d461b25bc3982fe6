"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Sources, in order of code points with null last, get weights that repeat; targets share the total
   by weight, stop at ``most`` times a source's size, and the excess is shared again by weight.
2. The mix is cut into blocks of equally many words. Sources receive blocks by the highest quotients
   target / (2k + 1), so every source has an integer number of them.
3. A source is cut into shards of bounded size by a hash of the row, so a hot source is many shards.
   Its blocks are apportioned to its shards in the same way.
4. Within a shard the documents lie end to end in seeded order. Whole repeats come first; the rest is
   a seeded selection of the shard's own blocks, and a document takes the words it has in them.

For those who mix whole documents, ``whole`` rounds the same quotas to documents: a shard is cut at its
rest in seeded order, and a document whose middle is before the cut goes once more. Every source with a
target above 0 has a block at least and keeps one document at least, the first of its first shard with one.

Only DataFrame operations are used. The global windows are over one row a source and over the few
quotients near a source's quota; all other windows are within a shard.

Edge cases: null text has no words; a document without words takes none; with no words at all every
target is 0; equal rows count as separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm import common

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 17
MOST_SHARDS = 4096
#: Prime and above any number of blocks in a shard, so a stride of it visits every block once.
STRIDE = 2_147_483_647


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row a source with its ``source_size``.

    Sorted by the level at which a source is full, the full ones come first, and the level of the
    others is what is left over the weight that is left.
    """
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    place = F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    cap = F.col("source_size") * most
    by_level = Window.partitionBy().orderBy("full_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    leveled = (
        sizes.withColumn("weight", F.element_at(cycle, ((place - 1) % len(weights) + 1).cast("int")))
        .withColumn("full_at", cap / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn(
            "level",
            (F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0)))
            / F.sum("weight").over(after),
        )
        .withColumn(
            "common",
            F.first(F.when(F.col("full_at") >= F.col("level"), F.col("level")), ignorenulls=True).over(
                by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        )
    )
    share = F.least(cap.cast("double"), F.col("common") * F.col("weight"))
    return leveled.select("source", "source_size", F.coalesce(share, F.lit(0.0)).alias("target"))


def apportion(
    parties: DataFrame, group: Sequence[str], order: Sequence[Column], votes: str, seats: str
) -> DataFrame:
    """Add ``quota``: the ``seats`` of a group, dealt to its parties by the highest quotients.

    A party's final number of seats lies near its exact share: rounding at a common divisor misses the
    total by half a seat a party, and its share of that miss is what it can gain or lose. So only the
    quotients in that range are ranked, a few for every party; all seats below it are certain.
    """
    whole = Window.partitionBy(*group).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    exact = F.try_divide(F.col(votes) * F.col(seats), F.sum(votes).over(whole))
    named = parties.withColumn("party", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    ranged = (
        named.withColumn("exact", F.coalesce(exact, F.lit(0.0)))
        .withColumn("parties", F.count(F.lit(1)).over(whole))
        .withColumn(
            "slack",
            2 + F.ceil(F.coalesce(F.try_divide(F.col("exact"), F.col(seats)), F.lit(0.0)) * F.col("parties") / 2),
        )
        .withColumn("sure", F.greatest(F.floor("exact") - F.col("slack"), F.lit(0)))
        .withColumn("open", F.col(seats) - F.sum("sure").over(whole))
    )
    ranks = F.sequence("sure", F.floor("exact") + F.col("slack"))
    quotient = F.col(votes) / (2 * F.col("seat") + 1)
    winners = (
        ranged.where(F.col(votes) > 0)
        .withColumn("seat", F.explode(ranks))
        .withColumn("quotient", quotient)
        .withColumn(
            "rank",
            F.row_number().over(
                Window.partitionBy(*group).orderBy(F.col("quotient").desc(), "party", "seat")
            ),
        )
        .where(F.col("rank") <= F.col("open"))
        .groupBy(*group, "party")
        .agg(F.count(F.lit(1)).alias("won"))
    )
    keys = [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in [*group, "party"]]
    condition = keys[0]
    for k in keys[1:]:
        condition = condition & k
    return (
        ranged.alias("a")
        .join(winners.alias("b"), condition, "left")
        .select(
            *[F.col(f"a.{c}") for c in parties.columns],
            (F.col("sure") + F.coalesce("won", F.lit(0))).alias("quota"),
        )
    )


def mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    block_words: int = BLOCK_WORDS,
    seed: str = "mix",
    whole: bool = False,
) -> DataFrame:
    """One row a document: ``doc_id``, ``size``, ``source``, ``source_size``, ``target``, ``taken``,
    ``copies``.

    ``copies`` is for those who mix whole documents: whole repeats, and one more if the middle word is
    in a selected block. With ``whole`` it is the quota rounded to documents, and ``taken`` the words of
    these copies.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(common.WORD)), F.lit(0)).cast("long")
    docs = common.stage(
        df.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            size.alias("size"),
            F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("dealt"),
        ),
        "mix-sizes",
    )
    per_source = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(per_source, weights, most).withColumn(
        "blocks",
        F.round(
            F.sum("target").over(
                Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            )
            / block_words
        ).cast("long"),
    )
    least = F.when(F.col("target") > 0, 1).otherwise(0) if whole else F.lit(0)
    shards = F.least(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(MOST_SHARDS))
    sources = common.stage(
        apportion(goals, [], [F.col("source").asc_nulls_last()], "target", "blocks")
        .withColumn("source_blocks", F.greatest("quota", least.cast("long")))
        .drop("quota")
        .withColumn("shards", F.greatest(shards, F.lit(1)).cast("int"))
        .drop("blocks"),
        "mix-sources",
    )
    # One row a source: a bounded side only where Spark measures it so; no hint.
    dealt = docs.alias("d").join(
        sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "inner"
    ).select(
        "d.doc_id", "d.source", "d.size", "d.dealt", "s.source_size", "s.target", "s.source_blocks",
        # One struct as key: rows dealt by source alone would put a whole source in one task.
        F.struct(
            F.col("d.source").alias("source"),
            F.pmod("d.dealt", F.col("s.shards").cast("long")).cast("int").alias("number"),
        ).alias("shard"),
    )
    per_shard = (
        dealt.groupBy("shard")
        .agg(F.sum("size").alias("shard_size"), F.max("source_blocks").alias("source_blocks"))
        .withColumn("of", F.col("shard.source"))
    )
    quotas = apportion(per_shard, ["of"], [F.col("shard.number")], "shard_size", "source_blocks").select(
        F.col("shard").alias("q_shard"),
        "shard_size",
        "quota",
        (F.col("shard.number") == F.min(F.when(F.col("quota") > 0, F.col("shard.number"))).over(Window.partitionBy("of"))).alias("leads"),
    )
    line = Window.partitionBy("shard").orderBy(
        F.xxhash64(F.lit(seed), "dealt"), F.col("doc_id").asc_nulls_last(), "size"
    )
    laid = dealt.withColumn("end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    placed = laid.join(quotas, F.col("shard") == F.col("q_shard"))
    return _taken(placed, most, block_words, seed, whole)


def _taken(placed: DataFrame, most: int, block_words: int, seed: str, whole: bool) -> DataFrame:
    """Words that the mix takes from each document of a shard with its quota of blocks."""
    total = F.least(F.col("quota") * block_words, F.col("shard_size") * most)
    repeats = F.coalesce(F.try_divide(total, F.col("shard_size")).cast("long"), F.lit(0))
    counted = (
        placed.withColumn("start", F.col("end") - F.col("size"))
        .withColumn("repeats", repeats)
        .withColumn("rest", total - F.col("repeats") * F.col("shard_size"))
        .withColumn("chosen", F.floor(F.col("rest") / block_words))
        .withColumn("over", F.col("rest") - F.col("chosen") * block_words)
        .withColumn("count", F.greatest(F.ceil(F.col("shard_size") / block_words), F.lit(1)))
        .withColumn("turn", F.pmod(F.xxhash64(F.lit(seed), "shard"), "count"))
    )

    def selected(block: Column) -> Column:
        """Words of a block that are selected: all, the first few of the last one, or none."""
        rank = F.pmod((block + F.col("turn")) * STRIDE, F.col("count"))
        return F.when(rank < F.col("chosen"), F.lit(block_words).cast("long")).when(
            rank == F.col("chosen"), F.col("over")
        ).otherwise(F.lit(0).cast("long"))

    def words(block: Column) -> Column:
        low = F.greatest(block * block_words, F.col("start"))
        high = F.least(block * block_words + selected(block), F.col("end"))
        return F.greatest(high - low, F.lit(0).cast("long"))

    blocks = F.sequence(
        F.floor(F.col("start") / block_words), F.floor((F.col("end") - 1) / block_words)
    )
    part = F.when(
        F.col("size") > 0, F.aggregate(blocks, F.lit(0).cast("long"), lambda s, b: s + words(b))
    ).otherwise(F.lit(0))
    middle = F.floor((F.col("start") + F.col("end")) / 2)
    holds = (middle % block_words) < selected(F.floor(middle / block_words))
    taken = F.col("repeats") * F.col("size") + part
    if whole:
        first = F.coalesce(F.col("leads"), F.lit(False)) & (F.col("start") == 0) & (F.col("repeats") == 0)
        holds = (F.col("start") + F.col("end") <= 2 * F.col("rest")) | first
        taken = (F.col("repeats") + holds.cast("long")) * F.col("size")
    copies = F.when(F.col("size") > 0, F.col("repeats") + holds.cast("long")).otherwise(F.lit(1))
    return counted.select(
        "doc_id",
        F.col("size").cast("long").alias("size"),
        "source",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        taken.cast("long").alias("taken"),
        copies.cast("int").alias("copies"),
    )
