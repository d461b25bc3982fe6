"""Chat formatting: collapse logged snapshots of growing conversations, then render what is left.

A log that writes a conversation after every turn holds all its prefixes. The hash of a prefix rolls
over the turns: it is the exclusive or of the hashes of (turn, role, text, times), so it needs no whole
conversation in one task: turns are summed up in chunks of their numbers, and chunks are chained. A
conversation whose final hash is the hash of a proper prefix of another, or of an equal one with a
smaller id, is dropped by an anti-join. What is left is rendered, a part for every chunk.

Edge cases: null role or text counts as empty; repeated rows of one turn count as one turn that is said
so many times, and are rendered so often; several rows of a turn stand in the order of role and text;
null turns come before all others; nothing says which rows without id belong together, so each of them is
a conversation of one turn (and equal ones collapse, as all equal conversations do); an empty table gives
an empty result; marks that occur in a text are broken up, so that a text can't open a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turn numbers in a chunk.
CHUNK = 256
OPEN, SHUT = "<|", "|>"


def _turns(df: DataFrame) -> DataFrame:
    """A row for each distinct (conversation, turn, role, text), with its hash and chunk.

    ``conv`` is the conversation: its id, or what is said in the only turn of one without id.
    """
    said = (
        df.select(
            F.col("conv_id").alias("conv_id"),
            F.coalesce(F.col("turn").cast("bigint"), F.lit(-(1 << 62))).alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("times", F.when(F.col("conv_id").isNull(), 1).otherwise(F.col("times")))
        .withColumn("chunk", F.floor(F.col("turn") / CHUNK))
        .withColumn("h1", F.xxhash64(F.lit(1), "turn", "role", "text", "times"))
        .withColumn("h2", F.xxhash64(F.lit(2), "turn", "role", "text", "times"))
    )
    return said.withColumn("conv", _conversation(F.col("turn"), F.col("h1"), F.col("h2"))).drop("conv_id")


def _conversation(turn: Column, h1: Column, h2: Column) -> Column:
    alone = F.when(F.col("conv_id").isNull(), F.struct(turn.alias("turn"), h1.alias("h1"), h2.alias("h2")))
    return F.struct(F.col("conv_id").alias("conv_id"), alone.alias("alone"))


def prefixes(df: DataFrame) -> DataFrame:
    """``conv``, ``conv_id``, ``turn``, ``p1``, ``p2``, ``final``: the hash of each prefix that ends with a turn."""
    per_turn = _turns(df).groupBy("conv", "chunk", "turn").agg(
        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2")
    )
    chunks = per_turn.groupBy("conv", "chunk").agg(
        F.bit_xor("h1").alias("c1"), F.bit_xor("h2").alias("c2")
    )
    earlier = (
        Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy("conv")
    chained = chunks.select(
        F.struct("conv", "chunk").alias("part"),
        F.coalesce(F.bit_xor("c1").over(earlier), F.lit(0)).alias("b1"),
        F.coalesce(F.bit_xor("c2").over(earlier), F.lit(0)).alias("b2"),
        (F.max("chunk").over(whole) == F.col("chunk")).alias("ends"),
    )
    turns = per_turn.select(F.struct("conv", "chunk").alias("part"), "turn", "h1", "h2")
    line = Window.partitionBy("part").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    last = Window.partitionBy("part")
    return turns.join(chained, "part").select(
        F.col("part.conv").alias("conv"),
        F.col("part.conv.conv_id").alias("conv_id"),
        "turn",
        F.bit_xor("h1").over(line).bitwiseXOR(F.col("b1")).alias("p1"),
        F.bit_xor("h2").over(line).bitwiseXOR(F.col("b2")).alias("p2"),
        (F.col("ends") & (F.max("turn").over(last) == F.col("turn"))).alias("final"),
    )


def maximal(df: DataFrame) -> DataFrame:
    """``conv_id`` and ``conv`` of the conversations that are no prefix of another; of equal ones, the
    smallest, and one without id only if none has an id."""
    found = prefixes(df)
    whole = (
        found.where("final").groupBy("turn", "p1", "p2").agg(F.min("conv_id").alias("conv_id"))
    )
    proper = found.where("NOT final").select("turn", "p1", "p2").distinct()
    return whole.join(proper, ["turn", "p1", "p2"], "left_anti").select(
        "conv_id", _conversation(F.col("turn"), F.col("p1"), F.col("p2")).alias("conv")
    )


def _safe(text: Column) -> Column:
    """Marks broken up by a blank."""
    return F.replace(F.replace(text, F.lit(OPEN), F.lit("< |")), F.lit(SHUT), F.lit("| >"))


def rendered(df: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``n_turns``, ``rendered`` of the maximal conversations.

    A part has the turns of one chunk of turn numbers, so almost every conversation is one part, and a
    conversation of any length is many bounded ones; they are numbered by their chunks.
    """
    own = _turns(df).join(maximal(df).select("conv"), "conv", "left_semi")
    said = F.concat(
        F.lit(OPEN), _safe(F.col("role")), F.lit(SHUT + "\n"), _safe(F.col("text")), F.lit(f"\n{OPEN}end{SHUT}\n")
    )
    line = F.struct("turn", "role", "text", F.array_join(F.array_repeat(said, F.col("times").cast("int")), "").alias("said"))
    grouped = own.groupBy(F.struct("conv", "chunk").alias("part")).agg(
        F.sum("times").alias("n_turns"), F.array_sort(F.collect_list(line)).alias("lines")
    )
    return grouped.select(
        F.col("part.conv.conv_id").alias("conv_id"),
        F.col("part.chunk").alias("part"),
        "n_turns",
        F.array_join(F.col("lines.said"), "").alias("rendered"),
    )
