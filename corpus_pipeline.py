"""The corpus pipeline: five stages over documents, each written to Parquet and read by the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written and read again as the next one's docs. All but the last return the columns of documents. A stage
may be run by itself on docs that were read elsewhere, so those with Python keep its batches small themselves.

Edge cases: rows of a null id are never near copies to be dropped; of rows that repeat an id and its text
one stays after the near-duplicate stage, and different texts of one id are separate documents; an empty
table passes through; extra columns of documents stay, maps too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricewright.llm import bpe, language, lines, minhash, mixing
from pricewright.llm.common import fresh, short_batches, stage, table
from pricewright.llm.queries import vocabulary

#: A document is rejected if its language can't be told: no letters, or no language above this share.
LEAST_SCORE = 0.4
#: Lines on more than this share of a source's different documents are boilerplate, in every source that
#: has op6's least number of them. Near copies count once. op6 asks for 0.3 of a host; a source gathers
#: several hosts, so the boilerplate of a host with a sixth of it is to be found.
LINE_RATIO = 0.05
LEAST_DOCUMENTS = lines.LEAST_PAGES
#: Boilerplate goes whatever share of a document it is.
MOST_LINES = 1.0

def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told. Learns from the labelled ones among them."""
    short_batches(spark)
    model = language.fit(docs, "doc_id", "text", "lang")
    found = fresh(docs.columns, "found")
    told = docs.withColumn(found, language.predict(F.col("text"), model))
    sure = (F.col(f"{found}.lang") != language.UNDETERMINED) & (F.col(f"{found}.score") >= LEAST_SCORE)
    return told.where(sure).select(*docs.columns)


def strip_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out the lines that too many documents of a source have. Every document stays."""
    short_batches(spark)
    return lines.drop_lines(
        docs, "source", ratio=LINE_RATIO, least_pages=LEAST_DOCUMENTS, copies_once=True, most=MOST_LINES,
        near_once=True,
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies.

    A document is an id with its text: different texts under one id are judged apart.
    """
    short_batches(spark)
    key = fresh(docs.columns, "row_key")
    named = docs.where("doc_id IS NOT NULL").withColumn(key, F.xxhash64("doc_id", "text"))
    groups = minhash.near_duplicates(named, key=key).select(F.col("doc_id").alias(key), "component_id").distinct()
    ids = named.select(key, F.col("doc_id").alias("id")).distinct()
    first = groups.join(ids, key).groupBy("component_id").agg(F.min(F.struct("id", key)).alias("first"))
    kept = named.join(first.select(f"first.{key}"), key, "left_semi").dropDuplicates([key])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix says: not at all, once, or up to three times.

    Rows are met by id, text and source, so rows without id or of one id keep their own copies; rows equal
    in all three share theirs.
    """
    key = fresh(docs.columns, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text", "source"))
    mixed = mixing.mix(keyed, key=key, whole=True)
    taken = mixed.groupBy(F.col("doc_id").alias(key)).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    place, times = fresh(keyed.columns, "place"), fresh(keyed.columns, "times")
    counts = taken.where("copies > 0").select(key, F.struct("copies", "rows").alias(times))
    # Rows of a key come sorted out of the join.
    line = F.row_number().over(Window.partitionBy(key).orderBy(key))
    copies = F.expr(f"int({times}.copies div {times}.rows + int({place} <= {times}.copies % {times}.rows))")
    met = keyed.join(counts, key).withColumn(place, line).withColumn(times, copies).where(F.col(times) > 0)
    return met.withColumn(place, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and a digest of what they decode to."""
    short_batches(spark)
    base = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    both = base.select("doc_id", "source", bpe.round_trip(F.col("text"), vocabulary()).alias("b"))
    return both.select("doc_id", "source", "b.ids", "b.decoded").select(
        "doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify),
    ("lines", strip_lines),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("tokens", encode),
]

#: The network of the first stage is learned, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
