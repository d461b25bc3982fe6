"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.sources import scratch
from pricewright.sources.shipping import ship

#: Fixed value: a word is a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a batch handed to Python. Texts may be long, so it is far below Spark's 10,000.
BATCH_ROWS = 1024

#: Rows of a file of a staged table whose size is known, a sketch each at most.
FILE_ROWS = 5_000


def short_batches(spark: SparkSession) -> None:
    """Batches for Python are kept small from here on, as texts can be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, to be handed to Python in small batches."""
    ship(spark)
    short_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, or a longer form of it that clashes with no column, whatever its case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """Is crc32 of the id as text divisible by 5? A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def hash_share(*columns: Column, seed: str) -> Column:
    """A repeatable number in [0, 1) from the columns' values."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / float(1 << 30)


def stage(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors.

    Where ``rows``, how many there are at most, is known, few rows are written by few tasks. Not for tables
    of shingles, which are large.
    """
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    return scratch.stage(df, name)
