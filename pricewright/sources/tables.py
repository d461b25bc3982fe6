"""Week-partitioned tables, catalog tables and the price export."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewright.functions.calendar import Cycle

#: Partition columns of week tables: the cycle that wrote the rows, and their week.
WRITTEN_BY = "cycle_start"
WEEK = "week_start"
#: Append-only table beside the cycles' folders: which version of a cycle was published, and when.
MANIFEST = "_published"


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a Parquet table? Any other failure to look is an error and not a no."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def read_weeks(spark: SparkSession, path: str) -> DataFrame:
    """A dataset of weeks; a filter on the week reads only its directories.

    Each row names the cycle that wrote it. A week can hold rows of several cycles, as a cycle may
    also deliver late sales of an earlier week; ``sales.add_up`` makes one row of them.
    """
    root = path.rstrip("/")
    newest = (
        spark.read.parquet(f"{root}/{MANIFEST}").groupBy(WRITTEN_BY).agg(F.max_by("version", "published").alias("version"))
    )
    # A line for each cycle.
    parts = [f"{root}/{WRITTEN_BY}={r[WRITTEN_BY]}/version={r['version']}" for r in newest.collect()]
    df = spark.read.option("basePath", root).parquet(*sorted(parts)).drop("version")
    return df.withColumn(WEEK, F.col(WEEK).cast("date")).withColumn(
        WRITTEN_BY, F.col(WRITTEN_BY).cast("date")
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_weeks(df: DataFrame, path: str, cycle: Cycle) -> None:
    """Write the weeks of a cycle, replacing all that this cycle wrote before and nothing else.

    Rows of other cycles stay, those of the same week too: running a job twice changes nothing, and a
    late sale is added to its week. The cycle is the outer partition, so a repeat also clears weeks
    that it no longer has.

    The rows go to a new version's folder first; only then a line in the manifest makes readers take it in
    place of the cycle's earlier one, whose files go last. A run that dies half-way leaves what was
    published before.

    The rebalance hint puts a week's rows together, splits a week too large for one task and
    merges small ones, so neither tiny files nor one huge writer task come about.
    """
    root, version = path.rstrip("/"), f"v{uuid.uuid4().hex}"
    spark, folder = df.sparkSession, f"{root}/{WRITTEN_BY}={cycle.start}"
    made = df.drop(WRITTEN_BY).hint("rebalance", WEEK).write.partitionBy(WEEK)
    made.parquet(f"{folder}/version={version}")
    line = spark.range(1).select(
        F.lit(cycle.start).alias(WRITTEN_BY), F.lit(version).alias("version"), F.current_timestamp().alias("published")
    )
    line.write.mode("append").parquet(f"{root}/{MANIFEST}")
    # A line for each run of this cycle. Readers of the bare folders find one version, too.
    runs = spark.read.parquet(f"{root}/{MANIFEST}").where(F.col(WRITTEN_BY) == F.lit(cycle.start))
    nothing = spark.createDataFrame([], df.drop(WRITTEN_BY).schema)
    for run in runs.where(F.col("version") != version).select("version").distinct().collect():
        nothing.write.partitionBy(WEEK).mode("overwrite").parquet(f"{folder}/version={run['version']}")


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    mode: str = "append",
    path: str | None = None,
) -> None:
    """Append to (or replace) a catalog table, partitioned and placed as given when it is first made."""
    out = df.hint("rebalance", *partition_by) if partition_by else df
    writer = out.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def save_weeks_table(df: DataFrame, name: str, cycle: Cycle, path: str | None = None) -> None:
    """The same for a catalog table: all that this cycle wrote is replaced, all else stays.

    The partitions to replace are named in the statement. ``path`` is where a new table's files go.
    """
    spark = df.sparkSession
    body = [f for f in df.schema.fields if f.name not in (WRITTEN_BY, WEEK)]
    if not spark.catalog.tableExists(name):
        dated = [T.StructField(c, T.DateType()) for c in (WRITTEN_BY, WEEK)]
        empty = spark.createDataFrame([], T.StructType([*body, *dated]))
        writer = empty.write.format("parquet").partitionBy(WRITTEN_BY, WEEK)
        (writer.option("path", path) if path else writer).saveAsTable(name)
    columns = [c for c in spark.table(name).columns if c != WRITTEN_BY]
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION ({WRITTEN_BY} = DATE'{cycle.start}', {WEEK}) "
        f"SELECT /*+ REBALANCE({WEEK}) */ * FROM {{rows}}",
        rows=df.select(*columns),
    )


def suggested_prices(chosen: DataFrame) -> DataFrame:
    return chosen.select(
        "product_id",
        "store_id",
        F.date_format("week_start", "yyyy-MM-dd HH:mm:ss").alias("week_start"),
        "price",
    )


def export_prices(chosen: DataFrame, root: str, cycle: Cycle) -> str:
    """Comma text without header, named after the cycle start; an earlier export of it is replaced.

    A small export comes out as one part file, a large one as several.
    """
    path = f"{root.rstrip('/')}/suggested_prices_{cycle.start.strftime('%Y_%m_%d')}"
    suggested_prices(chosen).hint("rebalance").write.mode("overwrite").csv(path)
    return path


def save_view(spark: SparkSession, name: str, statement: str) -> None:
    """A view in the catalog, which other sessions see too."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {statement}")


def register(frames: Mapping[str, DataFrame]) -> None:
    """Make results queryable by SQL under the given names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
