"""Sales logs and price changes: nested JSON documents, one per store and file."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewright.functions.calendar import Cycle, to_day
from pricewright.sources.shipping import ship

_ITEM = T.StructType(
    [T.StructField("Price", T.DoubleType()), T.StructField("ProductID", T.StringType())]
)
SALES_LOG = T.StructType(
    [
        T.StructField("SalesLogDateTime", T.StringType()),
        T.StructField("StoreID", T.StringType()),
        T.StructField(
            "Transactions",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("Subtotal", T.DoubleType()),
                        T.StructField("Tax", T.DoubleType()),
                        T.StructField("Total", T.DoubleType()),
                        T.StructField("TransactionDateTime", T.StringType()),
                        T.StructField("Products", T.ArrayType(_ITEM)),
                    ]
                )
            ),
        ),
    ]
)
PRICE_CHANGE = T.StructType(
    [
        T.StructField("PriceDate", T.StringType()),
        T.StructField("StoreID", T.StringType()),
        T.StructField("PriceUpdates", T.ArrayType(_ITEM)),
    ]
)

# File name prefixes of the two kinds of log.
PREFIX = {"sales": "sales_store", "prices": "pc_store"}
SUFFIX = "_00_00_00.json"


def _dates(cycle: Cycle, kind: str) -> list[str]:
    total = (cycle.end - cycle.start).days
    if kind == "sales":
        offsets = range(1, total + 1)
    else:
        offsets = range(0, total // cycle.days * cycle.days, cycle.days)
    return [(cycle.start + timedelta(days=n)).strftime("%Y_%m_%d") for n in offsets]


def cycle_globs(root: str, cycle: Cycle, kind: str) -> str:
    """Glob of a cycle's files, so files of other cycles are not even opened."""
    return f"{root.rstrip('/')}/{PREFIX[kind]}[0-9]*_{{{','.join(_dates(cycle, kind))}}}{SUFFIX}"


def in_cycle(name: Column, cycle: Cycle, kind: str) -> Column:
    """Does a file of this name belong to the cycle? The same choice as ``cycle_globs``, as a filter.

    For cycles of so many days that a glob would be unwieldy. The name may also be that of the folder that
    holds the file, alone or as the value of a partition.
    """
    pattern = rf"(?:^|[/=]){PREFIX[kind]}[0-9][^/]*_([0-9]{{4}}_[0-9]{{2}}_[0-9]{{2}}){SUFFIX}(?:/[^/]*)?$"
    day = F.to_date(F.try_to_timestamp(F.regexp_extract(name, pattern, 1), F.lit("yyyy_MM_dd")))
    offset = F.datediff(day, F.lit(cycle.start))
    total = (cycle.end - cycle.start).days
    if kind == "sales":
        inside = offset.between(1, total)
    else:
        whole = total // cycle.days * cycle.days
        inside = (offset >= 0) & (offset < whole) & (offset % cycle.days == 0)
    return F.coalesce(inside, F.lit(False))


def _reader(spark: SparkSession, schema: T.StructType, one_per_file: bool) -> DataFrameReader:
    """Stops at a document that can't be read, naming its file, and doesn't pass over it."""
    return spark.read.schema(schema).option("multiLine", one_per_file).option("mode", "FAILFAST")


def _read(spark: SparkSession, path: str, schema: T.StructType, one_per_file: bool) -> DataFrame:
    return _reader(spark, schema, one_per_file).json(path)


def read_cycle(
    spark: SparkSession, root: str, cycle: Cycle, kind: str, one_per_file: bool = True
) -> DataFrame:
    """A cycle's documents in all folders below ``root``, with ``source_file``, the path of each.

    The choice is a filter on file metadata, so files of other cycles are listed and not opened.
    """
    schema = {"sales": SALES_LOG, "prices": PRICE_CHANGE}[kind]
    found = _reader(spark, schema, one_per_file).option("recursiveFileLookup", True).json(root)
    named = found.select(*schema.names, F.col("_metadata.file_path").alias("source_file"))
    return named.where(in_cycle(F.col("source_file"), cycle, kind))


def read_sales_logs(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Sales documents. The declared schema saves the pass that inference needs.

    ``one_per_file=False`` reads one document per line, which Spark can split within a file.
    """
    return _read(spark, path, SALES_LOG, one_per_file)


def read_price_changes(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    return _read(spark, path, PRICE_CHANGE, one_per_file)


#: What Spark's writer names the folder of rows without a name. It starts so that it is not hidden.
_NAMELESS = "file=__HIVE_DEFAULT_PARTITION__"
#: Each task puts its own files in place; else the driver moves all of them, one after the other.
_BY_TASKS = "mapreduce.fileoutputcommitter.algorithm.version", "2"


def write_files(rows: DataFrame, path: str) -> None:
    """Lines ``value`` into text files named ``file``, in folders below ``path``. A task has whole files and
    their lines in order.

    In a mounted folder a task writes its files itself and then names their folder, as Spark's writer makes a folder
    for each file and starts three processes for its rights; the names are listed beside them. Other stores are
    reached through Spark's writer only, and a file's name is then that of its folder.
    """
    mounted = re.fullmatch(r"(?:file:(?://)?)?(/[^/].*)", path)
    if mounted is None:
        rows.write.option(*_BY_TASKS).partitionBy("file").text(path)
        return
    ship(rows.sparkSession)
    root = mounted[1]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        # Hidden until it is whole; of two attempts the first stays.
        made = f"{root}/_attempt-{task.taskAttemptId()}"
        os.makedirs(made, exist_ok=True)
        name, out, names = None, None, []
        for batch in batches:
            files, text = batch["file"].fill_null(_NAMELESS), batch["value"]
            ends = np.flatnonzero(files.to_numpy(zero_copy_only=False)[1:] != files.to_numpy(zero_copy_only=False)[:-1]) + 1
            cuts = [0, *ends.tolist(), len(files)]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if start == end:
                    continue
                own = files[start].as_py()
                if own != name:
                    if out is not None:
                        out.close()
                    name, out = own, open(f"{made}/{own}", "wb")
                    names.append(own)
                out.write(_bytes(text.slice(start, end - start)))
        if out is not None:
            out.close()
        if not names:
            os.rmdir(made)
            return
        try:
            os.rename(made, f"{root}/files-{task.partitionId():05d}")
        except OSError:
            if not os.path.isdir(f"{root}/files-{task.partitionId():05d}"):
                raise
        yield pa.RecordBatch.from_arrays([pa.array(names)], ["file"])

    lines = rows.select("file", F.concat(F.coalesce("value", F.lit("")), F.lit("\n")).alias("value"))
    lines.mapInArrow(each, "file string").write.option(*_BY_TASKS).parquet(f"{path}/_names")


def _bytes(text: pa.Array) -> memoryview:
    """All values of an array of texts without nulls, one after the other."""
    _, places, data = text.buffers()
    width = np.int64 if pa.types.is_large_string(text.type) else np.int32
    at = np.frombuffer(places, dtype=width)[[text.offset, text.offset + len(text)]]
    return memoryview(data)[at[0] : at[1]]


def flatten_sales(logs: DataFrame) -> DataFrame:
    """One row per unit sold: product, store, time text and day of the transaction."""
    sold = logs.select("StoreID", F.explode("Transactions").alias("t")).select(
        "StoreID", "t.TransactionDateTime", F.explode("t.Products").alias("p")
    )
    return sold.select(
        F.col("p.ProductID").alias("product_id"),
        F.col("StoreID").cast("string").alias("store_id"),
        F.col("TransactionDateTime").alias("datetime"),
        to_day(F.col("TransactionDateTime")).alias("sale_day"),
    )


def flatten_prices(changes: DataFrame) -> DataFrame:
    """One row per price change; its week is its own date."""
    updated = changes.select("PriceDate", "StoreID", F.explode("PriceUpdates").alias("p"))
    return updated.select(
        F.col("p.ProductID").alias("product_id"),
        F.col("StoreID").cast("string").alias("store_id"),
        F.col("PriceDate").alias("date"),
        F.col("p.Price").alias("price"),
        to_day(F.col("PriceDate")).alias("week_start"),
    )
