"""Straight lines by least squares, from moments that can be stored and added up.

A row of moments stands for any number of observations, so a fit for any coarser key, or over more weeks,
is a sum of stored rows and never reads the observations again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SUMS = ("observations", "sum_x", "sum_y", "sum_xx", "sum_xy")


def moments(df: DataFrame, by: Sequence[str], x: Column, y: Column) -> DataFrame:
    """A row per key: number of observations, sums, and the range of ``x``. Rows without x or y don't count."""
    both = df.select(*by, x.alias("_x"), y.alias("_y")).where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    return both.groupBy(*by).agg(
        F.count("*").alias("observations"),
        F.sum("_x").alias("sum_x"),
        F.sum("_y").alias("sum_y"),
        F.sum(F.col("_x") * F.col("_x")).alias("sum_xx"),
        F.sum(F.col("_x") * F.col("_y")).alias("sum_xy"),
        F.min("_x").alias("min_x"),
        F.max("_x").alias("max_x"),
    )


def add_up(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Moments of coarser keys, or of several stored parts; no key at all is one row."""
    return stored.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.min("min_x").alias("min_x"), F.max("max_x").alias("max_x")
    )


def lines(stored: DataFrame) -> DataFrame:
    """``slope`` and ``intercept`` of every row of moments that has two different x."""
    n, sx, sy, sxx, sxy = (F.col(c) for c in _SUMS)
    slope = F.try_divide(n * sxy - sx * sy, n * sxx - sx * sx)
    return (
        stored.where(F.col("min_x") < F.col("max_x"))
        .withColumn("slope", slope)
        .withColumn("intercept", (sy - F.col("slope") * sx) / n)
    )
