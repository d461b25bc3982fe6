"""Readers of the small comma-separated inputs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewright.functions.calendar import Cycle

# Columns of the two dimension files, in file order.
PRODUCT_FIELDS = ("department_id", "brand_id", "product_id", "msrp", "cost")
PRODUCT_TEXT = ("department_id", "brand_id", "product_id")
STORE_FIELDS = ("store_id", "avg_hhi", "avg_traffic")
STORE_TEXT = ("store_id",)


def read_dimension(
    spark: SparkSession, path: str, fields: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """A file with a header whose columns are renamed by position.

    Categorical fields stay text without quotes, all others become doubles. An empty field is null; a
    field that is no number is an error, and so is a line with too few or too many fields.
    """

    def number(name: str) -> Column:
        made = F.col(name).try_cast("double")
        refused = F.raise_error(F.concat(F.lit(f"{name} is no number: "), F.col(name)))
        return F.when(F.col(name).isNull() | made.isNotNull(), made).otherwise(refused.cast("double"))

    schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    # All columns are parsed, or a short line would only show where its last field is asked for.
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True)
    raw = reader.option("mode", "FAILFAST").option("columnPruning", False).csv(path)
    return raw.select(
        *[
            F.regexp_replace(name, '"', "").alias(name)
            if name in categorical
            else number(name).alias(name)
            for name in fields
        ]
    )


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, PRODUCT_FIELDS, PRODUCT_TEXT)


def read_stores(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, STORE_FIELDS, STORE_TEXT)


def read_cycle(spark: SparkSession, path: str, days: int = 7) -> Cycle:
    """The control file: a header and one line ``start,end``. Its two dates are all that is fetched."""
    schema = T.StructType([T.StructField("start", T.DateType()), T.StructField("end", T.DateType())])
    line = spark.read.schema(schema).option("header", True).csv(path).first()
    if line is None or not isinstance(line["start"], date) or not isinstance(line["end"], date):
        raise ValueError(f"{path} holds no line with a start and an end date")
    return Cycle(line["start"], line["end"], days)
