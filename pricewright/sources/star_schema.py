"""Retail inputs made from a star schema of ``lineitem``, ``part`` and ``supplier``.

A line item is one unit sold, a supplier is a store, and a product is a part name of one brand; the
noun of the name is the department. Stores grow with the data while competing groups keep their
size. Money is added in whole ten-thousandths of a cent, so no result depends on the order of
addition.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.functions.calendar import Cycle, week_start

# Fourteen half-year weeks; they span every ship date of the tables.
CYCLE = Cycle(date(1995, 1, 2), date(2001, 12, 24), days=182)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _brand_number() -> Column:
    return F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("bigint")


def _list_price() -> Column:
    """List price in hundredths of a cent: dearer brands have higher numbers."""
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    return cents * (50 + 2 * _brand_number())


def _product_id() -> Column:
    return F.concat_ws(" ", "p_name", "p_brand")


def sales(spark: SparkSession, folder: str, stores: DataFrame | None = None) -> DataFrame:
    """One row per unit sold: store_id, product_id, sale_day, paid (10^-6 currency units), discounted.

    With ``stores``, of the stores in it.
    """
    parts = _table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        _product_id().alias("product_id"),
        _list_price().alias("list_price"),
    )
    percent_off = F.round(F.col("l_discount") * 100).cast("bigint")
    lines = _table(spark, folder, "lineitem").withColumn("store_id", F.col("l_suppkey").cast("string"))
    if stores is not None:
        lines = lines.join(stores, "store_id", "left_semi")
    return (
        lines.join(parts, "l_partkey")
        .select(
            "l_orderkey",
            "l_linenumber",
            "store_id",
            "product_id",
            F.col("l_shipdate").cast("date").alias("sale_day"),
            (F.col("list_price") * (100 - percent_off)).alias("paid"),
            (percent_off > 0).alias("discounted"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Product attributes. Cheap brands have thin margins, so some have no price on a group's grid."""
    by_product = (
        _table(spark, folder, "part")
        .groupBy(
            F.element_at(F.split("p_name", " "), 2).alias("department_id"),
            F.col("p_brand").alias("brand_id"),
            _product_id().alias("product_id"),
        )
        .agg(F.max(_list_price()).alias("top"), F.max(_brand_number()).alias("number"))
    )
    msrp_cents = F.expr("(top + 50) div 100")
    with_msrp = by_product.withColumn("msrp_cents", msrp_cents)
    cost_cents = F.expr("(msrp_cents * (98 - (3 * number) div 2) + 50) div 100")
    return with_msrp.select(
        "department_id",
        "brand_id",
        "product_id",
        (F.col("msrp_cents") / 100.0).alias("msrp"),
        (cost_cents / 100.0).alias("cost"),
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    """Store attributes: the account balance stands for household income, units sold for traffic."""
    traffic = _table(spark, folder, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("units"))
    suppliers = _table(spark, folder, "supplier")
    return suppliers.join(traffic, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
        F.col("s_suppkey").cast("string").alias("store_id"),
        F.col("s_acctbal").alias("avg_hhi"),
        F.coalesce("units", F.lit(0)).cast("double").alias("avg_traffic"),
    )


def _by_week(spark: SparkSession, folder: str, cycle: Cycle, stores: DataFrame | None = None) -> DataFrame:
    """Units of a week, store and product, whether any was discounted, and the mean price paid in cents."""
    cents = F.expr("(2 * paid_sum + 10000 * units) div (20000 * units)")
    return (
        sales(spark, folder, stores)
        .groupBy(week_start(F.col("sale_day"), cycle).alias("week_start"), "store_id", "product_id")
        .agg(
            F.sum("paid").alias("paid_sum"),
            F.count("*").alias("units"),
            F.max("discounted").alias("discounted"),
        )
        .select(
            "week_start",
            "store_id",
            "product_id",
            "units",
            "discounted",
            F.date_format("week_start", "yyyy-MM-dd HH:mm:ss").alias("date"),
            (cents / 100.0).alias("price"),
        )
    )


def price_changes(spark: SparkSession, folder: str, cycle: Cycle = CYCLE) -> DataFrame:
    """The mean price paid per week, store and product, in whole cents.

    Weeks in which no unit was discounted bring no price change.
    """
    changed = _by_week(spark, folder, cycle).where("discounted")
    return changed.select("product_id", "store_id", "date", "price", "week_start")


def priced_weeks(
    spark: SparkSession, folder: str, cycle: Cycle = CYCLE, stores: DataFrame | None = None
) -> DataFrame:
    """Weekly sales with the price change of their week, in one grouping of the sales: of all stores, or of
    those in ``stores``."""
    changed = F.col("discounted")
    return _by_week(spark, folder, cycle, stores).select(
        "week_start",
        "store_id",
        "product_id",
        F.col("units").alias("sales"),
        F.when(changed, F.col("date")).alias("date"),
        F.when(changed, F.col("price")).alias("price"),
    )
