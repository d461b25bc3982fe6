"""Figures shown about sales, forecasts, profit and run times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.sources import tables

# Names of the timed steps.
AGGREGATION = "data_clean_and_aggregation"
TRAINING = "model_training"
OPTIMIZATION = "optimization"
STEP_TIMES = "step string, time double, exec_date string"


def sales_by_price(sales: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean weekly sales at each price: the points of a demand curve."""
    return (
        sales.where(F.col("price").isNotNull())
        .groupBy(*by, "price")
        .agg(F.avg("sales").alias("avg_sales"), F.count("*").alias("weeks"))
    )


def elasticity(sales: DataFrame, by: Sequence[str]) -> DataFrame:
    """Slope of log sales over log price per key that was sold at two or more prices."""
    usable = sales.where((F.col("price") > 0) & (F.col("sales") > 0))
    return (
        usable.groupBy(*by)
        .agg(
            F.regr_slope(F.ln("sales"), F.ln("price")).alias("elasticity"),
            F.count("*").alias("observations"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
        .where(F.col("min_price") < F.col("max_price"))
    )


def mape(chosen: DataFrame, sales: DataFrame) -> DataFrame:
    """Mean absolute percentage error per week of the demand predicted for products then sold."""
    key = ["week_start", "store_id", "product_id"]
    error = F.abs(F.col("sales") - F.col("pred_demand")) / F.col("sales")
    return (
        chosen.select(*key, "pred_demand")
        .join(sales.select(*key, "sales"), key)
        .groupBy("week_start")
        .agg(F.avg(error).alias("mape"), F.count("*").alias("products"))
    )


def _in(group: str, value: Column) -> Column:
    return F.max(F.when(F.col("group_val") == group, value))


def group_weeks(sales: DataFrame) -> DataFrame:
    """Per week and store group: profit and units of an average store, and the mean price.

    Added up per store first, so one large store is only many partial sums.
    """
    by_store = sales.groupBy("week_start", "group_val", "store_id").agg(
        F.sum((F.col("price") - F.col("cost")) * F.col("sales")).alias("profit"),
        F.sum("sales").alias("units"),
        F.sum("price").alias("price_total"),
        F.count("price").alias("priced"),
    )
    return by_store.groupBy("week_start", "group_val").agg(
        F.avg("profit").alias("store_profit"),
        F.avg("units").alias("store_units"),
        F.try_divide(F.sum("price_total"), F.sum("priced")).alias("avg_price"),
        F.count("*").alias("stores"),
    )


def profit_gain(sales: DataFrame) -> DataFrame:
    """Treatment over control per week: profit, units and price, as ratio minus one."""
    sides = (
        group_weeks(sales)
        .groupBy("week_start")
        .agg(
            *[
                _in(group, F.col(measure)).alias(f"{group}_{measure}")
                for measure in ("store_profit", "store_units", "avg_price")
                for group in ("treatment", "control")
            ]
        )
    )

    def gain(measure: str) -> Column:
        return F.try_divide(F.col(f"treatment_{measure}"), F.col(f"control_{measure}")) - 1

    return sides.select(
        "*",
        gain("store_profit").alias("profit_gain"),
        gain("store_units").alias("volume_change"),
        gain("avg_price").alias("price_change"),
    )


def weeks(df: DataFrame) -> DataFrame:
    """Weeks of a table of sales or of recommendations, in order."""
    return df.select("week_start").distinct().orderBy("week_start")


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows; Spark keeps n per task and merges those."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def log_step(spark: SparkSession, table: str, step: str, seconds: float, exec_date: str) -> None:
    log_steps(spark.createDataFrame([(step, float(seconds), exec_date)], STEP_TIMES), table)


def log_steps(lines: DataFrame, table: str, path: str | None = None) -> None:
    """Append lines of (step, time, exec_date)."""
    tables.save_table(lines.select("step", "time", "exec_date"), table, path=path)


def step_times(timings: DataFrame) -> DataFrame:
    """Every step on every date, with time 0 where it did not run; no timing is lost.

    Step names are few by nature; they reach the dates as one array, which replaces a product of two
    tables. A timing whose step or date is null has no place in the grid and stays as it is.
    """
    names = timings.agg(F.array_sort(F.collect_set("step")).alias("steps")).scalar()
    dates = timings.select("exec_date").where("exec_date IS NOT NULL").distinct()
    grid = dates.withColumn("step", F.explode(names))
    return grid.join(timings, ["step", "exec_date"], "full_outer").select(
        "step", "exec_date", F.coalesce("time", F.lit(0.0)).alias("time")
    )
