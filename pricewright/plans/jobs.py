"""The three weekly jobs: aggregate sales, train demand, recommend prices.

Each reads and writes under one set of locations and leaves a line in the step time table. They run in
this order; aggregating or recommending the same cycle twice leaves the same data.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.functions.calendar import Cycle, latest
from pricewright.operators import candidates, demand, experiment, features, optimize, reports, sales
from pricewright.sources import dimensions, logs, registry, scratch, tables


@dataclass(frozen=True)
class Locations:
    """Where inputs are and results go. Names of files and folders, and, further down, of
    tables and views."""

    raw: str
    parameters: str
    results: str

    @property
    def sales(self) -> str:
        return f"{self.results}/aggregated_sales_data"

    @property
    def training_rows(self) -> str:
        return f"{self.results}/train_data"

    @property
    def models(self) -> str:
        return f"{self.results}/Models"

    @property
    def recommendations(self) -> str:
        return f"{self.results}/opt_results_data"

    @property
    def exports(self) -> str:
        return f"{self.results}/medium_results"

    @property
    def store_groups(self) -> str:
        return f"{self.parameters}/stores_processed"


def read_cycle(spark: SparkSession, at: Locations, days: int = 7) -> Cycle:
    return dimensions.read_cycle(spark, f"{at.parameters}/processed_time_df.csv", days)


def aggregate(spark: SparkSession, at: Locations, cycle: Cycle, seed: int = 1) -> None:
    """Nested logs of the cycle to weekly sales with attributes and store group."""
    began = time.monotonic()
    products = dimensions.read_products(spark, f"{at.parameters}/products.csv")

    def build() -> DataFrame:
        stores = dimensions.read_stores(spark, f"{at.parameters}/stores.csv")
        return experiment.assign_groups(
            experiment.cluster_stores(stores, seed=seed), seed=str(seed)
        )

    groups = experiment.load_or_assign(spark, at.store_groups, build)
    sold = logs.flatten_sales(
        logs.read_sales_logs(spark, logs.cycle_globs(at.raw, cycle, "sales"))
    )
    prices = logs.flatten_prices(
        logs.read_price_changes(spark, logs.cycle_globs(at.raw, cycle, "prices"))
    )
    table = sales.aggregate(sold, prices, products, experiment.for_join(groups), cycle)
    tables.write_weeks(table, at.sales, cycle)
    written = tables.read_weeks(spark, at.sales).where(F.col(tables.WRITTEN_BY) == F.lit(cycle.start))
    tables.save_weeks_table(written, "df_sales", cycle)
    seconds = time.monotonic() - began
    reports.log_step(spark, "df_time", reports.AGGREGATION, seconds, str(cycle.latest))


def train(
    spark: SparkSession, at: Locations, first_time: bool, seed: int = 1, **settings: int
) -> bool:
    """Fit the forest to all weekly sales. Returns whether it was this run's turn to train."""
    if not registry.should_train(spark, at.models, first_time):
        return False
    began = time.monotonic()
    weekly = sales.add_up(tables.read_weeks(spark, at.sales))
    tables.overwrite(features.price_features(weekly), at.training_rows)
    rows = spark.read.parquet(at.training_rows)
    forest = demand.train(rows, seed, **settings)
    when = registry.model_time(weekly)
    fitted = demand.evaluate(demand.score(forest, rows))
    registry.log_metrics(fitted.withColumn("model_time", when.scalar()), "df_model_performance")
    registry.publish(forest.model, spark, at.models)
    built = when.first()["model_time"]
    reports.log_step(spark, "df_time", reports.TRAINING, time.monotonic() - began, built)
    return True


@dataclass(frozen=True)
class Pricing:
    """Settings of a price search."""

    weeks_ahead: int = 0
    prices: int = candidates.PRICES
    group: tuple[str, ...] = features.GROUP
    allowed: Callable[[Column], Column] | None = None


def recommend(
    spark: SparkSession, at: Locations, cycle: Cycle, settings: Pricing = Pricing()
) -> None:
    """Recommended prices of the treatment stores for the week after the cycle."""
    began = time.monotonic()
    with scratch.job(spark):
        last = sales.add_up(latest(tables.read_weeks(spark, at.sales), cycle))
        offered = candidates.products(experiment.treated(last), cycle, settings.weeks_ahead)
        products = scratch.stage(offered, "products")
        if products.isEmpty():
            raise ValueError(f"no treatment store sold anything in the week of {cycle.latest}")
        model = demand.Forest(registry.load_latest(spark, at.models))
        chosen = optimize.recommend(
            products, model, settings.group, settings.prices, settings.allowed
        )
        tables.write_weeks(chosen, at.recommendations, cycle)
        target = cycle.latest + timedelta(days=cycle.days * (settings.weeks_ahead + 1))
        written = tables.read_weeks(spark, at.recommendations).where(
            (F.col(tables.WRITTEN_BY) == F.lit(cycle.start)) & (F.col("week_start") == F.lit(target))
        )
        tables.export_prices(written, at.exports, cycle)
        tables.save_weeks_table(written, "df_opt", cycle)
    seconds = time.monotonic() - began
    reports.log_step(spark, "df_time", reports.OPTIMIZATION, seconds, str(cycle.latest))
    finished = reports.step_times(tables.read_table(spark, "df_time"))
    tables.save_table(finished, "df_time_final", mode="overwrite")


def views(spark: SparkSession, at: Locations) -> None:
    """Results as views for ad-hoc SQL."""
    tables.register(
        {
            "Aggregated_Sales_Data": sales.add_up(tables.read_weeks(spark, at.sales)),
            "Optimization_Result_Data": tables.read_weeks(spark, at.recommendations),
        }
    )
    # Catalog views, for other sessions as well; a late sale is part of its week's row.
    of_sales = sales.added_up_sql("df_sales", spark.table("df_sales").columns)
    tables.save_view(spark, "Sales_Aggregation", of_sales)
    tables.save_view(spark, "Optimization_Results", "SELECT * FROM df_opt")
    tables.save_view(spark, "Model_Performance", "SELECT * FROM df_model_performance")
